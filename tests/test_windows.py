"""The stateful operators of streams against their batch counterparts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from echolex.operators import ranking
from echolex.streaming import windows as W

START = datetime(2024, 1, 1)
SCHEMA = "who string, ts timestamp, id long, _note string, part int, big long"


def at(minutes):
    return START + timedelta(minutes=minutes)


@pytest.fixture
def run(spark, tmp_path):
    """Stream rows part by part through an operator; `again` starts the query anew before the last part."""

    def go(rows, build, again=False):
        df = spark.createDataFrame(rows, SCHEMA)
        parts = sorted({r[4] for r in rows})

        def start():
            stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
            with W.stateful_session(spark):
                out = build(stream)
                writer = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
                writer.option("path", f"{tmp_path}/out").trigger(availableNow=True).start().awaitTermination()
            return out.schema

        for part in parts:
            df.filter(F.col("part") == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            if again or part == parts[-1]:
                schema = start()
        return spark.read.schema(schema).parquet(f"{tmp_path}/out")

    return go


def cap(limit, **options):
    return lambda df: W.cap_stream(df, "who", "ts", limit, "id", **options)


def ordered_rows(n=400):
    """Rows in the order of time, every other one of one key, with null keys and equal times."""
    return [
        ("hot" if i % 2 else [None, "a", "b"][i % 3], at(i // 5 * 0.25), i, f"n{i}", i // 100, None if i % 7 else 2**60 + i)
        for i in range(n)
    ]


@pytest.mark.parametrize("limit, again", [(1, False), (3, True)])
def test_cap_equals_the_batch_form(spark, run, limit, again):
    rows = ordered_rows()
    got = run(rows, cap(limit), again)
    expected = ranking.cap_per_window(spark.createDataFrame(rows, SCHEMA), "who", "ts", limit, "id", "1 minute")
    assert sorted(got.columns) == sorted(expected.columns)
    found = sorted(map(str, got.select(expected.columns).collect()))
    assert found == sorted(map(str, expected.collect()))
    assert max(r["n"] for r in got.groupBy("who", "window_start").agg(F.count("*").alias("n")).collect()) == limit


def test_cap_of_unordered_and_late_rows(run):
    rows = [
        ("a", at(10.5), 1, "-", 0, 1),
        ("a", at(10.2), 2, "-", 1, 1),  # earlier, but its window is full
        ("a", None, 3, "-", 1, 1),
        ("a", at(100), 4, "-", 2, 1),
        ("b", at(10.2), 5, "-", 3, 1),  # behind the new watermark, not behind that of the batch before
        ("a", at(100.1), 6, "-", 3, 1),
        ("c", at(10.2), 7, "-", 4, 1),  # behind both
        ("a", at(10.7), 8, "-", 4, 1),  # likewise; its window's count is gone by now
    ]
    assert sorted(r["id"] for r in run(rows, cap(1)).collect()) == [1, 4, 5]


def test_cap_ties_go_by_number(run):
    rows = [("a", at(1), i, "-", 0, 1) for i in (10, 9, 100)]
    assert sorted(r["id"] for r in run(rows, cap(2)).collect()) == [9, 10]


def test_silent_hours(run):
    rows = [
        ("a", at(5), 1, "-", 0, 1),
        ("a", at(65), 2, "-", 0, 1),
        ("b", at(70), 3, "-", 0, 1),
        (None, at(70), 4, "-", 0, 1),
        ("a", at(60 * 4 + 30), 5, "-", 1, 1),
        ("b", None, 6, "-", 1, 1),
        ("a", at(60 * 6 + 20), 7, "-", 2, 1),
        ("a", at(60 * 6 + 25), 8, "-", 2, 1),
    ]
    found = run(rows, lambda df: W.freshness_stream(df, "who", "ts"), again=True).collect()
    shown = sorted((r["who"], r["window_start"].hour, r["n"], r["ok"]) for r in found)
    a = [("a", h, n, n > 0) for h, n in enumerate((1, 1, 0, 0, 1, 0))]
    b = [("b", h, n, n > 0) for h, n in zip(range(1, 6), (1, 0, 0, 0, 0))]
    assert shown == a + b


def test_empty_stream(run, spark, tmp_path):
    rows = [("a", None, 1, "-", 0, 1)]
    assert run(rows, cap(1)).count() == 0
