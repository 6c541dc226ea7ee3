import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from echolex.plans.score import score_posts
from echolex.schemas import POST_SCHEMA, SCORED_SCHEMA
from echolex.sources import posts as P
from echolex.sources import tables, testdata


def test_messages_keep_nulls_and_round_trip(spark, sf_dir):
    rows = testdata.posts(spark, sf_dir).limit(5)
    messages = P.to_messages(rows)
    assert json.loads(messages.first()["value"])["title"] is None
    back = P.parse_posts(messages.select(F.col("value").cast("binary").alias("value")))
    assert back.columns == POST_SCHEMA.names
    assert back.exceptAll(rows.select(back.columns)).isEmpty()


def test_malformed_messages(spark):
    values = [('{"id": "a", "text": "hello", "created_utc": 1.5}',), ("{broken",), (None,)]
    messages = spark.createDataFrame(values, "value string")
    assert [r["id"] for r in P.parse_posts(messages).collect()] == ["a", None, None]
    good, bad = P.split_messages(messages)
    assert [r["id"] for r in good.collect()] == ["a", None]
    assert [r["value"] for r in bad.collect()] == ["{broken"]


def test_union_of_sources(spark):
    submissions = spark.createDataFrame(
        [("s1", "Title", "body", 1.0, "ann"), ("s2", "Title", " 　", 2.0, "ann")],
        "id string, title string, selftext string, created_utc double, author string",
    )
    comments = spark.createDataFrame(
        [("c1", "reply", 3.0, "bob", "s1", "t3_s1"), ("c2", None, 3.0, "bob", "s1", "t3_s1")],
        "id string, body string, created_utc double, author string, submission_id string, parent_id string",
    )
    got = sorted(tuple(r) for r in P.union_posts(submissions, comments).collect())
    assert got == [
        ("c1", None, "reply", 3.0, "bob", "comment", "s1", "t3_s1"),
        ("s1", "Title", "body", 1.0, "ann", "submission", "s1", None),
    ]


def test_read_or_empty(spark, tmp_path):
    assert tables.read_or_empty(spark, f"{tmp_path}/absent").schema == SCORED_SCHEMA
    (tmp_path / "empty").mkdir()
    assert tables.read_or_empty(spark, f"{tmp_path}/empty").count() == 0
    spark.createDataFrame([("1", "x")], "id string, text string").write.parquet(f"{tmp_path}/t/a")
    assert tables.read_or_empty(spark, f"{tmp_path}/t/a").first()["sentiment_label"] is None


def test_files_with_different_columns(spark, tmp_path):
    spark.createDataFrame([("1", "x")], "id string, text string").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([("2", 3)], "id string, n int").write.parquet(f"{tmp_path}/b")
    df = tables.read_table(spark, f"{tmp_path}/a", f"{tmp_path}/b", merge_schema=True)
    assert sorted(df.columns) == ["id", "n", "text"] and df.count() == 2


def test_describe_and_sample(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    assert [tuple(r) for r in tables.describe_table(df).collect()] == [("n", "int"), ("s", "string")]
    assert tables.sample_rows(df, 1, ["n"]).first()["s"] == "a"
    assert tables.sample_rows(df, 1).count() == 1


def test_partitioned_write_prunes_and_compacts(spark, sf_dir, tmp_path):
    scored = score_posts(testdata.multiscript_posts(spark, sf_dir))
    path = f"{tmp_path}/scored"
    for _ in range(2):
        tables.write_scored(scored, path, compression="zstd")
    kept = tables.read_scored(spark, path, datetime(2024, 1, 2), ["ko", "ru"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "created_date" in filters and "detected_language" in filters
    assert kept.select("detected_language").distinct().count() == 2


def test_spread_only_when_asked(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert tables.spread(df, 5).rdd.getNumPartitions() == 5
    assert tables.spread(df) is df


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path):
    path = f"{tmp_path}/zones"
    rows = spark.range(1).selectExpr("'a' id", "timestamp_seconds(1704139200) created_at", "'en' detected_language")
    tables.write_scored(rows, path)  # 2024-01-01 20:00 UTC
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        since = F.timestamp_seconds(F.lit(1704135600))
        kept = tables.read_scored(spark, path, since)
        assert kept.count() == 1
        assert "PartitionFilters: [isnotnull(created_date" in kept._jdf.queryExecution().executedPlan().toString()
        tables.write_scored(rows, path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["created_date"].isoformat() for r in spark.read.parquet(path).collect()] == ["2024-01-01"] * 2


def test_compaction_keeps_rows_and_other_days(spark, tmp_path):
    path = f"{tmp_path}/table"
    rows = spark.range(40).selectExpr(
        "string(id) id", "timestamp_seconds(1704100000 + id % 2 * 86400) created_at", "'en' detected_language"
    )
    for part in range(4):
        tables.write_scored(rows.filter(f"id % 4 = {part}").coalesce(1), path)
    before = spark.read.parquet(path).inputFiles()
    tables.compact(spark, path, "2024-01-01")
    after = spark.read.parquet(path)
    assert sorted(int(r["id"]) for r in after.collect()) == list(range(40))
    assert len([f for f in after.inputFiles() if "2024-01-01" in f]) == 1
    assert {f for f in before if "2024-01-02" in f} == {f for f in after.inputFiles() if "2024-01-02" in f}


@pytest.mark.parametrize("name", ["documents", "events"])
def test_adapters_keep_every_row(spark, sf_dir, name):
    n = spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
    build = {"documents": testdata.multiscript_posts, "events": testdata.error_events}[name]
    assert build(spark, sf_dir).count() == n


def test_write_messages_to_a_file_sink(spark, sf_dir, tmp_path):
    rows = testdata.posts(spark, sf_dir)
    P.write_messages(rows, fmt="text", path=f"{tmp_path}/messages")
    back = P.parse_posts(spark.read.text(f"{tmp_path}/messages"))
    assert back.exceptAll(rows.select(back.columns)).isEmpty() and back.count() == rows.count()
