from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from echolex.functions.text import cache_key
from echolex.operators import cache
from echolex.sources.cache_store import CacheStore

NOON = datetime(2024, 3, 10, 12, tzinfo=timezone.utc)
RESULT = "struct<label:string,confidence:double,source:string,text_length:int>"


@pytest.fixture
def store(spark, tmp_path, request):
    name = f"cache_{abs(hash(request.node.name))}"
    yield CacheStore(spark, name, f"{tmp_path}/cache", buckets=4)
    spark.sql(f"DROP TABLE {name}")


def entries(spark, rows):
    """Entries of (text, label, hours before noon)."""
    df = spark.createDataFrame([(t, l, NOON - timedelta(hours=h)) for t, l, h in rows], "text string, label string, at timestamp")
    result = F.struct("label", F.lit(0.5), F.lit("local"), F.length("text")).cast(RESULT)
    return df.select(cache_key(F.col("text")).alias("key"), result.alias("result"), F.col("at").alias("cached_at"))


def posts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def labels(found):
    return {r["id"]: r["result"] and r["result"]["label"] for r in found.collect()}


ROWS = [("x", "OLD", 30), ("y", "Y1", 20), ("y", "Y2", 3), ("z", "GONE", 60), ("w", "W", 1), ("v", "EDGE", 24)]


def test_lookup_equals_the_batch_form(spark, store):
    store.store(entries(spark, ROWS[:4]))
    store.store(entries(spark, ROWS[2:]))
    asked = posts(spark, ["x", "y", "z", "w", "v", "none", None, *["y"] * 50])
    found = labels(store.lookup(asked, NOON, hot_rows=10))
    assert found == labels(cache.lookup_cached(asked, entries(spark, ROWS), NOON))
    assert found[1] == "Y2" and found[3] == "W" and found[4] is None


def test_only_touched_days_are_rewritten(spark, store):
    def files():
        return {r[0] for r in store.entries().select(F.input_file_name()).distinct().collect()}

    store.store(entries(spark, ROWS))
    before = files()
    store.store(entries(spark, [("n", "N", 2), ("w", "W2", 0)]))
    kept = before & files()
    assert kept == {f for f in before if "day=2024-03-10" not in f} and kept
    assert labels(store.lookup(posts(spark, ["w", "n", "y"]), NOON)) == {0: "W2", 1: "N", 2: "Y2"}
    assert store.entries().count() == 7


def test_old_days_go_whole(spark, store):
    store.store(entries(spark, ROWS))
    assert [str(d) for d in store.expire(NOON)] == ["2024-03-08"]
    assert [str(d) for d in store.days()] == ["2024-03-09", "2024-03-10"]
    assert store.entries().count() == 5


def test_empty_and_unusable_entries(spark, store):
    assert labels(store.lookup(posts(spark, ["x"]), NOON)) == {0: None} and store.days() == []
    store.store(entries(spark, ROWS).withColumn("key", F.lit(None).cast("string")))
    store.store(entries(spark, ROWS).limit(0))
    assert store.days() == [] and store.expire(NOON) == []


def test_found_again_under_another_name(spark, store, tmp_path):
    store.store(entries(spark, ROWS))
    other = CacheStore(spark, "cache_again", f"{tmp_path}/cache", buckets=4)
    assert other.entries().count() == 5 + 1
    assert CacheStore(spark, "cache_wider", f"{tmp_path}/cache", buckets=8).entries().count() == 0
    for name in ("cache_again", "cache_wider"):
        spark.sql(f"DROP TABLE {name}")


def test_one_file_a_bucket_of_a_day_written_by_many_tasks(spark, store, monkeypatch):
    """Days and buckets are dealt over more tasks than there are buckets; files stay one a bucket and day."""
    made = []
    repartition = type(store.entries()).repartition
    monkeypatch.setattr(type(store.entries()), "repartition", lambda df, n, *by: made.append(n) or repartition(df, n, *by))
    rows = [(f"t{i}", "L", i % 200) for i in range(400)]
    store.store(entries(spark, rows))
    store.store(entries(spark, rows[:300]))
    assert made == [8, 8] and store.buckets == 4
    days = len(store.days())
    assert days == len({r["day"] for r in store.entries().select("day").distinct().collect()}) == 9
    assert store.entries().count() == 400 and len(store.entries().inputFiles()) <= 4 * days
    assert labels(store.lookup(posts(spark, ["t3", "t5", "t150"]), NOON)) == {0: "L", 1: "L", 2: None}


def test_cache_side_is_not_shuffled(spark, store):
    store.store(entries(spark, ROWS))
    live = store.live(NOON)
    live.collect()
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    found = store.lookup(posts(spark, ["x", "y"]), NOON)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    depth = lines[scan].index("FileScan")
    below_join = []
    for line in reversed(lines[:scan]):
        body = line.lstrip(" :+-")
        if len(line) - len(body) < depth:
            depth = len(line) - len(body)
            below_join.append(body)
            if "SortMergeJoin" in body:
                break
    assert below_join[-1].startswith("SortMergeJoin") or "SortMergeJoin" in below_join[-1]
    assert not any("Exchange" in line for line in below_join)
    assert "PartitionFilters: [isnotnull(day" in lines[scan] or "day#" in lines[scan].split("PartitionFilters:")[1]
