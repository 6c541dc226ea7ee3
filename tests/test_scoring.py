"""Models, scoring per distinct text, cache, skew helpers, rankings."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from echolex.functions.text import cache_key
from echolex.operators import cache, ranking, scoring
from echolex.operators.skew import hot_keys, lookup_join, top_per_group
from echolex.plans.score import score_posts
from echolex.schemas import CACHE_SCHEMA, SCORED_SCHEMA

AS_OF = datetime(2024, 1, 2)


def posts(spark, texts):
    rows = [(str(i), None, t, 1704067200.0 + i, "u", "submission", str(i), None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id string, title string, text string, created_utc double,"
                                 " author_name string, type string, submission_id string, parent_id string")


def labels(df):
    return {r["id"]: r["sentiment_label"] for r in df.collect()}


def test_score_posts_columns_and_labels(spark):
    scored = score_posts(posts(spark, ["a good day it is", "정말 최고 좋은 하루입니다 오늘", "short", None]))
    assert scored.columns == SCORED_SCHEMA.names
    got = {r["id"]: (r["detected_language"], r["sentiment_label"]) for r in scored.collect()}
    assert got == {"0": ("en", "POSITIVE"), "1": ("ko", "POSITIVE")}


def test_whole_text_unless_cut(spark):
    text = "x " * 600 + "good"
    assert labels(score_posts(posts(spark, [text]))) == {"0": "POSITIVE"}
    assert labels(score_posts(posts(spark, [text]), max_chars=1000)) == {"0": "NEUTRAL"}


def test_model_with_fallback(spark):
    def factory():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("model failed")
            return ["5_STARS" if "many" in t else None for t in texts]

        return predict

    texts = ["many words in here", "boom and a good day", "boom and nothing else", "some bad words here"]
    scored = score_posts(posts(spark, texts), model=scoring.model_scorer(factory))
    assert labels(scored) == {"0": "POSITIVE", "1": "POSITIVE", "2": "NEUTRAL", "3": "NEGATIVE"}


def test_model_failures_are_marked_and_end_the_job_over_a_share(spark):
    def factory():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("model failed")
            return ["5_STARS" for _ in texts]

        return predict

    texts = ["plain words in here" if i % 3 else "boom and a bad day" for i in range(900)]
    rows = posts(spark, texts).coalesce(1)
    scored = score_posts(rows, model=scoring.model_scorer(factory), status="failed").cache()
    assert scored.filter("failed").count() == 300
    assert scored.filter("failed and sentiment_label = 'NEGATIVE'").count() == 300
    strict = score_posts(rows, model=scoring.model_scorer(factory, max_failed_share=0.2))
    with pytest.raises(Exception, match="the model failed on"):
        strict.write.format("noop").mode("overwrite").save()


def test_lexicons_of_the_caller(spark):
    rows = posts(spark, ["очень хорошо сегодня", "это плохо сегодня", "just a superb day"])
    own = {"ru": (("хорошо",), ("плохо",)), "en": (("superb",), ("dull",))}
    assert labels(score_posts(rows, lexicons=own)) == {"0": "POSITIVE", "1": "NEGATIVE", "2": "POSITIVE"}
    assert labels(score_posts(rows)) == {"0": "NEUTRAL", "1": "NEUTRAL", "2": "NEUTRAL"}


def test_score_distinct_keeps_every_row(spark):
    pick = random.Random(3)
    texts = ["good copy"] * 300 + [pick.choice(["bad one", "so so", None]) for _ in range(100)]
    rows = posts(spark, texts)
    for hot_rows in (10, 1000):
        got = labels(scoring.score_distinct(rows, scoring.label_texts, hot_rows=hot_rows))
        expected = {"good copy": "POSITIVE", "bad one": "NEGATIVE", "so so": "NEUTRAL", None: "NEUTRAL"}
        assert got == {str(i): expected[t] for i, t in enumerate(texts)}


def test_lookup_join_salts_hot_keys(spark):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"))
    rows = rows.unionByName(spark.createDataFrame([(5000, None)], "id long, key string"))
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("unused", 3)], "key string, v int")
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    assert [tuple(r) for r in hot_keys(counts, "key", hot_rows=100).collect()] == [("hot", 4)]
    got = {r["id"]: r["v"] for r in lookup_join(rows, table, "key", "id", hot_rows=100).collect()}
    assert len(got) == 1001 and got[5000] is None
    assert all(got[i] == 1 for i in range(400))
    assert all(got[i] == (2 if i % 7 == 1 else None) for i in range(400, 1000))


def test_null_keys_are_spread(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "k").alias("key"))
    table = spark.createDataFrame([("k", 1)], "key string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(rows, table, "key", "id", hot_rows=10)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 1000 and max(sizes) <= 2 * 1000 / 8


def entry(key, label, hours_ago):
    return (key, (label, 0.6, "local", 1), AS_OF - timedelta(hours=hours_ago))


def test_cache_lookup_and_split(spark):
    rows = posts(spark, ["one", "two", "three", "one", None])
    keys = [r["k"] for r in rows.select(cache_key(F.col("text")).alias("k")).collect()]
    stored = spark.createDataFrame(
        [entry(keys[0], "OLD", 5), entry(keys[0], "NEW", 1), entry(keys[1], "EXPIRED", 24), entry("other", "X", 1)],
        CACHE_SCHEMA,
    )
    hits, misses = cache.split_cached(rows, stored, AS_OF, hot_rows=1)
    assert {r["id"]: r["result"]["label"] for r in hits.collect()} == {"0": "NEW", "3": "NEW"}
    assert {r["id"] for r in misses.collect()} == {"1", "2", "4"}


def test_evict_keeps_newest_per_key(spark):
    stored = spark.createDataFrame([entry("a", "1", 1), entry("a", "2", 9), entry("b", "3", 2), entry("c", "4", 3)], CACHE_SCHEMA)
    assert [r["key"] for r in cache.evict(stored, 2).collect()] == ["a", "b"]


def test_top_per_group_small_and_large_n(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).alias("g"), (F.col("id") * 7919 % 3001).alias("v"), "id")
    for n in (5, 1500):
        got = top_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], n, "id").collect()
        for g in (True, False):
            every = sorted([(-(i * 7919 % 3001), i) for i in range(3000) if (i % 3 == 0) is g])[:n]
            assert sorted((-r["v"], r["id"]) for r in got if r["g"] is g) == every


def test_latest_per_bucket_and_cap(spark):
    rows = [(str(i), START + timedelta(seconds=i), ("ko", "en", "ja", None)[i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, created_at timestamp, detected_language string")
    got = ranking.latest_per_bucket(df, 3).collect()
    assert sorted((r["lang_bucket"], int(r["id"])) for r in got) == [
        ("en", 29), ("en", 33), ("en", 37), ("ko", 28), ("ko", 32), ("ko", 36), ("other", 35), ("other", 38), ("other", 39),
    ]
    capped = ranking.cap_per_window(df, "detected_language", "created_at", 2, "id", "20 seconds")
    assert capped.count() == 16
    assert [r["id"] for r in ranking.newest(df).limit(2).collect()] == ["39", "38"]


START = datetime(2024, 1, 1)
