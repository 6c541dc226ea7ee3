"""What is computed once, and in what amounts."""

from pyspark.sql import functions as F

from echolex.functions.replies import parse_reply
from echolex.operators import scoring
from echolex.plans import registry
from echolex.session import ARROW_BYTES, ARROW_KEY
from echolex.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_reply_is_computed_and_parsed_once(spark):
    text = F.md5(F.col("id").cast("string").cast("binary"))
    reply = F.concat(F.lit('{"sentiment": "'), text, F.lit('", "confidence": 0.25}'))
    got = spark.range(3).select("id", parse_reply(reply).alias("r")).select("id", "r.label", "r.confidence")
    plan = plan_of(got)
    assert plan.count("md5(") == 1 and plan.count("from_json(") == 1
    rows = got.withColumn("want", text).collect()
    assert [(r["label"], r["confidence"]) for r in rows] == [(r["want"], 0.25) for r in rows]


def test_reports_and_their_read_model_use_posts_scored_once(spark, sf_dir):
    base, scored, _ = registry._reports(spark, sf_dir)
    assert "documents.parquet" not in plan_of(scored)
    want = registry._scored(spark, sf_dir)
    assert scored.exceptAll(want).isEmpty() and scored.count() == want.count()
    tables.remove_path(spark, base)


def test_a_model_gets_batches_of_bounded_bytes(spark):
    spark.conf.set(ARROW_KEY, str(256 << 20))
    model = scoring.model_scorer(lambda: lambda texts: ["positive" for _ in texts])
    rows = spark.range(3).selectExpr("string(id) text", "'en' detected_language")
    got = scoring.with_label(rows, model=model)
    assert spark.conf.get(ARROW_KEY) == str(ARROW_BYTES)
    assert [r["sentiment_label"] for r in got.collect()] == ["POSITIVE"] * 3
