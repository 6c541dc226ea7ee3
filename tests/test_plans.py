"""Physical plans: what must and must not be in them."""

import pytest

import __spark_entry__ as entry
from echolex.plans.registry import QUERIES
from echolex.plans.score import score_posts
from echolex.sources.posts import parse_posts, to_messages
from echolex.sources.testdata import posts

WITH_PYTHON = {"model_score"}
WITH_ACTIONS = {
    "partitioned_read", "merged_read", "written_formats", "report_store", "read_model", *[n for n in QUERIES if n.startswith("stream_")],
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITH_ACTIONS))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in WITH_PYTHON:
        assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_messages_are_parsed_once(spark, sf_dir):
    scored = score_posts(parse_posts(to_messages(posts(spark, sf_dir))))
    assert plan_of(scored).count("from_json") == 1


def test_rejects_are_counted_over_one_decoding(spark, sf_dir):
    plan = plan_of(QUERIES["json_rejects"](spark, sf_dir))
    assert plan.count("from_json") == 1 and plan.count("FileScan") == 1


def test_distinct_texts_are_shuffled_without_the_text_as_key(spark, sf_dir):
    plan = plan_of(QUERIES["score_distinct"](spark, sf_dir))
    assert "hashpartitioning(text_key" in plan and ", text#" not in "".join(
        line for line in plan.splitlines() if "Exchange hashpartitioning" in line
    )


def test_scoring_a_scan_needs_no_shuffle(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "cast(doc_id as string) id", "null title", "text", "1d created_utc", "source author_name",
        "'submission' type", "'' submission_id", "'' parent_id",
    )
    plan = plan_of(score_posts(table))
    assert "Exchange" not in plan and "IsNotNull(text)" in plan


def test_groups_are_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry.queries()["latest_per_language"](spark, sf_dir))
    assert plan.index("Exchange hashpartitioning(lang_bucket") < plan.index("10, Partial")


def test_recency_reaches_the_scan(spark, sf_dir, tmp_path):
    from echolex.operators.cleaning import recent

    df = spark.createDataFrame([("2024-01-01",)], "s string").selectExpr("cast(s as timestamp) created_at")
    df.write.parquet(f"{tmp_path}/t")
    plan = plan_of(recent(spark.read.parquet(f"{tmp_path}/t"), "2024-01-01 12:00:00"))
    assert "GreaterThanOrEqual(created_at" in plan
