import pytest
from pyspark.sql import functions as F

from echolex.operators.cleaning import latest_time
from echolex.plans import incremental as I
from echolex.plans.report import daily_report
from echolex.plans.score import score_posts
from echolex.sources import tables, testdata
from echolex.streaming import posts as stream


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return score_posts(testdata.multiscript_posts(spark, sf_dir)).cache()


def shown(report):
    return [(r["report_date"], round(r["average_sentiment_score"], 9), r["top_keywords"]) for r in report.collect()]


def store(scored, path, batches=3):
    for batch in range(batches):
        I.write_report_states(scored.filter(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch), batch, path)


def windows(scored):
    """Last times of windows over the whole table, and one long before and after it."""
    for hours in (0, 7, 20, 31, 2000, -3000):
        yield latest_time(scored) - F.expr(f"INTERVAL {hours} HOURS")


@pytest.mark.parametrize("mode", ["rolling", "calendar"])
def test_equals_the_report_over_any_window(spark, scored, tmp_path, mode):
    store(scored, f"{tmp_path}/states")
    states = I.read_states(spark, f"{tmp_path}/states")
    for as_of in windows(scored):
        assert shown(I.incremental_report(states, as_of, mode)) == shown(daily_report(scored, as_of, mode))


def test_repeated_batches_replace_their_states(spark, scored, tmp_path):
    path = f"{tmp_path}/states"
    store(scored, path)
    before = sorted(map(str, I.read_states(spark, path).collect()))
    I.write_report_states(scored.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == 1), 1, path)
    assert sorted(map(str, I.read_states(spark, path).collect())) == before
    I.write_report_states(scored.limit(0), 7, path)
    assert sorted(map(str, I.read_states(spark, path).collect())) == before


def test_days_can_be_merged(spark, scored, tmp_path):
    path, as_of = f"{tmp_path}/states", latest_time(scored)
    store(scored, path)
    want = shown(I.incremental_report(I.read_states(spark, path), as_of))
    for day in ("2024-01-01", "2024-01-02"):
        I.merge_states(spark, path, day)
        states = I.read_states(spark, path)
        assert shown(I.incremental_report(states, as_of)) == want
        assert states.filter(F.col("created_date") == day).select("batch_id").distinct().collect()[0][0] == -1


def test_reports_read_states_only(spark, scored, tmp_path):
    store(scored, f"{tmp_path}/states", 1)
    report = I.incremental_report(I.read_states(spark, f"{tmp_path}/states"), "2024-01-02 00:00:00")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "selftext" not in plan and "sentiment_label" not in plan
    physical = report._jdf.queryExecution().executedPlan().toString()
    pruned = [x.split("]")[0] for x in physical.split("PartitionFilters: [")[1:]]
    assert pruned and all("kind" in x and "created_date" in x for x in pruned)


def test_null_times_no_posts_and_odd_windows(spark, scored, tmp_path):
    assert I.incremental_report(I.read_states(spark, f"{tmp_path}/absent"), "2024-01-02").count() == 0
    timeless = scored.withColumn("created_at", F.lit(None).cast("timestamp"))
    assert I.report_states(timeless).count() == 0
    store(scored, f"{tmp_path}/states", 1)
    with pytest.raises(Exception, match="not at the begin of a minute"):
        I.incremental_report(I.read_states(spark, f"{tmp_path}/states"), "2024-01-02 00:00:30").collect()


def test_a_batch_has_files_by_month_whatever_its_days(spark, tmp_path):
    path = f"{tmp_path}/states"
    scored = spark.range(400).selectExpr(
        "string(id) id", "concat('text word', id) text", "timestamp_seconds(1704100000 + id * 86400) created_at",
        "'en' detected_language", "'NEUTRAL' sentiment_label",
    )
    for batch in range(2):
        I.write_report_states(scored.filter(f"id % 2 = {batch}"), batch, path)
    states = I.read_states(spark, path)
    assert len(states.inputFiles()) <= 2 * 2 * 14
    assert states.filter("kind = 'posts'").count() == 400
    assert states.filter("created_date != to_date(bucket)").count() == 0
    before = sorted(map(tuple, states.select("kind", "bucket", "word", "n").collect()), key=str)
    for day in ("2024-01-01", "2024-01-05", "2024-02-01"):
        I.merge_states(spark, path, day)
        states = I.read_states(spark, path)
        assert [r[0] for r in states.filter(F.col("created_date") == day).select("batch_id").distinct().collect()] == [-1]
        assert sorted(map(tuple, states.select("kind", "bucket", "word", "n").collect()), key=str) == before


def rows(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).select("id").collect())


def test_staged_batches_are_not_seen(spark, scored, tmp_path):
    path = f"{tmp_path}/table"
    part = scored.filter("cast(id as int) < 50")
    stream.write_scored_batch(part, 0, path)
    before = rows(spark, path)
    staged = tables.staged_folder(path, "posts-0")
    stream.stage_scored_batch(scored, staged)
    assert rows(spark, path) == before
    tables.commit_folder(spark, staged, stream.batch_folder(path, "posts", 0))
    assert len(rows(spark, path)) == scored.count()
    assert not [p for p in tmp_path.rglob("*") if "_replaced" in p.name or p.name.startswith("posts-0")]


def test_a_failed_write_leaves_no_trace(spark, scored, tmp_path):
    path = f"{tmp_path}/table"
    stream.write_scored_batch(scored, 0, path)
    before = sorted(map(str, tmp_path.rglob("*.parquet")))
    with pytest.raises(Exception, match="lost"):
        stream.write_scored_batch(scored.withColumn("text", F.raise_error(F.lit("lost")).cast("string")), 1, path)
    assert sorted(map(str, tmp_path.rglob("*.parquet"))) == before


def test_a_broken_off_commit_is_undone(spark, scored, tmp_path):
    path = f"{tmp_path}/table"
    stream.write_scored_batch(scored, 0, path)
    before = rows(spark, path)
    folder = tmp_path / "table" / "stream=posts"
    (folder / "batch_id=0").rename(folder / "_replaced-batch_id=0")  # as a commit does first
    tables.recover_folders(spark, str(folder))
    assert rows(spark, path) == before
    (folder / "_replaced-batch_id=0").mkdir()
    tables.recover_folders(spark, str(folder))
    assert rows(spark, path) == before and not (folder / "_replaced-batch_id=0").exists()
