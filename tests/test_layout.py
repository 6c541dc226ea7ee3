"""How many files the tables are stored in."""

import pytest

from echolex.plans import registry
from echolex.sources import tables
from echolex.streaming import posts as stream

ONCE = {"availableNow": True}


def of_many_days(spark, n=400):
    """Scored posts, one a day."""
    return spark.range(n).selectExpr(
        "string(id) id", "'text' text", "timestamp_seconds(1704100000 + id * 86400) created_at",
        "if(id % 2 = 0, 'en', 'ko') detected_language", "'NEUTRAL' sentiment_label",
    )


@pytest.mark.parametrize("writers", [1, 3])
def test_a_batch_has_files_by_language_whatever_its_days(spark, tmp_path, writers):
    path = f"{tmp_path}/table"
    rows = of_many_days(spark)
    stream.write_scored_batch(rows, 0, path, writers=writers)
    stored = spark.read.parquet(path)
    assert len(stored.inputFiles()) <= 2 * writers
    assert stored.count() == 400
    assert stored.filter("created_date = date'2024-02-01'").count() == 1
    assert stored.filter("created_date != to_date(created_at)").count() == 0


def test_the_file_sink_has_files_by_language_whatever_its_days(spark, tmp_path):
    rows = of_many_days(spark)
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    scored = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    stream.start_file_sink(scored, f"{tmp_path}/table", f"{tmp_path}/c", ONCE, writers=2).awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/table")
    assert stored.count() == 400 and len(stored.inputFiles()) <= 4


def test_large_batches_come_in_several_files(spark, sf_dir, tmp_path, monkeypatch):
    """More files for more input, in as many batches, with the same rows."""
    monkeypatch.setattr(registry, "FILE_BYTES", 10_000)
    size = tables.stored_bytes(spark, f"{sf_dir}/documents.parquet")
    per_batch = -(-size // (6 * 10_000))
    messages = registry._stream_messages(spark, sf_dir, f"{tmp_path}/x")
    assert per_batch > 1
    assert len(list((tmp_path / "x" / "in").glob("*.parquet"))) == 6 * per_batch
    query = messages.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    query = query.option("checkpointLocation", f"{tmp_path}/c").trigger(**ONCE).start()
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 6
    assert spark.read.parquet(f"{tmp_path}/out").count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_a_log_of_large_input_is_written_by_more_tasks_than_partitions(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registry, "FILE_BYTES", 10_000)
    got = registry.stream_offsets(spark, sf_dir)
    want = registry.scored_posts(spark, sf_dir)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    assert registry.message_sink(spark, sf_dir).count() == got.sparkSession.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_no_task_of_the_message_sink_gets_a_third_of_a_large_input(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "FILE_BYTES", 10_000)
    registry._stream_messages(spark, sf_dir, f"{tmp_path}/x", batches=registry.SINK_FILES)
    rows = [spark.read.parquet(str(f)).count() for f in (tmp_path / "x" / "in").glob("*.parquet")]
    assert len(rows) > 3 * registry.SINK_FILES and max(rows) < sum(rows) / 6


def test_a_batch_written_again_scores_its_own_posts_only(spark, sf_dir, monkeypatch):
    scored = []
    score = registry.score_posts
    monkeypatch.setattr(registry, "score_posts", lambda posts, **o: scored.append(posts.count()) or score(posts, **o))
    got = registry.stream_idempotent(spark, sf_dir)
    assert len(scored) == 1 and 0 < scored[0] < got.count() / 3
