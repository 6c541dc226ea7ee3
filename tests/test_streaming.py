import pytest
from pyspark.sql import functions as F

from echolex.plans.score import score_posts
from echolex.sources.posts import to_messages
from echolex.sources.tables import remove_path
from echolex.sources.testdata import multiscript_posts
from echolex.streaming import posts as stream

ONCE = {"availableNow": True}


@pytest.fixture
def inbox(spark, sf_dir, tmp_path):
    """A folder of message files; `add(part)` puts in half of the documents."""
    rows = multiscript_posts(spark, sf_dir)

    class Inbox:
        path = f"{tmp_path}/in"
        expected = score_posts(rows)

        def add(self, part):
            half = rows.filter((F.col("id") % 2) == part)
            to_messages(half).coalesce(1).write.mode("append").text(self.path)

        def scored(self, **options):
            messages = stream.read_messages_stream(spark, "text", path=self.path, maxFilesPerTrigger=1)
            return stream.score_messages(messages, **options)

    return Inbox()


def rows_of(df):
    return sorted(map(tuple, df.select("id", "created_at", "detected_language", "sentiment_label").collect()))


def run(query):
    query.awaitTermination()
    return query


def test_file_sink_equals_batch_and_restarts(spark, inbox, tmp_path):
    path, checkpoint = f"{tmp_path}/table", f"{tmp_path}/checkpoint"
    inbox.add(0)
    run(stream.start_file_sink(inbox.scored(partitions=4), path, checkpoint, ONCE))
    inbox.add(1)
    run(stream.start_file_sink(inbox.scored(), path, checkpoint, ONCE, writers=2))
    run(stream.start_file_sink(inbox.scored(), path, checkpoint, ONCE))
    assert rows_of(spark.read.parquet(path)) == rows_of(inbox.expected)


def test_batch_sink_replaces_replayed_batches(spark, inbox, tmp_path):
    path, checkpoint = f"{tmp_path}/table", f"{tmp_path}/checkpoint"
    inbox.add(0)
    inbox.add(1)
    listener = stream.MetricsTable(spark, f"{tmp_path}/metrics", "replayed")
    run(stream.start_batch_sink(inbox.scored(), path, checkpoint, trigger=ONCE, name="replayed"))
    listener.finish()
    table = spark.read.parquet(path)
    assert rows_of(table) == rows_of(inbox.expected)
    first = table.filter("batch_id = 0").select(*inbox.expected.columns)
    first.cache().count()
    stream.write_scored_batch(first, 0, path)
    assert rows_of(spark.read.parquet(path)) == rows_of(inbox.expected)
    stream.write_scored_batch(first.limit(0), 99, path)
    assert rows_of(spark.read.parquet(path)) == rows_of(inbox.expected)
    counters = stream.run_counters(stream.stream_metrics(spark, f"{tmp_path}/metrics")).first()
    assert counters["processed_batches"] == 2 and counters["total_records"] == inbox.expected.count()


def test_new_checkpoint_needs_a_new_stream_name(spark, inbox, tmp_path):
    path = f"{tmp_path}/table"
    inbox.add(0)
    run(stream.start_batch_sink(inbox.scored(), path, f"{tmp_path}/c1", trigger=ONCE))
    with pytest.raises(ValueError):
        stream.start_batch_sink(inbox.scored(), path, f"{tmp_path}/c2", trigger=ONCE)
    run(stream.start_batch_sink(inbox.scored(), path, f"{tmp_path}/c2", stream="other", trigger=ONCE))
    assert spark.read.parquet(path).groupBy("stream").count().count() == 2


def test_failing_batch_stops_the_query(spark, inbox, tmp_path):
    inbox.add(0)
    broken = inbox.scored().withColumn("sentiment_label", F.raise_error(F.lit("scorer broke")).cast("string"))
    query = stream.start_file_sink(broken, f"{tmp_path}/table", f"{tmp_path}/c", ONCE)
    with pytest.raises(Exception, match="scorer broke"):
        query.awaitTermination()


def test_repeated_ids_go_and_late_posts_stay(spark, inbox, tmp_path):
    rows = multiscript_posts(spark, "/root/testdata/sf0.001")
    for part in ("cast(id as int) >= 100", "cast(id as int) < 100", "cast(id as int) >= 100"):
        to_messages(rows.filter(part)).coalesce(1).write.mode("append").text(inbox.path)
    scored = inbox.scored(dedup_within="1 hour")
    run(stream.start_file_sink(scored, f"{tmp_path}/table", f"{tmp_path}/c", ONCE))
    assert rows_of(spark.read.parquet(f"{tmp_path}/table")) == rows_of(inbox.expected)


def test_metrics_outlast_the_progress_spark_keeps(spark, inbox, tmp_path):
    rows = to_messages(multiscript_posts(spark, "/root/testdata/sf0.001"))
    rows.repartition(5).write.text(inbox.path)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        listener = stream.MetricsTable(spark, f"{tmp_path}/metrics", "long_run")
        query = stream.start_file_sink(
            inbox.scored(), f"{tmp_path}/table", f"{tmp_path}/c", ONCE, name="long_run"
        )
        run(query)
        listener.finish()
        assert len(query.recentProgress) <= 2
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    counters = stream.run_counters(stream.stream_metrics(spark, f"{tmp_path}/metrics")).first()
    assert counters["processed_batches"] == 5
    assert counters["total_records"] == inbox.expected.count()


def test_unreadable_messages_are_kept(spark, inbox, tmp_path):
    inbox.add(0)
    spark.createDataFrame([("{broken",), ("[1",)], "value string").coalesce(1).write.mode("append").text(inbox.path)
    messages = stream.read_messages_stream(spark, "text", path=inbox.path, maxFilesPerTrigger=1)
    run(stream.start_split_sink(messages, f"{tmp_path}/table", f"{tmp_path}/bad", f"{tmp_path}/c", trigger=ONCE))
    assert sorted(r["value"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()) == ["[1", "{broken"]
    assert spark.read.parquet(f"{tmp_path}/table").count() == inbox.expected.filter("id % 2 = 0").count()


def test_every_committed_batch_has_its_metrics(spark, inbox, tmp_path):
    """Without any listener, and after a batch whose commit was lost."""
    rows = to_messages(multiscript_posts(spark, "/root/testdata/sf0.001"))
    rows.repartition(3).write.text(inbox.path)
    for _ in range(2):
        messages = stream.read_messages_stream(spark, "text", path=inbox.path, maxFilesPerTrigger=1)
        run(
            stream.start_split_sink(
                messages, f"{tmp_path}/table", f"{tmp_path}/bad", f"{tmp_path}/c", trigger=ONCE, metrics=f"{tmp_path}/m"
            )
        )
        remove_path(spark, f"{tmp_path}/c/commits/2")
    found = stream.stream_metrics(spark, f"{tmp_path}/m")
    assert sorted(r["batch_id"] for r in found.collect()) == [0, 1, 2]
    assert found.filter("seconds > 0 and processed_rows_per_second > 0").count() == 3
    counters = stream.run_counters(found).first()
    assert counters["processed_batches"] == 3 and counters["total_records"] == inbox.expected.count()
    assert found.agg(F.sum("input_rows")).first()[0] == rows.count()


def test_kafka_defaults():
    options = stream.source_options("kafka", {"subscribe": "posts"})
    assert options == {"failOnDataLoss": "true", "startingOffsets": "earliest", "subscribe": "posts"}
    assert stream.source_options("kafka", stream.LIVE_OPTIONS) == stream.LIVE_OPTIONS
    assert stream.source_options("text", {"maxFilesPerTrigger": 1}) == {"maxFilesPerTrigger": 1}
