"""The streaming scorer: source, sinks, metrics."""

import threading
import time
from datetime import datetime, timezone

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from echolex.operators.distribution import observed_counts
from echolex.plans.score import score_posts
from echolex.sources import message_log
from echolex.sources.posts import split_messages, split_tagged, tagged_posts
from echolex.sources.tables import (
    commit_folder,
    path_exists,
    recover_folders,
    remove_path,
    staged_folder,
    with_created_date,
)

# Nothing is skipped or capped by default: all messages from the first on, and an
# error when messages expired before they were read.
KAFKA_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}
# For a live view that may skip messages: newest first, at most 1,000 a trigger.
LIVE_OPTIONS = {
    "failOnDataLoss": "false",
    "startingOffsets": "latest",
    "maxOffsetsPerTrigger": "1000",
}
TRIGGER = "30 seconds"
# Folders of the streamed tables.
STREAM_PARTITIONS = ("detected_language",)


def source_options(fmt, options):
    """Source options with the defaults of the format filled in.

    `minPartitions` is worth setting for a topic with few partitions: it lets
    several tasks read and score one partition.
    """
    defaults = KAFKA_OPTIONS if fmt == "kafka" else {}
    return {**defaults, **options}


def read_messages_stream(spark, fmt="kafka", schema="value string", path=None, **options):
    """Stream of messages with a `value` column. Kafka needs its connector.

    `message_log` reads a log of `echolex.sources.message_log` by offsets, with
    a cap on the messages of a batch.
    """
    if fmt == "message_log":
        message_log.register(spark)
    reader = spark.readStream.format(fmt).options(**source_options(fmt, options))
    if fmt not in ("kafka", "message_log"):
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def score_messages(messages, partitions=None, dedup_within=None, **score_options):
    """Messages to scored posts; unreadable messages are left out, see `start_split_sink`.

    `partitions` deals the messages of a batch over that many tasks first, for
    sources that deliver a batch in one or a few tasks.
    `dedup_within` (e.g. "1 hour") drops a repeated post id that arrives within
    that time, for sources that may send twice. The time is that of arrival, so
    an old post that comes late is kept. Off by default.
    """
    if partitions:
        messages = messages.repartition(partitions)
    posts, _ = split_messages(messages)
    scored = score_posts(posts, **score_options)
    if dedup_within:
        arrived = scored.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", dedup_within)
        scored = arrived.dropDuplicatesWithinWatermark(["id"]).drop("_arrived")
    return scored


def _trigger(writer, trigger):
    return writer.trigger(**(trigger or {"processingTime": TRIGGER}))


def gather(scored, writers=None):
    """Bring rows of one language together before a partitioned write.

    A stream's folders are its languages, of which there are few, and the day is
    a column of the files: a batch may hold posts of any number of days, and a
    folder for each would cost a file for every few rows. A folder's rows are
    dealt by post id over `writers` tasks, so one large language is not left to
    a single task; the default is a sixteenth of the shuffle partitions. So a
    batch writes at most `writers` files per language. Where adaptive execution
    is on in a stateless query, it joins small writers again.
    """
    if writers is None:
        writers = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16
    salt = F.pmod(F.xxhash64("id"), F.lit(max(1, writers)))
    return with_created_date(scored).repartition(*map(F.col, STREAM_PARTITIONS), salt)


def drain(query):
    """Wait until a stream has read all its source holds, in as many batches as its cap needs.

    Spark's own wait ends with what the source offers at once, one batch of a
    capped source.
    """
    unchanged, last = 0, None
    while unchanged < 3:
        query.processAllAvailable()
        now = (query.lastProgress or {"batchId": None})["batchId"]
        unchanged, last = (unchanged + 1 if now == last else 0), now


def _named(writer, name):
    return writer.queryName(name) if name else writer


def start_file_sink(
    scored, path, checkpoint, trigger=None, compression="snappy", writers=None, name=None
):
    """Append scored posts to a partitioned Parquet table, exactly once.

    The file sink keeps its own log of committed files in the table folder;
    `checkpoint` must lie outside of it.
    """
    writer = (
        gather(scored.observe("posts", *observed_counts()), writers)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*STREAM_PARTITIONS)
        .option("compression", compression)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return _trigger(_named(writer, name), trigger).start()


def stage_scored_batch(batch, staged, compression="snappy", writers=None):
    """Write one micro-batch into a folder beside the table, where readers do not see it.

    Files are sorted by day, so a read of some days skips the pages of others.
    """
    (
        gather(batch, writers)
        .sortWithinPartitions(*STREAM_PARTITIONS, "created_date")
        .write.option("compression", compression)
        .partitionBy(*STREAM_PARTITIONS)
        .parquet(staged)
    )


def batch_folder(path, stream, batch_id):
    return f"{path}/stream={stream}/batch_id={batch_id}"


def write_scored_batch(batch, batch_id, path, stream="posts", compression="snappy", writers=None):
    """Write one micro-batch into its own folder, replacing what is there.

    A replayed batch therefore replaces its rows and never doubles them. The
    rows are written beside the table and moved in whole; until then readers
    find what was there before, and a write that fails leaves nothing. No
    emptiness test is needed: an empty batch writes no data file.
    """
    spark = batch.sparkSession
    staged = staged_folder(path, f"{stream}-{batch_id}")
    try:
        stage_scored_batch(batch, staged, compression, writers)
        commit_folder(spark, staged, batch_folder(path, stream, batch_id))
    finally:
        remove_path(spark, staged)


def start_batch_sink(
    scored, path, checkpoint, stream="posts", trigger=None, compression="snappy", writers=None, name=None
):
    """Write through `write_scored_batch`; failures stop the query, and the
    checkpoint replays the batch.

    Batch numbers restart with a new checkpoint and would overwrite older
    folders of the same `stream` name, so that combination is refused.
    """
    spark = scored.sparkSession
    recover_folders(spark, f"{path}/stream={stream}")
    used = path_exists(spark, f"{path}/stream={stream}")
    if used and not path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"stream {stream!r} has data in {path}: new checkpoints need a new stream name")
    writer = (
        scored.observe("posts", *observed_counts())
        .writeStream.outputMode("append")
        .foreachBatch(
            lambda batch, batch_id: write_scored_batch(
                batch, batch_id, path, stream, compression, writers
            )
        )
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(_named(writer, name), trigger).start()


def start_split_sink(
    messages, path, rejects_path, checkpoint, stream="posts", trigger=None, metrics=None, **score_options
):
    """Score messages and keep the unreadable ones, both from one decoding.

    Each micro-batch is decoded once and kept while its two sides are written:
    posts through `write_scored_batch`, rejects into their own folder by batch
    number, so that a replayed batch replaces both.

    With `metrics` a row of counts of each batch goes to a table there before
    the batch is committed, so every committed batch has its row, whatever
    becomes of the driver; `stream_metrics` reads it.
    """
    spark = messages.sparkSession
    recover_folders(spark, f"{path}/stream={stream}")

    def write(batch, batch_id):
        started = time.time()
        tagged = tagged_posts(batch).persist()
        try:
            posts, rejects = split_tagged(tagged)
            counts = Observation()
            scored = score_posts(posts, **score_options).observe(counts, *observed_counts())
            write_scored_batch(scored, batch_id, path, stream)
            rejects.write.mode("overwrite").parquet(f"{rejects_path}/stream={stream}/batch_id={batch_id}")
            if metrics:
                write_batch_metrics(batch, batch_id, metrics, stream, started, tagged.count(), counts.get)
        finally:
            tagged.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def write_batch_metrics(batch, batch_id, path, stream, started, input_rows, counts):
    """Store the row of one batch: its counts, when it began (epoch seconds) and how long it took."""
    spark = batch.sparkSession
    seconds = time.time() - started
    began = datetime.fromtimestamp(started, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    rate = input_rows / seconds
    row = (batch_id, began, seconds, input_rows, None, rate, *[counts.get(n) for n in COUNTED])
    staged = staged_folder(path, f"{stream}-{batch_id}")
    spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1).write.parquet(staged)
    commit_folder(spark, staged, f"{path}/stream={stream}/batch={batch_id}")


COUNTED = ("records", "positive", "negative", "neutral")
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("records", T.LongType()),
        T.StructField("positive", T.LongType()),
        T.StructField("negative", T.LongType()),
        T.StructField("neutral", T.LongType()),
    ]
)


def _metric_row(progress):
    observed = progress.observedMetrics.get("posts")
    counts = observed.asDict() if observed is not None else {}
    return (
        progress.batchId,
        progress.timestamp,
        progress.durationMs.get("triggerExecution", 0) / 1000.0,
        progress.numInputRows,
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        *[counts.get(name) for name in COUNTED],
    )


class MetricsTable(StreamingQueryListener):
    """Writes one row per micro-batch of one query to a table, whatever the run's length.

    Rows are keyed by stream name and batch number, so a replayed batch
    replaces its row. `finish` waits for the query's last event and detaches.
    Rows follow Spark's events: those of a driver that dies before an event are
    missing. `start_split_sink(metrics=...)` has a row for every committed batch.
    """

    def __init__(self, spark, path, query_name):
        self.spark, self.path, self.query_name = spark, path, query_name
        self.ended, self.failure = threading.Event(), None
        spark.streams.addListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name != self.query_name or self.failure:
            return
        try:
            row = self.spark.createDataFrame([_metric_row(progress)], METRICS_SCHEMA).coalesce(1)
            folder = f"{self.path}/stream={self.query_name}/batch={progress.batchId}"
            row.write.mode("overwrite").parquet(folder)
        except Exception as failure:  # reported by finish, in the caller's thread
            self.failure = failure

    def onQueryTerminated(self, event):
        self.ended.set()

    def finish(self, seconds=60):
        """Detach once the query's end has been heard; raises what a write has raised."""
        heard = self.ended.wait(seconds)
        self.spark.streams.removeListener(self)
        if self.failure:
            raise self.failure
        if not heard:
            raise TimeoutError(f"no end of query {self.query_name!r} within {seconds} s")


def stream_metrics(spark, path):
    """One row per micro-batch of the whole run, as a `MetricsTable` or `start_split_sink` wrote them."""
    return spark.read.schema(METRICS_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def run_counters(metrics):
    """Run totals of a metrics table: batches with rows, posts, labels."""
    return metrics.agg(
        F.count_if(F.col("input_rows") > 0).alias("processed_batches"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}")
            for c in COUNTED
        ],
    )
