"""The daily report from partial states, without reading the posts again.

Every batch of scored posts leaves its counts by minute: posts, the sum of
their scores, and how often each keyword occurs. States of any batches add up,
so a report over any window is a sum of the minutes in it.

A folder holds a month of a batch, sorted by day: a batch may have posts of any
number of days, and a folder for each would cost two files for every few posts.
"""

from pyspark.sql import functions as F

from echolex.functions.sentiment import label_score
from echolex.functions.times import as_time, cutoff, utc_day
from echolex.operators.keywords import keyword_counts, keywords_json
from echolex.sources.tables import commit_folder, path_exists, remove_path, staged_folder

GRAIN = "minute"
# Folder of the states: the first day of the month of `created_date`.
MONTH = "created_date_month"
STATES_DDL = (
    f"bucket timestamp, word string, n long, score_sum double, n_scored long, created_date date, kind string, {MONTH} date"
)


def _month(day):
    return F.trunc(day, "month")


def _write(states, path, *folders):
    """Write states by kind and month, those of a folder sorted by day."""
    folders = [*folders, "kind", MONTH]
    rows = states.withColumn(MONTH, _month(F.col("created_date"))).hint("rebalance", *folders)
    rows.sortWithinPartitions(*folders, "created_date").write.partitionBy(*folders).parquet(path)


def report_states(scored, grain=GRAIN, compat=False):
    """Counts by time bucket: kind 'posts' (n, score_sum, n_scored) and kind 'words' (word, n).

    Posts without a time are in no window and leave no state.
    """
    rows = scored.filter(F.col("created_at").isNotNull()).select(
        F.date_trunc(grain, "created_at").alias("bucket"), "text", label_score(F.col("sentiment_label")).alias("_score")
    )
    posts = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("_score").cast("double"), F.lit(0.0)).alias("score_sum"),
        F.count("_score").alias("n_scored"),
    )
    posts = posts.select("bucket", F.lit(None).cast("string").alias("word"), "n", "score_sum", "n_scored", F.lit("posts").alias("kind"))
    words = keyword_counts(rows, compat=compat, by=["bucket"]).select(
        "bucket",
        "word",
        F.col("count").alias("n"),
        F.lit(None).cast("double").alias("score_sum"),
        F.lit(None).cast("long").alias("n_scored"),
        F.lit("words").alias("kind"),
    )
    return posts.unionAll(words).withColumn("created_date", utc_day(F.col("bucket")))


def write_report_states(batch, batch_id, path, stream="posts", **options):
    """Store the states of one batch; those of the same number and stream are replaced."""
    spark = batch.sparkSession
    staged = staged_folder(path, f"{stream}-{batch_id}")
    states = report_states(batch, **options)
    _write(states, staged)
    commit_folder(spark, staged, f"{path}/stream={stream}/batch_id={batch_id}")


def read_states(spark, path):
    """All stored states; an absent folder has none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{STATES_DDL}, stream string, batch_id long")
    return spark.read.schema(f"{STATES_DDL}, stream string, batch_id long").parquet(path)


def merge_states(spark, path, day, stream="posts"):
    """Add up the states of a day over all batches of a stream into one folder, under batch number -1.

    Batches that may still be repeated must not be merged: their states would
    count twice.
    """
    states = read_states(spark, path).filter(F.col("stream") == stream)
    the_day, kept = F.lit(str(day)).cast("date"), ("bucket", "word", "n", "score_sum", "n_scored", "kind", "created_date")
    merged = states.filter((F.col(MONTH) == _month(the_day)) & (F.col("created_date") == the_day))
    merged = merged.groupBy("kind", "created_date", "bucket", "word").agg(
        *[F.sum(c).alias(c) for c in ("n", "score_sum", "n_scored")]
    )
    others = states.filter((F.col("batch_id") == -1) & (F.col("created_date") != the_day))
    # The month's other days of the batches, whose folders are written anew without the day.
    rest = states.filter((F.col("batch_id") >= 0) & (F.col(MONTH) == _month(the_day)) & (F.col("created_date") != the_day))
    staged, left = staged_folder(path, f"{stream}-merged"), staged_folder(path, f"{stream}-left")
    _write(merged.select(*kept).unionByName(others.select(*kept)), staged)
    _write(rest.select(*kept, "batch_id"), left, "batch_id")
    numbers = [r["batch_id"] for r in states.select("batch_id").distinct().collect() if r["batch_id"] >= 0]
    commit_folder(spark, staged, f"{path}/stream={stream}/batch_id=-1")
    month = f"{MONTH}={str(day)[:7]}-01"
    for number in numbers:
        for kind in ("posts", "words"):
            folder = f"batch_id={number}/kind={kind}/{month}"
            if path_exists(spark, f"{left}/{folder}"):
                commit_folder(spark, f"{left}/{folder}", f"{path}/stream={stream}/{folder}")
            else:
                remove_path(spark, f"{path}/stream={stream}/{folder}")
    remove_path(spark, left)


def incremental_report(states, as_of, mode="rolling", n=10, grain=GRAIN):
    """`daily_report` from states: one row, or none when there was no post.

    The window must begin at a border of the buckets, else the plan raises.
    """
    start = cutoff(as_of, mode=mode)
    border = F.date_trunc(grain, start)
    start = F.when(border == start, start).otherwise(
        F.raise_error(F.concat(F.lit(f"not at the begin of a {grain}: "), start.cast("string"))).cast("timestamp")
    )
    days = (F.col(MONTH) >= _month(utc_day(border))) & (F.col("created_date") >= utc_day(border))
    window = states.filter(days & (F.col("bucket") >= start))
    words = window.filter("kind = 'words'").groupBy("word").agg(F.sum("n").alias("count"))
    top = keywords_json(words.orderBy(F.col("count").desc(), "word").limit(n))
    posts = window.filter("kind = 'posts'").agg(
        F.sum("n").alias("n_posts"), F.try_divide(F.sum("score_sum"), F.sum("n_scored")).alias("average_sentiment_score")
    )
    return posts.filter(F.col("n_posts") > 0).select(
        as_time(as_of).alias("report_date"), "average_sentiment_score", top.scalar().alias("top_keywords")
    )
