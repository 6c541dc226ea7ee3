"""Newest rows, overall and per group."""

from pyspark.sql import functions as F

from echolex.functions.language import language_bucket
from echolex.operators.skew import top_per_group


def newest(df, ts="created_at", tie="id"):
    """All rows, newest first. The tie column also splits equal times over tasks."""
    return df.orderBy(F.col(ts).desc(), F.col(tie))


def latest_row(df, ts, *ties):
    """The newest row of a table; `ties` order rows of one time, the smallest first."""
    return df.orderBy(F.col(ts).desc(), *ties).limit(1)


def latest_per_bucket(df, n=10, ts="created_at", tie="id"):
    """The newest `n` rows of each language bucket (ko, en, other)."""
    bucketed = df.withColumn("lang_bucket", language_bucket(F.col("detected_language")))
    return top_per_group(bucketed, ["lang_bucket"], [F.col(ts).desc(), F.col(tie)], n, tie)


def cap_per_window(df, key, ts, limit, tie, width="1 minute"):
    """At most `limit` rows per key and fixed time window, the earliest ones."""
    windowed = df.withColumn("window_start", F.window(ts, width)["start"])
    order = [F.col(ts), F.col(tie)]
    return top_per_group(windowed, [key, "window_start"], order, limit, tie)
