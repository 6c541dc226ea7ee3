"""Counts and means over scored posts."""

from pyspark.sql import functions as F

from echolex.functions.language import language_bucket, script_count
from echolex.functions.lexicons import LABELS
from echolex.functions.sentiment import label_score
from echolex.functions.text import or_empty


def avg_sentiment(df, label="sentiment_label"):
    """Mean score and number of posts in one row."""
    return df.agg(
        F.avg(label_score(F.col(label))).alias("average_sentiment_score"),
        F.count(F.lit(1)).alias("n_posts"),
    )


def label_distribution(df, label="sentiment_label"):
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def language_distribution(df, language="detected_language"):
    return df.groupBy(language).agg(F.count(F.lit(1)).alias("n"))


def language_kpis(df):
    """Totals per language bucket in one row."""
    bucket = language_bucket(F.col("detected_language"))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(bucket == "ko").alias("ko"),
        F.count_if(bucket == "en").alias("en"),
        F.count_if(bucket == "other").alias("other"),
    )


def labels_by_language(df):
    """Label counts per language bucket; rows without a label are not counted."""
    return (
        df.filter(F.col("sentiment_label").isNotNull())
        .groupBy(language_bucket(F.col("detected_language")).alias("lang_bucket"), "sentiment_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def corpus_language(df, *group_cols, text="text"):
    """One language per group of texts: ko when over a tenth of all their
    characters are Hangul, else en."""
    body = or_empty(F.col(text))
    sums = df.groupBy(*group_cols).agg(
        F.sum(script_count(body, "ko")).alias("korean_chars"),
        F.sum(F.length(body)).alias("total_chars"),
    )
    korean = F.col("korean_chars") * 10 > F.col("total_chars")
    return sums.withColumn("language", F.when(korean, "ko").otherwise("en"))


def observed_counts():
    """Aggregates to `observe` on a batch: rows, and rows per label."""
    label = F.col("sentiment_label")
    return [F.count(F.lit(1)).alias("records")] + [
        F.count_if(label == name).alias(name.lower()) for name in LABELS
    ]
