"""The daily report and the dashboard's read model."""

from pyspark.sql import functions as F

from echolex.functions.times import as_time, report_time
from echolex.operators.cleaning import ensure_timestamp, recent
from echolex.operators.distribution import avg_sentiment, labels_by_language, language_kpis
from echolex.operators.keywords import keywords_json, parse_keywords, top_keywords
from echolex.operators.ranking import latest_per_bucket, latest_row


def daily_report(scored, as_of, mode="rolling", n=10, compat=False):
    """The report of the last day as one row, or no row when there was no post.

    The mean reads only the label and time columns; the keywords read the text.
    The two results meet as a scalar, without a join and without the driver.
    """
    window = recent(ensure_timestamp(scored), as_of, mode=mode)
    top = keywords_json(top_keywords(window, n, compat=compat))
    return (
        avg_sentiment(window)
        .filter(F.col("n_posts") > 0)
        .select(
            as_time(as_of).alias("report_date"),
            "average_sentiment_score",
            top.scalar().alias("top_keywords"),
        )
    )


def latest_report(reports):
    """The newest report with its display time."""
    return latest_row(reports, "report_date", *[c for c in reports.columns if c != "report_date"]).withColumn(
        "report_time", report_time(F.col("report_date"))
    )


def read_model(scored, reports, n=10):
    """The frames a dashboard shows, by name."""
    latest = latest_report(reports)
    return {
        "kpis": language_kpis(scored),
        "labels": labels_by_language(scored),
        "newest": latest_per_bucket(scored, n).select(
            "lang_bucket", "id", "created_at", "text", "sentiment_label", "detected_language"
        ),
        "report": latest.drop("top_keywords"),
        "keywords": parse_keywords(latest.select("report_date", "top_keywords")),
    }
