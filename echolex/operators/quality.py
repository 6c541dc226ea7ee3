"""Freshness and quality checks over scored posts."""

from pyspark.sql import functions as F

from echolex.functions.lexicons import LABELS, LANGUAGES
from echolex.operators.cleaning import ensure_timestamp, recent


def freshness(df, as_of, hours=1):
    """One row: number of posts of the last `hours`, and whether there are any."""
    found = recent(ensure_timestamp(df), as_of, hours).agg(F.count(F.lit(1)).alias("n"))
    return found.select("n", (F.col("n") > 0).alias("ok"))


def quality_report(df, columns=("id", "text", "created_at", "detected_language", "sentiment_label")):
    """One row per check with the number of failing posts.

    Missing values per column, surplus rows per id, unreadable times, and
    labels or languages outside their domain. Ids are counted on their own, one
    number for each id and task before they are shuffled; all other checks are
    one plain aggregate, of which each task sends one row.
    """
    raw_time = F.col("created_at")
    readable = raw_time if df.schema["created_at"].dataType.typeName().startswith("timestamp") else (
        F.try_to_timestamp(raw_time)
    )
    checks = {f"missing_{c}": F.col(c).isNull() for c in columns}
    checks["malformed_created_at"] = raw_time.isNotNull() & readable.isNull()
    checks["invalid_language"] = ~F.col("detected_language").isin(*LANGUAGES)
    checks["invalid_label"] = ~F.col("sentiment_label").isin(*LABELS)
    per_id = df.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    surplus = per_id.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_id"))
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(test).alias(name) for name, test in checks.items()])
    wide = wide.withColumn("duplicate_id", surplus.scalar())
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(name).alias("failures"))
            for name in ["duplicate_id", *checks]
        ]
    )
    return wide.select("n_rows", F.inline(rows)).select(
        "check", "failures", "n_rows", (F.col("failures") == 0).alias("ok")
    )
