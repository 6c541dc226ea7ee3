"""Error events: recency, counts, recovery, alerts."""

from pyspark.sql import functions as F

from echolex.functions.lexicons import ALERT_SEVERITIES, DEFAULT_STRATEGY
from echolex.functions.recovery import alert_text, fallback_rule, recovery_strategy
from echolex.functions.times import cutoff


def recent_errors(errors, as_of, hours=24):
    """Events strictly newer than `hours` before `as_of`."""
    return errors.filter(F.col("timestamp") > cutoff(as_of, hours))


def error_counts(errors, column):
    """Events per component or per severity."""
    return errors.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _recovery_columns():
    attempted = F.coalesce(F.col("recovery_attempted"), F.lit(False))
    succeeded = attempted & F.coalesce(F.col("recovery_successful"), F.lit(False))
    return [F.count_if(attempted).alias("attempts"), F.count_if(succeeded).alias("successes")]


def _rate():
    return F.coalesce(
        F.lit(100.0) * F.col("successes") / F.nullif(F.col("attempts"), F.lit(0)), F.lit(0.0)
    ).alias("recovery_success_rate")


def recovery_rate(errors):
    """Successful share of attempted recoveries in percent, 0 when none was tried."""
    return errors.agg(*_recovery_columns()).select("attempts", "successes", _rate())


def error_breakdown(errors):
    """Counts per component, per severity and in total, in one pass.

    Rows have (dimension, value, n); dimension is component, severity or total.
    """
    total, by_component = F.grouping_id() == 3, F.grouping_id() == 1
    pairs = errors.groupBy("component", "severity").agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.groupingSets([["component"], ["severity"], []], "component", "severity")
        .agg(
            F.sum("n").alias("n"),
            F.when(total, "total").when(by_component, "component").otherwise("severity").alias("dimension"),
        )
        .select("dimension", F.coalesce("component", "severity").alias("value"), "n")
    )


def error_statistics(errors, as_of, hours=24, states=None):
    """The error report as one row.

    Both count maps, the totals and the recovery rate come from one pass over
    the recent events: events are first counted per (component, severity), and
    only those counts are gathered, one entry per component. `states`
    (component, state) adds a map of states that are known already; rows
    without a component or state are left out of it.
    """
    pairs = (
        recent_errors(errors, as_of, hours)
        .groupBy("component", "severity")
        .agg(F.count(F.lit(1)).alias("n"), *_recovery_columns())
    )
    sets = pairs.groupingSets([["component"], ["severity"], []], "component", "severity").agg(
        F.grouping_id().alias("g"),
        *[F.sum(c).alias(c) for c in ("n", "attempts", "successes")],
    )
    level = F.col("g")

    def total(name):
        return F.coalesce(F.max(F.when(level == 3, F.col(name))), F.lit(0)).alias(name)

    def breakdown(name, mask):
        named = F.when((level == mask) & F.col(name).isNotNull(), F.struct(F.col(name), F.col("n")))
        return F.map_from_entries(F.array_sort(F.collect_list(named))).alias(f"{name}_breakdown")

    report = sets.agg(
        total("n"),
        total("attempts"),
        total("successes"),
        breakdown("component", 1),
        breakdown("severity", 2),
    ).select(F.col("n").alias("total_errors"), "component_breakdown", "severity_breakdown", _rate())
    if states is None:
        return report
    states = states.filter(F.col("component").isNotNull() & F.col("state").isNotNull())
    states = states.groupBy("component").agg(F.max("state").alias("state"))
    entries = F.array_sort(F.collect_list(F.struct("component", "state")))
    return report.withColumn(
        "circuit_breaker_states", states.agg(F.map_from_entries(entries)).scalar()
    )


def with_strategy(errors, strategies=None):
    """Add the recovery strategy of each event.

    `strategies` (error_type, strategy) replaces the built-in table; types it
    does not list are MANUAL. It is a plain join: Spark broadcasts a table that
    it finds small enough, and may split a frequent type otherwise.
    """
    if strategies is None:
        return errors.withColumn("strategy", recovery_strategy(F.col("error_type")))
    joined = errors.join(strategies, "error_type", "left")
    return joined.withColumn("strategy", F.coalesce("strategy", F.lit(DEFAULT_STRATEGY)))


def with_fallback(errors):
    return errors.withColumn("fallback", fallback_rule(F.col("component")))


def alerts(errors):
    """Events severe enough to alert on, with the alert text."""
    return errors.filter(F.col("severity").isin(*ALERT_SEVERITIES)).withColumn(
        "alert", alert_text(F.col("severity"), F.col("component"))
    )
