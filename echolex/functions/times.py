"""Instants, display times and cutoffs.

Instants are kept in UTC (session time zone UTC) and shifted for display only.
No function reads the clock: callers pass `as_of`.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

KST = "Asia/Seoul"
# Range of epoch seconds a timestamp can show: years 1 to 9999.
MIN_EPOCH = -62135596800
MAX_EPOCH = 253402300799


def as_time(value):
    """A timestamp column from a column, datetime or ISO string."""
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp")


def utc_day(ts):
    """The UTC day of an instant, whatever the time zone of the session."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / 86_400_000_000).cast("int"))


def epoch_to_timestamp(seconds):
    """Instant of whole epoch seconds; out-of-range values give null."""
    whole = seconds.try_cast("bigint")
    return F.when(whole.between(MIN_EPOCH, MAX_EPOCH), F.timestamp_seconds(whole))


def epoch_to_local(seconds, zone=KST):
    """Wall-clock time of epoch seconds in a zone, for display."""
    return F.from_utc_timestamp(epoch_to_timestamp(seconds), zone)


def utc_to_kst(ts):
    return F.from_utc_timestamp(ts, KST)


def kst_to_utc(ts):
    return F.to_utc_timestamp(ts, KST)


def format_kst(ts, as_of=None, naive=False):
    """Text of a time in Korea, e.g. "2024-01-01 09:00:00 KST".

    An instant is shifted; a `naive` value is taken as Korean wall time.
    A null time is replaced by `as_of` (an instant) when given.
    """
    shown = ts.cast("timestamp") if naive else utc_to_kst(ts)
    if as_of is not None:
        shown = F.coalesce(shown, utc_to_kst(as_time(as_of)))
    return F.date_format(shown, "yyyy-MM-dd HH:mm:ss 'KST'")


def report_time(ts):
    """Display time of a report: nine hours after its UTC instant."""
    return ts + F.expr("INTERVAL 9 HOURS")


def cutoff(as_of, hours=None, mode="rolling"):
    """Earliest instant that counts as recent.

    `rolling` goes back `hours` (24 by default). `calendar` goes back to
    midnight of the day before, a span of 24 to 48 hours.
    """
    as_of = as_time(as_of)
    if mode == "calendar":
        return F.date_sub(as_of.cast("date"), 1).cast("timestamp")
    if mode != "rolling":
        raise ValueError(f"unknown recency mode: {mode}")
    return as_of - F.make_dt_interval(hours=F.lit(24 if hours is None else hours))


def age_under(ts, as_of, hours):
    """True while less than `hours` have passed since `ts`."""
    return as_time(as_of) - ts < F.make_dt_interval(hours=F.lit(hours))
