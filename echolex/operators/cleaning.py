"""Row filters: clean text, recency, type repair."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolex.functions.times import cutoff, utc_day

# Fixed values of the clean filter.
REMOVED_MARKERS = ("[deleted]", "[removed]")
UNSUPPORTED_PREFIX = "This post contains content not supported"
MIN_CHARS = {"current": 10, "strict": 20}


def clean_posts(df, preset="current", compat=False, text="text"):
    """Keep posts with usable text.

    `current`: over 10 characters when trimmed, no removal marker, not only
    white space and symbols. `strict`: over 20 characters, also not the
    unsupported-content notice and over 5 letters (Latin, Hangul) or digits.
    `compat=True` takes "symbol" in the ASCII sense, which drops text that is
    wholly non-Latin.
    """
    body = F.col(text)
    symbols_only = r"^[\s\W]*$" if compat else r"(?U)^[\s\W]*$"
    keep = body.isNotNull() & (F.length(F.trim(body)) > MIN_CHARS[preset])
    for marker in REMOVED_MARKERS:
        keep = keep & ~body.contains(marker)
    if preset == "strict":
        letters = F.length(F.regexp_replace(body, "[^a-zA-Z가-힣0-9]+", ""))
        keep = keep & ~body.startswith(UNSUPPORTED_PREFIX) & (letters > 5)
    return df.filter(keep & ~body.rlike(symbols_only))


def ensure_timestamp(df, name="created_at"):
    """Repair a time column stored as text; unreadable values become null.

    A column that is a timestamp already stays untouched, so filters on it
    still reach the scan.
    """
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(name, F.try_to_timestamp(F.col(name)))


def recent(df, as_of, hours=None, mode="rolling", ts="created_at", strict=False):
    """Rows not older than the cutoff; `strict` leaves out the cutoff itself.

    With a `created_date` partition column the folders are pruned too.
    """
    start = cutoff(as_of, hours, mode)
    kept = F.col(ts) > start if strict else F.col(ts) >= start
    if ts == "created_at" and "created_date" in df.columns:
        kept = kept & (F.col("created_date") >= utc_day(start))
    return df.filter(kept)


def latest_time(df, ts="created_at"):
    """Largest time of a table as a scalar column, to stand in for `as_of`."""
    return df.agg(F.max(ts)).scalar()
