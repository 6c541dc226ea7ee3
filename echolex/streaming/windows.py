"""Stateful operators on streams: a cap per key and window, and freshness by hour.

Both run on `transformWithState`, whose state lives in RocksDB: queries are
started inside `stateful_session`.
"""

from contextlib import contextmanager

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
LATE = "10 minutes"
# Rows a silent stretch is handed out in at a time.
FILL_ROWS = 10_000


@contextmanager
def stateful_session(spark):
    """The state store these operators need, for the queries started inside; put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# --- cap ------------------------------------------------------------------------


def _first_rows(frames, keys, order, limit):
    """The first `limit` rows of each key of several frames, holding no more than that and one frame."""
    kept = None
    for frame in frames:
        both = frame if kept is None else pd.concat([kept, frame], ignore_index=True)
        ordered = both.sort_values(order, kind="stable", na_position="first")
        kept = ordered.groupby(keys, sort=False, dropna=False).head(limit) if keys else ordered.head(limit)
    return kept


class _Cap(StatefulProcessor):
    """Counts what a key and window has let through; forgets it once the window can get no more."""

    def __init__(self, order, limit, columns):
        self.order, self.limit, self.columns = order, limit, columns

    def init(self, handle):
        self.handle = handle
        self.passed = handle.getValueState("passed", "n int")

    def handleInputRows(self, key, rows, timerValues):
        n = self.passed.get()[0] if self.passed.exists() else 0
        if n < self.limit:
            first = _first_rows(rows, None, self.order, self.limit - n)
            if first is not None and len(first):
                self.passed.update((n + len(first),))
                self.handle.registerTimer(int(first["end_ms"].iloc[0]))
                yield first[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.passed.clear()
        return iter(())

    def close(self):
        pass


def cap_stream(df, key, ts, limit, tie, width="1 minute", late=LATE):
    """At most `limit` rows per key and fixed time window of a stream, let through as they arrive.

    The stream's counterpart of `operators.ranking.cap_per_window`: within a
    micro-batch the earliest rows by (`ts`, `tie`) pass, across batches those
    that came first, so the two agree when batches come in the order of time.
    The state is one counter per key and open window, dropped when the
    watermark passes the window's end. Rows behind the watermark of the batch
    before are dropped, which is when their window's count may be gone.

    A key may hold much of a batch: each Arrow batch is cut to `limit` rows per
    key and window before the shuffle, since no other row of it can pass.
    Null keys share one count; rows without a time belong to no window and are
    left out. An input column `window_start` is replaced, all others are kept;
    nested ones go through pandas as they are. Null ties come first.
    """
    names = [c for c in df.columns if c != "window_start"]
    packed, unpacked = zip(*[_carried(df.schema[c], f"c{i}") for i, c in enumerate(names)])
    whole_tie = isinstance(df.schema[tie].dataType, T.IntegralType)
    ties = F.coalesce(F.col(f"`{tie}`").cast("long"), F.lit(-(2**63))) if whole_tie else F.col(f"`{tie}`")
    time = F.col(f"`{ts}`")
    rows = (
        df.filter(time.isNotNull())
        .withColumn("window_start", F.window(time, width)["start"])
        .select(
            *packed,
            time.alias("at"),
            F.unix_micros(time).alias("micros"),
            ties.alias("tie"),
            F.unix_millis("window_start").alias("start_ms"),
            F.unix_millis(F.col("window_start") + F.expr(f"INTERVAL {width}")).alias("end_ms"),
            F.coalesce(F.concat(F.lit("+"), F.col(f"`{key}`").cast("string")), F.lit("-")).alias("cap_key"),
        )
    )
    order, groups = ["micros", "tie"], ["cap_key", "end_ms"]

    def precut(frames):
        for frame in frames:
            yield _first_rows([frame], groups, order, limit)

    columns = [*[f"c{i}" for i in range(len(names))], "start_ms"]
    passed = (
        rows.mapInPandas(precut, rows.schema)
        .withWatermark("at", late)
        .groupBy(*groups)
        .transformWithStateInPandas(
            statefulProcessor=_Cap(order, limit, columns),
            outputStructType=T.StructType([rows.schema[c] for c in columns]),
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return passed.select(*unpacked, F.timestamp_millis("start_ms").alias("window_start"))


def _carried(field, number):
    """A column on its way through pandas, and back.

    It goes under a number, for names that begin with "_" do not reach the state
    functions. Whole numbers and instants go as text: beside nulls pandas would
    round the former, and it shifts the latter to the session's wall clock.
    """
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.IntegralType):
        return column.cast("string").alias(number), F.col(number).cast(kind).alias(field.name)
    if isinstance(kind, T.TimestampType):
        back = F.timestamp_micros(F.col(number).cast("long")).alias(field.name)
        return F.unix_micros(column).cast("string").alias(number), back
    return column.alias(number), F.col(number).alias(field.name)


# --- freshness --------------------------------------------------------------------


class _Gaps(StatefulProcessor):
    """Puts in the windows in which a key had no rows, found by a timer at each window's end."""

    def __init__(self, width_ms):
        self.width_ms = width_ms

    def init(self, handle):
        self.handle = handle
        self.next = handle.getValueState("next", "ms long")

    def _frames(self, key, starts, counts):
        for at in range(0, len(starts), FILL_ROWS):
            cut = slice(at, at + FILL_ROWS)
            yield pd.DataFrame(
                {
                    "of": [key[0]] * len(starts[cut]),
                    "start_ms": starts[cut],
                    "n": counts[cut],
                }
            )

    def _wait(self, start):
        """Expect the window from `start` on; the timer at its end finds it empty."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.next.update((start,))
        self.handle.registerTimer(start + self.width_ms)

    def handleInputRows(self, key, rows, timerValues):
        found = {}
        for frame in rows:
            found.update(zip(frame["start_ms"].tolist(), frame["n"].tolist()))
        first = self.next.get()[0] if self.next.exists() else min(found)
        last = max(found)
        starts = range(first, last + 1, self.width_ms)
        yield from self._frames(key, starts, [found.get(s, 0) for s in starts])
        self._wait(last + self.width_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        first = self.next.get()[0]
        closed = (timerValues.getCurrentWatermarkInMs() - first) // self.width_ms
        if closed > 0:
            starts = range(first, first + closed * self.width_ms, self.width_ms)
            yield from self._frames(key, starts, [0] * len(starts))
            self._wait(first + closed * self.width_ms)

    def close(self):
        pass


def freshness_stream(df, by, ts, hours=1, late=LATE):
    """Rows per key and window of `hours`, silent windows included, as the watermark closes them.

    The stream's counterpart of `operators.quality.freshness`: one row
    (`by` as text, window_start, n, ok) per key and window from the key's first
    row on. A key that has fallen silent is found through the other keys, whose
    rows move the watermark. Counts are plain windowed aggregates, combined
    before the shuffle; only one row per key and window with rows reaches the
    timers. Rows that come after their window closed are dropped, rows without a time or key count
    nowhere.
    """
    width_ms = hours * 3_600_000
    counted = (
        df.filter(F.col(ts).isNotNull() & F.col(by).isNotNull())
        .select(F.col(by).cast("string").alias("of"), F.col(ts).alias("ts"))
        .withWatermark("ts", late)
        .groupBy(F.window("ts", f"{hours} hours"), "of")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("of", "n", F.unix_millis(F.col("window.start")).alias("start_ms"), F.window_time("window").alias("at"))
    )
    out = T.StructType(
        [
            T.StructField("of", T.StringType()),
            T.StructField("start_ms", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )
    filled = counted.groupBy("of").transformWithStateInPandas(
        statefulProcessor=_Gaps(width_ms),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
    )
    start = F.timestamp_millis("start_ms").alias("window_start")
    return filled.select(F.col("of").alias(by), start, "n", (F.col("n") > 0).alias("ok"))
