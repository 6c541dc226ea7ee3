"""The score cache as a stored table, bucketed by key and partitioned by day.

A day's folder holds the entries cached on that day. Storing entries rewrites
the folders of their days only, a bucket of a day by one task; expired entries
go with whole folders, without a rewrite. Files are bucketed and sorted by key, so a lookup shuffles its own
keys and reads the cache where it lies, of the days that can still be live only.
"""

from datetime import date

from pyspark.sql import functions as F

from echolex.functions.text import cache_key
from echolex.functions.times import age_under, as_time, utc_day
from echolex.operators.cache import TTL_HOURS, latest_entries
from echolex.operators.skew import HOT_ROWS, lookup_join
from echolex.schemas import SENTIMENT_SCHEMA
from echolex.sources.tables import path_exists, remove_paths

BUCKETS = 64
BUCKET = "_bucket"
DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


def _oldest_day(as_of, ttl_hours):
    """The first UTC day that can hold live entries at an instant."""
    return utc_day(as_time(as_of) - F.make_dt_interval(hours=F.lit(ttl_hours)))


class CacheStore:
    """A cache table `name` with its files under `path`.

    The number of buckets is part of the folder's name: opened with another
    number the cache is another, empty one, never one read wrongly. Give some
    128 MB of a day to a bucket. One writer at a time.
    """

    def __init__(self, spark, name, path, buckets=BUCKETS, result=SENTIMENT_SCHEMA):
        self.spark, self.name, self.buckets = spark, name, buckets
        self.path = f"{path.rstrip('/')}/buckets_{buckets}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (key STRING, result {result.simpleString()}, cached_at TIMESTAMP, day DATE) "
            f"USING parquet PARTITIONED BY (day) CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS "
            "LOCATION :path",
            {"path": self.path},
        )
        self._refresh()

    def _refresh(self):
        """See the folders as they are now, of which the catalog keeps a list of its own."""
        if path_exists(self.spark, self.path):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    def entries(self):
        """All stored entries (key, result, cached_at, day), one per key and day."""
        return self.spark.table(self.name)

    def days(self):
        """The days that have a folder, as the catalog lists them; no file is read."""
        if not path_exists(self.spark, self.path):
            return []
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return sorted(date.fromisoformat(r["partition"].partition("=")[2]) for r in listed)

    def store(self, entries):
        """Add entries (key, result, cached_at); of one key and day the newest stays.

        Only the days of the new entries are read and written again. Entries
        without a key or time are left out. The same entries stored twice are
        stored once.
        """
        fresh = entries.filter(F.col("key").isNotNull() & F.col("cached_at").isNotNull())
        fresh = fresh.select("key", "result", "cached_at", utc_day(F.col("cached_at")).alias("day"))
        touched = [r["day"] for r in fresh.select("day").distinct().collect()]
        if not touched:
            return
        old = self.entries().filter(F.col("day").isin(touched)).select(*fresh.columns)
        # Exchanged once, by day and bucket: the newest of a key and day is found where its file is written.
        rows = old.unionByName(fresh).withColumn(BUCKET, F.pmod(F.hash("key"), F.lit(self.buckets)))
        tasks = max(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        rows = rows.repartition(tasks, "day", BUCKET)
        newest = latest_entries(rows, "day", BUCKET).select(*fresh.columns)
        before = {k: self.spark.conf.get(k, None) for k in DYNAMIC}
        try:
            for k, v in DYNAMIC.items():
                self.spark.conf.set(k, v)
            newest.write.insertInto(self.name, overwrite=True)
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        self.spark.catalog.refreshTable(self.name)  # the write has added new days to the catalog itself

    def expire(self, as_of, ttl_hours=TTL_HOURS):
        """Remove the days of which no entry can be live at the instant `as_of`; returns them."""
        oldest = self.spark.range(1).select(_oldest_day(as_of, ttl_hours)).first()[0]
        gone = [day for day in self.days() if day < oldest]
        remove_paths(self.spark, [f"{self.path}/day={day}" for day in gone])
        self._refresh()
        return gone

    def live(self, as_of, ttl_hours=TTL_HOURS):
        """The newest live entry per key, read from the days that can hold one; nothing is shuffled."""
        may_live = F.col("day") >= _oldest_day(as_of, ttl_hours)
        entries = self.entries().filter(may_live & age_under(F.col("cached_at"), as_of, ttl_hours))
        return latest_entries(entries).select("key", "result")

    def lookup(self, posts, as_of, ttl_hours=TTL_HOURS, source="local", text="text", spread="id", hot_rows=HOT_ROWS):
        """Posts with the stored `result`, null when absent or expired, as `operators.cache.lookup_cached`.

        The different keys of the posts, combined before they are shuffled, meet
        the cache in its buckets; what they find is joined back with hot keys
        salted. Of the cache only hits are ever shuffled.
        """
        keyed = posts.withColumn("key", cache_key(F.col(text), source))
        asked = keyed.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        in_buckets = asked.select("key").repartition(self.buckets, "key")
        found = self.live(as_of, ttl_hours).hint("merge").join(in_buckets, "key")
        return lookup_join(keyed, found, "key", spread, counts=asked, hot_rows=hot_rows)
