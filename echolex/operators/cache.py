"""Score cache as a table (key, result, cached_at)."""

from pyspark.sql import functions as F

from echolex.functions.text import cache_key
from echolex.functions.times import age_under
from echolex.operators.skew import HOT_ROWS, lookup_join, top_per_group

TTL_HOURS = 24
MAX_ENTRIES = 10_000


def latest_entries(cache, *within):
    """Newest entry per key (and columns `within`); entries of equal time are ordered by their result."""
    order = [F.col("cached_at").desc(), F.col("result")]
    return top_per_group(cache, ["key", *within], order, 1, "cached_at")


def lookup_cached(
    posts, cache, as_of, ttl_hours=TTL_HOURS, source="local", text="text", spread="id",
    hot_rows=HOT_ROWS,
):
    """Posts with the cached `result`, null when absent or expired.

    Expired entries are dropped first: when the newest entry of a key has
    expired, so have the older ones. A text with very many copies is spread
    over several tasks.
    """
    live = latest_entries(cache.filter(age_under(F.col("cached_at"), as_of, ttl_hours)))
    keyed = posts.withColumn("key", cache_key(F.col(text), source))
    return lookup_join(keyed, live.select("key", "result"), "key", spread, hot_rows=hot_rows)


def split_cached(posts, cache, as_of, **options):
    """(hits, misses): posts with a usable cached result, and the others.

    Running both runs the lookup twice; store the result of `lookup_cached`
    when both sides are needed.
    """
    found = lookup_cached(posts, cache, as_of, **options)
    hit = F.col("result").isNotNull()
    return found.filter(hit), found.filter(~hit).drop("result")


def evict(cache, max_entries=MAX_ENTRIES):
    """The newest `max_entries` entries, one per key."""
    return latest_entries(cache).orderBy(F.col("cached_at").desc(), "key").limit(max_entries)
