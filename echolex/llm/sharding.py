"""Indivisible groups of equal texts into shards: best-fit decreasing.

Groups enter, largest first, the bin whose remaining capacity is tightest; the
bins stand in a balanced tree ordered by that capacity. Given a number of
shards instead of a capacity, the smallest capacity that suffices is searched.

Groups of a small share of the data are far too many to be placed one by one.
They are gathered by hash into grains, `grains` per shard, and a grain is
placed as one item. What is placed is therefore bounded by
2 * shards * grains items, whatever the size of the table.
"""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

GRAINS = 256  # per shard
BLOCKS = 64  # per shard, in which rows are numbered
SEARCH_STEPS = 12


class Tree:
    """A treap of (remaining, bin) pairs: balanced in expectation for any input."""

    def __init__(self, seed=7):
        self.root, self.priority = None, random.Random(seed).random

    def add(self, key):
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, [key, self.priority(), None, None]), high)

    def take(self, key):
        """Remove and return the smallest pair that is not below `key`, or None."""
        low, high = self._split(self.root, key)
        if high is None:
            self.root = low
            return None
        node, above = high, None
        while node[2] is not None:
            above, node = node, node[2]
        if above is None:
            high = node[3]
        else:
            above[2] = node[3]
        self.root = self._join(low, high)
        return node[0]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _join(self, low, high):
        if low is None or high is None:
            return low if high is None else high
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high


def best_fit_decreasing(items, capacity):
    """Bin of every (size, item), and the number of bins.

    Items above the capacity get a bin of their own.
    """
    tree, bins, placed = Tree(), 0, {}
    for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
        found = tree.take((size, -1))
        if found is None:
            found = (max(capacity, size), bins)
            bins += 1
        placed[item] = found[1]
        tree.add((found[0] - size, found[1]))
    return placed, bins


def fit_into(items, shards, steps=SEARCH_STEPS):
    """Placement of (size, item) pairs into at most `shards` bins of near-equal content."""
    items = list(items)
    if not items:
        return {}
    total, largest = sum(s for s, _ in items), max(s for s, _ in items)
    low = max(-(-total // shards), largest)
    high = low + largest  # best fit never needs more: a bin over `low` is then full enough
    best, bins = best_fit_decreasing(items, high)
    while bins > shards:
        high *= 2
        best, bins = best_fit_decreasing(items, high)
    for _ in range(steps):
        if low >= high:
            break
        middle = (low + high) // 2
        placed, bins = best_fit_decreasing(items, middle)
        if bins <= shards:
            best, high = placed, middle
        else:
            low = middle + 1
    return best


def assign_shards(docs, shards=24, id_col="doc_id", text_col="text", grains=GRAINS, blocks=BLOCKS):
    """One row per document: id, size, text_crc32, text_key, shard, slot.

    `size` is the UTF-8 bytes of the text plus 8. Equal texts share a
    `text_key` and a shard; null texts count as one text without bytes, with
    checksum 0. `slot` numbers the rows of a shard from 0 without gaps, in
    order of hash block, id and checksum; repeated rows get a slot each. An
    empty table gives no rows, and further columns are not read.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(text), F.lit("null")).alias("text_key"),
    ).checkpoint()

    groups = slim.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    large = F.col("bytes") * (shards * grains) >= F.lit(total)
    grain = F.pmod(F.xxhash64("text_key"), F.lit(shards * grains)).cast("string")
    items = groups.groupBy(F.when(large, F.col("text_key")).otherwise(grain).alias("item")).agg(
        F.sum("bytes").alias("bytes")
    )
    # At most 2 * shards * grains rows: that many groups can be large at most.
    placed = fit_into([(r["bytes"], r["item"]) for r in items.collect()], shards)
    plan = F.broadcast(spark.createDataFrame(list(placed.items()), "item string, shard int"))
    alone = plan.select(F.col("item").alias("text_key"), F.col("shard").alias("own_shard"))
    rows = (
        slim.withColumn("item", grain)
        .join(F.broadcast(alone), "text_key", "left")
        .join(plan, "item", "left")
        .withColumn("shard", F.coalesce("own_shard", "shard"))
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # shards * blocks rows at most.
    starts = (
        rows.groupBy("shard", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size", "text_key")
    return rows.join(F.broadcast(starts), ["shard", "block"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "text_key",
        "shard",
        (F.col("base") + F.row_number().over(within) - 1).alias("slot"),
    )
