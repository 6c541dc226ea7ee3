"""Mixing sources to target weights over a domain, language, source tree.

A token budget is handed down the tree. At every node the children share by
weight; a child that cannot use its share (its documents times `max_epochs`)
takes what it can, and its shortage goes to its siblings by their weights. Only
what all siblings together cannot use has been kept from the node in the first
place, so ancestors share a shortage last.

Each leaf then takes a prefix of its seeded epochs: whole epochs while the
target holds them, and of the last one the documents, in an order seeded by
epoch, up to the one that reaches the target.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from echolex.llm.sizes import broadcast_if_small

TREE = ("domain", "lang", "source")
BUCKET_HEX = 3  # 4,096 buckets of the seeded order per leaf


def word_tokens(text="text"):
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _with_weights(nodes, keys, weights):
    """Adds `w`: from `weights` (keys, weight) where given, else 1; never below 0."""
    if weights is None:
        return nodes.withColumn("w", F.lit(1.0))
    found = weights.select(*keys, F.col("weight").cast("double").alias("w"))
    w = F.greatest(F.coalesce("w", F.lit(1.0)), F.lit(0.0))
    return nodes.join(found, list(keys), "left").withColumn("w", w)


def share_out(nodes, parent, key):
    """`nodes` (parent keys, key, cap, w, amount of the parent) with `given` in place of amount.

    The level where sum(min(cap, w * level)) = amount is found from running
    sums in the order of cap / w: nodes that saturate come first.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    run = group.orderBy("full_at", key).rowsBetween(Window.unboundedPreceding, -1)
    rest = group.orderBy("full_at", key).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("amount") - F.coalesce(F.sum("cap").over(run), F.lit(0.0))) / F.sum("w").over(rest)
    open_level = F.when(F.col("full_at") > F.col("level"), F.col("level"))
    return (
        nodes.filter("w > 0")
        .withColumn("full_at", F.col("cap") / F.col("w"))
        .withColumn("level", level)
        .withColumn("open_level", F.max(open_level).over(group))
        .withColumn(
            "given", F.coalesce(F.least(F.col("cap"), F.col("w") * F.col("open_level")), F.col("cap"))
        )
        .drop("amount", "full_at", "level", "open_level", "w", "cap")
    )


def leaf_targets(leaves, budget, weights=None, tree=TREE):
    """tree columns, tokens, target: the budget (a number or a column over 0 rows' total) per leaf.

    `leaves`: tree columns, tokens, cap. `weights`: dict of level name to a
    table (tree columns down to that level, weight).
    """
    weights = weights or {}
    amounts = None
    for depth in range(1, len(tree) + 1):
        keys, parent = tree[:depth], tree[: depth - 1]
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").cast("double").alias("cap"))
        nodes = _with_weights(nodes, keys, weights.get(keys[-1]))
        if amounts is None:
            nodes = nodes.withColumn("amount", F.lit(float(budget)))
        else:
            nodes = nodes.join(amounts.withColumnRenamed("given", "amount"), list(parent))
        amounts = share_out(nodes, parent, keys[-1])
    # A leaf without weight, or below a node without, gets nothing.
    found = leaves.join(amounts, list(tree), "left")
    target = F.round(F.coalesce("given", F.lit(0.0))).cast("long")
    return found.select(*tree, "tokens", target.alias("target"))


def mix(docs, share, weights=None, max_epochs=1, seed=0, tree=TREE):
    """doc_id, tree columns, tokens, copies: how often each row of `docs` is taken.

    Needs doc_id, text and the tree columns; a null key is a node of its own,
    shown as "-". `share` of all tokens is the budget. A null or empty text has
    no tokens and is never taken. Repeated rows are taken alike; equal places
    in the seeded order (repeated ids) are ordered by tokens. An empty table
    gives no rows.
    """
    slim = docs.select(
        "doc_id",
        *[F.coalesce(F.col(k).cast("string"), F.lit("-")).alias(k) for k in tree],
        word_tokens().alias("tokens"),
    ).checkpoint()
    leaves = slim.groupBy(*tree).agg(F.sum("tokens").alias("tokens"))
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs).checkpoint()
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    targets = leaf_targets(leaves, total * share, weights, tree)
    whole = F.when(F.col("leaf_tokens") > 0, F.floor(F.col("target") / F.col("leaf_tokens")))
    targets = targets.withColumnRenamed("tokens", "leaf_tokens").withColumn(
        "whole", F.coalesce(whole, F.lit(0)).cast("int")
    )
    targets = targets.select(
        *tree, "whole", (F.col("target") - F.col("whole") * F.col("leaf_tokens")).alias("rest")
    ).checkpoint()
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    rows = (
        slim.filter("tokens > 0")
        .join(broadcast_if_small(targets), list(tree))
        .withColumn("place", place)
        .withColumn("bucket", F.substring("place", 1, BUCKET_HEX))
    )
    run = Window.partitionBy(*tree).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most 4,096 rows per leaf, so a leaf with much of the data is summed up before.
    sums = rows.groupBy(*tree, "bucket").agg(F.sum("tokens").alias("n"))
    sums = sums.select(*tree, "bucket", "n", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"))
    rows = rows.join(sums, [*tree, "bucket"])
    # Buckets before the one that reaches the target are taken whole, later ones not at all.
    sure = F.col("before") + F.col("n") <= F.col("rest")
    edge = ~sure & (F.col("before") < F.col("rest"))
    within = Window.partitionBy(*tree, "bucket").orderBy("place", "tokens")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    kept = [*tree, "doc_id", "tokens", "whole"]
    inner = rows.filter(edge).withColumn("partial", (reached < F.col("rest")).cast("int"))
    outer = rows.filter(~edge).withColumn("partial", sure.cast("int"))
    out = inner.select(*kept, "partial").unionByName(outer.select(*kept, "partial"))
    out = out.withColumn("copies", F.col("whole") + F.col("partial")).filter("copies > 0")
    return out.select("doc_id", *tree, "tokens", "copies")


def take(docs, mixed):
    """The rows of `docs` that `mixed` takes, once for each copy."""
    ids = mixed.groupBy("doc_id").agg(F.max("copies").alias("_copies"))
    ids = ids.withColumnRenamed("doc_id", "_taken")
    met = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_taken")))
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(docs.columns)
