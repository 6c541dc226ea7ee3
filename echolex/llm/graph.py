"""Connected components of a link table, on Spark."""

from pyspark.sql import Window
from pyspark.sql import functions as F

MAX_ROUNDS = 60
ROWS_PER_TASK = 250_000


def _is_star(edges):
    """Every child has one parent, and no parent is a child."""
    ends = edges.select(F.col("child").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("parent", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _round(edges):
    """One large-star and one small-star step; children are larger than parents."""
    both = edges.unionAll(edges.select(F.col("parent"), F.col("child")))
    least = both.groupBy("child").agg(F.min("parent").alias("least"))
    least = least.select(F.col("child").alias("parent"), F.least("child", "least").alias("least"))
    moved = edges.join(least, "parent").select("child", F.col("least").alias("parent"))
    # Dealt by child once, for the distinct rows and the minimum of each child.
    moved = moved.repartition("child").distinct()
    moved = moved.withColumn("least", F.min("parent").over(Window.partitionBy("child")))
    aside = moved.filter("parent != least").select(F.col("parent").alias("child"), F.col("least").alias("parent"))
    return aside.unionAll(moved.select("child", F.col("least").alias("parent"))).distinct()


def _kept(edges, rows=None):
    """Checkpointed edges and their number, in as many files as that number needs."""
    if rows is not None:
        edges = edges.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    edges = edges.checkpoint()
    return edges, edges.count()


def components(links, a="a", b="b"):
    """node, component (its smallest node) of every node of a link other than to itself.

    Alternates star contractions until every component is a star around its
    smallest node. Only minima are aggregated, so a node with very many links
    is combined before the shuffle. Nulls link nothing; repeated links count once.
    """
    edges, rows = _kept(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent"))
        .distinct()
    )
    for _ in range(MAX_ROUNDS):
        if _is_star(edges):
            roots = edges.select(F.col("parent").alias("node")).distinct()
            return edges.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionAll(
                roots.select("node", F.col("node").alias("component"))
            )
        edges, rows = _kept(_round(edges), rows)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def linked_groups(nodes, links, node="rep", name="group"):
    """node, group: nodes of one group are connected by links, though not all connected ones share it.

    The group is the smallest linked node, followed twice; far cheaper than
    `components` where connected nodes are mostly linked to one and the same.
    """
    both = links.select(F.col("a").alias(node), F.col("b").alias("to")).unionAll(links.select("b", "a"))
    up = both.groupBy(node).agg(F.min("to").alias("to"))
    up = up.select(node, F.least(node, "to").alias("to")).checkpoint()
    above = up.select(F.col(node).alias("to"), F.col("to").alias("above"))
    up = up.join(above, "to", "left").select(node, F.coalesce("above", "to").alias(name))
    return nodes.join(up, node, "left").select(node, F.coalesce(name, node).alias(name))
