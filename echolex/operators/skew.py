"""Joins and rankings that stay balanced when one key holds much of the data."""

from pyspark.sql import Window
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 1_000_000
# Sub-groups a large ranking is cut in first.
RANK_SALTS = 64


def hot_keys(counts, key, n="n", hot_rows=HOT_ROWS):
    """The keys of a (key, n) table above `hot_rows`, with the number of salts each gets.

    There are at most as many as all rows over `hot_rows`.
    """
    salts = F.ceil(F.col(n) / hot_rows).cast("int")
    return counts.filter((F.col(n) > hot_rows) & F.col(key).isNotNull()).select(key, salts.alias("salts"))


def lookup_join(rows, table, key, spread, how="left", counts=None, hot_rows=HOT_ROWS):
    """Join `rows` to `table` (unique on `key`) with hot keys salted.

    `counts` holds rows per key (key, n); it is computed with map-side
    combining when not given. Rows of a hot key are dealt to `salts` tasks by
    the hash of `spread`, and the one matching table row is repeated that many
    times, so a task gets some `hot_rows` rows of a key. Null keys match
    nothing; they are dealt over all shuffle partitions. All other keys take
    salt 0. Broadcast are the hot keys, one per `hot_rows` rows at most.
    """
    if counts is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(counts, key, hot_rows=hot_rows))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.coalesce(F.col("salts"), F.lit(1))
    dealt = F.when(F.col(key).isNull(), F.lit(16 * tasks)).otherwise(salts)
    left = rows.join(hot, key, "left").withColumn(
        "salt", F.pmod(F.xxhash64(spread), dealt).cast("int")
    )
    right = table.join(hot, key, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return left.drop("salts").join(right.drop("salts"), [key, "salt"], how).drop("salt")


def top_per_group(df, keys, order, n, spread):
    """First `n` rows of each group by `order`, which must be total.

    Spark cuts each group to `n` rows per task before the shuffle (its window
    group limit), for `n` up to a session threshold. A larger `n` ranks within
    salted sub-groups first, so a large group never meets in one task whole.
    """
    spark = df.sparkSession
    threshold = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(RANK_SALTS)))
        df = _ranked(salted, [*keys, "_salt"], order, n).drop("_salt")
    return _ranked(df, keys, order, n)


def _ranked(df, keys, order, n):
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
