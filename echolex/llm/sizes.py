"""Settings and sizes the operators share."""

from pyspark.sql import functions as F

from echolex.session import ensure_checkpoint_dir

MAX_ROWS = 10_000
BATCH_BYTES = 4 << 20


def broadcast_if_small(table, rows=MAX_ROWS):
    """`table`, marked for broadcast if it has at most `rows` rows; it should be cheap to count.

    A join that shuffles by the key of a small table would send a frequent key
    to one task. Beyond the limit the join is left to Spark.
    """
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def prepare(spark):
    """Checkpoint folder where none is set, and Arrow batches of bounded bytes for long texts."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
