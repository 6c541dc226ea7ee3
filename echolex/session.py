"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

ARROW_BYTES = 16 << 20  # of an Arrow batch handed to Python
ARROW_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

# Settings the operators are written for. Adaptive execution merges small
# shuffle partitions and splits skewed ones; UTC keeps instants unshifted.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    ARROW_KEY: str(ARROW_BYTES),
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name="echolex", master=None, legacy_parquet=False, conf=None):
    """Create (or get) a session with the settings above.

    `legacy_parquet` writes decimals and nested lists in the older layout, for
    readers that need it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if legacy_parquet:
        settings["spark.sql.parquet.writeLegacyFormat"] = "true"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark):
    """Hand Python batches of bounded bytes: by rows alone a batch of long texts has no bound."""
    spark.conf.set(ARROW_KEY, str(ARROW_BYTES))


def shared_dir(spark):
    """The folder all executors can reach, as the cluster names it.

    Falls back to a temporary folder only in local mode, where driver and
    executors are one process.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="echolex-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark, label):
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark):
    """Set the checkpoint folder where the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
