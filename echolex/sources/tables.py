"""Parquet tables: reads with pruning, partitioned and report writes."""

import uuid

from pyspark.sql import functions as F

from echolex.functions.times import as_time, utc_day
from echolex.schemas import REPORT_SCHEMA, SCORED_SCHEMA

PARTITIONS = ("created_date", "detected_language")


def path_exists(spark, path):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(jvm_path)


def stored_bytes(spark, path):
    """Bytes of the files under a path."""
    return _file_system(spark, path).getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(path)).getLength()


def read_table(spark, *paths, merge_schema=False):
    """Read Parquet folders; files with differing columns unite by name."""
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def spread(df, partitions=None):
    """Deal a small input over `partitions` tasks before work that is heavy per row.

    Splits follow files and row groups, so a small table may come as one task.
    Without a number nothing is done: a large input fills the cluster by itself.
    """
    return df.repartition(partitions) if partitions else df


def read_or_empty(spark, path, schema=SCORED_SCHEMA):
    """Read a folder by declared schema; an absent or empty one has no rows.

    Columns a file lacks come out null, so files of several versions can be
    read together without opening every footer to merge schemas.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def describe_table(df):
    """Column names and types of a table."""
    return df.sparkSession.createDataFrame(df.dtypes, "name string, type string")


def sample_rows(df, n=5, order_by=None):
    """A few rows to look at, the first ones of an order when one is given."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def with_created_date(df):
    """Add the partition day: that of the instant in UTC."""
    return df.withColumn("created_date", utc_day(F.col("created_at")))


def write_scored(df, path, mode="append", compression="snappy"):
    """Write scored posts partitioned by day and language.

    `rebalance` sends the rows of a partition together, to avoid small files,
    and lets adaptive execution cut a large partition (one language may hold
    most of a day) into several tasks.
    """
    (
        with_created_date(df)
        .hint("rebalance", *PARTITIONS)
        .write.mode(mode)
        .option("compression", compression)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_scored(spark, path, since=None, languages=None):
    """Read partitioned scored posts; both filters prune folders."""
    df = spark.read.parquet(path)
    if since is not None:
        since = as_time(since)
        df = df.filter((F.col("created_date") >= utc_day(since)) & (F.col("created_at") >= since))
    if languages is not None:
        df = df.filter(F.col("detected_language").isin(*languages))
    return df


def compact(spark, path, day):
    """Write the files of one day anew, gathered; other days stay as they are.

    The day's rows go to a folder beside the table first, since a folder cannot
    be read while it is replaced.
    """
    staged = f"{path.rstrip('/')}.compact-{day}"
    rows = spark.read.parquet(path).filter(F.col("created_date") == F.lit(str(day)).cast("date"))
    rows.write.mode("overwrite").parquet(staged)
    (
        spark.read.parquet(staged)
        .hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
    remove_path(spark, staged)


def remove_path(spark, path):
    """Remove a folder the library made for itself."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(jvm_path, True)


def remove_paths(spark, paths):
    """Remove many folders of one file system."""
    fs = _file_system(spark, paths[0]) if paths else None
    for path in paths:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def _file_system(spark, path):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _move(spark, fs, old, new):
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(new).getParent())
    if not fs.rename(path(old), path(new)):
        raise OSError(f"cannot move {old} to {new}")


def staged_folder(path, label):
    """A new folder beside the data of a table, which readers of the table do not see."""
    return f"{path.rstrip('/')}/_staged/{label}-{uuid.uuid4().hex}"


def commit_folder(spark, staged, target):
    """Make a staged folder that of the table, in one move of the file system.

    What stood there before is moved aside first and removed last; a commit that
    broke off between the moves is undone by `recover_folders`.
    """
    fs, path = _file_system(spark, target), spark._jvm.org.apache.hadoop.fs.Path
    aside = _aside(target)
    if fs.exists(path(target)):
        fs.delete(path(aside), True)
        _move(spark, fs, target, aside)
    _move(spark, fs, staged, target)
    fs.delete(path(aside), True)


def _aside(target):
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_replaced-{name}"


def recover_folders(spark, folder):
    """Put back what a broken-off commit in `folder` had moved aside; remove what it had replaced."""
    fs, path = _file_system(spark, folder), spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(path(folder)):
        return
    for status in fs.listStatus(path(folder)):
        name = status.getPath().getName()
        if name.startswith("_replaced-"):
            target = f"{folder}/{name[len('_replaced-'):]}"
            if fs.exists(path(target)):
                fs.delete(path(f"{folder}/{name}"), True)
            else:
                _move(spark, fs, f"{folder}/{name}", target)


def write_legacy(df, path, compression="snappy"):
    """Write with decimals and lists in the older Parquet layout.

    The layout is a setting of the session, not of a writer; it is put back
    afterwards.
    """
    conf, key = df.sparkSession.conf, "spark.sql.parquet.writeLegacyFormat"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def write_report(report, path, compression="snappy"):
    """Store the report rows of some days; a day's rows replace what is there of it."""
    report = report.select(*[F.col(f.name).cast(f.dataType) for f in REPORT_SCHEMA])
    (
        report.withColumn("report_day", utc_day(F.col("report_date")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy("report_day")
        .parquet(path)
    )


def read_reports(spark, path):
    """All stored reports, one per day; an absent folder has none."""
    return read_or_empty(spark, path, REPORT_SCHEMA)
