"""Parquet files of several versions read as one table, whatever the type of a column was in each.

Spark reads a folder with one type per column, and a merge of schemas fails on
a float beside a double or a text beside a time. Here the footers of all files
are read by the tasks, files of one schema are one version, every column gets a
type that holds all of its versions, and each version is one scan with casts.
"""

import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
FOOTERS_DDL = "file string, schema string, column string, physical string"
INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
INTEGER_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
FLOATS = (T.FloatType(), T.DoubleType())
TIMES = (T.DateType(), T.TimestampNTZType(), T.TimestampType())


def _footer(path):
    """(Spark schema as JSON, [(column, physical type)]) of a Parquet file."""
    from pyspark.sql.pandas.types import from_arrow_schema

    scheme, colon, rest = path.partition(":")
    uri = f"{scheme}://{rest}" if colon and not rest.startswith("//") else path
    fs, name = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(name) as source:
        meta = pq.ParquetFile(source).metadata
        written = (meta.metadata or {}).get(SPARK_SCHEMA)
        schema = written.decode() if written else from_arrow_schema(meta.schema.to_arrow_schema(), True).json()
        columns = [meta.schema.column(i) for i in range(meta.num_columns)]
        return schema, [(c.path, c.physical_type) for c in columns]


def footers(spark, *paths):
    """(file, schema, column, physical) of all Parquet files below the paths, read by the tasks.

    `schema` is that of Spark as JSON, `physical` the type a column is stored
    in. A file without columns has none of either.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")

    def read(batches):
        for batch in batches:
            rows = [
                {"file": path, "schema": schema, "column": column, "physical": physical}
                for path in batch.column(0).to_pylist()
                for schema, columns in [_footer(path)]
                for column, physical in columns
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    return files.load(list(paths)).select("path").mapInArrow(read, FOOTERS_DDL)


def common_type(kinds):
    """The narrowest type that holds all values of the given types; text where there is none."""
    kinds = [k for k in dict.fromkeys(kinds) if not isinstance(k, T.NullType)]
    if not kinds:
        return T.StringType()
    out = kinds[0]
    for kind in kinds[1:]:
        out = _wider(out, kind)
    return out


def _wider(a, b):
    if a == b:
        return a
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.index)
    numbers = (*INTEGERS, *FLOATS)
    if a in numbers and b in numbers:
        return T.DoubleType()  # a float does not hold all integers
    decimals = [k for k in (a, b) if isinstance(k, T.DecimalType)]
    if decimals and all(isinstance(k, T.DecimalType) or k in INTEGERS for k in (a, b)):
        scale = max(k.scale for k in decimals)
        whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else INTEGER_DIGITS[k] for k in (a, b))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if decimals and (a in FLOATS or b in FLOATS):
        return T.DoubleType()
    if a in TIMES and b in TIMES:
        return max(a, b, key=TIMES.index)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type([a.elementType, b.elementType]), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, common_type([a.valueType, b.valueType]), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    return T.StringType()


def common_schema(schemas):
    """Columns of all schemas by name, in the order they are first met, each with its common type."""
    kinds = {}
    for schema in schemas:
        for f in schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)
    return T.StructType([T.StructField(n, common_type(k)) for n, k in kinds.items()])


def _as(column, stored, wanted):
    """A stored value as the wanted type; a text that cannot be read is null."""
    if stored == wanted:
        return column
    if isinstance(stored, T.StructType) and isinstance(wanted, T.StructType):
        kinds = {f.name: f.dataType for f in stored.fields}
        fields = [
            (_as(column[f.name], kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(stored, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: _as(x, stored.elementType, wanted.elementType))
    if isinstance(stored, T.MapType) and isinstance(wanted, T.MapType):
        return F.transform_values(column, lambda _, x: _as(x, stored.valueType, wanted.valueType))
    if isinstance(stored, (T.StructType, T.ArrayType, T.MapType)) and isinstance(wanted, T.StringType):
        return F.to_json(column)
    if isinstance(stored, T.StringType):
        return F.try_to_timestamp(column) if isinstance(wanted, T.TimestampType) else column.try_cast(wanted)
    return column.cast(wanted)


def _cast(name, stored, wanted):
    value = F.lit(None).cast(wanted) if stored is None else _as(F.col(f"`{name}`"), stored, wanted)
    return value.alias(name)


def read_mixed(spark, *paths, schema=None):
    """All Parquet files below the paths as one table.

    With `schema` the columns are those it names, in its types; otherwise all
    columns that occur, each in a type that holds every version of it (numbers
    with numbers, times with times, anything else as text). Columns that a file
    lacks are null. Paths without files give no rows of `schema`, and an error
    without one. Folders that carry a column in their name do not add it.
    """
    if schema is None:
        schemas = _versions(spark, paths)
        if not schemas:
            raise ValueError(f"no Parquet files below {', '.join(paths)}")
        wanted = common_schema([s for s, _ in schemas])
    else:
        wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        schemas = _versions(spark, paths)
    out = None
    for stored, files in schemas:
        kinds = {f.name: f.dataType for f in stored.fields}
        rows = spark.read.schema(stored).parquet(*files)
        rows = rows.select(*[_cast(f.name, kinds.get(f.name), f.dataType) for f in wanted.fields])
        out = rows if out is None else out.unionAll(rows)
    return spark.createDataFrame([], wanted) if out is None else out


def _versions(spark, paths):
    """[(schema, files)]: files of one schema together. Names of files come to the driver, as in any scan."""
    from echolex.sources.tables import path_exists

    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        return []
    found = footers(spark, *there).select("file", "schema").distinct()
    versions = found.groupBy("schema").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return [
        (T.StructType.fromJson(json.loads(r["schema"])), r["files"]) for r in versions.orderBy("files").collect()
    ]
