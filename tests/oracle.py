"""Runs a query on Spark and its SQL twin on DuckDB and compares the rows."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def type_names(df, relation):
    """Column types of both sides by family, to catch int/long/double mix-ups."""
    spark = {"bigint": "int64", "int": "int32", "double": "double", "string": "text", "boolean": "bool"}
    duck = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool"}
    left = {name: spark.get(kind, kind) for name, kind in df.dtypes}
    right = {n: duck.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    return left, right


def compare(df, con, sql):
    """(spark rows, oracle rows, spark types, oracle types), each in one order."""
    relation = con.sql(sql)
    types = type_names(df, relation)
    return (
        _rows(df.columns, [tuple(r) for r in df.collect()]),
        _rows(relation.columns, relation.fetchall()),
        *types,
    )
