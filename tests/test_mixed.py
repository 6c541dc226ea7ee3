import datetime as dt
import decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from echolex.sources import mixed as M
from echolex.sources import tables


def save(spark, path, ddl, *rows):
    spark.createDataFrame(list(rows), ddl).coalesce(1).write.parquet(str(path))


def read(spark, path, **options):
    return sorted(map(tuple, M.read_mixed(spark, str(path), **options).collect()), key=str)


def test_float_and_double(spark, tmp_path):
    save(spark, tmp_path / "a", "id string, x float", ("1", 1.5))
    save(spark, tmp_path / "b", "id string, x double", ("2", 0.1), ("3", None))
    with pytest.raises(Exception, match="CANNOT_MERGE"):
        tables.read_table(spark, str(tmp_path / "a"), str(tmp_path / "b"), merge_schema=True)
    assert read(spark, tmp_path) == [("1", 1.5), ("2", 0.1), ("3", None)]


def test_text_and_time(spark, tmp_path):
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    save(spark, tmp_path / "a", "id int, created_at string", (1, "2024-01-01 00:00:00"), (2, "soon"))
    save(spark, tmp_path / "b", "id int, created_at timestamp", (3, when))
    assert read(spark, tmp_path) == [(1, "2024-01-01 00:00:00"), (2, "soon"), (3, "2024-01-02 03:04:05")]
    got = read(spark, tmp_path, schema="created_at timestamp, id long, more string")
    assert got == [(None, 2, None), (dt.datetime(2024, 1, 1), 1, None), (when, 3, None)]


def test_columns_that_some_files_lack_and_nested_ones(spark, tmp_path):
    save(spark, tmp_path / "a", "id int, s struct<x:int>, l array<int>", (1, (1,), [1]))
    save(spark, tmp_path / "b", "s struct<y:string,x:long>, id long, l array<double>", (("q", 5), 2, [0.5]))
    got = M.read_mixed(spark, str(tmp_path))
    assert got.schema["s"].dataType == T.StructType.fromDDL("x long, y string")
    assert got.schema["l"].dataType == T.ArrayType(T.DoubleType())
    assert sorted(map(tuple, got.collect())) == [(1, (1, None), [1.0]), (2, (5, "q"), [0.5])]


def test_files_of_other_writers(spark, tmp_path):
    pq.write_table(pa.table({"id": pa.array([1], pa.int16()), "t": ["x"]}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"id": pa.array([70000], pa.int32())}), tmp_path / "b.parquet")
    assert read(spark, tmp_path) == [(1, "x"), (70000, None)]


def test_no_files(spark, tmp_path):
    assert M.read_mixed(spark, f"{tmp_path}/absent", schema="id int").count() == 0
    with pytest.raises(ValueError, match="no Parquet files"):
        M.read_mixed(spark, f"{tmp_path}/absent")


@pytest.mark.parametrize(
    "kinds, wanted",
    [
        ("byte int", "int"),
        ("int float", "double"),
        ("float double", "double"),
        ("long double", "double"),
        ("decimal(10,2) decimal(12,6)", "decimal(14,6)"),
        ("decimal(10,2) int", "decimal(12,2)"),
        ("decimal(38,0) decimal(38,10)", "string"),
        ("decimal(10,2) double", "double"),
        ("date timestamp", "timestamp"),
        ("boolean int", "string"),
        ("string timestamp", "string"),
        ("void int", "int"),
        ("void void", "string"),
        ("map<string,int> map<string,long>", "map<string,bigint>"),
    ],
)
def test_common_types(spark, kinds, wanted):
    kinds = [f.dataType for f in T.StructType.fromDDL(", ".join(f"c{i} {k}" for i, k in enumerate(kinds.split())))]
    for order in (kinds, kinds[::-1]):
        assert M.common_type(order).simpleString() == wanted


def test_legacy_layout_and_setting(spark, tmp_path):
    df = spark.createDataFrame([(decimal.Decimal("1.25"),)], "v decimal(18,4)")
    tables.write_legacy(df, f"{tmp_path}/legacy")
    df.write.parquet(f"{tmp_path}/plain")
    stored = {n: M.footers(spark, f"{tmp_path}/{n}").first()["physical"] for n in ("legacy", "plain")}
    assert stored == {"legacy": "FIXED_LEN_BYTE_ARRAY", "plain": "INT64"}
    assert read(spark, tmp_path) == [(decimal.Decimal("1.2500"),)] * 2
