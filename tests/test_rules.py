"""Times, replies, recovery rules."""

from datetime import datetime

from pyspark.sql import functions as F

from echolex.functions import recovery, replies, times
from echolex.operators.cleaning import ensure_timestamp, recent
from echolex.operators.errors import with_strategy

TEXT = F.col("text")


def shown(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def test_epoch(spark):
    values = [(1755560080.9,), (1e300,), (float("nan"),), (None,)]
    df = spark.createDataFrame(values, "s double")
    got = [r[0] for r in df.select(shown(times.epoch_to_timestamp(F.col("s")))).collect()]
    assert got[0] == "2025-08-18 23:34:40" and got[1] is None and got[3] is None
    local = df.limit(1).select(shown(times.epoch_to_local(F.col("s")))).first()[0]
    assert local == "2025-08-19 08:34:40"


def test_korean_time(column_of):
    values = ["2024-01-01 00:00:00", None]
    ts = TEXT.cast("timestamp")
    assert column_of(values, times.format_kst(ts)) == ["2024-01-01 09:00:00 KST", None]
    assert column_of(values, times.format_kst(ts, naive=True))[0] == "2024-01-01 00:00:00 KST"
    assert column_of(values, times.format_kst(ts, as_of="2024-01-02 20:00:00"))[1] == "2024-01-03 05:00:00 KST"
    assert column_of(values, shown(times.kst_to_utc(times.utc_to_kst(ts)))) == values
    assert column_of(values, shown(times.report_time(ts)))[0] == "2024-01-01 09:00:00"


def test_recency_modes(spark):
    stamps = ["2024-01-09 00:00:00", "2024-01-09 12:00:00", "2024-01-10 11:00:00", "2024-01-10 12:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.to_timestamp("s").alias("created_at"))
    as_of = datetime(2024, 1, 10, 12)
    assert recent(df, as_of).count() == 3
    assert recent(df, as_of, strict=True).count() == 2
    assert recent(df, as_of, mode="calendar").count() == 4
    assert recent(df, as_of, hours=1).count() == 2
    assert recent(df, "2024-01-10 12:00:00", hours=1, strict=True).count() == 1


def test_ensure_timestamp(spark):
    df = spark.createDataFrame([("2024-01-01 01:02:03",), ("soon",), (None,)], "created_at string")
    fixed = ensure_timestamp(df)
    assert fixed.schema["created_at"].dataType.typeName() == "timestamp"
    assert [r[0] for r in fixed.select(shown("created_at")).collect()] == ["2024-01-01 01:02:03", None, None]
    assert ensure_timestamp(fixed) is fixed


def test_parse_reply(column_of):
    values = [
        '{"sentiment": "POSITIVE", "confidence": 0.9}',
        ' {"sentiment": "NEGATIVE", "confidence": "0.25"}',
        '{"sentiment": "NEGATIVE"}',
        '{"confidence": 0.7}',
        '{"sentiment": "NEGATIVE", "confidence": "high"}',
        "POSITIVE",
        '[{"sentiment": "POSITIVE"}]',
        '{"sentiment": "POS',
        None,
    ]
    got = [(r["label"], r["confidence"]) for r in column_of(values, replies.parse_reply(TEXT))]
    assert got == [
        ("POSITIVE", 0.9),
        ("NEGATIVE", 0.25),
        ("NEGATIVE", 0.5),
        ("NEUTRAL", 0.7),
        ("NEUTRAL", 0.5),
        ("NEUTRAL", 0.5),
        ("NEUTRAL", 0.5),
        ("NEUTRAL", 0.5),
        ("NEUTRAL", 0.5),
    ]


def test_recovery_rules(column_of, spark):
    values = ["TimeoutError", "OpenAIError", "SparkError", "DiskSpaceError", "KeyError", None]
    expected = ["RETRY", "FALLBACK", "RESTART", "MANUAL", "MANUAL", "MANUAL"]
    assert column_of(values, recovery.recovery_strategy(TEXT)) == expected
    names = ["Sentiment-API", "API", "my_Database", "other", None]
    assert column_of(names, recovery.fallback_rule(TEXT)) == [
        "keyword_scoring", "local_processing", "cached_data", None, None,
    ]
    own = spark.createDataFrame([("KeyError", "RETRY")], "error_type string, strategy string")
    errors = spark.createDataFrame([("KeyError", 1), ("TimeoutError", 2)], "error_type string, n int")
    got = with_strategy(errors, own).collect()
    assert {r["n"]: r["strategy"] for r in got} == {1: "RETRY", 2: "MANUAL"}
