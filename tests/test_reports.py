import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from echolex.operators import distribution, errors, keywords, quality
from echolex.plans.report import daily_report, latest_report, read_model
from echolex.sources.tables import read_reports, write_report

AS_OF = datetime(2024, 1, 10, 12)
DDL = "id string, created_at timestamp, text string, detected_language string, sentiment_label string"


def scored(spark):
    rows = [
        ("1", AS_OF, "Great news, great weather", "en", "POSITIVE"),
        ("2", AS_OF - timedelta(hours=3), "news of the weather", "en", "neutral"),
        ("3", AS_OF - timedelta(hours=5), "좋은 날씨 news", "ko", "Negative"),
        ("4", AS_OF - timedelta(hours=30), "old old old", "ja", "POSITIVE"),
        ("5", AS_OF - timedelta(hours=2), "a b c", None, None),
    ]
    return spark.createDataFrame(rows, DDL)


def test_daily_report(spark):
    row = daily_report(scored(spark), AS_OF, n=3).first()
    assert row["report_date"] == AS_OF and row["average_sentiment_score"] == 0.0
    assert json.loads(row["top_keywords"]) == [
        {"word": "news", "count": 3},
        {"word": "great", "count": 2},
        {"word": "weather", "count": 2},
    ]
    assert json.loads(daily_report(scored(spark), AS_OF, "calendar", 1).first()["top_keywords"])[0]["count"] == 3


def test_daily_report_accepts_text_times_and_empty_days(spark):
    as_text = scored(spark).withColumn("created_at", F.col("created_at").cast("string"))
    assert daily_report(as_text, AS_OF).count() == 1
    assert daily_report(scored(spark), datetime(2030, 1, 1)).count() == 0


def test_report_store_and_read_model(spark, tmp_path):
    path = f"{tmp_path}/reports"
    assert read_reports(spark, path).count() == 0
    for day in (AS_OF - timedelta(days=1), AS_OF, AS_OF):
        write_report(daily_report(scored(spark), day), path)
    reports = read_reports(spark, path)
    assert reports.count() == 2
    latest = latest_report(reports).first()
    assert latest["report_date"] == AS_OF and latest["report_time"] == AS_OF + timedelta(hours=9)
    frames = read_model(scored(spark), reports, n=1)
    assert tuple(frames["kpis"].first()) == (5, 1, 2, 2)
    assert {tuple(r) for r in frames["labels"].collect()} == {
        ("en", "POSITIVE", 1), ("en", "neutral", 1), ("ko", "Negative", 1), ("other", "POSITIVE", 1),
    }
    assert {(r["lang_bucket"], r["id"]) for r in frames["newest"].collect()} == {("en", "1"), ("ko", "3"), ("other", "5")}
    assert [(r["rank"], r["word"]) for r in frames["keywords"].orderBy("rank").limit(2).collect()] == [(1, "news"), (2, "great")]


def test_bad_keyword_json_gives_no_rows(spark):
    reports = spark.createDataFrame([(1, "not json"), (2, '[{"word": "a", "count": 3}]')], "n int, top_keywords string")
    assert [tuple(r) for r in keywords.parse_keywords(reports).collect()] == [(2, 1, "a", 3)]


def test_stopword_table(spark):
    stop = spark.createDataFrame([("news",)], "word string")
    words = {r["word"] for r in keywords.keyword_counts(scored(spark), stopwords=stop).collect()}
    assert "news" not in words and "the" in words


def test_distributions(spark):
    df = scored(spark)
    assert {tuple(r) for r in distribution.label_distribution(df).collect()} >= {("POSITIVE", 2), (None, 1)}
    assert distribution.language_distribution(df).filter("detected_language = 'en'").first()["n"] == 2


def test_freshness(spark):
    assert tuple(quality.freshness(scored(spark), AS_OF).first()) == (1, True)
    assert tuple(quality.freshness(scored(spark), AS_OF + timedelta(hours=2)).first()) == (0, False)


def test_quality_report(spark):
    rows = [
        ("1", "2024-01-01 00:00:00", "t", "en", "POSITIVE"),
        ("1", "soon", None, "xx", "ODD"),
        ("1", None, "t", None, None),
        (None, "2024-01-01 00:00:00", "t", "ko", "NEUTRAL"),
        (None, "2024-01-01 00:00:00", "t", "ko", "NEUTRAL"),
    ]
    df = spark.createDataFrame(rows, DDL.replace("timestamp", "string"))
    got = {r["check"]: (r["failures"], r["n_rows"], r["ok"]) for r in quality.quality_report(df).collect()}
    assert got == {
        "duplicate_id": (2, 5, False),
        "missing_id": (2, 5, False),
        "missing_text": (1, 5, False),
        "missing_created_at": (1, 5, False),
        "missing_detected_language": (1, 5, False),
        "missing_sentiment_label": (1, 5, False),
        "malformed_created_at": (1, 5, False),
        "invalid_language": (1, 5, False),
        "invalid_label": (1, 5, False),
    }
    empty = {r["check"]: r["failures"] for r in quality.quality_report(df.limit(0)).collect()}
    assert set(empty.values()) == {0}


def error_rows(spark):
    rows = [
        (AS_OF, "api", "HIGH", True, True),
        (AS_OF - timedelta(hours=23), "api", "LOW", True, False),
        (AS_OF - timedelta(hours=1), "db", "CRITICAL", False, False),
        (AS_OF - timedelta(hours=24), "db", "LOW", True, True),
        (AS_OF - timedelta(hours=2), None, "LOW", None, None),
    ]
    return spark.createDataFrame(
        rows, "timestamp timestamp, component string, severity string, recovery_attempted boolean, recovery_successful boolean"
    )


def test_error_statistics(spark):
    states = spark.createDataFrame([("api", "OPEN"), (None, "OPEN"), ("db", None)], "component string, state string")
    row = errors.error_statistics(error_rows(spark), AS_OF, states=states).first()
    assert row["total_errors"] == 4
    assert row["component_breakdown"] == {"api": 2, "db": 1}
    assert row["severity_breakdown"] == {"HIGH": 1, "LOW": 2, "CRITICAL": 1}
    assert row["recovery_success_rate"] == 50.0
    assert row["circuit_breaker_states"] == {"api": "OPEN"}
    none = errors.error_statistics(error_rows(spark), datetime(2030, 1, 1)).first()
    assert (none["total_errors"], none["component_breakdown"], none["recovery_success_rate"]) == (0, {}, 0.0)


def test_alerts_and_rate(spark):
    assert {r["alert"] for r in errors.alerts(error_rows(spark)).collect()} == {
        "🚨 ALERT: HIGH error in api", "🚨 ALERT: CRITICAL error in db",
    }
    assert errors.recovery_rate(error_rows(spark)).first()["recovery_success_rate"] > 66
    assert errors.recovery_rate(error_rows(spark).limit(0)).first()["recovery_success_rate"] == 0.0
