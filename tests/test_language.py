from pyspark.sql import functions as F

from echolex.functions import language as L
from echolex.operators.distribution import corpus_language
from echolex.operators.scoring import with_language

CASES = {
    "안녕하세요 반갑 hi": "ko",
    "你好世界 ok": "zh",
    "こんにちは世界": "zh",
    "こんにちは": "ja",
    "カタカナ": "ja",
    "Привет мир": "ru",
    "สวัสดี": "th",
    "مرحبا": "ar",
    "plain text": "en",
    "déjà vu, naïve": "en",
    " ": "en",
    "": "en",
    "😀😀😀": "en",
    "한aaaaaaaaa": "en",  # one in ten is not more than a tenth
    "한aaaaaaaa": "ko",
    "한aaaa aaaaa": "en",  # spaces do not count
}


def test_seven_way(column_of):
    values = [*CASES, None]
    assert column_of(values, L.detect_language(F.col("text"))) == [*CASES.values(), "en"]


def test_two_way(column_of):
    values = ["plain 가 text", "plain", "Привет", None, " "]
    assert column_of(values, L.detect_korean(F.col("text"))) == ["ko", "en", "en", "en", "en"]


def test_bucket(column_of):
    values = ["ko", "en", "ja", None]
    assert column_of(values, L.language_bucket(F.col("text"))) == ["ko", "en", "other", "other"]


def test_corpus_language(spark):
    rows = spark.createDataFrame(
        [("a", "가나다"), ("a", "x" * 20), ("b", "가"), ("b", "y" * 20), ("c", None)],
        "author string, text string",
    )
    got = {r["author"]: r["language"] for r in corpus_language(rows, "author").collect()}
    assert got == {"a": "ko", "b": "en", "c": "en"}


def test_scripts_are_counted_in_what_lies_beyond_latin(spark):
    """The text is cut once a row; the branches of the rule read the cut text."""
    texts = ["plain", "", None, "ähnlich über Öl", "é" * 9 + "й", "é" * 8 + "й", "“quoted” — text", "가 " * 5 + "b" * 44, "가 " * 5 + "b" * 45, "😀" * 9 + "ก"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = with_language(rows)
    assert found.columns == ["i", "text", "detected_language"]
    assert [r[0] for r in found.orderBy("i").select("detected_language").collect()] == [
        "en", "en", "en", "en", "en", "ru", "en", "ko", "en", "en",
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(coalesce(text") == 1
