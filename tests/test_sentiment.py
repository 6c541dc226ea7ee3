import random
import re

import pytest
from pyspark.sql import functions as F

from echolex.functions import lexicons as W
from echolex.functions import sentiment as S

TEXT = F.col("text")


def versus(pos, neg):
    return "POSITIVE" if pos > neg else "NEGATIVE" if neg > pos else "NEUTRAL"


def plain_tokens(text, positive, negative):
    tokens = (text or "").lower().split()

    def hits(words):
        return sum(any(w in t for w in words) for t in tokens)

    return hits(positive), hits(negative)


def plain_presence(text, positive, negative):
    low = (text or "").lower()
    return versus(sum(w in low for w in positive), sum(w in low for w in negative))


def plain_exact(text):
    if not text or not text.strip():
        return "NEUTRAL"
    low = text.lower()
    words = set(re.findall(r"\b\w+\b", low))
    pos, neg = len(words & set(W.ENGLISH_POSITIVE)), len(words & set(W.ENGLISH_NEGATIVE))
    if pos != neg:
        return versus(pos, neg)
    if words & set(W.NEUTRAL_CUES) or "?" in text:
        return "NEUTRAL"
    if len(text) > 200:
        return "POSITIVE"
    return "NEGATIVE" if any(w in low for w in W.ERROR_WORDS) else "NEUTRAL"


@pytest.fixture(scope="module")
def corpus():
    """Texts of lexicon words, glued and spaced at random, and edge cases."""
    pick = random.Random(7)
    words = [*W.ENGLISH_POSITIVE, *W.ENGLISH_NEGATIVE, *W.NEUTRAL_CUES, *W.KOREAN_POSITIVE]
    words += [*W.KOREAN_NEGATIVE, *W.MIXED_NEGATIVE, "window", "made", "\x01", "wi\x01n", "_good_", "x9", "É"]
    gaps = ["", " ", "  ", "\t", "　", "\n", "\x1c", ".", "-", " "]
    texts = [
        "".join(
            (w.upper() if pick.random() < 0.2 else w) + pick.choice(gaps)
            for w in pick.choices(words, k=pick.randrange(1, 25))
        )
        for _ in range(400)
    ]
    return texts + ["good good bad", "I made a window", "what is this", "errors everywhere", "x" * 201, "", " 　", None]


def test_token_label(column_of, corpus):
    for language in ("en", "ko"):
        expected = [versus(*plain_tokens(t, *W.LEXICONS[language])) for t in corpus]
        assert column_of(corpus, S.token_label(TEXT, language)) == expected


def test_token_sentiment_by_row_language(spark, corpus):
    rows = [(i, t, ("ko", "en", "fr", None)[i % 4]) for i, t in enumerate(corpus)]
    df = spark.createDataFrame(rows, "i int, text string, lang string")
    got = df.select("i", S.token_sentiment(TEXT, F.col("lang")).alias("s")).collect()
    for i, s in got:
        text, language = rows[i][1], rows[i][2]
        pos, neg = plain_tokens(text, *W.LEXICONS["ko" if language == "ko" else "en"])
        blank = not (text or "").strip()
        confidence = 0.5 if blank else 0.6 if pos == neg else min(0.8, 0.5 + max(pos, neg) * 0.1)
        assert s["label"] == versus(pos, neg)
        assert s["confidence"] == pytest.approx(confidence)
        assert (s["source"], s["text_length"]) == ("local", 0 if blank else len(text))


def test_presence(column_of, corpus):
    pairs = [
        (S.presence_label(TEXT), W.ENGLISH_POSITIVE, W.ENGLISH_NEGATIVE),
        (S.korean_presence_label(TEXT), W.KOREAN_POSITIVE, W.KOREAN_NEGATIVE),
        (S.mixed_presence_label(TEXT), W.MIXED_POSITIVE, W.MIXED_NEGATIVE),
    ]
    for expression, positive, negative in pairs:
        expected = [plain_presence(t, positive, negative) for t in corpus]
        assert column_of(corpus, expression) == expected


def test_exact(column_of, corpus):
    assert column_of(corpus, S.exact_label(TEXT)) == [plain_exact(t) for t in corpus]


def test_scorers_differ_as_documented(column_of):
    values = ["good good bad", "I made a window", "errors everywhere", "x" * 201]
    assert column_of(values, S.token_label(TEXT)) == ["POSITIVE", "NEUTRAL", "NEGATIVE", "NEUTRAL"]
    assert column_of(values, S.presence_label(TEXT)) == ["NEUTRAL", "NEUTRAL", "NEGATIVE", "NEUTRAL"]
    assert column_of(values, S.exact_label(TEXT)) == ["NEUTRAL", "NEUTRAL", "NEGATIVE", "POSITIVE"]


def test_routed(spark):
    rows = [("ko", "최고 good", "POSITIVE"), ("en", "bad day", "NEGATIVE"), ("ja", "good", "NEUTRAL"), (None, "good", "NEUTRAL")]
    df = spark.createDataFrame(rows, "lang string, text string, expected string")
    wrong = df.filter(S.routed_label(TEXT, F.col("lang")) != F.col("expected"))
    assert wrong.isEmpty()


def test_label_score(column_of):
    values = ["Positive", "NEUTRAL", "negative", "other", None]
    assert column_of(values, S.label_score(TEXT)) == [1.0, 0.0, -1.0, 0.0, 0.0]


def test_model_labels(column_of):
    values = ["POSITIVE", "5_STARS", "4_stars", "1_STAR", "2_STARS", "3_STARS", "LABEL_0", "긍정", None]
    assert column_of(values, S.standard_label(TEXT)) == [
        "POSITIVE", "POSITIVE", "POSITIVE", "NEGATIVE", "NEGATIVE", "NEUTRAL", "NEUTRAL", "NEUTRAL", None,
    ]
    assert column_of(values, S.standard_label(TEXT, "label_id")) == [
        "POSITIVE", "NEUTRAL", "NEUTRAL", "NEUTRAL", "NEUTRAL", "NEUTRAL", "NEGATIVE", "POSITIVE", None,
    ]
    with pytest.raises(ValueError):
        S.standard_label(TEXT, "unknown")


def test_cascade(column_of):
    expression = S.cascade(F.nullif(TEXT, F.lit("")), F.lit(None).cast("string"))
    assert column_of(["POSITIVE", "", None], expression) == ["POSITIVE", "NEUTRAL", "NEUTRAL"]


def test_ascii_words_are_found_in_one_pass(spark):
    """One expression a list, instead of a search and a replacement for every word of it."""
    rows = spark.createDataFrame([("good",)], "text string")
    plan = rows.select(S.token_label(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    wide = rows.select(S.token_label(F.col("text"), "ko"))._jdf.queryExecution().optimizedPlan().toString()
    assert wide.count("replace(") > 50 and plan.count("replace(") == 0


def test_token_hits_equal_a_plain_count(spark):
    rng = random.Random(5)
    parts = ["win", "won", "goo", "good", "bad", "ba", "sad", "a", "\x01", "\x02", " ", " ", "\u3000", "\n", "좋은", "😀", ".*", "]"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "i int, text string")
    for words in (("good", "win", "won"), ("bad", "sad", "ad"), ("a",), (".*", "]", "win"), ("좋은", "win")):
        found = rows.select("i", S.token_hits(F.col("text"), words).alias("n")).collect()
        assert {r["i"]: r["n"] for r in found} == {
            **{i: sum(any(w in t for w in words) for t in re.split(r"[ \n\u3000]+", text)) for i, text in enumerate(texts)},
            len(texts): 0,
        }


@pytest.mark.parametrize("language", ["en", "ko", "ru"])
def test_narrowed_texts_have_the_same_hits(texts, language):
    """What is left of a text is short and holds its hits, for ASCII, Korean and a caller's lists."""
    own = {"ru": (("тхе", "up"), ("ин",))}
    values = ["goodbad xbadgood ok", "좋은나쁜 x나쁨최고 그냥", "тхеин upтхе нет", "mad\u00a0good\tgood", "", "none " * 50]
    pos, neg = {**S.LEXICONS, **own}[language]
    short = S.narrowed(F.col("text"), language, own)
    counts = [S.token_hits(t, words) for t in (F.col("text"), short) for words in (pos, neg)]
    for r in texts(values).select(*[c.alias(f"c{i}") for i, c in enumerate(counts)], F.length(short).alias("n")).collect():
        assert (r["c0"], r["c1"]) == (r["c2"], r["c3"]) and r["n"] <= 20
    assert texts(values).agg(F.sum(counts[0]), F.sum(counts[1])).first()[0] > 0
