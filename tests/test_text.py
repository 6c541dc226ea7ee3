import hashlib

from pyspark.sql import functions as F

from echolex.functions import text as X
from echolex.operators.cleaning import clean_posts

TEXT = F.col("text")


def test_whitespace_is_unicode_white_space():
    assert set(X.WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_strip_and_truncate(column_of):
    values = ["　 a b\t\n", "abc", " ", None]
    assert column_of(values, X.strip(TEXT)) == ["a b", "abc", "", None]
    assert column_of(values, X.truncate(TEXT, 2)) == ["a ", "ab", "", None]


def test_blank(column_of):
    assert column_of([None, "", "　\t\n", " ", "x"], X.is_blank(TEXT)) == [True] * 4 + [False]


def test_tokenize_orders(column_of):
    assert column_of(["Great News"], X.tokenize(TEXT)) == [["great", "news"]]
    assert column_of(["Great News"], X.tokenize(TEXT, compat=True)) == [["", "reat", "", "ews"]]


def test_keywords_equal_long_tokens(column_of):
    values = ["Great News, it's 한국어 a b 10%", "", "ONE  two", "x"]
    for compat in (False, True):
        tokens = column_of(values, X.tokenize(TEXT, compat))
        expected = [[t for t in row if len(t) > 1] for row in tokens]
        assert column_of(values, X.keywords(TEXT, compat=compat)) == expected


def test_cache_key(column_of):
    digest = hashlib.md5("가 a:local".encode()).hexdigest()
    assert column_of(["가 a", None], X.cache_key(TEXT)) == [digest, None]


def test_mask_names_first_term(column_of):
    values = ["The TOKEN and the password", "api Key", "nothing", None]
    assert column_of(values, X.mask_sensitive(TEXT)) == [
        "[로그에 민감한 정보 포함됨 - password]",
        "[로그에 민감한 정보 포함됨 - key]",
        "nothing",
        None,
    ]


CLEANING = [
    (None, False, False),
    ("short", False, False),
    ("hello world foo", True, False),
    ("some long text [deleted] here", False, False),
    ("some long text [removed] here", False, False),
    ("!!! ??? ... --- *** ###", False, False),
    ("This post contains content not supported on old clients", True, False),
    ("안녕하세요 반갑습니다 오늘", True, False),
    ("안녕하세요 반갑습니다 오늘도 좋은 하루 되세요", True, True),
    ("a long enough English sentence", True, True),
]


def test_clean_presets(texts):
    rows = texts([t for t, _, _ in CLEANING])
    kept = {r["i"] for r in clean_posts(rows).collect()}
    strict = {r["i"] for r in clean_posts(rows, "strict").collect()}
    assert kept == {i for i, c in enumerate(CLEANING) if c[1]}
    assert strict == {i for i, c in enumerate(CLEANING) if c[2]}


def test_clean_compat_drops_non_latin(texts):
    rows = texts(["안녕하세요 반갑습니다 오늘", "안녕하세요 반갑습니다 ok", "plain English text"])
    assert {r["i"] for r in clean_posts(rows, compat=True).collect()} == {1, 2}
