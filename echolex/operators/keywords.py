"""Keyword counts and their JSON form."""

from pyspark.sql import functions as F

from echolex.functions.lexicons import STOPWORDS
from echolex.functions.text import keywords
from echolex.schemas import KEYWORDS_DDL


def keyword_counts(df, text="text", min_length=2, compat=False, stopwords=STOPWORDS, by=()):
    """Occurrences of each keyword, stopwords left out; with `by` for each value of those columns.

    A word list is tested before the shuffle. A DataFrame of stopwords (one
    `word` column, any size) is anti-joined after counting, when every word is
    down to one row and no word can be hot.
    """
    words = df.select(*by, F.explode(keywords(F.col(text), min_length, compat)).alias("word"))
    listed = isinstance(stopwords, (list, tuple, set, frozenset))
    if listed and stopwords:
        words = words.filter(~F.col("word").isin(*sorted(set(stopwords))))
    counts = words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))
    return counts if listed else counts.join(stopwords.select("word"), "word", "left_anti")


def top_keywords(df, n=10, **options):
    """The most frequent keywords; equal counts are ordered by word."""
    return keyword_counts(df, **options).orderBy(F.col("count").desc(), "word").limit(n)


def keywords_json(top):
    """One row with the keywords as a JSON list, most frequent first."""
    ranked = F.array_sort(
        F.collect_list(F.struct((-F.col("count")).alias("order"), F.col("word"), F.col("count")))
    )
    pairs = F.transform(ranked, lambda k: F.struct(k["word"].alias("word"), k["count"].alias("count")))
    return top.agg(F.to_json(pairs).alias("top_keywords"))


def parse_keywords(reports, column="top_keywords"):
    """Keyword rows (rank, word, count) of stored reports; bad JSON gives none."""
    kept = [c for c in reports.columns if c != column]
    parsed = F.from_json(F.col(column), KEYWORDS_DDL)
    return reports.select(*kept, F.posexplode(parsed).alias("pos", "keyword")).select(
        *kept, (F.col("pos") + 1).alias("rank"), "keyword.word", "keyword.count"
    )
