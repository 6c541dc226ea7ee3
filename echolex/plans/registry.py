"""The queries of the engine over the benchmark tables, by name."""

import time
from functools import reduce

from pyspark.sql import functions as F

from echolex.functions import replies, times
from echolex.functions import sentiment as S
from echolex.functions.text import cache_key, mask_sensitive, or_empty, truncate
from echolex.operators import (
    cache,
    cleaning,
    distribution,
    errors,
    keywords,
    quality,
    ranking,
    scoring,
)
from echolex.plans import incremental
from echolex.plans.report import daily_report, latest_report, read_model
from echolex.plans.score import score_posts
from echolex.session import ensure_checkpoint_dir, scratch_path
from echolex.sources import message_log, mixed, tables, testdata
from echolex.sources.cache_store import CacheStore
from echolex.sources import posts as P
from echolex.streaming import posts as stream
from echolex.streaming import windows

TIME = "yyyy-MM-dd HH:mm:ss"
ONCE = {"availableNow": True}
STREAM_FILES = 6
SINK_FILES = 3
LOG_BATCHES = 4
EVENT_PARTS = 4
FILE_BYTES = 1 << 20  # of the input, in a file of messages; a batch has so many that tasks come out even
LOG_TASK_ROWS = 10_000
# Word lists a caller may bring: Russian ones, and English ones in place of the built-in.
OWN_LEXICONS = {"ru": (("тхе", "аб"), ("ин", "ел")), "en": (("great", "tion"), ("awful", "er"))}


def _doc(spark, sf_dir):
    return testdata.documents(spark, sf_dir)


def _scored(spark, sf_dir, **options):
    return score_posts(testdata.multiscript_posts(spark, sf_dir), **options)


def _stored_scores(spark, sf_dir, path):
    """Scored posts stored and read back, for queries that need them several times."""
    _scored(spark, sf_dir).write.parquet(path)
    return tables.read_or_empty(spark, path)


def _timed(spark, sf_dir):
    return scoring.with_created_at(testdata.posts(spark, sf_dir))


def _shown(ts):
    return F.date_format(ts, TIME)


def _or_dash(name):
    """Nulls shown as a dash, so that both engines hand out the same value."""
    return F.coalesce(name, F.lit("-")).alias(name)


def _result(df, *columns):
    """Scored rows reduced to what is compared."""
    return df.select("id", _shown("created_at").alias("created_at"), *columns)


# --- cleaning, language, labels ---------------------------------------------


def label_counts(spark, sf_dir):
    return distribution.label_distribution(score_posts(testdata.posts(spark, sf_dir)))


def scored_posts(spark, sf_dir):
    return _result(_scored(spark, sf_dir), "detected_language", "sentiment_label")


def _cleaned(preset="current", compat=False):
    def query(spark, sf_dir):
        kept = cleaning.clean_posts(testdata.multiscript_posts(spark, sf_dir), preset, compat)
        return kept.select("id", F.length("text").cast("bigint").alias("n_chars"))

    return query


def _detected(two_way):
    def query(spark, sf_dir):
        rows = testdata.multiscript_posts(spark, sf_dir)
        return scoring.with_language(rows, two_way=two_way).select("id", "detected_language")

    return query


def lexicon_tokens(spark, sf_dir):
    rows = scoring.with_language(testdata.multiscript_posts(spark, sf_dir))
    return scoring.with_sentiment(rows).select(
        "id",
        "sentiment.label",
        F.round("sentiment.confidence", 6).alias("confidence"),
        "sentiment.source",
        F.col("sentiment.text_length").cast("bigint").alias("text_length"),
    )


def lexicon_presence(spark, sf_dir):
    rows = testdata.multiscript_posts(spark, sf_dir).select("id", F.lower("text").alias("text"))
    text = F.col("text")
    return rows.select(
        "id",
        S.presence_label(text, lowered=text).alias("english"),
        S.korean_presence_label(text, text).alias("korean"),
        S.mixed_presence_label(text, text).alias("mixed"),
    )


def lexicon_exact(spark, sf_dir):
    rows = testdata.multiscript_posts(spark, sf_dir)
    return scoring.with_label(rows, "exact").select("id", "sentiment_label")


def routed_label(spark, sf_dir):
    scored = _scored(spark, sf_dir, preset="strict", scorer="routed")
    return scored.select("id", "detected_language", "sentiment_label")


def label_score(spark, sf_dir):
    shouted = F.when(F.length("text") % 2 == 0, F.lower("sentiment_label")).otherwise(
        F.col("sentiment_label")
    )
    return _scored(spark, sf_dir).select("id", S.label_score(shouted).alias("score"))


def avg_sentiment(spark, sf_dir):
    return distribution.avg_sentiment(_scored(spark, sf_dir)).select(
        F.round("average_sentiment_score", 6).alias("average_sentiment_score"), "n_posts"
    )


def _raw_labels(spark, sf_dir):
    """Labels as models print them, made from the length and language of each text."""
    n = F.col("n_chars")
    stars = n % 5 + 1
    names = F.array(*map(F.lit, ("긍정", "부정", "중립", "positive", "Negative", "mixed")))
    raw = (
        F.when(F.col("lang") == "es", F.concat(F.lit("LABEL_"), n % 4))
        .when(F.col("lang") == "de", F.element_at(names, (n % 6 + 1).cast("int")))
        .otherwise(F.concat(stars, F.when(stars == 1, "_star").otherwise("_STARS")))
    )
    return _doc(spark, sf_dir).select("doc_id", raw.alias("raw"))


def _standard(scheme):
    def query(spark, sf_dir):
        label = S.standard_label(F.col("raw"), scheme).alias("label")
        return _raw_labels(spark, sf_dir).select("doc_id", "raw", label)

    return query


def truncate_text(spark, sf_dir):
    cut = truncate(F.col("text"), 1000)
    return _doc(spark, sf_dir).select(
        "doc_id", F.length(cut).cast("bigint").alias("n_chars"), F.md5(cut).alias("digest")
    )


def cascade(spark, sf_dir):
    """Model label where the text names one, then the token label, then NEUTRAL."""
    text = F.col("text")
    model = F.when(text.contains("then"), "positive").when(text.contains("tion"), "1_star")
    tokens = F.when(F.length("text") > 500, S.token_label(text))
    return _doc(spark, sf_dir).select(
        "doc_id", S.cascade(S.standard_label(model), tokens).alias("label")
    )


def _stub_model():
    """Stands in for a model: stars by text length, and a failure for long texts."""

    def predict(texts):
        if any(len(t) > 5000 for t in texts):
            raise ValueError("text too long")
        return [f"{len(t) % 5 + 1}_STARS" for t in texts]

    return predict


def model_score(spark, sf_dir):
    """Labels, which rows the model failed on, and how many did."""
    model = scoring.model_scorer(_stub_model)
    scored = _scored(spark, sf_dir, model=model, status="failed").select("id", "sentiment_label", "failed")
    total = scored.agg(F.count_if("failed").alias("failed_rows"))
    return scored.withColumn("failed_rows", total.scalar())


def lexicon_custom(spark, sf_dir):
    """Labels with word lists of the caller for two languages."""
    scored = _scored(spark, sf_dir, lexicons=OWN_LEXICONS)
    return scored.select("id", "detected_language", "sentiment_label")


def score_distinct(spark, sf_dir):
    rows = testdata.posts(spark, sf_dir)
    labelled = scoring.score_distinct(rows, scoring.label_texts)
    return labelled.select("id", "sentiment_label")


def parse_reply(spark, sf_dir):
    """Replies of several shapes, some unreadable, read back."""
    # Projections of their own: the lower-cased text and the label are computed once per row.
    rows = _doc(spark, sf_dir).withColumn("lowered", F.lower(or_empty(F.col("text"))))
    rows = rows.select("doc_id", "n_chars", S.presence_label(F.col("text"), lowered=F.col("lowered")).alias("label"))
    n, label = F.col("n_chars"), F.col("label")
    reply = (
        F.when(n % 5 == 0, F.concat(F.lit("label: "), label))
        .when(n % 5 == 1, F.to_json(F.struct(label.alias("sentiment"))))
        .when(n % 5 == 2, F.to_json(F.struct(label.alias("sentiment"), F.lit("high").alias("confidence"))))
        .when(n % 5 == 3, F.to_json(F.struct((n % 100 / 100).alias("confidence"))))
        .otherwise(F.to_json(F.struct(label.alias("sentiment"), (n % 100 / 100).alias("confidence"))))
    )
    parsed = rows.select("doc_id", replies.parse_reply(reply).alias("r"))
    return parsed.select("doc_id", "r.label", F.round("r.confidence", 6).alias("confidence"))


# --- keywords and reports ----------------------------------------------------


def keyword_counts(spark, sf_dir):
    return keywords.keyword_counts(testdata.multiscript_posts(spark, sf_dir))


def keyword_counts_table(spark, sf_dir):
    """Keywords that do not occur in `benchmark`, given as a stopword table."""
    banned = keywords.keyword_counts(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), stopwords=())
    return keywords.keyword_counts(testdata.posts(spark, sf_dir), stopwords=banned)


def top_keywords(spark, sf_dir):
    return keywords.top_keywords(testdata.multiscript_posts(spark, sf_dir))


def top_keywords_compat(spark, sf_dir):
    return keywords.top_keywords(testdata.multiscript_posts(spark, sf_dir), compat=True)


def _report(spark, sf_dir, mode="rolling"):
    as_of = cleaning.latest_time(_timed(spark, sf_dir))
    return daily_report(_scored(spark, sf_dir), as_of, mode)


def _daily(mode):
    def query(spark, sf_dir):
        return _report(spark, sf_dir, mode).select(
            _shown("report_date").alias("report_date"),
            F.round("average_sentiment_score", 6).alias("average_sentiment_score"),
            "top_keywords",
        )

    return query


def report_keywords_parsed(spark, sf_dir):
    parsed = keywords.parse_keywords(_report(spark, sf_dir).select("top_keywords"))
    return parsed.select(F.col("rank").cast("bigint").alias("rank"), "word", "count")


def _incremental(mode):
    def query(spark, sf_dir):
        """The report of the last day from states of three batches, one of them stored twice."""
        base = scratch_path(spark, "states")
        scored = _scored(spark, sf_dir)
        for batch in (0, 1, 2, 1):
            part = scored.filter(F.pmod(F.col("id").cast("long"), F.lit(3)) == batch)
            incremental.write_report_states(part, batch, base)
        as_of = cleaning.latest_time(_timed(spark, sf_dir))
        report = incremental.incremental_report(incremental.read_states(spark, base), as_of, mode)
        return _settled(spark, base, _shown_report(report))

    return query


def _shown_report(report):
    return report.select(
        _shown("report_date").alias("report_date"),
        F.round("average_sentiment_score", 6).alias("average_sentiment_score"),
        "top_keywords",
    )


def latest_report_query(spark, sf_dir):
    """Newest of one report per day, made from the days of the posts."""
    reports = (
        _scored(spark, sf_dir)
        .groupBy(F.date_trunc("day", "created_at").alias("report_date"))
        .agg(F.avg(S.label_score(F.col("sentiment_label"))).alias("average_sentiment_score"))
    )
    return latest_report(reports).select(
        _shown("report_date").alias("report_date"),
        _shown("report_time").alias("report_time"),
        F.round("average_sentiment_score", 6).alias("average_sentiment_score"),
    )


def language_kpis(spark, sf_dir):
    return distribution.language_kpis(_scored(spark, sf_dir))


def language_distribution(spark, sf_dir):
    return distribution.language_distribution(_scored(spark, sf_dir))


def labels_by_language(spark, sf_dir):
    return distribution.labels_by_language(_scored(spark, sf_dir))


def latest_per_language(spark, sf_dir):
    newest = ranking.latest_per_bucket(_scored(spark, sf_dir))
    return _result(newest, "lang_bucket", "sentiment_label")


def newest_posts(spark, sf_dir):
    return _result(ranking.newest(_scored(spark, sf_dir)), "sentiment_label")


def corpus_language(spark, sf_dir):
    return distribution.corpus_language(testdata.multiscript_posts(spark, sf_dir), "author_name")


# --- time --------------------------------------------------------------------


def epoch_to_local(spark, sf_dir):
    local = times.epoch_to_local(F.col("created_utc"))
    return testdata.posts(spark, sf_dir).select("id", _shown(local).alias("local_time"))


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def utc_kst_roundtrip(spark, sf_dir):
    kst = times.utc_to_kst(F.col("ts"))
    return _events(spark, sf_dir).select(
        "event_id", _shown(kst).alias("kst"), _shown(times.kst_to_utc(kst)).alias("utc")
    )


def format_kst(spark, sf_dir):
    ts = F.when(F.col("event_type") != "view", F.col("ts"))
    return _events(spark, sf_dir).select(
        "event_id",
        times.format_kst(ts, as_of="2024-02-01 00:00:00").alias("shown"),
        times.format_kst(F.col("ts"), naive=True).alias("shown_naive"),
    )


def report_time_display(spark, sf_dir):
    shown = times.report_time(F.col("ts"))
    return _events(spark, sf_dir).select("event_id", _shown(shown).alias("shown"))


def _recent(mode):
    def query(spark, sf_dir):
        rows = _timed(spark, sf_dir)
        kept = cleaning.recent(rows, cleaning.latest_time(rows), mode=mode)
        return kept.select("id", _shown("created_at").alias("created_at"))

    return query


def freshness(spark, sf_dir):
    rows = _timed(spark, sf_dir)
    return quality.freshness(rows, cleaning.latest_time(rows))


def ensure_timestamp(spark, sf_dir):
    """Event times stored as text, those of one type unreadable."""
    text = F.when(F.col("event_type") == "view", "soon").otherwise(_shown("ts"))
    rows = _events(spark, sf_dir).select("event_id", text.alias("created_at"))
    repaired = cleaning.ensure_timestamp(rows)
    seconds = F.coalesce(F.unix_seconds("created_at"), F.lit(-1))
    return repaired.select("event_id", seconds.alias("seconds"))


# --- ingest, storage, quality -------------------------------------------------


def union_posts(spark, sf_dir):
    rows = P.union_posts(*testdata.conversation_sources(spark, sf_dir))
    return rows.select(
        "id",
        "created_utc",
        "author_name",
        "type",
        "submission_id",
        _or_dash("parent_id"),
        F.md5("text").alias("digest"),
    )


def blank_filter(spark, sf_dir):
    """Texts of `conversations` with those of short turns blanked out."""
    text = F.when(F.length("text") > 100, F.col("text")).when(F.col("turn") % 2 == 0, F.lit("　\t\n"))
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return P.drop_blank(rows.withColumn("text", text)).select("conv_id", "turn")


def json_roundtrip(spark, sf_dir):
    rows = P.parse_posts(P.to_messages(testdata.multiscript_posts(spark, sf_dir)))
    return rows.select(
        "id",
        _or_dash("title"),
        "created_utc",
        "author_name",
        "type",
        _or_dash("parent_id"),
        F.md5("text").alias("digest"),
    )


def _messages_with_errors(spark, sf_dir):
    """Messages, those of one source cut short."""
    rows = testdata.posts(spark, sf_dir)
    value = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    cut = F.substring(value, 1, 20)
    return rows.select(F.when(F.col("author_name") == "src3", cut).otherwise(value).alias("value"))


def json_rejects(spark, sf_dir):
    """Posts per author and unreadable messages, counted over one decoding."""
    tagged = P.tagged_posts(_messages_with_errors(spark, sf_dir))
    author = F.when(F.col(P.CORRUPT).isNotNull(), F.lit("(rejected)")).otherwise(F.col("author_name"))
    return tagged.groupBy(author.alias("author_name")).agg(F.count(F.lit(1)).alias("n"))


def describe_table(spark, sf_dir):
    return tables.describe_table(_doc(spark, sf_dir))


def _settled(spark, base, result):
    """A result kept in the checkpoint folder, so that the query's own folder can go."""
    ensure_checkpoint_dir(spark)
    kept = result.checkpoint()
    tables.remove_path(spark, base)
    return kept


def merged_read(spark, sf_dir):
    """Files of two versions and an absent folder read together, by declared schema."""
    base = scratch_path(spark, "versions")
    rows = _doc(spark, sf_dir)
    rows.filter("doc_id % 2 = 0").select("doc_id", "lang").write.parquet(f"{base}/old")
    rows.filter("doc_id % 2 = 1").select("doc_id", "lang", "source").write.parquet(f"{base}/new")
    both = tables.read_table(spark, f"{base}/old", f"{base}/new", merge_schema=True)
    none = tables.read_or_empty(spark, f"{base}/absent", both.schema)
    read = both.unionByName(none)
    return _settled(spark, base, read.select("doc_id", "lang", _or_dash("source")))


def written_formats(spark, sf_dir):
    """Event values written in both layouts and compressions, read back with how they are stored."""
    base = scratch_path(spark, "formats")
    rows = _events(spark, sf_dir).select("event_id", F.col("value").cast("decimal(18,4)").alias("value"))
    rows.write.option("compression", "zstd").parquet(f"{base}/plain")
    tables.write_legacy(rows, f"{base}/legacy", "gzip")
    parts = []
    for name in ("plain", "legacy"):
        stored = mixed.footers(spark, f"{base}/{name}").filter("column = 'value'").agg(F.max("physical")).scalar()
        read = spark.read.parquet(f"{base}/{name}")
        parts.append(read.select("event_id", F.col("value").cast("double").alias("value"), F.lit(name).alias("layout"), stored.alias("physical")))
    return _settled(spark, base, parts[0].unionAll(parts[1]))


def mixed_types_read(spark, sf_dir):
    """Posts stored in three versions that differ in columns and types, read as one table."""
    base = scratch_path(spark, "mixed")
    rows = _scored(spark, sf_dir).select("id", "created_utc", "created_at", F.length("text").alias("n"), "sentiment_label")
    part = F.pmod(F.col("id").cast("long"), F.lit(3))
    rows.filter(part == 0).select(
        "id", F.col("created_utc").cast("float"), _shown("created_at").alias("created_at"), "n"
    ).write.parquet(f"{base}/a")
    rows.filter(part == 1).withColumn("n", F.col("n").cast("long")).write.parquet(f"{base}/b")
    rows.filter(part == 2).withColumn("id", F.col("id").cast("long")).withColumn("n", F.col("n") / 2).write.parquet(f"{base}/c")
    found = mixed.read_mixed(spark, base)
    declared = mixed.read_mixed(spark, base, schema="id string, created_at timestamp")
    both = found.select("id", "created_utc", "n", _or_dash("sentiment_label")).join(
        declared.select("id", _shown("created_at").alias("created_at")), "id"
    )
    return _settled(spark, base, both)


def empty_window_report(spark, sf_dir):
    """The daily report of a day without posts, and of the last day: one row in all."""
    scored = _scored(spark, sf_dir)
    as_of = cleaning.latest_time(_timed(spark, sf_dir))
    late = daily_report(scored, as_of + F.expr("INTERVAL 30 DAYS"))
    both = daily_report(scored, as_of).unionByName(late)
    return both.select(_shown("report_date").alias("report_date"), F.round("average_sentiment_score", 6).alias("average_sentiment_score"))


def quality_report(spark, sf_dir):
    """Checks over scored posts of which some fields were damaged by source."""
    source = F.col("author_name")
    damaged = _scored(spark, sf_dir).withColumns(
        {
            "id": F.when(source == "src4", "0").when(source != "src5", F.col("id")),
            "created_at": F.when(source == "src6", "soon").otherwise(_shown("created_at")),
            "sentiment_label": F.when(source == "src7", "UNKNOWN").otherwise(F.col("sentiment_label")),
        }
    )
    return quality.quality_report(damaged)


def sample_rows(spark, sf_dir):
    rows = _doc(spark, sf_dir).select("doc_id", "lang", "source", "n_chars")
    return tables.sample_rows(rows, 5, [F.col("n_chars").desc(), F.col("doc_id")])


def partitioned_read(spark, sf_dir):
    """Scored posts written by day and language; English of the last day read back."""
    path = scratch_path(spark, "scored")
    tables.write_scored(_scored(spark, sf_dir), path)
    since = cleaning.latest_time(_timed(spark, sf_dir)) - F.expr("INTERVAL 1 DAY")
    kept = tables.read_scored(spark, path, since, ["en", "ko"])
    return _settled(spark, path, _result(kept, "detected_language", "sentiment_label"))


def _reports(spark, sf_dir):
    """Stored reports of the last two days, that of the last day written twice; posts are scored once and stored."""
    base = scratch_path(spark, "reports")
    scored = _stored_scores(spark, sf_dir, f"{base}/scored")
    as_of = cleaning.latest_time(_timed(spark, sf_dir))
    for at in (as_of - F.expr("INTERVAL 1 DAY"), as_of, as_of):
        tables.write_report(daily_report(scored, at), f"{base}/table")
    return base, scored, tables.read_reports(spark, f"{base}/table")


def report_store(spark, sf_dir):
    base, _, stored = _reports(spark, sf_dir)
    counted = stored.agg(F.count(F.lit(1)).alias("n_reports"))
    latest = latest_report(stored).select(
        _shown("report_date").alias("report_date"), F.round("average_sentiment_score", 6).alias("average_sentiment_score")
    )
    return _settled(spark, base, latest.withColumn("n_reports", counted.scalar()))


def read_model_query(spark, sf_dir):
    """All frames of the read model as (frame, key, value) rows."""
    base, scored, stored = _reports(spark, sf_dir)
    frames = read_model(scored, stored)

    def rows(name, key, value):
        return frames[name].select(F.lit(name).alias("frame"), key.alias("key"), value.cast("string").alias("value"))

    c = F.col
    names = ("total", "ko", "en", "other")
    kpis = F.create_map(*[x for k in names for x in (F.lit(k), c(k).cast("string"))])
    parts = [
        frames["kpis"].select(F.lit("kpis").alias("frame"), F.explode(kpis).alias("key", "value")),
        rows("labels", F.concat_ws("/", "lang_bucket", "sentiment_label"), c("n")),
        rows("newest", F.concat_ws("/", "lang_bucket", "id"), c("sentiment_label")),
        rows("report", F.lit("report_date"), _shown("report_date")),
        rows("keywords", c("rank").cast("string"), c("word")),
    ]
    return _settled(spark, base, reduce(lambda a, b: a.unionByName(b), parts))


# --- score cache and limits ---------------------------------------------------


def _cache(spark, sf_dir):
    """One entry per document, of its text, at its time."""
    rows = scoring.with_sentiment(_timed(spark, sf_dir).withColumn("detected_language", F.lit("en")))
    return rows.select(
        cache_key(F.col("text")).alias("key"),
        F.col("sentiment").alias("result"),
        F.col("created_at").alias("cached_at"),
    )


def cache_key_query(spark, sf_dir):
    return testdata.posts(spark, sf_dir).select("id", cache_key(F.col("text")).alias("key"))


def cache_split(spark, sf_dir):
    rows = testdata.posts(spark, sf_dir)
    as_of = cleaning.latest_time(_timed(spark, sf_dir))
    found = cache.lookup_cached(rows, _cache(spark, sf_dir), as_of)
    hits = found.select("id", F.col("result").isNotNull().alias("hit"), "result.label")
    return hits.withColumn("label", _or_dash("label"))


def cache_evict(spark, sf_dir):
    kept = cache.evict(_cache(spark, sf_dir), 100)
    return kept.select("key", "result.label", _shown("cached_at").alias("cached_at"))


def cache_store(spark, sf_dir):
    """The lookup of `cache_split` in a stored cache, filled in two goes that overlap, its old days removed."""
    base = scratch_path(spark, "cache")
    rows, timed = testdata.posts(spark, sf_dir), _timed(spark, sf_dir)
    as_of = timed.agg(F.max("created_at")).first()[0]
    name = "cache_" + base.rsplit("-", 1)[-1]
    store = CacheStore(spark, name, base, buckets=8)
    number = F.xxhash64("key") % 3
    entries = _cache(spark, sf_dir)
    store.store(entries.filter(number != 0))
    store.store(entries.filter(number != 1))
    store.expire(as_of)
    found = store.lookup(rows, as_of)
    hits = found.select("id", F.col("result").isNotNull().alias("hit"), "result.label")
    kept = _settled(spark, base, hits.withColumn("label", _or_dash("label")))
    spark.sql(f"DROP TABLE {name}")
    return kept


def _capped(width, limit):
    def query(spark, sf_dir):
        calls = testdata.call_outcomes(spark, sf_dir)
        kept = ranking.cap_per_window(calls, "component", "ts", limit, "call_id", width)
        return kept.select("component", "call_id", _shown("window_start").alias("window_start"))

    return query


# --- errors -------------------------------------------------------------------


def _errors(spark, sf_dir):
    return testdata.error_events(spark, sf_dir)


def _error_time(spark, sf_dir):
    return cleaning.latest_time(_errors(spark, sf_dir), "timestamp")


def recent_errors(spark, sf_dir):
    rows = errors.recent_errors(_errors(spark, sf_dir), _error_time(spark, sf_dir))
    return rows.select("event_id", "component", "severity")


def _error_counts(column):
    return lambda spark, sf_dir: errors.error_counts(_errors(spark, sf_dir), column)


def recovery_rate(spark, sf_dir):
    return errors.recovery_rate(_errors(spark, sf_dir)).select(
        "attempts", "successes", F.round("recovery_success_rate", 6).alias("recovery_success_rate")
    )


def error_breakdown(spark, sf_dir):
    rows = errors.error_breakdown(_errors(spark, sf_dir))
    return rows.select("dimension", _or_dash("value"), "n")


def _entries(name):
    """A map as sorted text, for comparison."""
    pairs = F.transform(
        F.array_sort(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.array_join(pairs, ";").alias(name)


def error_statistics(spark, sf_dir):
    report = errors.error_statistics(_errors(spark, sf_dir), _error_time(spark, sf_dir), hours=168)
    return report.select(
        "total_errors",
        _entries("component_breakdown"),
        _entries("severity_breakdown"),
        F.round("recovery_success_rate", 6).alias("recovery_success_rate"),
    )


def recovery_strategy(spark, sf_dir):
    rows = errors.with_strategy(_errors(spark, sf_dir))
    return rows.select("event_id", "error_type", "strategy")


def recovery_strategy_table(spark, sf_dir):
    """Strategies from a table of the caller, made from the error types that occur."""
    rows = _errors(spark, sf_dir)
    given = F.when(F.col("error_type").startswith("T"), "WAIT").otherwise("SKIP")
    table = rows.filter("error_type != 'Other'").select("error_type").distinct().withColumn("strategy", given)
    return errors.with_strategy(rows, table).select("event_id", "error_type", "strategy")


def fallback_rule(spark, sf_dir):
    """Fallbacks of components named after what they do."""
    kind = F.col("error_type")
    name = (
        F.when(kind == "TimeoutError", "Sentiment_")
        .when(kind == "HTTPError", "public_API_")
        .when(kind == "SparkError", "Database_")
        .otherwise("")
    )
    rows = _errors(spark, sf_dir).withColumn("component", F.concat(name, F.col("component")))
    rows = errors.with_fallback(rows)
    return rows.select("event_id", _or_dash("fallback"))


def alerts(spark, sf_dir):
    return errors.alerts(_errors(spark, sf_dir)).select("event_id", "severity", "alert")


def mask_sensitive_query(spark, sf_dir):
    masked = mask_sensitive(F.col("text"))
    shown = F.when(masked == F.col("text"), F.md5("text")).otherwise(masked)
    return _doc(spark, sf_dir).select("doc_id", shown.alias("shown"))


# --- streaming ------------------------------------------------------------------


def _batch_files(spark, sf_dir, batches):
    """Files a batch of messages is dealt over: one, and more where its share of the input is large."""
    return testdata.document_shares(spark, sf_dir, batches * FILE_BYTES)


def _message_files(spark, sf_dir, base, batches=STREAM_FILES):
    """The stream of the files that `_stream_messages` has written."""
    return stream.read_messages_stream(
        spark, "parquet", path=f"{base}/in", maxFilesPerTrigger=_batch_files(spark, sf_dir, batches)
    )


def _stream_messages(spark, sf_dir, base, rows=None, batches=STREAM_FILES):
    """JSON messages in files, streamed in `batches` batches of as many files."""
    messages = P.to_messages(testdata.multiscript_posts(spark, sf_dir)) if rows is None else rows
    messages.repartition(batches * _batch_files(spark, sf_dir, batches)).write.parquet(f"{base}/in")
    return _message_files(spark, sf_dir, base, batches)


def stream_scored(spark, sf_dir):
    base = scratch_path(spark, "stream")
    scored = stream.score_messages(_stream_messages(spark, sf_dir, base))
    stream.start_file_sink(scored, f"{base}/table", f"{base}/checkpoint", ONCE).awaitTermination()
    stored = spark.read.parquet(f"{base}/table")
    return _settled(spark, base, _result(stored, "detected_language", "sentiment_label"))


def stream_idempotent(spark, sf_dir):
    """The batch sink over several batches, one of them written again as after a failure."""
    base = scratch_path(spark, "stream")
    scored = stream.score_messages(_stream_messages(spark, sf_dir, base))
    stream.start_batch_sink(scored, f"{base}/table", f"{base}/checkpoint", trigger=ONCE).awaitTermination()
    ids = spark.read.parquet(f"{base}/table").filter("batch_id = 1").select("id")
    ids.write.parquet(f"{base}/ids")
    again = testdata.multiscript_posts(spark, sf_dir).join(spark.read.parquet(f"{base}/ids"), "id", "left_semi")
    stream.write_scored_batch(score_posts(again), 1, f"{base}/table")
    stored = spark.read.parquet(f"{base}/table")
    return _settled(spark, base, _result(stored, "detected_language", "sentiment_label"))


def _metrics(spark, sf_dir, base):
    scored = stream.score_messages(_stream_messages(spark, sf_dir, base))
    name = base.rsplit("/", 1)[-1]
    listener = stream.MetricsTable(spark, f"{base}/metrics", name)
    query = stream.start_file_sink(scored, f"{base}/table", f"{base}/checkpoint", ONCE, name=name)
    query.awaitTermination()
    listener.finish()
    return stream.stream_metrics(spark, f"{base}/metrics")


def stream_metrics(spark, sf_dir):
    """Run totals over all batches."""
    base = scratch_path(spark, "stream")
    return _settled(spark, base, stream.run_counters(_metrics(spark, sf_dir, base)))


def stream_batch_metrics(spark, sf_dir):
    """Run totals from the rows the batches stored themselves, one of them stored again after a failure."""
    base = scratch_path(spark, "stream")
    for again in (False, True):
        if again:
            tables.remove_path(spark, f"{base}/checkpoint/commits/{STREAM_FILES - 1}")
            messages = _message_files(spark, sf_dir, base)
        else:
            messages = _stream_messages(spark, sf_dir, base)
        stream.start_split_sink(
            messages, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", trigger=ONCE, metrics=f"{base}/metrics"
        ).awaitTermination()
    return _settled(spark, base, stream.run_counters(stream.stream_metrics(spark, f"{base}/metrics")))


def stream_throughput(spark, sf_dir):
    """Batches with rows, their rows, and whether each one's rates were measured."""
    base = scratch_path(spark, "stream")
    measured = (F.col("seconds") > 0) & (F.col("processed_rows_per_second") > 0)
    rows = _metrics(spark, sf_dir, base).filter("input_rows > 0")
    totals = rows.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"), F.every(measured).alias("measured")
    )
    return _settled(spark, base, totals)


def stream_dedup(spark, sf_dir):
    """Every message sent twice, the older half of the posts last: each id is stored once."""
    base = scratch_path(spark, "stream")
    sent = P.to_messages(testdata.multiscript_posts(spark, sf_dir))
    messages = _stream_messages(spark, sf_dir, base, sent.unionAll(sent))
    scored = stream.score_messages(messages, dedup_within="1 hour")
    stream.start_file_sink(scored, f"{base}/table", f"{base}/checkpoint", ONCE).awaitTermination()
    stored = spark.read.parquet(f"{base}/table")
    return _settled(spark, base, _result(stored, "detected_language", "sentiment_label"))


def stream_rejects(spark, sf_dir):
    """Posts and unreadable messages stored by a stream, per batch sink."""
    base = scratch_path(spark, "stream")
    messages = _stream_messages(spark, sf_dir, base, _messages_with_errors(spark, sf_dir))
    stream.start_split_sink(
        messages, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", trigger=ONCE
    ).awaitTermination()
    good = spark.read.parquet(f"{base}/table").select(F.lit("post").alias("kind"))
    bad = spark.read.parquet(f"{base}/rejects").select(F.lit("reject").alias("kind"))
    counts = good.unionAll(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return _settled(spark, base, counts)


def stream_commit(spark, sf_dir):
    """Rows by language that readers find of a batch while its new version is staged, dropped, and committed."""
    base = scratch_path(spark, "commit")
    table, scored = f"{base}/table", _scored(spark, sf_dir)
    even = scored.filter(F.col("id").cast("long") % 2 == 0)
    stream.write_scored_batch(even, 0, table)
    parts = []

    def look(phase):
        rows = spark.read.parquet(table).groupBy("detected_language").agg(F.count(F.lit(1)).alias("n"))
        parts.append(rows.select(F.lit(phase).alias("phase"), "detected_language", "n").checkpoint())

    ensure_checkpoint_dir(spark)
    staged = tables.staged_folder(table, "posts-0")
    stream.stage_scored_batch(scored, staged)
    look("staged")
    broken = scored.withColumn("text", F.raise_error(F.lit("broke off")).cast("string"))
    try:
        stream.write_scored_batch(broken, 0, table)
    except Exception as failure:
        if "broke off" not in str(failure):
            raise
    look("dropped")
    tables.commit_folder(spark, staged, stream.batch_folder(table, "posts", 0))
    look("committed")
    return _settled(spark, base, reduce(lambda a, b: a.unionAll(b), parts))


def _read_to_end(start, batches=None):
    """Run a stream until nothing is left, or stop it after some batches."""
    query = start()
    try:
        while batches is not None and query.isActive and (query.lastProgress or {"batchId": -1})["batchId"] < batches:
            time.sleep(0.05)
        if batches is None:
            stream.drain(query)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()


def stream_offsets(spark, sf_dir):
    """A capped stream from a message log, stopped midway and started again."""
    base = scratch_path(spark, "log")
    messages = P.to_messages(testdata.multiscript_posts(spark, sf_dir))
    message_log.append(messages.repartition(3 * _batch_files(spark, sf_dir, 3)), f"{base}/log", partitions=3)
    rows = messages.count()

    def start():
        log = stream.read_messages_stream(
            spark, "message_log", schema=None, path=f"{base}/log",
            maxOffsetsPerTrigger=-(-rows // LOG_BATCHES), group="scorer", rowsPerTask=LOG_TASK_ROWS,
        )
        scored = stream.score_messages(log)
        return stream.start_batch_sink(scored, f"{base}/table", f"{base}/checkpoint", trigger={"processingTime": "0 seconds"})

    _read_to_end(start, batches=1)
    _read_to_end(start)
    stored = spark.read.parquet(f"{base}/table")
    return _settled(spark, base, _result(stored, "detected_language", "sentiment_label"))


def _event_stream(spark, sf_dir, base):
    """Calls of components as a stream whose batches come in the order of time."""
    calls, micros = testdata.call_outcomes(spark, sf_dir), F.unix_micros("ts")
    shares = F.array(*[F.lit(i / EVENT_PARTS) for i in range(1, EVENT_PARTS)])
    cuts = calls.agg(F.percentile_approx(micros, shares)).first()[0]
    part = reduce(lambda n, cut: n + (micros >= cut).cast("int"), cuts, F.lit(0))
    for i in range(EVENT_PARTS):  # files are streamed in the order they were written
        calls.filter(part == i).coalesce(1).write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1)
    return source.parquet(f"{base}/in")


def _stateful(build):
    """Run a stateful operator over the calls and read what it wrote."""

    def query(spark, sf_dir):
        base = scratch_path(spark, "windows")
        with windows.stateful_session(spark):
            rows = build(_event_stream(spark, sf_dir, base))
            writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
            writer.option("path", f"{base}/out").trigger(**ONCE).start().awaitTermination()
        found = spark.read.schema(rows.schema).parquet(f"{base}/out")
        shown = found.withColumn("window_start", _shown("window_start"))
        return _settled(spark, base, shown.drop("ts"))

    return query


def _cap_calls(calls):
    calls = calls.select("component", "ts", "call_id")
    return windows.cap_stream(calls, "component", "ts", 2, "call_id", "1 hour")


def _fresh_components(calls):
    return windows.freshness_stream(calls, "component", "ts")


def message_sink(spark, sf_dir):
    """Messages sent by a stream to a log, its last batch sent again as after a failure."""
    base = scratch_path(spark, "sink")
    for _ in range(2):
        if tables.path_exists(spark, f"{base}/checkpoint/commits/{SINK_FILES - 1}"):
            tables.remove_path(spark, f"{base}/checkpoint/commits/{SINK_FILES - 1}")
            messages = _message_files(spark, sf_dir, base, SINK_FILES)
        else:
            messages = _stream_messages(spark, sf_dir, base, batches=SINK_FILES)
        message_log.start_message_sink(messages, f"{base}/log", f"{base}/checkpoint", "posts", 2, ONCE).awaitTermination()
    sent = spark.read.format("message_log").load(f"{base}/log")
    rows = P.parse_posts(sent).select("id", "created_utc", "author_name", "type", F.md5("text").alias("digest"))
    return _settled(spark, base, rows)


QUERIES = {
    "label_distribution": label_counts,
    "score_posts": scored_posts,
    "clean_posts": _cleaned(),
    "clean_posts_strict": _cleaned("strict"),
    "clean_posts_compat": _cleaned(compat=True),
    "detect_language": _detected(two_way=False),
    "detect_language_two_way": _detected(two_way=True),
    "lexicon_tokens": lexicon_tokens,
    "lexicon_presence": lexicon_presence,
    "lexicon_exact": lexicon_exact,
    "routed_label": routed_label,
    "label_score": label_score,
    "avg_sentiment": avg_sentiment,
    "standard_label": _standard("stars"),
    "label_id_map": _standard("label_id"),
    "truncate_text": truncate_text,
    "cascade": cascade,
    "model_score": model_score,
    "score_distinct": score_distinct,
    "parse_reply": parse_reply,
    "keyword_counts": keyword_counts,
    "keyword_counts_table": keyword_counts_table,
    "top_keywords": top_keywords,
    "top_keywords_compat": top_keywords_compat,
    "daily_report": _daily("rolling"),
    "daily_report_calendar": _daily("calendar"),
    "report_keywords_parsed": report_keywords_parsed,
    "latest_report": latest_report_query,
    "language_kpis": language_kpis,
    "language_distribution": language_distribution,
    "labels_by_language": labels_by_language,
    "latest_per_language": latest_per_language,
    "newest_posts": newest_posts,
    "corpus_language": corpus_language,
    "epoch_to_local": epoch_to_local,
    "utc_kst_roundtrip": utc_kst_roundtrip,
    "format_kst": format_kst,
    "report_time_display": report_time_display,
    "recent_rolling": _recent("rolling"),
    "recent_calendar": _recent("calendar"),
    "freshness": freshness,
    "ensure_timestamp": ensure_timestamp,
    "union_posts": union_posts,
    "blank_filter": blank_filter,
    "json_roundtrip": json_roundtrip,
    "json_rejects": json_rejects,
    "quality_report": quality_report,
    "sample_rows": sample_rows,
    "partitioned_read": partitioned_read,
    "cache_key": cache_key_query,
    "cache_split": cache_split,
    "cache_store": cache_store,
    "cache_evict": cache_evict,
    "cap_per_minute": _capped("1 minute", 1),
    "cap_per_hour": _capped("1 hour", 2),
    "recent_errors": recent_errors,
    "error_by_component": _error_counts("component"),
    "error_by_severity": _error_counts("severity"),
    "recovery_rate": recovery_rate,
    "error_breakdown": error_breakdown,
    "error_statistics": error_statistics,
    "recovery_strategy": recovery_strategy,
    "fallback_rule": fallback_rule,
    "alerts": alerts,
    "mask_sensitive": mask_sensitive_query,
    "stream_scored": stream_scored,
    "stream_idempotent": stream_idempotent,
    "stream_metrics": stream_metrics,
    "stream_throughput": stream_throughput,
    "stream_dedup": stream_dedup,
    "stream_rejects": stream_rejects,
    "stream_cap": _stateful(_cap_calls),
    "stream_freshness": _stateful(_fresh_components),
    "stream_offsets": stream_offsets,
    "message_sink": message_sink,
    "stream_commit": stream_commit,
    "stream_batch_metrics": stream_batch_metrics,
    "report_incremental": _incremental("rolling"),
    "report_incremental_calendar": _incremental("calendar"),
    "mixed_types_read": mixed_types_read,
    "lexicon_custom": lexicon_custom,
    "describe_table": describe_table,
    "merged_read": merged_read,
    "written_formats": written_formats,
    "empty_window_report": empty_window_report,
    "report_store": report_store,
    "read_model": read_model_query,
    "recovery_strategy_table": recovery_strategy_table,
}
