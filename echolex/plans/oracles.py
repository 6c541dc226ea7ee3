"""The queries of `registry` as DuckDB SQL over the same tables.

Written apart from the Spark side: tokens are split instead of searched,
ratios are divided.
"""

from echolex.functions import lexicons as W
from echolex.sources import testdata as D

SPACE = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(words)) + "]"


def _in(words):
    return "(" + _list(words)[1:-1] + ")"


def _replaced(pairs):
    sql = "text"
    for old, new in pairs:
        sql = f"replace({sql}, '{old}', '{new}')"
    return sql


def _multiscript():
    cases = [f"WHEN '{D.ENGLISH_SOURCE}' THEN {_replaced(D.ENGLISH_WORDS)}"]
    for name, letters in D.SCRIPT_BY_SOURCE.items():
        text = _replaced(D.KOREAN_WORDS) if name == D.KOREAN_SOURCE else "text"
        cases.append(f"WHEN '{name}' THEN translate({text}, '{D.LATIN}', '{letters}')")
    return "CASE source " + " ".join(cases) + " ELSE text END"


def _ratio(cls):
    return (
        f"len(regexp_extract_all(text, '[{cls}]'))::DOUBLE"
        " / nullif(length(replace(text, ' ', '')), 0) > 0.1"
    )


LANGUAGE = f"""CASE
    WHEN {_ratio('가-힣')} THEN 'ko'
    WHEN {_ratio(r'\x{600}-\x{6ff}\x{750}-\x{77f}\x{8a0}-\x{8ff}\x{fb50}-\x{fdff}\x{fe70}-\x{feff}')} THEN 'ar'
    WHEN {_ratio(r'\x{4e00}-\x{9fff}')} THEN 'zh'
    WHEN {_ratio(r'\x{3040}-\x{309f}\x{30a0}-\x{30ff}')} THEN 'ja'
    WHEN {_ratio(r'\x{400}-\x{4ff}')} THEN 'ru'
    WHEN {_ratio(r'\x{e00}-\x{e7f}')} THEN 'th'
    ELSE 'en' END"""
TWO_WAY = "CASE WHEN regexp_matches(text, '[가-힣]') THEN 'ko' ELSE 'en' END"
BUCKET = "CASE WHEN detected_language IN ('ko', 'en') THEN detected_language ELSE 'other' END"


def _clean(minimum=10, symbols=r"[^\p{L}\p{M}\p{N}_]", extra="TRUE"):
    return (
        f"text IS NOT NULL AND length(trim(text)) > {minimum}"
        " AND NOT contains(text, '[deleted]') AND NOT contains(text, '[removed]')"
        f" AND NOT regexp_matches(text, '^{symbols}*$') AND {extra}"
    )


STRICT = _clean(
    20,
    extra="NOT starts_with(text, 'This post contains content not supported')"
    " AND length(regexp_replace(text, '[^a-zA-Z가-힣0-9]', '', 'g')) > 5",
)


def _token_hits(words, text="text"):
    return (
        f"len(list_filter(regexp_split_to_array(lower({text}), '{SPACE}+'),"
        f" lambda t: list_bool_or(list_transform({_list(words)}, lambda w: contains(t, w)))))"
    )


def _present(words, text="text"):
    return f"len(list_filter({_list(words)}, lambda w: contains(lower({text}), w)))"


def _exact(words, text="text"):
    tokens = rf"list_distinct(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]+'))"
    return f"len(list_intersect({tokens}, {_list(words)}))"


def _own(language, side):
    """Hits of the word lists a caller brings, as the query has them."""
    lists = {"ru": (("тхе", "аб"), ("ин", "ел")), "en": (("great", "tion"), ("awful", "er"))}
    return _token_hits(lists[language][side])


def _versus(pos, neg):
    return f"CASE WHEN {pos} > {neg} THEN 'POSITIVE' WHEN {neg} > {pos} THEN 'NEGATIVE' ELSE 'NEUTRAL' END"


def _presence_label(pos, neg):
    return _versus(_present(pos), _present(neg))


EXACT = f"""CASE
    WHEN {_exact(W.ENGLISH_POSITIVE)} > {_exact(W.ENGLISH_NEGATIVE)} THEN 'POSITIVE'
    WHEN {_exact(W.ENGLISH_NEGATIVE)} > {_exact(W.ENGLISH_POSITIVE)} THEN 'NEGATIVE'
    WHEN NOT regexp_matches(text, '[^\\t-\\r ]') OR contains(text, '?') OR {_exact(W.NEUTRAL_CUES)} > 0 THEN 'NEUTRAL'
    WHEN length(text) > 200 THEN 'POSITIVE'
    WHEN {_present(W.ERROR_WORDS)} > 0 THEN 'NEGATIVE'
    ELSE 'NEUTRAL' END"""

POSTS = f"""posts AS (
    SELECT CAST(doc_id AS VARCHAR) AS id, text, source AS author_name, doc_id, lang, n_chars,
        TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 600) AS created_at
    FROM documents)"""
MULTI = POSTS.replace("posts AS", "multi AS").replace("id, text,", f"id, {_multiscript()} AS text,")
HITS = f"""hits AS (
    SELECT *, {LANGUAGE} AS detected_language,
        {_token_hits(W.KOREAN_POSITIVE)} AS ko_pos, {_token_hits(W.KOREAN_NEGATIVE)} AS ko_neg,
        {_token_hits(W.ENGLISH_POSITIVE)} AS en_pos, {_token_hits(W.ENGLISH_NEGATIVE)} AS en_neg
    FROM multi)"""
COUNTED = """counted AS (
    SELECT *, CASE detected_language WHEN 'ko' THEN ko_pos ELSE en_pos END AS pos,
        CASE detected_language WHEN 'ko' THEN ko_neg ELSE en_neg END AS neg
    FROM hits)"""
SCORED = f"""scored AS (
    SELECT *, {_versus('pos', 'neg')} AS sentiment_label FROM counted WHERE {_clean()})"""
SCORE = "CASE sentiment_label WHEN 'POSITIVE' THEN 1.0 WHEN 'NEGATIVE' THEN -1.0 ELSE 0.0 END::DOUBLE"
WITH_SCORED = f"WITH {MULTI}, {HITS}, {COUNTED}, {SCORED}"
WITH_MULTI = f"WITH {MULTI}"
WITH_POSTS = f"WITH {POSTS}"

TIME = "'%Y-%m-%d %H:%M:%S'"


def _shown(ts):
    return f"strftime({ts}, {TIME})"


CREATED = f"{_shown('created_at')} AS created_at"


def _words(table, min_length=2, compat=False, stop=True):
    body = "lower(regexp_replace(text, '[^a-z0-9가-힣 ]', ' ', 'g'))"
    if not compat:
        body = "regexp_replace(lower(text), '[^a-z0-9가-힣 ]', ' ', 'g')"
    stopped = f" AND word NOT IN {_in(W.STOPWORDS)}" if stop else ""
    return (
        f"SELECT word, count(*) AS \"count\" FROM"
        f" (SELECT unnest(string_split({body}, ' ')) AS word FROM {table})"
        f" WHERE length(word) >= {min_length}{stopped} GROUP BY word"
    )


def _top(table, compat=False):
    return f"{_words(table, compat=compat)} ORDER BY \"count\" DESC, word LIMIT 10"


def _report(since):
    return f"""{WITH_SCORED}, t AS (SELECT max(created_at) AS as_of FROM multi),
    day AS (SELECT s.* FROM scored s, t WHERE s.created_at >= {since}),
    top AS ({_top('day')})"""


ROLLING = "t.as_of - INTERVAL 24 HOUR"
CALENDAR = "(CAST(t.as_of AS DATE) - 1)::TIMESTAMP"


def _daily(since):
    return f"""{_report(since)}
    SELECT {_shown('(SELECT as_of FROM t)')} AS report_date,
        round(avg({SCORE}), 6) AS average_sentiment_score,
        (SELECT '[' || string_agg('{{"word":"' || word || '","count":' || "count" || '}}', ','
            ORDER BY "count" DESC, word) || ']' FROM top) AS top_keywords
    FROM day HAVING count(*) > 0"""


def _recent(since):
    return f"""{WITH_POSTS}, t AS (SELECT max(created_at) AS as_of FROM posts)
    SELECT id, {CREATED} FROM posts, t WHERE created_at >= {since}"""


RAW_LABELS = """raw AS (
    SELECT doc_id, CASE lang
        WHEN 'es' THEN 'LABEL_' || (n_chars % 4)
        WHEN 'de' THEN ['긍정', '부정', '중립', 'positive', 'Negative', 'mixed'][n_chars % 6 + 1]
        ELSE (n_chars % 5 + 1) || CASE WHEN n_chars % 5 = 0 THEN '_star' ELSE '_STARS' END
        END AS raw
    FROM documents)"""
STARS = r"""CASE
    WHEN regexp_matches(upper({0}), 'POSITIVE|[45]_STARS') THEN 'POSITIVE'
    WHEN regexp_matches(upper({0}), 'NEGATIVE|1_STAR|2_STARS') THEN 'NEGATIVE'
    ELSE 'NEUTRAL' END"""
TOKENS_EN = _versus(_token_hits(W.ENGLISH_POSITIVE), _token_hits(W.ENGLISH_NEGATIVE))

COMPONENT = "'svc_' || (user_id % 10)"
ERRORS = f"""errors AS (
    SELECT event_id, ts, {COMPONENT} AS component,
        CASE event_type WHEN 'error' THEN 'TimeoutError' WHEN 'click' THEN 'HTTPError'
            WHEN 'view' THEN 'ValidationError' WHEN 'signup' THEN 'SparkError' ELSE 'Other' END AS error_type,
        CASE WHEN value < 10 THEN 'LOW' WHEN value < 50 THEN 'MEDIUM'
            WHEN value < 200 THEN 'HIGH' ELSE 'CRITICAL' END AS severity,
        event_type <> 'error' AS attempted,
        event_type <> 'error' AND user_id % 2 = 0 AS ok
    FROM events)"""
WITH_ERRORS = f"WITH {ERRORS}"
RATE = (
    "round(coalesce(100.0 * count(*) FILTER (WHERE attempted AND ok)"
    " / nullif(count(*) FILTER (WHERE attempted), 0), 0)::DOUBLE, 6) AS recovery_success_rate"
)
def _capped(unit, limit):
    return f"""SELECT component, call_id, {_shown('window_start')} AS window_start FROM (
        SELECT {COMPONENT} AS component, event_id AS call_id, date_trunc('{unit}', ts) AS window_start,
            row_number() OVER (PARTITION BY user_id % 10, date_trunc('{unit}', ts) ORDER BY ts, event_id) AS rn
        FROM events) WHERE rn <= {limit}"""


def _by_text(name, source):
    return (
        f"(SELECT string_agg({name} || '=' || n, ';' ORDER BY {name})"
        f" FROM (SELECT {name}, count(*) AS n FROM {source} GROUP BY {name})) AS {name}_breakdown"
    )


CACHE = f"""live AS (
    SELECT md5(text || ':local') AS key, {TOKENS_EN} AS label, max(created_at) AS cached_at
    FROM posts GROUP BY 1, 2)"""

CACHE_SPLIT = f"""{WITH_POSTS}, {CACHE}, t AS (SELECT max(created_at) AS as_of FROM posts),
        fresh AS (SELECT * FROM live, t WHERE as_of - cached_at < INTERVAL 24 HOUR)
        SELECT id, f.key IS NOT NULL AS hit, coalesce(f.label, '-') AS label
        FROM posts LEFT JOIN fresh f ON f.key = md5(text || ':local')"""

MASK = (
    "CASE "
    + " ".join(
        f"WHEN contains(lower(text), '{t}') THEN '[로그에 민감한 정보 포함됨 - {t}]'" for t in W.SENSITIVE_TERMS
    )
    + " ELSE md5(text) END"
)

SCORED_ROWS = f"{WITH_SCORED} SELECT id, {CREATED}, detected_language, sentiment_label FROM scored"
DAMAGED = """damaged AS (
    SELECT CASE author_name WHEN 'src4' THEN '0' WHEN 'src5' THEN NULL ELSE id END AS id,
        text, detected_language, author_name = 'src6' AS bad_time,
        CASE author_name WHEN 'src7' THEN 'UNKNOWN' ELSE sentiment_label END AS sentiment_label
    FROM scored)"""


def _check(name, failures):
    return (
        f"SELECT '{name}' AS \"check\", {failures} AS failures, count(*) AS n_rows,"
        f" ({failures}) = 0 AS ok FROM damaged"
    )


QUALITY = " UNION ALL ".join(
    [
        _check("duplicate_id", "count(id) - count(DISTINCT id)"),
        _check("missing_id", "count(*) - count(id)"),
        _check("missing_text", "count(*) - count(text)"),
        _check("missing_created_at", "CAST(0 AS BIGINT)"),
        _check("missing_detected_language", "count(*) - count(detected_language)"),
        _check("missing_sentiment_label", "count(*) - count(sentiment_label)"),
        _check("malformed_created_at", "count(*) FILTER (WHERE bad_time)"),
        _check("invalid_language", f"count(*) FILTER (WHERE detected_language NOT IN {_in(W.LANGUAGES)})"),
        _check("invalid_label", f"count(*) FILTER (WHERE sentiment_label NOT IN {_in(W.LABELS)})"),
    ]
)

ORACLES = {
    "label_distribution": f"""{WITH_POSTS}
        SELECT {_versus(_token_hits(W.ENGLISH_POSITIVE), _token_hits(W.ENGLISH_NEGATIVE))} AS sentiment_label,
            count(*) AS n
        FROM posts WHERE {_clean()} GROUP BY 1""",
    "score_posts": SCORED_ROWS,
    "clean_posts": f"{WITH_MULTI} SELECT id, length(text) AS n_chars FROM multi WHERE {_clean()}",
    "clean_posts_strict": f"{WITH_MULTI} SELECT id, length(text) AS n_chars FROM multi WHERE {STRICT}",
    "clean_posts_compat": f"""{WITH_MULTI}
        SELECT id, length(text) AS n_chars FROM multi WHERE {_clean(symbols='[^a-zA-Z0-9_]')}""",
    "detect_language": f"{WITH_MULTI} SELECT id, {LANGUAGE} AS detected_language FROM multi",
    "detect_language_two_way": f"{WITH_MULTI} SELECT id, {TWO_WAY} AS detected_language FROM multi",
    "lexicon_tokens": f"""WITH {MULTI}, {HITS}, {COUNTED}
        SELECT id, {_versus('pos', 'neg')} AS label,
            round(CASE WHEN pos = neg THEN 0.6 ELSE least(0.8, 0.5 + 0.1 * greatest(pos, neg)) END::DOUBLE, 6)
                AS confidence,
            'local' AS source, length(text) AS text_length
        FROM counted""",
    "lexicon_presence": f"""{WITH_MULTI}
        SELECT id, {_presence_label(W.ENGLISH_POSITIVE, W.ENGLISH_NEGATIVE)} AS english,
            {_presence_label(W.KOREAN_POSITIVE, W.KOREAN_NEGATIVE)} AS korean,
            {_presence_label(W.MIXED_POSITIVE, W.MIXED_NEGATIVE)} AS mixed
        FROM multi""",
    "lexicon_exact": f"{WITH_MULTI} SELECT id, {EXACT} AS sentiment_label FROM multi",
    "routed_label": f"""{WITH_MULTI}
        SELECT id, {TWO_WAY} AS detected_language,
            CASE {TWO_WAY} WHEN 'ko' THEN {_presence_label(W.KOREAN_POSITIVE, W.KOREAN_NEGATIVE)}
                ELSE {EXACT} END AS sentiment_label
        FROM multi WHERE {STRICT}""",
    "label_score": f"{WITH_SCORED} SELECT id, {SCORE} AS score FROM scored",
    "avg_sentiment": f"""{WITH_SCORED}
        SELECT round(avg({SCORE}), 6) AS average_sentiment_score, count(*) AS n_posts FROM scored""",
    "standard_label": f"WITH {RAW_LABELS} SELECT doc_id, raw, {STARS.format('raw')} AS label FROM raw",
    "label_id_map": f"""WITH {RAW_LABELS}
        SELECT doc_id, raw, CASE WHEN raw IN ('LABEL_0', 'NEGATIVE', '부정', 'negative') THEN 'NEGATIVE'
            WHEN raw IN ('LABEL_2', 'POSITIVE', '긍정', 'positive') THEN 'POSITIVE' ELSE 'NEUTRAL' END AS label
        FROM raw""",
    "truncate_text": f"""SELECT doc_id, length(cut) AS n_chars, md5(cut) AS digest FROM (
        SELECT doc_id, substring(regexp_replace(regexp_replace(text, '^{SPACE}+', ''), '{SPACE}+$', ''), 1, 1000)
            AS cut FROM documents)""",
    "cascade": f"""SELECT doc_id, CASE WHEN contains(text, 'then') THEN 'POSITIVE'
            WHEN contains(text, 'tion') THEN 'NEGATIVE'
            WHEN length(text) > 500 THEN {TOKENS_EN} ELSE 'NEUTRAL' END AS label
        FROM documents""",
    "model_score": f"""{WITH_SCORED}
        SELECT id, CASE WHEN length(text) > 5000 THEN sentiment_label ELSE
            {STARS.format("(length(text) % 5 + 1) || '_STARS'")} END AS sentiment_label,
            length(text) > 5000 AS failed, count(*) FILTER (WHERE length(text) > 5000) OVER () AS failed_rows
        FROM scored""",
    "lexicon_custom": f"""WITH {MULTI}, tagged AS (SELECT *, {LANGUAGE} AS detected_language FROM multi),
        own AS (SELECT *, CASE detected_language WHEN 'ru' THEN {_own('ru', 0)} WHEN 'ko' THEN
                {_token_hits(W.KOREAN_POSITIVE)} ELSE {_own('en', 0)} END AS pos,
            CASE detected_language WHEN 'ru' THEN {_own('ru', 1)} WHEN 'ko' THEN
                {_token_hits(W.KOREAN_NEGATIVE)} ELSE {_own('en', 1)} END AS neg FROM tagged)
        SELECT id, detected_language, {_versus('pos', 'neg')} AS sentiment_label FROM own WHERE {_clean()}""",
    "describe_table": """SELECT * FROM (VALUES ('doc_id', 'bigint'), ('text', 'string'), ('lang', 'string'),
        ('source', 'string'), ('n_chars', 'bigint')) t(name, type)""",
    "merged_read": """SELECT doc_id, lang, CASE WHEN doc_id % 2 = 1 THEN coalesce(source, '-') ELSE '-' END AS source
        FROM documents""",
    "written_formats": """SELECT event_id, CAST(value AS DECIMAL(18, 4))::DOUBLE AS value, layout, physical
        FROM events, (VALUES ('plain', 'INT64'), ('legacy', 'FIXED_LEN_BYTE_ARRAY')) l(layout, physical)""",
    "mixed_types_read": f"""{WITH_SCORED}
        SELECT id, CASE id::BIGINT % 3 WHEN 0 THEN created_utc::FLOAT::DOUBLE ELSE created_utc END AS created_utc,
            (length(text) / CASE id::BIGINT % 3 WHEN 2 THEN 2.0 ELSE 1.0 END)::DOUBLE AS n,
            CASE id::BIGINT % 3 WHEN 0 THEN '-' ELSE sentiment_label END AS sentiment_label, {CREATED}
        FROM (SELECT *, CAST(1704067200 + id::BIGINT * 600 AS DOUBLE) AS created_utc FROM scored)""",
    "stream_commit": f"""{WITH_SCORED}
        SELECT phase, detected_language, count(*) AS n
        FROM scored, (VALUES ('staged'), ('dropped'), ('committed')) p(phase)
        WHERE phase = 'committed' OR id::BIGINT % 2 = 0 GROUP BY ALL""",
    "report_incremental": _daily(ROLLING),
    "report_incremental_calendar": _daily(CALENDAR),
    "recovery_strategy_table": f"""{WITH_ERRORS}
        SELECT event_id, error_type, CASE WHEN error_type = 'TimeoutError' THEN 'WAIT'
            WHEN error_type = 'Other' THEN 'MANUAL' ELSE 'SKIP' END AS strategy FROM errors""",
    "empty_window_report": f"""{WITH_SCORED}, t AS (SELECT max(created_at) AS as_of FROM posts_all)
        SELECT {_shown('as_of')} AS report_date, round(avg({SCORE}), 6) AS average_sentiment_score
        FROM scored, t WHERE created_at >= as_of - INTERVAL 24 HOUR GROUP BY as_of""".replace(
        "posts_all", "multi"),
    "report_store": f"""{WITH_SCORED}, t AS (SELECT max(created_at) AS as_of FROM multi)
        SELECT {_shown('as_of')} AS report_date, round(avg({SCORE}), 6) AS average_sentiment_score,
            2::BIGINT AS n_reports
        FROM scored, t WHERE created_at >= as_of - INTERVAL 24 HOUR GROUP BY as_of""",
    "read_model": f"""{_report(ROLLING)}, bucketed AS (SELECT *, {BUCKET} AS lang_bucket FROM scored)
        SELECT 'kpis' AS frame, k AS key, (CASE k WHEN 'total' THEN count(*) ELSE
            count(*) FILTER (WHERE lang_bucket = k) END)::VARCHAR AS value
        FROM bucketed, (VALUES ('total'), ('ko'), ('en'), ('other')) v(k) GROUP BY k
        UNION ALL SELECT 'labels', lang_bucket || '/' || sentiment_label, count(*)::VARCHAR
        FROM bucketed GROUP BY ALL
        UNION ALL SELECT 'newest', lang_bucket || '/' || id, sentiment_label FROM (SELECT *, row_number() OVER (
            PARTITION BY lang_bucket ORDER BY created_at DESC, id) AS rn FROM bucketed) WHERE rn <= 10
        UNION ALL SELECT 'report', 'report_date', {_shown('max(created_at)')} FROM multi
        UNION ALL SELECT 'keywords', row_number() OVER (ORDER BY "count" DESC, word)::VARCHAR, word FROM top""",
    "score_distinct": f"{WITH_POSTS} SELECT id, {TOKENS_EN} AS sentiment_label FROM posts",
    "parse_reply": f"""SELECT doc_id,
            CASE WHEN n_chars % 5 IN (1, 4)
                THEN {_presence_label(W.ENGLISH_POSITIVE, W.ENGLISH_NEGATIVE)} ELSE 'NEUTRAL' END AS label,
            round(CASE WHEN n_chars % 5 IN (3, 4) THEN n_chars % 100 / 100.0 ELSE 0.5 END::DOUBLE, 6) AS confidence
        FROM documents""",
    "keyword_counts": f"{WITH_MULTI} {_words('multi')}",
    "keyword_counts_table": f"""WITH banned AS ({_words('benchmark', stop=False)}), kept AS (
            {_words('documents', stop=False)})
        SELECT * FROM kept WHERE word NOT IN (SELECT word FROM banned)""",
    "top_keywords": f"{WITH_MULTI} {_top('multi')}",
    "top_keywords_compat": f"{WITH_MULTI} {_top('multi', compat=True)}",
    "daily_report": _daily(ROLLING),
    "daily_report_calendar": _daily(CALENDAR),
    "report_keywords_parsed": f"""{_report(ROLLING)}
        SELECT row_number() OVER (ORDER BY "count" DESC, word) AS rank, word, "count" FROM top""",
    "latest_report": f"""{WITH_SCORED}
        SELECT {_shown('day')} AS report_date, {_shown('day + INTERVAL 9 HOUR')} AS report_time,
            round(avg({SCORE}), 6) AS average_sentiment_score
        FROM (SELECT *, date_trunc('day', created_at)::TIMESTAMP AS day FROM scored)
        GROUP BY day ORDER BY day DESC LIMIT 1""",
    "language_kpis": f"""{WITH_SCORED}
        SELECT count(*) AS total, count(*) FILTER (WHERE detected_language = 'ko') AS ko,
            count(*) FILTER (WHERE detected_language = 'en') AS en,
            count(*) FILTER (WHERE detected_language NOT IN ('ko', 'en')) AS other
        FROM scored""",
    "language_distribution": f"{WITH_SCORED} SELECT detected_language, count(*) AS n FROM scored GROUP BY 1",
    "labels_by_language": f"""{WITH_SCORED}
        SELECT {BUCKET} AS lang_bucket, sentiment_label, count(*) AS n FROM scored GROUP BY 1, 2""",
    "latest_per_language": f"""{WITH_SCORED}
        SELECT id, {CREATED}, lang_bucket, sentiment_label FROM (
            SELECT *, {BUCKET} AS lang_bucket,
                row_number() OVER (PARTITION BY {BUCKET} ORDER BY created_at DESC, id) AS rn FROM scored)
        WHERE rn <= 10""",
    "newest_posts": f"""{WITH_SCORED}
        SELECT id, {CREATED}, sentiment_label FROM scored ORDER BY scored.created_at DESC, id""",
    "corpus_language": f"""{WITH_MULTI}, sums AS (
            SELECT author_name, CAST(sum(len(regexp_extract_all(text, '[가-힣]'))) AS BIGINT) AS korean_chars,
                CAST(sum(length(text)) AS BIGINT) AS total_chars
            FROM multi GROUP BY author_name)
        SELECT *, CASE WHEN korean_chars / total_chars::DOUBLE > 0.1 THEN 'ko' ELSE 'en' END AS language FROM sums""",
    "epoch_to_local": f"""{WITH_POSTS}
        SELECT id, {_shown('created_at + INTERVAL 9 HOUR')} AS local_time FROM posts""",
    "utc_kst_roundtrip": f"""SELECT event_id, {_shown('ts + INTERVAL 9 HOUR')} AS kst, {_shown('ts')} AS utc
        FROM events""",
    "format_kst": f"""SELECT event_id,
            CASE WHEN event_type = 'view' THEN '2024-02-01 09:00:00'
                ELSE {_shown('ts + INTERVAL 9 HOUR')} END || ' KST' AS shown,
            {_shown('ts')} || ' KST' AS shown_naive
        FROM events""",
    "report_time_display": f"SELECT event_id, {_shown('ts + INTERVAL 9 HOUR')} AS shown FROM events",
    "recent_rolling": _recent(ROLLING),
    "recent_calendar": _recent(CALENDAR),
    "freshness": f"""{WITH_POSTS}, t AS (SELECT max(created_at) AS as_of FROM posts)
        SELECT count(*) AS n, count(*) > 0 AS ok FROM posts, t WHERE created_at >= t.as_of - INTERVAL 1 HOUR""",
    "ensure_timestamp": """SELECT event_id,
            CASE WHEN event_type <> 'view' THEN CAST(floor(epoch(ts)) AS BIGINT) ELSE -1 END AS seconds
        FROM events""",
    "union_posts": """SELECT conv_id || '_' || turn AS id,
            CAST(1704067200 + conv_id * 3600 + turn * 60 AS DOUBLE) AS created_utc, role AS author_name,
            CASE WHEN turn = 0 THEN 'submission' ELSE 'comment' END AS type,
            conv_id || '_0' AS submission_id,
            CASE WHEN turn > 0 THEN conv_id || '_' || (turn - 1) ELSE '-' END AS parent_id, md5(text) AS digest
        FROM conversations WHERE text IS NOT NULL AND regexp_matches(text, '\\S')""",
    "blank_filter": "SELECT conv_id, turn FROM conversations WHERE length(text) > 100",
    "json_roundtrip": f"""{WITH_MULTI}
        SELECT id, '-' AS title, CAST(1704067200 + doc_id * 600 AS DOUBLE) AS created_utc,
            author_name, 'submission' AS type, '-' AS parent_id, md5(text) AS digest
        FROM multi""",
    "json_rejects": """SELECT CASE source WHEN 'src3' THEN '(rejected)' ELSE source END AS author_name, count(*) AS n
        FROM documents GROUP BY 1""",
    "quality_report": f"{WITH_SCORED}, {DAMAGED} {QUALITY}",
    "sample_rows": """SELECT doc_id, lang, source, n_chars FROM documents
        ORDER BY n_chars DESC, doc_id LIMIT 5""",
    "partitioned_read": f"""{WITH_SCORED}, t AS (SELECT max(created_at) AS as_of FROM multi)
        SELECT id, {CREATED}, detected_language, sentiment_label FROM scored, t
        WHERE scored.created_at >= t.as_of - INTERVAL 1 DAY AND detected_language IN ('en', 'ko')""",
    "cache_key": "SELECT CAST(doc_id AS VARCHAR) AS id, md5(text || ':local') AS key FROM documents",
    "cache_split": CACHE_SPLIT,
    "cache_store": CACHE_SPLIT,
    "cache_evict": f"""{WITH_POSTS}, {CACHE}
        SELECT key, label, {_shown('cached_at')} AS cached_at FROM live
        ORDER BY live.cached_at DESC, key LIMIT 100""",
    "cap_per_minute": _capped("minute", 1),
    "cap_per_hour": _capped("hour", 2),
    "recent_errors": f"""{WITH_ERRORS}
        SELECT event_id, component, severity FROM errors
        WHERE ts > (SELECT max(ts) FROM errors) - INTERVAL 24 HOUR""",
    "error_by_component": f"{WITH_ERRORS} SELECT component, count(*) AS n FROM errors GROUP BY 1",
    "error_by_severity": f"{WITH_ERRORS} SELECT severity, count(*) AS n FROM errors GROUP BY 1",
    "recovery_rate": f"""{WITH_ERRORS}
        SELECT count(*) FILTER (WHERE attempted) AS attempts, count(*) FILTER (WHERE attempted AND ok) AS successes,
            {RATE} FROM errors""",
    "error_breakdown": f"""{WITH_ERRORS}
        SELECT 'component' AS dimension, component AS value, count(*) AS n FROM errors GROUP BY component
        UNION ALL SELECT 'severity', severity, count(*) FROM errors GROUP BY severity
        UNION ALL SELECT 'total', '-', count(*) FROM errors""",
    "error_statistics": f"""{WITH_ERRORS},
        recent AS (SELECT * FROM errors WHERE ts > (SELECT max(ts) FROM errors) - INTERVAL 168 HOUR)
        SELECT count(*) AS total_errors, {_by_text('component', 'recent')}, {_by_text('severity', 'recent')},
            {RATE}
        FROM recent""",
    "recovery_strategy": f"""{WITH_ERRORS}
        SELECT event_id, error_type, CASE WHEN error_type IN ('TimeoutError', 'ValidationError') THEN 'RETRY'
            WHEN error_type = 'HTTPError' THEN 'FALLBACK' WHEN error_type = 'SparkError' THEN 'RESTART'
            ELSE 'MANUAL' END AS strategy
        FROM errors""",
    "fallback_rule": f"""{WITH_ERRORS}
        SELECT event_id, CASE error_type WHEN 'TimeoutError' THEN 'keyword_scoring'
            WHEN 'HTTPError' THEN 'local_processing' WHEN 'SparkError' THEN 'cached_data' ELSE '-' END AS fallback
        FROM errors""",
    "alerts": f"""{WITH_ERRORS}
        SELECT event_id, severity, '🚨 ALERT: ' || severity || ' error in ' || component AS alert
        FROM errors WHERE severity IN ('HIGH', 'CRITICAL')""",
    "mask_sensitive": f"SELECT doc_id, {MASK} AS shown FROM documents",
    "stream_scored": SCORED_ROWS,
    "stream_idempotent": SCORED_ROWS,
    "stream_cap": _capped("hour", 2),
    "stream_freshness": f"""WITH e AS (SELECT {COMPONENT} AS component, date_trunc('hour', ts) AS hour FROM events),
        closed AS (SELECT date_trunc('hour', max(ts) - INTERVAL 10 MINUTE) - INTERVAL 1 HOUR AS last FROM events),
        hours AS (SELECT component, unnest(generate_series(min(hour), max(last), INTERVAL 1 HOUR)) AS hour
            FROM e, closed GROUP BY component),
        counts AS (SELECT component, hour, count(*) AS n FROM e GROUP BY ALL)
        SELECT component, {_shown('hour')} AS window_start, coalesce(n, 0) AS n, n IS NOT NULL AS ok
        FROM hours LEFT JOIN counts USING (component, hour)""",
    "stream_offsets": SCORED_ROWS,
    "message_sink": f"""{WITH_MULTI}
        SELECT id, CAST(1704067200 + doc_id * 600 AS DOUBLE) AS created_utc, author_name, 'submission' AS type,
            md5(text) AS digest
        FROM multi""",
    "stream_dedup": SCORED_ROWS,
    "stream_throughput": "SELECT 6::BIGINT AS batches, count(*) AS input_rows, true AS measured FROM documents",
    "stream_rejects": f"""WITH {POSTS} SELECT 'reject' AS kind, count(*) AS n FROM documents WHERE source = 'src3'
        UNION ALL SELECT 'post', count(*) FROM posts WHERE author_name IS DISTINCT FROM 'src3' AND {_clean()}""",
    "stream_metrics": f"""{WITH_SCORED}
        SELECT CAST(6 AS BIGINT) AS processed_batches, count(*) AS total_records,
            count(*) FILTER (WHERE sentiment_label = 'POSITIVE') AS total_positive,
            count(*) FILTER (WHERE sentiment_label = 'NEGATIVE') AS total_negative,
            count(*) FILTER (WHERE sentiment_label = 'NEUTRAL') AS total_neutral
        FROM scored""",
    "stream_batch_metrics": f"""{WITH_SCORED}
        SELECT CAST(6 AS BIGINT) AS processed_batches, count(*) AS total_records,
            count(*) FILTER (WHERE sentiment_label = 'POSITIVE') AS total_positive,
            count(*) FILTER (WHERE sentiment_label = 'NEGATIVE') AS total_negative,
            count(*) FILTER (WHERE sentiment_label = 'NEUTRAL') AS total_neutral
        FROM scored""",
}
