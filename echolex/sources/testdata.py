"""Maps the benchmark tables onto posts, error events and call outcomes."""

from functools import reduce

from pyspark.sql import functions as F

from echolex.sources.tables import spread, stored_bytes

START_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
LATIN = "abcdefghijklmnopqrstuvwxyz"

# Sources whose Latin letters are rewritten into another script, so that every
# language rule is met on the full table. The words put in first give the
# lexicons something to find.
SCRIPT_BY_SOURCE = {
    "src1": "가나다라마바사아자차카타파하거너더러머버서어저처커터",
    "src2": "абвгдежзийклмнопрстуфхцчшщ",
    "src3": "的一是不了人我在有他这中大来上国个到说们为子和你地出",
    "src4": "あいうえおかきくけこさしすせそたちつてとなにぬねのは",
    "src5": "กขคฆงจฉชซญฎฏฐฑฒณดตถทธนบปผฝ",
    "src6": "ابتثجحخدذرزسشصضطظعغفقكلمنه",
}
KOREAN_SOURCE = "src1"
ENGLISH_SOURCE = "src8"
KOREAN_WORDS = ((" the ", " 좋은 "), (" in ", " 나쁜 "))
ENGLISH_WORDS = ((" the ", " great "), (" in ", " Awful "))


INPUT_PARTITIONS = "spark.echolex.inputPartitions"


def _load(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    """`documents`, dealt over the number of tasks the session asks for, if it does.

    The benchmark tables come as one row group, which one task would read.
    """
    partitions = spark.conf.get(INPUT_PARTITIONS, None)
    return spread(_load(spark, sf_dir, "documents"), partitions and int(partitions))


def document_shares(spark, sf_dir, share_bytes):
    """In how many parts `documents` comes when a part holds some `share_bytes` of its files."""
    return max(1, -(-stored_bytes(spark, f"{sf_dir}/documents.parquet") // share_bytes))


def posts(spark, sf_dir):
    """`documents` as posts, ten minutes apart from 2024 on."""
    return as_posts(documents(spark, sf_dir))


def as_posts(documents, text=None):
    """Documents as posts, with another text when one is given.

    That text is made by `explode`, which filters are not pushed below: it is
    computed once per row and not once per condition.
    """
    if text is not None:
        documents = documents.select("doc_id", "source", F.explode(F.array(text)).alias("text"))
    doc_id = F.col("doc_id").cast("string")
    return documents.select(
        doc_id.alias("id"),
        F.lit(None).cast("string").alias("title"),
        F.col("text"),
        (F.lit(START_EPOCH) + F.col("doc_id") * 600).cast("double").alias("created_utc"),
        F.col("source").alias("author_name"),
        F.lit("submission").alias("type"),
        doc_id.alias("submission_id"),
        F.lit(None).cast("string").alias("parent_id"),
    )


def _replace_all(text, pairs):
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def multiscript_text(text, source):
    out = F.when(source == ENGLISH_SOURCE, _replace_all(text, ENGLISH_WORDS))
    for name, letters in SCRIPT_BY_SOURCE.items():
        worded = _replace_all(text, KOREAN_WORDS) if name == KOREAN_SOURCE else text
        out = out.when(source == name, F.translate(worded, LATIN, letters))
    return out.otherwise(text)


def multiscript_posts(spark, sf_dir):
    """The posts of `posts`, some sources rewritten into other scripts."""
    text = multiscript_text(F.col("text"), F.col("source"))
    return as_posts(documents(spark, sf_dir), text)


def conversation_sources(spark, sf_dir):
    """`conversations` as (submissions, comments) source rows."""
    rows = _load(spark, sf_dir, "conversations")
    turn_id = F.concat_ws("_", "conv_id", "turn")
    time = (F.lit(START_EPOCH) + F.col("conv_id") * 3600 + F.col("turn") * 60).cast("double")
    submissions = rows.filter("turn = 0").select(
        turn_id.alias("id"),
        F.lit(None).cast("string").alias("title"),
        F.col("text").alias("selftext"),
        time.alias("created_utc"),
        F.col("role").alias("author"),
    )
    comments = rows.filter("turn > 0").select(
        turn_id.alias("id"),
        F.col("text").alias("body"),
        time.alias("created_utc"),
        F.col("role").alias("author"),
        F.concat("conv_id", F.lit("_0")).alias("submission_id"),
        F.concat_ws("_", "conv_id", F.col("turn") - 1).alias("parent_id"),
    )
    return submissions, comments


def _component():
    return F.concat(F.lit("svc_"), F.col("user_id") % 10)


def error_events(spark, sf_dir):
    """`events` as error events."""
    kind, value = F.col("event_type"), F.col("value")
    attempted = kind != "error"
    return _load(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _component().alias("component"),
        F.when(kind == "error", "TimeoutError")
        .when(kind == "click", "HTTPError")
        .when(kind == "view", "ValidationError")
        .when(kind == "signup", "SparkError")
        .otherwise("Other")
        .alias("error_type"),
        F.concat(kind, F.lit(" "), F.col("props")).alias("message"),
        F.when(value < 10, "LOW")
        .when(value < 50, "MEDIUM")
        .when(value < 200, "HIGH")
        .otherwise("CRITICAL")
        .alias("severity"),
        attempted.alias("recovery_attempted"),
        (attempted & (F.col("user_id") % 2 == 0)).alias("recovery_successful"),
    )


def call_outcomes(spark, sf_dir):
    """`events` as calls of components that succeeded or failed."""
    return as_outcomes(_load(spark, sf_dir, "events"))


def as_outcomes(events):
    return events.select(
        _component().alias("component"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("call_id"),
        (F.col("event_type") != "error").alias("ok"),
    )
