"""Posts as JSON messages and as mapped source rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolex.functions.text import is_blank
from echolex.schemas import POST_SCHEMA

CORRUPT = "_corrupt_record"


def parse_posts(messages, value="value"):
    """Decode JSON messages into flat post columns.

    A malformed message gives a row of nulls, which the clean filter drops;
    `split_messages` keeps such messages instead.

    `inline` yields the same columns as selecting `data.*`, but the optimizer
    cannot push filters below it. After a plain projection each condition of
    the clean filter would parse the message again.
    """
    decoded = F.from_json(F.col(value).cast("string"), POST_SCHEMA)
    return messages.select(F.inline(F.array(decoded)))


def tagged_posts(messages, value="value"):
    """Messages decoded once: the post columns and the text of an unreadable message."""
    schema = T.StructType(POST_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"),
        schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return messages.select(F.inline(F.array(parsed)))


def split_tagged(tagged):
    """(posts, rejects) of decoded messages. Store `tagged` when both sides are needed."""
    bad = F.col(CORRUPT).isNotNull()
    return tagged.filter(~bad).drop(CORRUPT), tagged.filter(bad).select(F.col(CORRUPT).alias("value"))


def split_messages(messages, value="value"):
    """(posts, rejects) of messages; rejects hold the unreadable text.

    Each side decodes when it is used. To decode once for both, keep
    `tagged_posts` and split that.
    """
    return split_tagged(tagged_posts(messages, value))


def to_messages(posts):
    """One JSON text per row in a `value` column; null fields are written out."""
    return posts.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def from_submissions(rows):
    """Thread starters (id, title, selftext, created_utc, author) as posts."""
    return rows.select(
        F.col("id").cast("string").alias("id"),
        F.col("title"),
        F.col("selftext").alias("text"),
        F.col("created_utc").cast("double").alias("created_utc"),
        F.col("author").cast("string").alias("author_name"),
        F.lit("submission").alias("type"),
        F.col("id").cast("string").alias("submission_id"),
        F.lit(None).cast("string").alias("parent_id"),
    )


def from_comments(rows):
    """Comments (id, body, created_utc, author, submission_id, parent_id) as posts."""
    return rows.select(
        F.col("id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("title"),
        F.col("body").alias("text"),
        F.col("created_utc").cast("double").alias("created_utc"),
        F.col("author").cast("string").alias("author_name"),
        F.lit("comment").alias("type"),
        F.col("submission_id").cast("string").alias("submission_id"),
        F.col("parent_id").cast("string").alias("parent_id"),
    )


def union_posts(submissions, comments):
    """Both kinds of source rows as one set of posts, blank texts left out."""
    return drop_blank(from_submissions(submissions).unionByName(from_comments(comments)))


def drop_blank(posts, text="text"):
    return posts.filter(~is_blank(F.col(text)))


def write_messages(posts, fmt="kafka", mode="append", **options):
    """Send posts as JSON messages, by default to Kafka (needs its connector)."""
    to_messages(posts).write.format(fmt).mode(mode).options(**options).save()
