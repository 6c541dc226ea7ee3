"""Declared schemas of the records that enter and leave the engine.

Every field is nullable. `created_utc` is a double: a 32-bit float cannot hold
epoch seconds without rounding them to steps of about two minutes.
"""

from pyspark.sql import types as T

POST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("author_name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("submission_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
    ]
)

SCORED_SCHEMA = T.StructType(
    POST_SCHEMA.fields
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("detected_language", T.StringType()),
        T.StructField("sentiment_label", T.StringType()),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("report_date", T.TimestampType()),
        T.StructField("average_sentiment_score", T.DoubleType()),
        T.StructField("top_keywords", T.StringType()),
    ]
)

SENTIMENT_SCHEMA = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("text_length", T.IntegerType()),
    ]
)

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("result", SENTIMENT_SCHEMA),
        T.StructField("cached_at", T.TimestampType()),
    ]
)

ERROR_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("component", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("stack_trace", T.StringType()),
        T.StructField("context", T.MapType(T.StringType(), T.StringType())),
        T.StructField("recovery_attempted", T.BooleanType()),
        T.StructField("recovery_successful", T.BooleanType()),
    ]
)

KEYWORDS_DDL = "array<struct<word:string,count:bigint>>"
