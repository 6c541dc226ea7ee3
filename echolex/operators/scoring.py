"""Labelling posts: lexicon scorers, caller-supplied models, scoring per text."""

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolex.functions import sentiment as S
from echolex.functions.language import beyond_latin, detect_korean, detect_language, solid_length
from echolex.functions.text import or_empty, truncate
from echolex.functions.times import epoch_to_timestamp
from echolex.operators.skew import HOT_ROWS, lookup_join
from echolex.session import bound_batches

LOWERED = "_lowered"
BEYOND, SOLID = "_beyond", "_solid"


def with_created_at(df, seconds="created_utc"):
    return df.withColumn("created_at", epoch_to_timestamp(F.col(seconds)))


def with_language(df, text="text", two_way=False):
    if two_way:
        return df.withColumn("detected_language", detect_korean(F.col(text)))
    # Projections of their own: each branch of the rule reads what is computed once per row.
    beyond, text = F.col(BEYOND), F.col(text)
    df = df.withColumn(BEYOND, beyond_latin(text))
    df = df.withColumn(SOLID, F.when(beyond == "", 0).otherwise(solid_length(text)))
    return df.withColumn("detected_language", detect_language(text, beyond, F.col(SOLID))).drop(BEYOND, SOLID)


def with_label(
    df, scorer="tokens", text="text", max_chars=None, model=None, lexicons=None, status=None
):
    """Add `sentiment_label` by a scorer, or by a model with the scorer behind it.

    Scorers: `tokens` (default, by the row's language), `presence`, `mixed`,
    `exact`, `routed`. The whole text is scored unless `max_chars` is given.
    `model` is a UDF from `model_scorer`; rows it fails on fall back to the
    scorer, and then to NEUTRAL; `status` names a boolean column that marks
    them. `lexicons` (language: (positive words, negative words)) replaces
    entries of the token scorer's table or adds languages to it.
    """
    body = truncate(F.col(text), max_chars) if max_chars else F.col(text)
    # A projection of its own: the lower-cased text is computed once per row.
    df = df.withColumn(LOWERED, F.lower(or_empty(body)))
    lowered, language = F.col(LOWERED), F.col("detected_language")
    if scorer == "tokens":
        df = df.withColumn(LOWERED, S.narrowed(lowered, language, lexicons))
    scorers = {
        "tokens": lambda: S.token_label(body, language, lowered, lexicons),
        "presence": lambda: S.presence_label(body, lowered=lowered),
        "mixed": lambda: S.mixed_presence_label(body, lowered),
        "exact": lambda: S.exact_label(body, lowered),
        "routed": lambda: S.routed_label(body, language, lowered),
    }
    label = S.cascade(scorers[scorer]())
    if model is not None:
        bound_batches(df.sparkSession)
        df = df.withColumn("_model", model(body))
        label = S.cascade(S.standard_label(F.col("_model.label")), scorers[scorer]())
    df = df.withColumn("sentiment_label", label)
    if status:
        df = df.withColumn(status, (F.col("_model.failed") == 1) if model is not None else F.lit(False))
    return df.drop(LOWERED, "_model")


def label_texts(df, text="text", **options):
    """Language and label of a frame that holds texts only."""
    return with_label(with_language(df, text), text=text, **options)


def with_sentiment(df, text="text", language="detected_language"):
    """Add the full `sentiment` struct of the token scorer."""
    df = df.withColumn(LOWERED, F.lower(or_empty(F.col(text))))
    df = df.withColumn(LOWERED, S.narrowed(F.col(LOWERED), F.col(language)))
    value = S.token_sentiment(F.col(text), F.col(language), F.col(LOWERED))
    return df.withColumn("sentiment", value).drop(LOWERED)


MODEL_RESULT = T.StructType(
    [T.StructField("label", T.StringType()), T.StructField("failed", T.IntegerType())]
)
# Texts a worker has scored before its share of failures is judged.
MIN_JUDGED = 200


def model_scorer(factory, batch_size=64, max_failed_share=0.5):
    """A UDF over text from `factory`, which loads a model and returns `predict`.

    `predict` takes a list of texts and returns raw labels. The factory runs
    once per Python worker. When a batch fails its texts are tried one by one,
    and a text that fails alone gets a null label and `failed`. A worker of
    which more than `max_failed_share` of the texts have failed raises the
    model's error instead of labelling on without it; 1 never raises.
    """

    def make_predict():
        predict = factory()
        seen = {"texts": 0, "failed": 0}

        def attempt(texts):
            try:
                labels = list(predict(texts))
                if len(labels) != len(texts):
                    raise ValueError(f"{len(labels)} labels for {len(texts)} texts")
                return [(label, False) for label in labels], None
            except Exception as failure:
                if len(texts) == 1:
                    return [(None, True)], failure
                parts = [attempt([t]) for t in texts]
                return [x for part, _ in parts for x in part], failure

        def predict_batch(texts):
            filled = ["" if pd.isna(t) else t for t in texts]
            found, failure = attempt(filled)
            seen["texts"] += len(found)
            seen["failed"] += sum(failed for _, failed in found)
            if seen["texts"] >= MIN_JUDGED and seen["failed"] > max_failed_share * seen["texts"]:
                raise RuntimeError(f"the model failed on {seen['failed']} of {seen['texts']} texts") from failure
            return {
                "label": np.array([label for label, _ in found], dtype=object),
                "failed": np.array([failed for _, failed in found], dtype=np.int32),
            }

        return predict_batch

    return predict_batch_udf(make_predict, return_type=MODEL_RESULT, batch_size=batch_size)


def score_distinct(posts, score, text="text", spread="id", hot_rows=HOT_ROWS):
    """Score each distinct text once and join the labels back.

    For scorers that cost more than a shuffle of the text. Texts are grouped by
    their digest, one copy of each per task reaching the shuffle; the join back
    is keyed by the digest, and the rows of much-copied texts are spread over
    several tasks. `score` is a function that adds `sentiment_label` to a frame
    with the text column, such as `label_texts`. Null texts share one key.
    """
    key = F.coalesce(F.sha2(F.col(text), 256), F.lit("null"))
    keyed = posts.withColumn("text_key", key)
    copies = keyed.groupBy("text_key").agg(F.any_value(text).alias(text))
    labels = score(copies).select("text_key", "sentiment_label")
    return lookup_join(keyed, labels, "text_key", spread, hot_rows=hot_rows).drop("text_key")
