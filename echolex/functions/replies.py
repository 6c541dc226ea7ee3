"""Reading a model's JSON reply."""

from pyspark.sql import functions as F

REPLY_DDL = "sentiment string, confidence string"


def once(value, use):
    """`use(value)` with the value computed once per row, however often it occurs there.

    Written out, each occurrence in a condition would compute it again.
    """
    return F.transform(F.array(value), use)[0]


def parse_reply(reply):
    """Struct (label, confidence) of a reply like {"sentiment": .., "confidence": ..}.

    Missing fields default to NEUTRAL and 0.5. A reply that is no JSON object,
    or whose confidence is no number, is NEUTRAL with 0.5 as a whole.
    """

    def read(reply):
        return F.when(F.ltrim(reply).startswith("{"), F.from_json(reply, REPLY_DDL))

    def checked(parsed):
        confidence = parsed["confidence"]
        number = confidence.try_cast("double")
        usable = confidence.isNull() | number.isNotNull()
        return F.struct(
            F.when(usable, F.coalesce(parsed["sentiment"], F.lit("NEUTRAL")))
            .otherwise("NEUTRAL")
            .alias("label"),
            F.coalesce(number, F.lit(0.5)).alias("confidence"),
        )

    return once(once(reply, read), checked)
