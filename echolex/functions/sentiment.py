"""Lexicon scorers and label rules as native expressions.

Counts are used in always-evaluated positions (`sign` picks the label), so
Spark's common-subexpression elimination computes each count once per row.
No higher-order function is used: those fall out of whole-stage codegen.
"""

import re
from functools import reduce
from itertools import groupby
from operator import add, or_

from pyspark.sql import functions as F

from echolex.functions.lexicons import (
    ENGLISH_NEGATIVE,
    ENGLISH_POSITIVE,
    ERROR_WORDS,
    KOREAN_NEGATIVE,
    KOREAN_POSITIVE,
    LEXICONS,
    MIXED_NEGATIVE,
    MIXED_POSITIVE,
    NEUTRAL_CUES,
)
from echolex.functions.text import WS, is_blank, or_empty

WORD = r"\p{L}\p{N}_"
MARK = "\x01"
NOT_MARK = "\x02"


def _one_of(words):
    """Alternation of words, grouped by first character to fail early."""
    ordered = sorted(set(words))
    parts = []
    for first, group in groupby(ordered, key=lambda w: w[0]):
        rests = "|".join(re.escape(w[1:]) for w in group)
        parts.append(f"{re.escape(first)}(?:{rests})")
    return "(?:" + "|".join(parts) + ")"


def _by_sign(balance, negative, zero, positive):
    return F.element_at(F.array(negative, zero, positive), F.signum(balance).cast("int") + 2)


def _sign_label(balance):
    """NEGATIVE, NEUTRAL or POSITIVE by the sign of an integer column."""
    return _by_sign(balance, F.lit("NEGATIVE"), F.lit("NEUTRAL"), F.lit("POSITIVE"))


def _by_language(language, build, lexicons=None):
    """`build(pos, neg)` for a fixed language, or routed by a language column.

    `lexicons` adds languages to the built-in table or replaces them; a language
    in neither takes "en".
    """
    known = {**LEXICONS, **(lexicons or {})}
    if isinstance(language, str):
        return build(*known.get(language, known["en"]))
    routed = F
    for code, lists in known.items():
        if code != "en":
            routed = routed.when(language == code, build(*lists))
    return routed.otherwise(build(*known["en"]))


def _minimal(words):
    """Words that contain no other word of the list; the rest adds no match."""
    return [w for w in dict.fromkeys(words) if not any(o != w and o in w for o in words)]


def _any_of(words):
    """Pattern of any of the words, behind a look at the characters they can begin with.

    The look keeps the regex engine from trying the alternatives at every
    character; character classes are fast within Latin-1 only, see `_plain`.
    """
    depth = min(3, *map(len, words)) if len(words) > 1 else 1
    heads = "".join("[" + "".join(sorted({re.escape(w[i]) for w in words})) + "]" for i in range(depth))
    return f"(?={heads}){_one_of(words)}"


def _plain(words):
    return bool(words) and all(w and w.isascii() for w in words)


def _begin(words):
    """A look at whether any of the words can begin here.

    Classes of wide characters are slow in a regex, a range is not.
    """
    if _plain(words):
        return _any_of(words)
    heads = sorted(w[0] for w in words)
    return f"(?=[{re.escape(heads[0])}-{re.escape(heads[-1])}]){_one_of(words)}"


def narrowed(lowered, language="en", lexicons=None):
    """What holds the words of a row's language in a text: a short text with the same hits.

    From each token its part from the first word of either list on. The whole
    text is passed once, so give the result a projection of its own; both
    lists are then counted in what it leaves.
    """

    def keep(pos, neg):
        words = [*pos, *neg]
        if not words or not all(words):
            return lowered
        found = F.regexp_extract_all(lowered, F.lit(f"{_begin(_minimal(words))}[^{WS}]*+"), F.lit(0))
        return F.array_join(found, " ")

    return _by_language(language, keep, lexicons)


def token_hits(lowered, words):
    """Number of white-space tokens that contain any of the words.

    For ASCII words a match is a word and the rest of its token, so each token
    counts once, in one pass over the text. Of other lists every word found is
    overwritten by a mark, then tokens with a mark are counted: classes of wide
    characters are slow in a regex, and texts without any word skip the
    marking. Both are linear in the text. No word holds white space.
    """
    words = _minimal(words)
    if _plain(words):
        return F.coalesce(F.regexp_count(lowered, F.lit(f"{_any_of(words)}[^{WS}]*+")), F.lit(0))
    marked = F.replace(lowered, F.lit(MARK), F.lit(NOT_MARK))
    for word in words:
        marked = F.replace(marked, F.lit(word), F.lit(MARK))
    hits = F.regexp_count(marked, F.lit(f"{MARK}[^{WS}]*+"))
    return F.when(reduce(or_, [lowered.contains(w) for w in words]), hits).otherwise(0)


def token_label(text, language="en", lowered=None, lexicons=None):
    """Label of the token-containment scorer, by the built-in and the caller's word lists."""
    lowered = F.lower(or_empty(text)) if lowered is None else lowered
    balance = _by_language(
        language, lambda pos, neg: token_hits(lowered, pos) - token_hits(lowered, neg), lexicons
    )
    return _sign_label(balance)


def token_sentiment(text, language="en", lowered=None, lexicons=None):
    """Token-containment scorer as struct (label, confidence, source, text_length).

    A text is positive when more tokens contain a positive word than a negative
    one. The winner's confidence grows by 0.1 per hit up to 0.8; a tie has 0.6,
    a blank text 0.5 and length 0.
    """
    text = or_empty(text)
    lowered = F.lower(text) if lowered is None else lowered
    pos = _by_language(language, lambda p, _: token_hits(lowered, p), lexicons)
    neg = _by_language(language, lambda _, n: token_hits(lowered, n), lexicons)
    balance = pos - neg
    winner = F.least(F.lit(0.8), F.lit(0.5) + F.lit(0.1) * F.greatest(pos, neg))
    blank = is_blank(text)
    tie = F.when(blank, F.lit(0.5)).otherwise(F.lit(0.6))
    return F.struct(
        _sign_label(balance).alias("label"),
        _by_sign(balance, winner, tie, winner).alias("confidence"),
        F.lit("local").alias("source"),
        F.when(blank, F.lit(0)).otherwise(F.length(text)).alias("text_length"),
    )


def _present(lowered, words):
    return reduce(add, [lowered.contains(w).cast("int") for w in words])


def presence_label(text, positive=ENGLISH_POSITIVE, negative=ENGLISH_NEGATIVE, lowered=None):
    """Label by how many distinct lexicon words occur anywhere in the text."""
    lowered = F.lower(or_empty(text)) if lowered is None else lowered
    return _sign_label(_present(lowered, positive) - _present(lowered, negative))


def korean_presence_label(text, lowered=None):
    return presence_label(text, KOREAN_POSITIVE, KOREAN_NEGATIVE, lowered)


def mixed_presence_label(text, lowered=None):
    """Last-resort scorer over the short mixed list."""
    return presence_label(text, MIXED_POSITIVE, MIXED_NEGATIVE, lowered)


def exact_label(text, lowered=None, long_text=200):
    """Label by distinct whole-word matches, with cue rules for ties.

    On a tie: a neutral cue word or "?" gives NEUTRAL; then a text over
    `long_text` characters POSITIVE; then an error word anywhere NEGATIVE.
    """
    text = or_empty(text)
    lowered = F.lower(text) if lowered is None else lowered
    cues = [w for w in NEUTRAL_CUES if re.fullmatch(r"\w+", w)]
    wanted = _one_of(ENGLISH_POSITIVE + ENGLISH_NEGATIVE + tuple(cues))
    pattern = f"(?<![{WORD}]){wanted}(?![{WORD}])"
    found = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))

    def hits(words):
        return F.size(F.array_intersect(found, F.array(*map(F.lit, words))))

    balance = hits(ENGLISH_POSITIVE) - hits(ENGLISH_NEGATIVE)
    tie = F.lit(None).cast("string")
    decided = _by_sign(balance, F.lit("NEGATIVE"), tie, F.lit("POSITIVE"))
    has_error_word = reduce(or_, [lowered.contains(w) for w in ERROR_WORDS])
    undecided = (
        F.when(is_blank(text) | text.contains("?") | (hits(cues) > 0), "NEUTRAL")
        .when(F.length(text) > long_text, "POSITIVE")
        .when(has_error_word, "NEGATIVE")
        .otherwise("NEUTRAL")
    )
    return F.coalesce(decided, undecided)


def routed_label(text, language, lowered=None):
    """Korean presence scorer for ko, exact scorer for en, NEUTRAL otherwise."""
    return (
        F.when(language == "ko", korean_presence_label(text, lowered))
        .when(language == "en", exact_label(text, lowered))
        .otherwise("NEUTRAL")
    )


def label_score(label):
    """+1 / 0 / -1 for a label in any case; anything else scores 0."""
    lowered = F.lower(label)
    return (
        F.when(lowered == "positive", F.lit(1.0))
        .when(lowered == "negative", F.lit(-1.0))
        .otherwise(F.lit(0.0))
    )


# Raw model labels and what they stand for.
STANDARD_POSITIVE = ("POSITIVE", "4_STARS", "5_STARS")
STANDARD_NEGATIVE = ("NEGATIVE", "1_STAR", "2_STARS")
ID_LABELS = {
    "NEGATIVE": ("LABEL_0", "NEGATIVE", "부정", "negative"),
    "NEUTRAL": ("LABEL_1", "NEUTRAL", "중립", "neutral"),
    "POSITIVE": ("LABEL_2", "POSITIVE", "긍정", "positive"),
}


def standard_label(label, scheme="stars"):
    """Raw model label to POSITIVE / NEGATIVE / NEUTRAL; null stays null.

    `stars` looks for names and star counts inside the label, `label_id` maps
    a fixed set of whole labels.
    """
    if scheme == "label_id":
        mapped = F.when(label.isNull(), F.lit(None).cast("string"))
        for name, raw in ID_LABELS.items():
            mapped = mapped.when(label.isin(*raw), name)
        return mapped.otherwise("NEUTRAL")
    if scheme != "stars":
        raise ValueError(f"unknown label scheme: {scheme}")
    upper = F.upper(label)
    return (
        F.when(label.isNull(), F.lit(None).cast("string"))
        .when(reduce(or_, [upper.contains(w) for w in STANDARD_POSITIVE]), "POSITIVE")
        .when(reduce(or_, [upper.contains(w) for w in STANDARD_NEGATIVE]), "NEGATIVE")
        .otherwise("NEUTRAL")
    )


def cascade(*labels):
    """First label that is not null, NEUTRAL when none is."""
    return F.coalesce(*labels, F.lit("NEUTRAL"))
