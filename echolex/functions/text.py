"""Text clean-up, tokenising, keys and masking."""

from pyspark.sql import functions as F

from echolex.functions.lexicons import SENSITIVE_MARKER, SENSITIVE_TERMS

# Unicode white space, once as characters and once as a regex class. Java's
# bare \s is ASCII only, so every pattern here spells the class out.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
WS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
KEYWORD_CHARS = "a-z0-9가-힣"


def or_empty(text):
    return F.coalesce(text, F.lit(""))


def strip(text):
    """Drop Unicode white space from both ends (`trim` drops U+0020 only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text):
    """True for null, empty and all-white-space text."""
    return ~or_empty(text).rlike(f"[^{WS}]")


def truncate(text, max_chars):
    """Strip, then keep the first `max_chars` characters."""
    return F.substring(strip(text), 1, max_chars)


def tokenize(text, compat=False):
    """Split into keyword tokens on single spaces; empty tokens stay in.

    Text is lower-cased first. `compat=True` lower-cases last, so that capital
    letters are cleaned away ("Great" gives "reat").
    """
    source = text if compat else F.lower(text)
    return F.split(F.regexp_replace(source, f"[^{KEYWORD_CHARS} ]", " "), " ")


def keywords(text, min_length=2, compat=False):
    """The tokens of `tokenize` that have at least `min_length` characters.

    One extraction instead of replace, split and filter: a token is a maximal
    run of keyword characters.
    """
    source = text if compat else F.lower(text)
    return F.regexp_extract_all(source, F.lit(f"[{KEYWORD_CHARS}]{{{min_length},}}"), F.lit(0))


def cache_key(text, source="local"):
    """md5 of `text:source`; null when the text is null."""
    source = F.lit(source) if isinstance(source, str) else source
    return F.md5(F.concat(text, F.lit(":"), source))


def mask_sensitive(message, marker=SENSITIVE_MARKER):
    """Replace a whole message that mentions a sensitive term by a marker."""
    lowered = F.lower(message)
    masked = F
    for term in SENSITIVE_TERMS:
        masked = masked.when(lowered.contains(term), F.lit(marker % term))
    return masked.otherwise(message)
