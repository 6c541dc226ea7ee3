"""Language detection from script ratios."""

from pyspark.sql import functions as F

from echolex.functions.text import or_empty

# Script ranges, in the order in which they are tested.
SCRIPT_CLASSES = {
    "ko": "가-힣",
    "ar": r"\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff\ufb50-\ufdff\ufe70-\ufeff",
    "zh": r"\u4e00-\u9fff",
    "ja": r"\u3040-\u309f\u30a0-\u30ff",
    "ru": r"\u0400-\u04ff",
    "th": r"\u0e00-\u0e7f",
}
DEFAULT_LANGUAGE = "en"
# No listed script lies within.
LATIN_RUN = r"[\x{0}-\x{3ff}]+"


def script_count(text, language):
    """Number of characters of a script. Matches runs, not single characters,
    so no array of one-character strings is built."""
    rest = F.regexp_replace(text, f"[{SCRIPT_CLASSES[language]}]+", "")
    return F.length(text) - F.length(rest)


def beyond_latin(text):
    """The characters from U+0400 on, among which all listed scripts are; none of ASCII text."""
    text = or_empty(text)
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, "").otherwise(F.regexp_replace(text, LATIN_RUN, ""))


def solid_length(text):
    """Number of characters other than spaces."""
    return F.length(F.replace(or_empty(text), F.lit(" "), F.lit("")))


def detect_language(text, beyond=None, total=None):
    """First script that holds more than a tenth of the non-space characters.

    Null, blank and unmatched text is English. Scripts are counted in what
    `beyond_latin` leaves of a text: text without it, such as ASCII text,
    leaves at the first branch. A caller that has `beyond_latin` and
    `solid_length` of the text in columns saves computing them by branch.
    Han is tested before kana: Japanese with over 10 % kanji gives "zh".
    """
    beyond = beyond_latin(text) if beyond is None else beyond
    total = solid_length(text) if total is None else total
    language = F.when(beyond == "", DEFAULT_LANGUAGE)
    for code in SCRIPT_CLASSES:
        language = language.when(script_count(beyond, code) * 10 > total, code)
    return language.otherwise(DEFAULT_LANGUAGE)


def detect_korean(text):
    """Two-way rule: any Hangul syllable gives "ko", everything else "en"."""
    hangul = or_empty(text).rlike(f"[{SCRIPT_CLASSES['ko']}]")
    return F.when(hangul, "ko").otherwise(DEFAULT_LANGUAGE)


def language_bucket(language):
    """ko / en / other; null counts as other."""
    return F.when(language == "ko", "ko").when(language == "en", "en").otherwise("other")
