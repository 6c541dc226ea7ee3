"""Quality rules: text statistics and n-gram perplexity bands per language.

The model is a modified Kneser-Ney 4-gram over UTF-16 units, one per language.
Four units fill exactly one 64-bit number, so counting, contexts and suffixes
are plain arithmetic on a LONG column. Spark counts the grams of all texts and
computes the probabilities with joins and aggregates.

Every gram keeps its own log probability, whatever the corpus. The most frequent
ones, at most 2 ** hash_bits, are sent to the executors as arrays sorted by gram
(12 bytes an entry) and looked up there. The others stay a table on Spark: each
text's counts of them are joined to it. With the default no joined gram has more
than one in two million of all units, so none is a hot key. Log probabilities are
whole multiples of 1 / SCALE, so sums are exact and do not depend on the way taken.

Every text takes part in the counts, so no gram of a text is unknown.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echolex.llm import texts as T

ORDER = 4
HASH_BITS = 22  # 2 ** HASH_BITS grams at most are looked up, the others are joined
SCALE = 1 << 24
PAD = "\n" * (ORDER - 1)
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Bands: median of the language plus or minus so many median deviations.
LOWER_DEVIATIONS = 24.0  # copies of a text make it well predicted
UPPER_DEVIATIONS = 8.0
# Log perplexities are compared in steps of this size.
STEP = 0.0005
# Tables of one row per language are broadcast up to this many languages.
MAX_BROADCAST_LANGUAGES = 10_000
HELD_GRAMS = 1 << 21  # distinct grams a counting task holds before it passes them on
UNITS = 1 << 18

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


# --- statistics of whole texts ----------------------------------------------------


def _per_row(flags, offsets):
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(keys):
    """(earlier equal entry exists, any other equal entry exists) of each key."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    earlier, any_other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    any_other[order[1:]] = same
    any_other[order[:-1]] |= same
    return earlier, any_other


def statistics(data, offsets):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    rows = len(offsets) - 1
    words = T.find_words(data, offsets)
    solid = ~T.IS_SPACE[data]
    chars = _per_row(solid & ((data & 0xC0) != 0x80), offsets)
    symbols = _per_row(_IS_SYMBOL[data], offsets)

    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    line_row = np.repeat(np.arange(rows), _per_row(data == 10, offsets) + 1)
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(solid, out=filled[1:])
    with_word = filled[end] > filled[start]
    start, end, line_row = start[with_word], end[with_word], line_row[with_word]
    keys = T.mix(T.hash_spans(data, start, end) + line_row.astype(np.uint64) * T.ROLL)
    dup_lines = np.bincount(line_row[_seen_before(keys)[0]], minlength=rows)

    hashes = T.hash_spans(data, words.start, words.end)
    value, row, first = T.windows(hashes, words, 3)
    twice = _seen_before(T.mix(value + row.astype(np.uint64) * T.ROLL))[1]
    covered = np.zeros(len(hashes) + 3, bool)
    for k in range(3):
        covered[first[twice] + k] = True
    repeated = np.bincount(words.row[covered[: len(hashes)]], minlength=rows)
    return words.counts, chars, symbols, dup_lines, repeated


# --- grams ------------------------------------------------------------------------


def _gram_slices(values):
    """(position, grams, counts of grams per text) of ranges of a list of texts."""
    at = 0
    while at < len(values):
        stop, units = at, 0
        while stop < len(values) and (stop == at or units < UNITS):
            units += len(values[stop])
            stop += 1
        encoded = [(PAD + v).encode("utf-16-le", "surrogatepass") for v in values[at:stop]]
        size = np.array([len(e) // 2 for e in encoded], np.int64)
        unit = np.frombuffer(b"".join(encoded), "<u2").astype(np.uint64)
        gram = unit[: len(unit) - ORDER + 1].copy()
        for k in range(1, ORDER):
            gram = (gram << np.uint64(16)) | unit[k : len(unit) - ORDER + 1 + k]
        ends = np.cumsum(size)
        inside = np.ones(len(unit), bool)
        for k in range(1, ORDER):
            inside[ends - k] = False  # would reach into the next text
        yield at, gram[inside[: len(gram)]], size - ORDER + 1
        at = stop


def _by_language(langs, texts):
    """(language, row numbers, texts) of a batch; null texts are left out."""
    langs = langs.to_numpy(zero_copy_only=False)
    texts = texts.to_numpy(zero_copy_only=False)
    there = np.array([t is not None for t in texts], bool)
    for lang in sorted(set(langs[there])):
        rows = np.flatnonzero(there & (langs == lang))
        yield lang, rows, [texts[r] for r in rows]


def _merged(parts):
    key = np.concatenate([p[0] for p in parts])
    unique, inverse = np.unique(key, return_inverse=True)
    return unique, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)


def count_grams(docs):
    """lang, gram, n: counted per task first, then over all tasks."""

    def count(batches):
        held = {}

        def emit():
            for lang, parts in held.items():
                gram, n = _merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(gram), pa.string()),
                        pa.array(gram.view(np.int64)),
                        pa.array(n),
                    ],
                    names=["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            for lang, _, values in _by_language(batch.column(0), batch.column(1)):
                for _, gram, _ in _gram_slices(values):
                    parts = held.get(lang, []) + [np.unique(gram, return_counts=True)]
                    held[lang] = [_merged(parts)] if len(parts) > 1 else parts
            if sum(len(p[0]) for parts in held.values() for p in parts) > HELD_GRAMS:
                yield from emit()
        yield from emit()

    counted = docs.select(_lang(docs), "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).checkpoint()


def _few(rows):
    """A function that marks tables of one row per language of `rows` for broadcast.

    A shuffled join by language would send most rows to one task. Beyond the
    checked number of languages no single one can fill a task alone, and the
    join is left to Spark.
    """
    found = rows.select("lang").distinct().limit(MAX_BROADCAST_LANGUAGES + 1).count()
    return F.broadcast if found <= MAX_BROADCAST_LANGUAGES else lambda table: table


def _lang(docs):
    lang = F.col("lang") if "lang" in docs.columns else F.lit("")
    return F.coalesce(lang.cast("string"), F.lit("")).alias("lang")


def kneser_ney(counts):
    """lang, gram, n, p of every counted gram: interpolated modified Kneser-Ney.

    The highest order uses counts; lower orders use the number of distinct
    units a gram follows. The lowest one gives way to the uniform distribution.
    """
    levels = [counts]
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (16 * k)) - 1))
        levels.append(
            levels[-1].groupBy("lang", suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        )
    few = _few(counts)
    lower = None
    for k, level in zip(range(1, ORDER + 1), reversed(levels)):
        level = _discounted(level, few)
        if lower is None:
            share = F.lit(1.0) / F.col("types")
        else:
            below = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("share"))
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (16 * (k - 1))) - 1))
            level = level.withColumn("suffix", suffix).join(below, ["lang", "suffix"])
            share = F.col("share")
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("freed") / F.col("total") * share
        lower = level.withColumn("p", p)
    return lower.select("lang", "gram", "n", "p")


def _discounted(level, few):
    """Adds the discount d of each row and, per context, total, freed mass, types."""
    cut = level.groupBy("lang").agg(
        *[F.greatest(F.count_if(F.col("n") == k), F.lit(1)).alias(f"n{k}") for k in range(1, 5)]
    )
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    cuts = [
        F.greatest(F.lit(0.0), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")) for k in (1, 2, 3)
    ]
    cut = cut.select("lang", *[c.alias(f"d{k}") for k, c in enumerate(cuts, 1)])
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    context = Window.partitionBy("lang", F.shiftrightunsigned("gram", 16))
    return (
        level.join(few(cut), "lang")
        .withColumn("d", d)
        .withColumn("total", F.sum("n").over(context))
        .withColumn("freed", F.sum("d").over(context))
        .withColumn("types", F.count(F.lit(1)).over(context))
        .drop("d1", "d2", "d3")
    )


@dataclass
class Model:
    """Log probabilities in steps of 1 / SCALE: frequent grams by language, the table of the others."""

    frequent: Broadcast  # lang to (sorted grams, log probabilities)
    others: DataFrame | None  # lang, gram, log_p; None where there are none


def _frequent_from(counts, limit):
    """The smallest power of two so that at most `limit` grams are counted as often; 1: all of them."""
    size = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("grams")).collect()
    total = 0
    for r in sorted(sizes, reverse=True):  # at most 63 rows
        total += r["grams"]
        if total > limit:
            return 2 << r["size"]
    return 1


def train(docs, hash_bits=HASH_BITS):
    """The Model of all grams; at most 2 ** hash_bits of them go to the executors, the others are joined."""
    counts = count_grams(docs)
    least = _frequent_from(counts, 1 << hash_bits)
    log_p = F.round(F.log("p") * SCALE).cast("int").alias("log_p")
    model = kneser_ney(counts).select("lang", "gram", "n", log_p)
    others = None
    if least > 1:
        model = model.checkpoint()
        others = model.filter(F.col("n") < least).select("lang", "gram", "log_p")
    table = model.filter(F.col("n") >= least).select("lang", "gram", "log_p").toArrow()
    lang = table["lang"].combine_chunks().dictionary_encode()
    gram, log_p = table["gram"].to_numpy().view(np.uint64), table["log_p"].to_numpy()
    code = lang.indices.to_numpy()
    order = np.lexsort((gram, code))
    bounds = np.searchsorted(code[order], np.arange(len(lang.dictionary) + 1))
    frequent = {
        name: (gram[order[low:high]], log_p[order[low:high]])
        for name, low, high in zip(lang.dictionary.to_pylist(), bounds[:-1], bounds[1:])
    }
    return Model(docs.sparkSession.sparkContext.broadcast(frequent), others)


# --- scoring ----------------------------------------------------------------------

SCORES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "log_perplexity": pa.float64(),
}


_NO_GRAMS = np.zeros(0, np.uint64), np.zeros(0, np.int32)


def _looked_up(gram, lang, frequent):
    """(log probability or 0, found) of each gram among the frequent ones of its language."""
    grams, log_p = frequent.get(lang, _NO_GRAMS)
    if not len(grams):
        return np.zeros(len(gram), np.int64), np.zeros(len(gram), bool)
    at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
    found = grams[at] == gram
    return np.where(found, log_p[at], 0).astype(np.int64), found


def _frequent_sums(langs, texts, frequent):
    """Units, units of other grams, and sum of log probabilities of the frequent ones, of each row."""
    out = np.zeros((3, len(langs)), np.int64)
    for lang, rows, values in _by_language(langs, texts):
        for at, gram, count in _gram_slices(values):
            log_p, found = _looked_up(gram, lang, frequent)
            ends = np.concatenate([[0], np.cumsum(count)])
            some = rows[at : at + len(count)]
            out[0, some], out[1, some], out[2, some] = count, _per_row(~found, ends), _per_row(log_p, ends)
    return out


def _key():
    """The text and its language by digest: rows alike in both have the same log perplexity."""
    return F.unhex(F.md5(F.concat_ws("\n", F.md5("lang"), "text")))


def _other_sums(docs, model):
    """_key, _met, _other: units of grams that are not frequent, and the sum of their log probabilities.

    Both count a text as often as it occurs.
    """
    frequent = model.frequent

    def count(batches):
        for batch in batches:
            for lang, rows, values in _by_language(batch.column(1), batch.column(2)):
                for at, gram, size in _gram_slices(values):
                    other = np.flatnonzero(~_looked_up(gram, lang, frequent.value)[1])
                    gram, row = gram[other], rows[at + np.repeat(np.arange(len(size)), size)[other]]
                    order = np.lexsort((gram, row))
                    gram, row = gram[order], row[order]
                    new = np.ones(len(gram), bool)
                    new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
                    first = np.flatnonzero(new)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(row[first])),
                            pa.array([lang] * len(first), pa.string()),
                            pa.array(gram[first].view(np.int64)),
                            pa.array(np.diff(np.append(first, len(gram)))),
                        ],
                        names=["_key", "lang", "gram", "n"],
                    )

    slim = docs.select(_lang(docs), F.col("text").cast("string").alias("text")).filter("text is not null")
    met = slim.select(_key().alias("_key"), "lang", "text").mapInArrow(
        count, "_key binary, lang string, gram long, n long"
    )
    return (
        met.join(model.others, ["lang", "gram"])
        .groupBy("_key")
        .agg(F.sum("n").alias("_met"), F.sum(F.col("n") * F.col("log_p")).alias("_other"))
    )


def scored(docs, model):
    """`docs` with the columns of SCORES in a struct column `_scores`; nothing else changes."""
    inner = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        _lang(docs),
        F.col("text").cast("string").alias("text"),
    )
    names = [n for n in SCORES if n != "log_perplexity"]
    sums = ["units", "others", "log_p"]
    frequent = model.frequent

    def score(batches):
        for batch in batches:
            parts = [statistics(d, o) for _, d, o in T.slices(batch.column(2))]
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)]
            columns = columns or [pa.array([], pa.int64())] * 5
            columns += map(pa.array, _frequent_sums(batch.column(1), batch.column(2), frequent.value))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.StructArray.from_arrays(columns, names + sums)],
                names=["row", "lang", "text", "_sums"],
            )

    fields = ", ".join(f"{n} long" for n in names + sums)
    kind = inner.schema["row"].dataType.simpleString()
    out = inner.mapInArrow(score, f"row {kind}, lang string, text string, _sums struct<{fields}>")
    log_p = F.col("_sums.log_p")
    if model.others is not None:
        # Unique on the right side: adaptive execution may split a text of very many rows on the left.
        out = out.withColumn("_key", _key()).join(_other_sums(docs, model), "_key", "left")
        log_p += F.coalesce(F.expr("_other div (_met div _sums.others)"), F.lit(0))
    # A text without grams has none.
    log_perplexity = -log_p / F.nullif(F.col("_sums.units"), F.lit(0)) / SCALE
    scores = F.struct(*[F.col(f"_sums.{n}") for n in names], log_perplexity.alias("log_perplexity"))
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return out.select(*columns, scores.alias("_scores"))


def base_failed(scores="_scores"):
    words = F.col(f"{scores}.n_words")
    return (words < MIN_WORDS) | (100 * F.col(f"{scores}.n_repeat_words") > MAX_REPEAT_PERCENT * words)


def bands(rows, lower=LOWER_DEVIATIONS, upper=UPPER_DEVIATIONS):
    """lang, lower, upper of the log perplexity, from all texts that pass the base rules.

    Exact medians of the values rounded to STEP, found on their histogram.
    """
    good = rows.filter(~base_failed() & F.col("_scores.log_perplexity").isNotNull())
    level = good.select(_lang(rows), F.round(F.col("_scores.log_perplexity") / STEP).alias("v"))
    few = _few(rows)
    middle = _median(level)
    away = level.join(few(middle), "lang").select("lang", F.abs(F.col("v") - F.col("median")).alias("v"))
    width = _median(away).withColumnRenamed("median", "width")
    step = F.greatest(F.col("width"), F.lit(1.0)) * STEP
    return middle.join(width, "lang").select(
        "lang",
        (F.col("median") * STEP - lower * step).alias("lower"),
        (F.col("median") * STEP + upper * step).alias("upper"),
    )


def _median(values):
    run = Window.partitionBy("lang").orderBy("v")
    whole = Window.partitionBy("lang")
    return (
        values.groupBy("lang", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(run))
        .withColumn("all", F.sum("n").over(whole))
        .filter(F.col("upto") * 2 >= F.col("all"))
        .groupBy("lang")
        .agg(F.min("v").alias("median"))
    )


def judge(docs, hash_bits=HASH_BITS):
    """Every row of `docs` with a struct `_scores` and booleans `base_failed`, `kept`.

    Needs doc_id and text; without lang all texts are one language, a null lang
    is a language of its own. Null and empty texts have no words and fail.
    Repeated rows are judged alike, an empty table gives no rows. `hash_bits`
    decides how many grams are looked up and how many are joined, not the result.
    """
    model = train(docs, hash_bits)
    slim = docs.select("text", *(["lang"] if "lang" in docs.columns else []))
    scores = scored(slim, model).select(_lang(slim), "_scores").checkpoint()
    limits = bands(scores).checkpoint()
    return verdicts(scored(docs, model), limits)


def verdicts(rows, limits):
    """Adds base_failed and kept to scored rows."""
    named = limits.select(
        F.col("lang").alias("_lang"), F.col("lower").alias("_lower"), F.col("upper").alias("_upper")
    )
    inside = F.col("_scores.log_perplexity").between(F.col("_lower"), F.col("_upper"))
    return (
        rows.withColumn("_lang", _lang(rows))
        .join(_few(limits)(named), "_lang", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
        .drop("_lang")
    )
