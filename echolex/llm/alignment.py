"""Token alignment of two tokenizers, counted over a corpus.

Tokenizer A is a byte-level BPE, B a sentencepiece BPE with byte fallback. Both
read a space and then the text. The byte offsets where a token of A and one of
B end cut both sequences into groups; two tokens are linked where their byte
ranges overlap.

A text is cut before single spaces and newlines between words first. Neither
tokenizer merges over such a place, so both have a token end there, and equal
segments are aligned once for many occurrences. The work is columnar: segments
are flattened with parent indices, token lengths become offsets by segmented
cumulative sums, an Acero hash join on (segment, end) finds the common ends,
`Table.group_by` counts in how many documents of a task a pair is linked, and
Spark merges these partial counts.
"""

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from echolex.llm.texts import slices

# Pairs looked up in the tasks; the others are joined. 17 bytes each.
LOOKUP_PAIRS = 1 << 21
# Segments a worker remembers, and partial counts it gathers before it emits them.
CACHE_SEGMENTS = 500_000
PARTIAL_PAIRS = 1 << 20
SLICE_BYTES = 1 << 21
ENCODE_SEGMENTS = 20_000
B_BITS = 16  # ids are below 2^16, so a pair is one number of 32 bits
SPACE, NEWLINE = 0x20, 0x0A


def _byte_alphabet():
    """The character by which a byte-level vocabulary writes each byte.

    Visible Latin-1 characters stand for themselves; the others are numbered
    from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Vocabulary:
    """Bytes, byte length and printed form of every id."""

    def __init__(self, of_id):
        if max(of_id) >> B_BITS:
            raise ValueError(f"ids up to {max(of_id)} do not fit {B_BITS} bits")
        self.of_id = [of_id.get(i, b"") for i in range(max(of_id) + 1)]
        self.size = np.fromiter(map(len, self.of_id), np.int64, len(self.of_id))
        self.shown = pa.array([str(i) for i in range(len(self.of_id))])

    def spelled(self, ids):
        return b"".join(map(self.of_id.__getitem__, ids))


class ByteLevel:
    """Tokenizer A: a byte-level BPE."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet, found = _byte_alphabet(), {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            known = all(c in alphabet for c in token)
            found[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.vocabulary = Vocabulary(found)

    def encode(self, text):
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: a sentencepiece BPE, which puts a space before what it encodes."""

    def __init__(self, path):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                found[i] = bytes([int(piece[3:5], 16)])
                continue
            if "\n" in piece or "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {piece!r} goes over a word's end: its texts cannot be cut")
            found[i] = piece.replace("▁", " ").encode()
        self.vocabulary = Vocabulary(found)

    def encode(self, text):
        """`text` starts with a space, or with a newline: then the added space is taken off."""
        if text[0] == " ":
            return self.model.encode(text[1:], num_threads=1)
        return self.model.encode(text, num_threads=1)[1:]


def cut_places(data, offsets):
    """Start of every segment in the bytes of some rows, each row starting with a space.

    Cuts lie before a space or newline whose neighbours are no white space.
    Bytes of wide characters that may end a wide white space count as such.
    """
    n = len(data)
    begins = np.zeros(n, bool)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    if n > 2:
        mid, before, after = data[1:-1], data[:-2], data[2:]
        white = np.zeros(256, bool)
        white[[SPACE, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
        wide = np.zeros(256, bool)
        wide[[0xC2, 0x80, 0x81, 0x9A]] = True
        two_before = np.concatenate([[np.uint8(0)], data[:-3]])
        place = (mid == SPACE) | (mid == NEWLINE)
        place &= ~white[before] & ~white[after] & ~((before >= 0x80) & wide[two_before])
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        place &= ~edge[2:-1]  # what follows belongs to the same row
        begins[1:-1] |= place
    return np.flatnonzero(begins)


SEGMENTS = pa.schema(
    [
        ("valid", pa.bool_()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups", pa.string()),
        ("pairs", pa.large_list(pa.int64())),  # distinct, in order
        ("times", pa.large_list(pa.int64())),
    ]
)


class Aligner:
    """Aligns distinct segments and remembers them as rows of one Arrow table.

    Beyond `limit` rows those that were met again since the last time stay.
    """

    def __init__(self, path_a, path_b, limit=CACHE_SEGMENTS):
        self.a, self.b, self.limit = ByteLevel(path_a), Pieces(path_b), limit
        self.table, self.at, self.again = SEGMENTS.empty_table(), {}, np.zeros(0, bool)

    def segments(self, keys):
        """A row of `SEGMENTS` for each of the distinct texts `keys`."""
        if len(self.table) > self.limit:
            self._trim()
        met = [self.at[k] for k in keys if k in self.at]
        self.again[met] = True
        missing = [k for k in keys if k not in self.at] if len(met) < len(keys) else []
        parts = [self.table]
        for at in range(0, len(missing), ENCODE_SEGMENTS):
            parts.append(self._align(missing[at : at + ENCODE_SEGMENTS]))
        if missing:
            self.at.update(zip(missing, range(len(self.table), len(self.table) + len(missing))))
            self.again = np.concatenate([self.again, np.zeros(len(missing), bool)])
            self.table = pa.concat_tables(parts).combine_chunks()
        return self.table.take(np.fromiter(map(self.at.__getitem__, keys), np.int64, len(keys)))

    def _trim(self):
        keep = self.again if self.again.sum() <= self.limit // 2 else np.zeros(len(self.again), bool)
        new = np.cumsum(keep) - 1
        self.at = {k: int(new[i]) for k, i in self.at.items() if keep[i]}
        self.table = self.table.filter(pa.array(keep)).combine_chunks()
        self.again = np.zeros(len(self.table), bool)

    def _align(self, keys):
        """Encode all segments in one text; where that does not give its bytes back, one by one."""
        raw = [k.encode() for k in keys]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        # What ends in white space would run into the next one.
        alone = np.fromiter((k[-1].isspace() for k in keys), bool, len(keys))
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        n_joint = len(keys) - int(alone.sum())
        joint = self._both("".join([keys[i] for i in order[:n_joint]]), b"".join([raw[i] for i in order[:n_joint]]))
        single = order[n_joint:] if joint else order
        sides = [joint] if joint else []
        valid = np.ones(len(keys), bool)
        for i in single.tolist():
            found = self._both(keys[i], raw[i])
            valid[i] = found is not None
            if found:
                sides.append(found)
        order = order[valid[order]]
        ends = np.cumsum(size[order])
        a = _tokens([s[0] for s in sides], self.a.vocabulary, ends)
        b = _tokens([s[1] for s in sides], self.b.vocabulary, ends)
        found = _aligned(a, b, len(order), self.a.vocabulary, self.b.vocabulary)
        place = np.full(len(keys), -1, np.int64)
        place[order] = np.arange(len(order))
        return pa.concat_tables([found, _blank()]).take(np.where(place >= 0, place, len(order))).combine_chunks()

    def _both(self, text, raw):
        """Ids of both sides, or None where either does not give the bytes back."""
        if not text:
            return [], []
        ids = self.a.encode(text), self.b.encode(text)
        same = self.a.vocabulary.spelled(ids[0]) == raw and self.b.vocabulary.spelled(ids[1]) == raw
        return ids if same else None


def _blank():
    """The row of a segment without tokens."""
    row = {"valid": False, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pairs": [], "times": []}
    return pa.Table.from_pylist([row], SEGMENTS)


def _tokens(parts, vocabulary, ends):
    """Flat ids of all segments; of each token its segment, its bytes' range and its end in the segment.

    `ends`: where each segment ends in the bytes of all of them.
    """
    ids = np.concatenate([np.array(part, np.int64) for part in parts] or [np.zeros(0, np.int64)])
    to = np.cumsum(vocabulary.size[ids])
    segment = np.searchsorted(ends, to, "left")
    begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return {
        "ids": ids,
        "segment": segment,
        "from": to - vocabulary.size[ids],
        "to": to,
        "end": to - begin[segment] if len(ids) else to,
    }


def _common_ends(a, b):
    """Which tokens of each side end where one of the other side ends."""
    sides = [
        pa.table({"segment": x["segment"], "end": x["end"], name: np.arange(len(x["end"]))})
        for name, x in (("a", a), ("b", b))
    ]
    both = sides[0].join(sides[1], ["segment", "end"], join_type="inner", use_threads=False)
    cuts = []
    for name, x in (("a", a), ("b", b)):
        cut = np.zeros(len(x["end"]), bool)
        cut[both[name].to_numpy()] = True
        cuts.append(cut)
    return cuts


def _lists(values, bounds):
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), values)


def _bounds(sorted_parents, n):
    """Where the children of each of `n` parents begin, and the end."""
    return np.searchsorted(sorted_parents, np.arange(n + 1)).astype(np.int64)


def _aligned(a, b, n, of_a, of_b):
    """Rows of `SEGMENTS` of `n` segments from the tokens of both sides."""
    cut_a, cut_b = _common_ends(a, b)
    shown = []
    for x, cut, vocabulary in ((a, cut_a, of_a), (b, cut_b, of_b)):
        bounds = np.concatenate([[0], np.flatnonzero(cut) + 1])
        shown.append(pc.binary_join(_lists(vocabulary.shown.take(pa.array(x["ids"])), bounds), ","))
    group_segment = a["segment"][cut_a]
    group_bounds = _bounds(group_segment, n)
    groups = pc.binary_join(_lists(pc.binary_join_element_wise(*shown, "|"), group_bounds), ";")
    # Every token of A with all tokens of B that its bytes overlap; both sides cover the same bytes.
    first = np.searchsorted(b["to"], a["from"], "right")
    count = np.searchsorted(b["to"], a["to"], "left") - first + 1
    begin = np.cumsum(count) - count
    at_b = np.repeat(first - begin, count) + np.arange(int(count.sum()))
    pairs = (np.repeat(a["ids"], count) << B_BITS) | b["ids"][at_b]
    links, times = np.unique((np.repeat(a["segment"], count) << 32) | pairs, return_counts=True)
    link_bounds = _bounds(links >> 32, n)
    return pa.table(
        [
            pa.array(np.ones(n, bool)),
            pa.array(np.bincount(a["segment"], minlength=n)[:n]),
            pa.array(np.bincount(b["segment"], minlength=n)[:n]),
            pa.array(np.diff(group_bounds)),
            pa.array(np.bincount(np.repeat(a["segment"], count), minlength=n)[:n]),
            groups.cast(pa.string()),
            _lists(pa.array(links & 0xFFFFFFFF), link_bounds),
            _lists(pa.array(times.astype(np.int64)), link_bounds),
        ],
        schema=SEGMENTS,
    )


@lru_cache(maxsize=1)
def aligner(path_a, path_b):
    return Aligner(path_a, path_b)


def _expanded(bounds, of):
    """Positions of all children of the parents `of`, and how many each has."""
    count = np.diff(bounds)[of]
    begin = np.cumsum(count) - count
    return np.repeat(bounds[:-1][of] - begin, count) + np.arange(int(count.sum())), count


class Slice:
    """Rows of a slice with their segments: parent row and distinct segment of each occurrence."""

    def __init__(self, data, offsets, known):
        starts = cut_places(data, offsets)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        texts = pa.LargeStringArray.from_buffers(len(starts), bounds, pa.py_buffer(np.ascontiguousarray(data)))
        coded = texts.dictionary_encode()
        self.rows = len(offsets) - 1
        self.of = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.searchsorted(starts, offsets)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))
        self.distinct = known.segments(coded.dictionary.to_pylist()).combine_chunks()
        self.valid = np.diff(self.first) > 0
        self.valid[self.row[~self.numbers("valid")[self.of]]] = False
        self.pairs, self.times = (pc.list_flatten(self.distinct[c]).to_numpy() for c in ("pairs", "times"))
        lengths = pc.list_value_length(self.distinct["pairs"]).to_numpy().astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])

    def numbers(self, name):
        return self.distinct[name].to_numpy()

    def sums(self, of_segment):
        """Sum of a number of each segment over the segments of each row; 0 for rows without tokens."""
        total = np.concatenate([[0], np.cumsum(of_segment[self.of])])
        return np.where(self.valid, total[self.first[1:]] - total[self.first[:-1]], 0)

    def link_sums(self, of_link):
        """As `sums`, of a number of each distinct link taken as often as the link occurs."""
        total = np.concatenate([[0], np.cumsum(of_link * self.times)])
        return self.sums(total[self.bounds[1:]] - total[self.bounds[:-1]])

    def groups(self):
        if not len(self.of):
            return pa.array([""] * self.rows)
        texts = self.distinct["groups"].combine_chunks().take(pa.array(self.of))
        joined = pc.binary_join(_lists(texts, self.first.astype(np.int64)), ";")
        return pc.if_else(pa.array(self.valid), joined, pa.scalar("", joined.type))

    def row_pairs(self, wanted=None):
        """(row, pair, times) of all links of the rows, or of those whose place in `pairs` is wanted."""
        met = pa.table({"row": self.row, "segment": self.of}).filter(pa.array(self.valid[self.row]))
        met = met.group_by(["row", "segment"], use_threads=False).aggregate([([], "count_all")])
        take, count = _expanded(self.bounds, met["segment"].to_numpy())
        rows, often = (np.repeat(met[c].to_numpy(), count) for c in ("row", "count_all"))
        if wanted is not None:
            kept = wanted[take]
            take, rows, often = take[kept], rows[kept], often[kept]
        links = pa.table({"row": rows, "pair": self.pairs[take], "times": self.times[take] * often})
        return links.group_by(["row", "pair"], use_threads=False).aggregate([("times", "sum")])


def _spaced(texts):
    """A space and the text; null and empty texts stay empty."""
    texts = texts.fill_null("")
    return pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))


def pair_counts(docs, path_a, path_b, text_col="text"):
    """(a, b, n): in how many rows of `docs` a token a is linked to a token b."""

    def count(batches):
        known, held = aligner(path_a, path_b), []

        def merged():
            table = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return pa.table({"pair": table["pair"], "n": table["n_sum"]})

        size = 0
        for batch in batches:
            for _, data, offsets in slices(_spaced(batch.column(0)), SLICE_BYTES):
                found = Slice(data, offsets, known).row_pairs()
                found = found.group_by("pair", use_threads=False).aggregate([([], "count_all")])
                held.append(pa.table({"pair": found["pair"], "n": found["count_all"]}))
                size += len(found)
                if size > PARTIAL_PAIRS:
                    held, size = [merged()], 0
                    if len(held[0]) > PARTIAL_PAIRS // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from merged().to_batches()

    partial = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(count, "pair long, n long")
    total = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    return total.select(
        F.shiftright("pair", B_BITS).cast("int").alias("a"),
        F.col("pair").bitwiseAND((1 << B_BITS) - 1).cast("int").alias("b"),
        "n",
        "pair",
    )


def _with_best(counts):
    """`counts` with whether no other pair of the same token a has a higher count."""
    # One row for each token of a vocabulary.
    top = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("top")))
    return counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _frequent_from(counts, limit):
    """The smallest power of two such that at most `limit` pairs have that count."""
    powers = [1 << k for k in range(62)]
    row = counts.agg(*[F.count_if(F.col("n") >= p).alias(str(p)) for p in powers]).first()
    return next(p for p in powers if row[str(p)] <= limit)


class Lookup:
    """Counts of the frequent pairs, as sorted arrays."""

    def __init__(self, rows):
        order = np.argsort(rows["pair"].to_numpy())
        self.pairs = rows["pair"].to_numpy()[order]
        self.n = rows["n"].to_numpy()[order]
        self.best = rows["best"].to_numpy()[order]

    def find(self, pairs):
        """(count, whether best, whether held) of each pair; zeros where it is not held here."""
        if not len(self.pairs):
            none = np.zeros(len(pairs), np.int64)
            return none, none.astype(bool), none.astype(bool)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        held = self.pairs[at] == pairs
        return np.where(held, self.n[at], 0), self.best[at] & held, held


FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def align(docs, path_a, path_b, id_col="doc_id", text_col="text", lookup_pairs=LOOKUP_PAIRS):
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    `groups` is the text `a1,a2|b1;a3|b2,b3` of the ids of each group. The
    count of a pair is the number of rows that have it linked; `count_sum`
    sums it over all links, `n_best` counts the links whose count is the
    highest of their token of A, ties included.

    A null or empty text, or one that the tokens of either side do not give
    back byte by byte, has no tokens: zeros and an empty `groups`. Repeated
    rows count as often as they occur, whatever their ids; an empty table
    gives no rows; other columns are ignored. Long texts are taken whole.

    Corpus-wide, the `lookup_pairs` most frequent pairs at most are sent to
    all tasks; the links of all others are joined with their counts.
    """
    counts = _with_best(pair_counts(docs, path_a, path_b, text_col).checkpoint()).checkpoint()
    least = _frequent_from(counts, lookup_pairs)
    frequent = Lookup(counts.filter(F.col("n") >= least).toArrow())
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        known, lookup = aligner(path_a, path_b), shared.value
        for batch in batches:
            for row, data, offsets in slices(_spaced(batch.column(1)), SLICE_BYTES):
                part = Slice(data, offsets, known)
                n, best, held = lookup.find(part.pairs)
                numbers = [part.sums(part.numbers(f)) for f in FIELDS]
                numbers += [part.link_sums(best.astype(np.int64)), part.link_sums(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, part.rows),
                        *[pa.array(x, pa.int64()) for x in numbers],
                        part.groups(),
                        _others(part, ~held),
                    ],
                    ["doc_id", *FIELDS, "n_best", "count_sum", "groups", "others"],
                )

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run,
        f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
        " groups string, others array<struct<pair:long,times:long>>",
    )
    if least == 1:
        return rows.drop("others")
    return _add_others(rows, counts.filter(F.col("n") < least))


def _others(part, wanted):
    """For each row its links that the lookup does not hold, with how often they occur."""
    kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
    if not wanted.any():
        return pa.array([[]] * part.rows, kind)
    links = part.row_pairs(wanted).sort_by("row")
    links = links.combine_chunks()
    values = pa.StructArray.from_arrays(
        [pa.array(links[c].to_numpy(), pa.int64()) for c in ("pair", "times_sum")], ["pair", "times"]
    )
    bounds = _bounds(links["row"].to_numpy(), part.rows)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values).cast(kind)


def _add_others(rows, counts):
    """Add what the pairs that were not looked up contribute to each row."""
    # Numbered before they are stored, so the numbers stay.
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    links = rows.select("_row", F.inline("others")).join(counts, "pair")
    extra = links.groupBy("_row").agg(
        F.sum(F.col("times") * F.col("n")).alias("_sum"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
    )
    joined = rows.join(extra, "_row", "left")
    return joined.select(
        "doc_id",
        *FIELDS,
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        "groups",
    )
