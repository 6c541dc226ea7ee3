"""Bytes covered by a string of 200 bytes that starts at two places, by a collection's suffix order.

A window is the 200 bytes from one place of a text. Windows are equal only if
the least hash among their 64-byte grams is, so consecutive windows of one
least hash form a run, and a run whose hash occurs once is done. Runs that are
equal as a whole are counted by a digest; what is left, the different strings
that share a least hash, is ordered.

A repeated window has a gram of its run's hash at the same place as its equal,
so the spans of some 166 bytes about that gram that lie in all windows with the
gram within the same 35 places are equal too. Strings are cut to the windows
about spans that occur twice; strings without any are done.

Each task orders its strings column by column: in every round one symbol of
every string, from the end to the front, is inserted into the Burrows-Wheeler
transform of the collection, and the common prefixes of the new suffixes with
their neighbours follow from those of the round before. A round reads the
columns once in order and writes them once. A window is repeated where a
neighbouring suffix shares 200 bytes.

The columns stay in memory: a task orders its strings in parts of bounded size
(strings of one hash stay in one part), and between stages Spark's shuffle
files are the external files. A hash shared by more than `HOT_STRINGS` strings
would make an unbounded part; the windows of its runs are counted by their
128-bit digests instead.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from echolex.llm.texts import BYTE_CODES, ROLL, UNROLL, mix, slices, stream_code
from echolex.llm.texts import _powers as powers

WINDOW = 200
GRAM = 64
RUN_WINDOWS = WINDOW - GRAM + 1  # only periodic texts have longer runs
PART_BYTES = 1 << 18  # ordered at once; the columns stay in a core's cache
POOL_BYTES = 1 << 23  # strings from which parts of like lengths are made
RUN_BYTES = 1 << 17  # texts hashed at once
NARROW_BYTES = 1 << 19  # strings cut at once, but for a larger group
GRAM_PLACES = ((0, 33), (34, 67), (68, 101), (102, WINDOW - GRAM))  # of a gram in a window
HOT_STRINGS = 1 << 14
END = 0xFF  # no byte of UTF-8
PLACE_BITS = 24  # a part has fewer suffixes than 2^24
PLACE = np.uint32((1 << PLACE_BITS) - 1)
RUN_BITS = 16


# --- runs ------------------------------------------------------------------------


class Hasher:
    """64-bit hashes of spans of some bytes; `code` picks one of several functions."""

    def __init__(self, data, code=0):
        codes = mix(BYTE_CODES + stream_code(code)) | np.uint64(1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * powers(len(data), ROLL), out=self.sums[1:])
        self.back = powers(len(data) + 1, UNROLL)

    def grams(self, size):
        """Of the `size` bytes from every place, as far as they fit."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])

    def spans(self, first, size):
        value = (self.sums[first + size] - self.sums[first]) * self.back[first]
        return mix(value + np.asarray(size, np.uint64) * ROLL).view(np.int64)


def runs(data, offsets, window=WINDOW, longest=RUN_WINDOWS):
    """(row, least hash, digest, first window, windows, whether the hash occurs again) of all runs.

    `offsets` bound the rows; first windows are counted from the first byte of all rows.
    """
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none, none, none, none.astype(bool)
    hasher = Hasher(data)
    grams = hasher.grams(GRAM)
    least, span, covered = grams, window - GRAM + 1, 1
    while covered < span:
        step = min(covered, span - covered)
        least = np.minimum(least[: len(least) - step], least[step:])
        covered += step
    inside = np.zeros(len(least) + 1, np.int8)  # windows that lie in one row
    size = np.diff(offsets)
    begin, end = offsets[:-1][size >= window], offsets[1:][size >= window] - window + 1
    inside[begin] += 1
    inside[end] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    # Between the windows of two rows there are some that lie in none.
    new = np.concatenate([[True], (least[1:] != least[:-1]) | ~inside[:-1]])
    opens = np.flatnonzero(inside & new)
    if not len(opens):
        return none, none, none, none, none, none.astype(bool)
    row = np.searchsorted(offsets, opens, "right") - 1
    length = np.minimum(np.append(opens[1:], len(data)), offsets[row + 1] - window + 1) - opens
    pieces = -(-length // longest)
    part = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(opens, pieces) + part * longest
    count = np.minimum(longest, np.repeat(opens + length, pieces) - first)
    # A text that repeats inside one run has the gram of the run more than once in a string.
    hit = np.flatnonzero(grams <= least[opens].max())
    value = grams[hit]
    order = np.argsort(value, kind="stable")
    hit, value = hit[order], value[order]
    near = (value[1:] == value[:-1]) & (hit[1:] - hit[:-1] < longest + span)
    again = np.isin(least[first], value[1:][near])
    digest = hasher.spans(first, count + window - 1)
    return np.repeat(row, pieces), least[first].view(np.int64), digest, first, count, again


# --- the order of a collection ------------------------------------------------------


def _merged(old, stays, at, new):
    """`old` at the places that `stays` marks, `new` at the places `at`."""
    out = np.empty(len(stays), old.dtype)
    out[at] = new
    out[stays] = old
    return out


def _least_between(common, low, high):
    """Least of common[low + 1 : high + 1] for each pair."""
    order = np.argsort(-low, kind="stable")
    ends = np.empty(2 * len(low), np.int64)
    ends[0::2], ends[1::2] = low[order] + 1, high[order] + 1
    padded = np.append(common, common.dtype.type(0))
    out = np.empty(len(low), common.dtype)
    # From the last range to the first, so that what lies between two is a single place.
    out[order] = np.minimum.reduceat(padded, ends)[0::2] if len(low) else out
    return out


def collection(strings, lengths, cap=WINDOW):
    """(transform, common prefixes up to `cap`) of the suffixes of all strings in order.

    `strings` is a matrix of one string a row, aligned to the right; `lengths`
    their lengths, all at least 1. Every string ends in a symbol of its own,
    smaller than all bytes, in the order of the rows. A suffix that is a whole
    string has `END` as its preceding symbol.
    """
    m, width = strings.shape
    if m + int(lengths.sum()) > PLACE:
        raise ValueError("too many suffixes for one part")
    # Preceding symbols in the low bytes, common prefixes in the high ones, so that one merge moves both.
    column = strings[:, -1].astype(np.uint16)
    # Symbols of the transform with their places, in order: where each stands here is where the
    # suffix that it begins stands behind the `m` ends. `END` begins none.
    keys = (column.astype(np.uint32) << PLACE_BITS) | np.arange(m, dtype=np.uint32)
    active = np.argsort(keys, kind="stable")
    keys, rank = keys[active], np.arange(m)
    for j in range(1, width + 1):
        # A new suffix has a common prefix with the one before it, and that after with it.
        touched = np.concatenate([rank, rank[np.diff(rank, append=-1) != 1] + 1])
        touched = touched[(touched > 0) & (touched < len(keys))]
        low, high = keys[touched - 1], keys[touched]
        same = (low ^ high) <= PLACE
        shared = np.zeros(len(touched), np.uint16)
        ends = ((x[same] & PLACE).astype(np.int64) for x in (low, high))
        shared[same] = np.minimum(_least_between((column >> 8).astype(np.uint8), *ends), cap - 1) + 1
        at = m + rank
        before = np.full(len(at), END, np.uint16)
        inner = lengths[active] > j
        before[inner] = strings[active[inner], width - j - 1]
        # Old places move behind as many new ones as stand before them.
        moved = np.repeat(
            np.arange(len(at) + 1, dtype=np.uint32), np.diff(at - np.arange(len(at)), prepend=0, append=len(column))
        )
        keys += moved.take((keys & PLACE).astype(np.int64))
        stays = np.ones(len(column) + len(at), bool)
        stays[at] = False
        column = _merged(column, stays, at, before)
        column[m + touched] = (column[m + touched] & 0xFF) | (shared << 8)
        active, at = active[inner], at[inner]
        if not len(active):
            break
        new = (before[inner].astype(np.uint32) << PLACE_BITS) | at.astype(np.uint32)
        order = np.argsort(new, kind="stable")
        active, new = active[order], new[order]
        rank = np.searchsorted(keys, new) + np.arange(len(new))
        stays = np.ones(len(keys) + len(new), bool)
        stays[rank] = False
        keys = _merged(keys, stays, rank, new)
    return (column & 0xFF).astype(np.uint8), (column >> 8).astype(np.uint8)


def repeated_starts(strings, lengths, window=WINDOW):
    """For each string the places from its end (1 is the last byte) at which a repeated window starts.

    (string, distance from the end) of every suffix that shares `window` bytes
    with a neighbour in the order, found by following the transform from the
    ends of all strings to their fronts.
    """
    transform, common = collection(strings, lengths, window)
    order = np.argsort(transform, kind="stable")
    onward = np.empty(len(order), np.int64)
    m = len(strings)
    onward[order] = m + np.arange(len(order))
    full = common >= window
    repeated = full.copy()
    repeated[:-1] |= full[1:]
    place, active = np.arange(m), np.arange(m)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for j in range(1, strings.shape[1] + 1):
        active = active[lengths[active] >= j]
        place[active] = onward[place[active]]
        if j >= window:
            hit = active[repeated[place[active]]]
            found.append((hit, np.full(len(hit), j)))
    return tuple(np.concatenate(x) for x in zip(*found))


# --- Spark -----------------------------------------------------------------------


def _each_text(texts):
    """(row, bytes) of every text of an Arrow array that has a window."""
    for row, data, offsets in slices(texts):
        for k in np.flatnonzero(np.diff(offsets) >= WINDOW).tolist():
            yield row + k, data[offsets[k] : offsets[k + 1]]


def _run_rows(texts):
    """Of all texts: row, least hash, digest, first window, windows, again."""
    none = np.zeros(0, np.int64)
    found = [(none, none, none, none, none, none.astype(bool))]
    for at, data, offsets in slices(texts, RUN_BYTES):
        row, least, digest, first, count, again = runs(data, offsets)
        found.append((row + at, least, digest, first - offsets[row], count, again))
    return [np.concatenate(x) for x in zip(*found)]


def _batch(columns, names):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _counted_runs(batches):
    """least, digest, times, again: equal runs of a batch as one row."""
    for batch in batches:
        _, least, digest, _, _, again = _run_rows(batch.column(0))
        table = pa.table({"least": least, "digest": digest, "again": again})
        found = table.group_by(["least", "digest"], use_threads=False).aggregate([([], "count_all"), ("again", "max")])
        columns = [found[c].combine_chunks() for c in ("least", "digest", "count_all", "again_max")]
        yield pa.RecordBatch.from_arrays(columns, ["least", "digest", "times", "again"])


def _placed_runs(batches):
    """least, digest, the key of the text, place (first window and number of windows)."""
    for batch in batches:
        row, least, digest, first, count, _ = _run_rows(batch.column(2))
        keys = [batch.column(c).take(pa.array(row)) for c in (0, 1)]
        place = (first << RUN_BITS) | count
        yield pa.RecordBatch.from_arrays(
            [pa.array(least), pa.array(digest), *keys, pa.array(place)], ["least", "digest", "k1", "k2", "place"]
        )


def _strings(batches):
    """least, digest, string of the runs listed with each text; each string once in a while."""
    seen = set()
    for batch in batches:
        lists = batch.column(4)
        for row, data in _each_text(batch.column(3)):
            for r in lists[row].as_py() or ():
                key = r["least"], r["digest"]
                if key not in seen:
                    if len(seen) > 1 << 17:
                        seen.clear()
                    seen.add(key)
                    yield (*key, data, r["place"])


def _string_batches(batches):
    held, size = [], 0
    schema = pa.schema([("least", pa.int64()), ("digest", pa.int64()), ("string", pa.binary())])

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for least, digest, data, place in _strings(batches):
        first, count = place >> RUN_BITS, place & ((1 << RUN_BITS) - 1)
        held.append((least, digest, data[first : first + count + WINDOW - 1].tobytes()))
        size += len(held[-1][2])
        if size > 1 << 22:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def _window_batches(batches):
    """Two digests, key and place of every window of the runs listed with each text."""
    for batch in batches:
        lists = batch.column(4)
        for row, data in _each_text(batch.column(3)):
            listed = lists[row].as_py() or ()
            if not listed:
                continue
            places = [(r["place"] >> RUN_BITS) + np.arange(r["place"] & ((1 << RUN_BITS) - 1)) for r in listed]
            first = np.concatenate(places)
            digests = [Hasher(data, code).spans(first, np.full(len(first), WINDOW)) for code in (1, 2)]
            keys = [np.full(len(first), batch.column(c)[row].as_py()) for c in (0, 1)]
            yield _batch([*digests, *keys, first], ["d1", "d2", "k1", "k2", "first"])


def _groups(batches):
    """Lists of the different (least, digest, string) of one hash, from sorted rows."""
    group = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if group and group[0][0] != row[0]:
                yield group
                group = []
            if not group or group[-1][:2] != row[:2]:
                group.append(row)
    if group:
        yield group


def _narrowed(groups):
    """Lists of (least, digest, string, bytes cut off ahead): see `_cut_to_spans`."""
    held, size = [], 0
    for group in groups:
        held += group
        size += sum(len(x[2]) for x in group)
        if size > NARROW_BYTES:
            yield from _cut_to_spans(held)
            held, size = [], 0
    yield from _cut_to_spans(held)


def _cut_to_spans(rows):
    """Groups of the strings that hold a span twice found, cut to the windows about such spans.

    `rows` are whole groups of (least, digest, string). Every window of a string
    holds a gram of the hash `least`; at places `low` to `high` of a window it has
    the span from `low` bytes before the gram to the end of a window in which the
    gram is at `high`. Equal windows have equal spans, so none is lost.
    """
    lengths = np.array([len(x[2]) for x in rows], np.int64)
    ends = np.cumsum(lengths)
    hasher = Hasher(np.frombuffer(b"".join(x[2] for x in rows), np.uint8))
    grams = hasher.grams(GRAM).view(np.int64)
    least = np.repeat(np.array([x[0] for x in rows], np.int64), lengths)[: len(grams)]
    hit = np.flatnonzero(grams == least)
    which = np.searchsorted(ends, hit, "right")
    place = hit - (ends - lengths)[which]
    first, last = lengths.copy(), np.zeros(len(rows), np.int64)
    for low, high in GRAM_PLACES:
        # Places of the gram in those windows that lie in the string.
        near, far = np.maximum(low, place + WINDOW - lengths[which]), np.minimum(high, place)
        held = np.flatnonzero(near <= far)
        spans = hasher.spans(hit[held] - low, np.full(len(held), WINDOW - high + low))
        order = np.argsort(spans, kind="stable")
        same = np.flatnonzero(spans[order[1:]] == spans[order[:-1]])
        twice = held[order[np.union1d(same, same + 1)]]
        np.minimum.at(first, which[twice], place[twice] - far[twice])
        np.maximum.at(last, which[twice], place[twice] - near[twice] + WINDOW)
    group = []
    for i in np.flatnonzero(first < last).tolist():
        value, digest, string = rows[i]
        if group and group[0][0] != value:
            yield group
            group = []
        group.append((value, digest, string[first[i] : last[i]], int(first[i])))
    if group:
        yield group


def _parts(groups):
    """Lists of strings to be ordered together; whole groups, those of like length in one part."""
    pool, size = [], 0
    for group in groups:
        longest = max(len(x[2]) for x in group)
        pool.append((longest, group))
        size += longest * len(group)
        if size > POOL_BYTES:
            yield from _cut(pool)
            pool, size = [], 0
    yield from _cut(pool)


def _cut(pool):
    part, size = [], 0
    for longest, group in sorted(pool, key=lambda x: x[0]):
        part += group
        size += longest * len(group)
        if size > PART_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _ordered(batches):
    """least, digest, spans: repeated windows of every string that has some."""
    for part in _parts(_narrowed(_groups(batches))):
        lengths = np.array([len(x[2]) for x in part])
        width = int(lengths.max())
        strings = np.zeros((len(part), width), np.uint8)
        strings[np.arange(width) >= width - lengths[:, None]] = np.frombuffer(b"".join(x[2] for x in part), np.uint8)
        which, back = repeated_starts(strings, lengths)
        order = np.lexsort((-back, which))
        which, first = which[order], (lengths[which] - back)[order]
        ahead = np.array([x[3] for x in part])
        opens = np.flatnonzero(
            np.concatenate([[True], (which[1:] != which[:-1]) | (first[1:] != first[:-1] + 1)])
        ) if len(which) else np.zeros(0, np.int64)
        closes = np.append(opens[1:], len(which)) - 1 if len(opens) else opens
        yield _batch(
            [
                np.array([part[i][0] for i in which[opens]], np.int64),
                np.array([part[i][1] for i in which[opens]], np.int64),
                first[opens] + ahead[which[opens]],
                first[closes] - first[opens] + 1,
            ],
            ["least", "digest", "ahead", "windows"],
        )


def _removed(batches):
    """row, n_bytes, n_removed, n_spans, kept, spans."""
    for batch in batches:
        lists = batch.column(4)
        for at, data, offsets in slices(batch.column(3)):
            out = []
            for k in range(len(offsets) - 1):
                text = data[offsets[k] : offsets[k + 1]]
                begin, end = _covered(lists[at + k].as_py() or ())
                edge = np.zeros(len(text) + 1, np.int64)
                edge[begin] += 1
                edge[end] -= 1
                kept = text[np.cumsum(edge[:-1]) == 0].tobytes()
                spans = [{"start": int(b), "end": int(e)} for b, e in zip(begin, end)]
                out.append((len(text), len(text) - len(kept), len(spans), kept, spans))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), _REMOVED)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).slice(at, len(out)), *columns],
                ["row", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
            )


_REMOVED = [
    pa.int64(), pa.int64(), pa.int64(), pa.binary(),
    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
]


def _covered(windows):
    """Sorted runs of bytes, none touching the next, that the windows of (first, count) cover."""
    if not windows:
        none = np.zeros(0, np.int64)
        return none, none
    begin = np.array([w["first"] for w in windows], np.int64)
    end = begin + np.array([w["windows"] for w in windows], np.int64) + WINDOW - 1
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    opens = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[opens], end[np.append(opens[1:], True)]


_RUN = "least long, digest long, "


def repeated_windows(keyed, hot_strings=HOT_STRINGS):
    """(k1, k2, windows): for texts by key the (first, windows) whose 200 bytes start elsewhere too.

    `keyed` has k1, k2 (the digest of the text), row and text.
    """
    slim = keyed.select("k1", "k2", "text").filter(F.octet_length("text") >= WINDOW)
    counted = slim.select("text").mapInArrow(_counted_runs, _RUN + "times long, again boolean")
    # Dealt by hash once: equal runs and the runs of one hash meet without another shuffle.
    equal = counted.repartition("least").groupBy("least", "digest").agg(
        F.sum("times").alias("times"), F.max("again").alias("again")
    )
    by_hash = equal.groupBy("least").agg(
        F.sum("times").alias("total"), F.count(F.lit(1)).alias("strings"), F.max("again").alias("some")
    )
    by_hash = by_hash.filter("total > 1 or some")
    # With `again`, so that both sides read the same shuffle.
    shared = equal.join(by_hash, "least").select("least", "digest", "times", "strings", "some", "again").checkpoint()
    shared = shared.drop("again")
    placed = slim.mapInArrow(_placed_runs, _RUN + "k1 long, k2 long, place long")
    met = placed.join(shared, ["least", "digest"])
    first = F.shiftright("place", RUN_BITS)
    count = F.col("place").bitwiseAND((1 << RUN_BITS) - 1)
    key = ["k1", "k2"]
    whole = met.filter("times > 1").select(*key, first.alias("first"), count.alias("windows"))

    def listed(condition):
        runs_of = F.collect_set(F.struct("least", "digest", "place")).alias("runs")
        found = met.filter(condition).groupBy(*key).agg(runs_of)
        # A left join, as the last one has it, so that the shuffle of the texts is used again.
        text = F.when(F.col("runs").isNotNull(), F.col("text")).otherwise("")
        return keyed.join(found, key, "left").select(*key, "row", text.alias("text"), "runs")

    several = F.expr(f"(strings > 1 or some) and strings <= {hot_strings}")
    strings = listed(several).mapInArrow(_string_batches, _RUN + "string binary")
    ordered = strings.repartition("least").sortWithinPartitions("least", "digest").mapInArrow(
        _ordered, _RUN + "ahead long, windows long"
    )
    single = met.filter(several & F.expr("times = 1"))
    parts = single.join(ordered, ["least", "digest"]).select(*key, (first + F.col("ahead")).alias("first"), "windows")
    all_windows = whole.unionByName(parts)
    hot = F.col("strings") > hot_strings
    if not shared.filter(hot).isEmpty():
        every = listed(hot).mapInArrow(_window_batches, "d1 long, d2 long, k1 long, k2 long, first long")
        twice = every.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("d1", "d2")
        found = every.join(twice, ["d1", "d2"]).select(*key, "first", F.lit(1).cast("long").alias("windows"))
        all_windows = all_windows.unionByName(found)
    return all_windows.groupBy(*key).agg(F.collect_set(F.struct("first", "windows")).alias("windows"))


def remove_repeats(docs, id_col="doc_id", text_col="text", hot_strings=HOT_STRINGS):
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept (bytes), spans.

    Every byte of a text's UTF-8 that is covered by a string of 200 bytes which
    also starts elsewhere, in the same text or another row's, is taken out;
    what repeats is judged before anything is taken out, so no copy stays. A
    null text is an empty one; texts under 200 bytes stay whole. Rows with
    equal texts repeat each other whatever their ids, null ids included. An
    empty table gives no rows; other columns are ignored. `kept` may break a
    character where a repeat ends inside it. `spans` are the maximal runs of
    bytes taken out.
    """
    digest = F.md5(F.col("text"))
    keys = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(k) for at, k in ((1, "k1"), (16, "k2"))]
    slim = docs.select(docs[id_col].alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    keyed = slim.select(*keys, "row", "text")
    found = repeated_windows(keyed, hot_strings)
    id_type = keyed.schema["row"].dataType.simpleString()
    rows = keyed.join(found, ["k1", "k2"], "left").select("k1", "k2", "row", "text", "windows")
    return rows.mapInArrow(
        _removed,
        f"row {id_type}, n_bytes long, n_removed long, n_spans long, kept binary,"
        " spans array<struct<start:long,end:long>>",
    ).withColumnRenamed("row", "doc_id")
