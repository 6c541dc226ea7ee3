"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is its five-word shingles, each weighted by how often it occurs.
Two documents are linked when the probability Jaccard similarity of these
weighted sets is 0.8 or more.

ProbMinHash: every shingle is a Poisson process with its weight as rate; each
arrival hits a random register, and a register keeps the first shingle that
hits it. Registers of two documents agree with the probability Jaccard as
probability. Arrivals later than the latest register are not generated.

Candidates share a band of registers. Their number of equal registers gives an
estimate with a confidence bound; pairs that may reach the threshold are
verified exactly on their texts. The pairs of a bucket are never formed as
rows: every member meets the bucket's smallest one, and after that members that
are still apart are compared in blocks, of which only a spanning forest comes
out. The same is done once more with exact similarities, inside the classes
that the estimates had joined and verification has split. So whatever stays
apart has been compared, and a large class costs one comparison per member.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from echolex.llm import texts as T
from echolex.llm.graph import components, linked_groups

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# A pair at the threshold shares none of 25 bands of 5 with probability 5e-5.
BANDS, BAND_ROWS = 25, 5
REGISTERS = BANDS * BAND_ROWS
SIGMAS = 5.0
# Rows on one side of a block of comparisons.
REGISTER_BLOCK, TEXT_BLOCK = 2048, 256
# Equal registers a pair at the threshold has at least, but for SIGMAS deviations.
MIN_EQUAL = int(REGISTERS * THRESHOLD - SIGMAS * (REGISTERS * THRESHOLD * (1 - THRESHOLD)) ** 0.5)


def shingles(data, offsets):
    """(hash, row, count) of the distinct shingles of each row of a slice.

    A text of one to four words is one shingle; one without words has none.
    """
    words = T.find_words(data, offsets)
    value, row, _ = T.windows(T.hash_spans(data, words.start, words.end), words, SHINGLE_WORDS, short=True)
    keys = T.mix(value + row.astype(np.uint64) * T.ROLL)
    _, first, count = np.unique(keys, return_index=True, return_counts=True)
    return value[first], row[first], count


def prob_minhash(value, row, weight, rows, registers=REGISTERS):
    """(rows, registers) array of the shingle that hits each register first.

    Rows without shingles stay 0. The arrivals of a shingle depend on its hash
    alone, so equal shingles of different texts arrive alike.
    """
    first_at = np.full(rows * registers, np.inf)
    first_is = np.zeros(rows * registers, np.uint64)
    time = np.zeros(len(value))
    latest = np.full(rows, np.inf)
    turn = 0
    while len(value):
        seed = T.mix(value + T.stream_code(2 * turn + 1))
        uniform = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weight
        alive = time < latest[row]
        value, row, weight, time, seed = (x[alive] for x in (value, row, weight, time, seed))
        cell = row * registers + (T.mix(seed ^ T.ROLL) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first_at, cell, time)
        won = first_at[cell] == time
        first_is[cell[won]] = value[won]
        touched = np.unique(row)
        latest[touched] = first_at.reshape(rows, registers)[touched].max(axis=1)
        turn += 1
    return first_is.reshape(rows, registers)


def band_keys(signature):
    """One 64-bit key per band of each row."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.ones((len(signature), 1), np.uint64)
    for k in range(BAND_ROWS):
        key = T.mix(key * T.ROLL + parts[:, :, k])
    return key.view(np.int64)


def signatures(docs, id_col="doc_id", text_col="text"):
    """doc_id, text_key, bands (null without words), registers cut to 16 bits."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), text)

    def run(batches):
        for batch in batches:
            for at, data, offsets in T.slices(batch.column(2)):
                rows = len(offsets) - 1
                value, row, count = shingles(data, offsets)
                signature = prob_minhash(value, row, count.astype(np.float64), rows)
                empty = np.bincount(row, minlength=rows) == 0
                keys = band_keys(signature)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()),
                    mask=pa.array(empty),
                )
                short = (signature >> np.uint64(48)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, rows),
                        batch.column(1).slice(at, rows),
                        bands,
                        pa.array([r.tobytes() for r in short], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "bands", "registers"],
                )

    return source.mapInArrow(run, "doc_id long, text_key binary, bands array<long>, registers binary")


def probability_jaccard(a, x, b, y):
    """Similarity of two weighted sets given as (sorted elements, weights)."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x_only, y_only = x.sum() - x[i].sum(), y.sum() - y[j].sum()
    u, v = x[i].astype(np.float64), y[j].astype(np.float64)
    ratio = v / u
    order = np.argsort(ratio, kind="stable")
    u, v, ratio = u[order], v[order], ratio[order]
    # Of element e the share is 1 / sum over all f of max(x_f / x_e, y_f / y_e).
    upto = np.searchsorted(ratio, ratio, "right")
    x_sum, y_sum = np.concatenate([[0], np.cumsum(u)]), np.concatenate([[0], np.cumsum(v)])
    x_part = x_only + x_sum[upto]
    y_part = y_only + y_sum[-1] - y_sum[upto]
    return float((1.0 / (x_part / u + y_part / v)).sum())


def shingle_sets(texts):
    """(sorted shingles, counts) of each text."""
    out = []
    for _, data, offsets in T.slices(texts):
        value, row, count = shingles(data, offsets)
        order = np.lexsort((value, row))
        value, count = value[order], count[order]
        bounds = np.searchsorted(row[order], np.arange(len(offsets)))
        out += [(value[s:e], count[s:e]) for s, e in zip(bounds[:-1], bounds[1:])]
    return out


def similar_pairs(pairs, threshold=THRESHOLD):
    """a, b of the rows (a, b, text_a, text_b) that reach the threshold."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                left, right = shingle_sets(batch.column(2)), shingle_sets(batch.column(3))
                value = np.array([probability_jaccard(*p, *q) for p, q in zip(left, right)])
                keep = pa.array(value >= threshold - 1e-12)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"]
                )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _likely(pairs, registers):
    """Pairs whose number of equal registers lets them reach the threshold."""
    a = registers.select(F.col("rep").alias("a"), F.col("registers").alias("ra"))
    b = registers.select(F.col("rep").alias("b"), F.col("registers").alias("rb"))

    def run(batches):
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(-1, REGISTERS)
                for c in (batch.column(2), batch.column(3))
            )
            keep = pa.array((left == right).sum(axis=1) >= MIN_EQUAL)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"]
            )

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ra", "rb")
    return both.mapInArrow(run, "a long, b long")


def _apart(members, compare, block):
    """Links a, b between members of one key that lie in different groups.

    `members`: key (any type), rep, group, payload. Keys with one group drop
    out. Members outside the largest group of a key meet all others of it, in
    blocks of at most `block` rows on either side; those of the largest group
    do not meet each other. `compare(payloads, few, group)` gets the payloads of
    two blocks, which of them belong to the first, and their group numbers, and
    returns the positions of linked pairs.
    """
    size = members.groupBy("key", "group").agg(F.count(F.lit(1)).alias("n"))
    mixed = size.groupBy("key").agg(
        F.count(F.lit(1)).alias("groups"),
        F.max(F.struct("n", "group")).alias("largest"),
        F.sum("n").alias("all"),
    )
    mixed = mixed.filter("groups > 1").select(
        "key",
        F.col("largest.group").alias("largest"),
        F.ceil(F.col("all") / block).cast("int").alias("columns"),
        F.ceil((F.col("all") - F.col("largest.n")) / block).cast("int").alias("lines"),
    )
    known = members.join(mixed, "key").withColumn("few", F.col("group") != F.col("largest"))
    column = F.pmod(F.xxhash64("rep"), F.col("columns")).cast("int")
    line = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("lines")).cast("int")
    from_few = known.filter("few").withColumn("line", line).withColumn("column", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)))
    from_all = known.withColumn("column", column).withColumn("line", F.explode(F.sequence(F.lit(0), F.col("lines") - 1)))
    kept = [F.xxhash64("key", "line", "column").alias("place"), "rep", "group", "payload"]
    met = from_few.select(*kept, F.lit(True).alias("few")).unionAll(from_all.select(*kept, F.lit(False).alias("few")))
    met = met.repartition("place").sortWithinPartitions("place", F.col("few").desc(), "rep")

    def run(batches):
        for rows in _runs(batches):
            rep = rows["rep"].to_numpy()
            few, group = (rows[c].to_numpy(zero_copy_only=False) for c in ("few", "group"))
            i, j = compare(rows["payload"], few, group)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(rep[i], rep[j])), pa.array(np.maximum(rep[i], rep[j]))], names=["a", "b"]
            )

    return met.mapInArrow(run, "a long, b long").distinct()


def _runs(batches):
    """Record batches of the consecutive rows with one `place`."""
    held = []
    for batch in batches:
        place = batch["place"].to_numpy()
        if held and len(place) and held[-1]["place"][0].as_py() != place[0]:
            yield _whole(held)
            held = []
        cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(place)]
        for low, high in zip(bounds[:-2], bounds[1:-1]):
            yield _whole([*held, batch.slice(low, high - low)])
            held = []
        if len(place):
            held.append(batch.slice(bounds[-2]))
    if held:
        yield _whole(held)


def _whole(parts):
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


class _Forest:
    """Union of numbered items; starts with items of equal `group` together."""

    def __init__(self, group):
        _, first = np.unique(group, return_index=True)
        self.up = first[np.searchsorted(group[first], group)].tolist()

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _likely_places(registers, few, group):
    """Pairs (one of `few`, any of another group) with enough equal registers, most equal first."""
    x, y = np.flatnonzero(few), np.flatnonzero(~few)
    found = []
    for low in range(0, len(x), 64):
        part = x[low : low + 64]
        equal = np.zeros((len(part), len(y)), np.int16)
        for k in range(registers.shape[1]):
            equal += registers[part, k][:, None] == registers[y, k][None, :]
        near = (equal >= MIN_EQUAL) & (group[part][:, None] != group[y][None, :])
        i, j = np.nonzero(near)
        found.append((part[i], y[j], equal[i, j]))
    i, j, equal = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
    order = np.argsort(-equal, kind="stable")
    return i[order], j[order]


def _forest_of(pairs, group, linked=None):
    forest, i_out, j_out = _Forest(group), [], []
    for i, j in zip(*(p.tolist() for p in pairs)):
        if forest.root(i) != forest.root(j) and (linked is None or linked(i, j)):
            forest.join(i, j)
            i_out.append(i)
            j_out.append(j)
    return np.array(i_out, np.int64), np.array(j_out, np.int64)


def _compare_registers(payloads, few, group):
    registers = np.frombuffer(b"".join(payloads.to_pylist()), "<u2").reshape(-1, REGISTERS)
    return _forest_of(_likely_places(registers, few, group), group)


def _compare_texts(payloads, few, group):
    sets = shingle_sets(payloads)
    value = np.concatenate([v for v, _ in sets])
    count = np.concatenate([n for _, n in sets]).astype(np.float64)
    row = np.repeat(np.arange(len(sets)), [len(v) for v, _ in sets])
    registers = (prob_minhash(value, row, count, len(sets)) >> np.uint64(48)).astype(np.uint16)

    def linked(i, j):
        return probability_jaccard(*sets[i], *sets[j]) >= THRESHOLD - 1e-12

    return _forest_of(_likely_places(registers, few, group), group, linked)


def near_duplicates(docs, id_col="doc_id", text_col="text"):
    """doc_id, class_id, n_copies, kept: one row per row of `docs`.

    class_id is the smallest doc_id reachable by links; kept says that it is
    the document's own. n_copies counts the rows with an equal text. Equal
    texts are one class, empty ones too; a null text links with nothing. Rows
    that repeat a doc_id and text get equal results; a null doc_id takes no
    part and is kept. An empty table gives no rows.
    """
    signed = signatures(docs, id_col, text_col).checkpoint()
    usable = signed.filter(F.col("doc_id").isNotNull() & F.col("text_key").isNotNull())
    copies = usable.groupBy("text_key").agg(
        F.min(F.struct("doc_id", "bands", "registers")).alias("least"), F.count(F.lit(1)).alias("n_copies")
    )
    copies = copies.select(
        "text_key", "n_copies", F.col("least.doc_id").alias("rep"), "least.bands", "least.registers"
    ).checkpoint()
    links = _links(copies, docs, id_col, text_col)
    groups = components(links.select("a", "b")).select(F.col("node").alias("rep"), "component")
    classes = copies.select("text_key", "rep", "n_copies").join(groups, "rep", "left")
    classes = classes.select("text_key", "n_copies", F.coalesce("component", "rep").alias("class_id"))
    out = signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("text_key")).alias("text_key"))
    out = out.join(classes, "text_key", "left")
    return out.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _links(copies, docs, id_col, text_col):
    """Verified links between different texts that connect every class."""
    entries = copies.select("rep", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n"))
    buckets = entries.join(shared.filter("n > 1"), "bucket").select("bucket", "rep", "a").checkpoint()
    registers = copies.select("rep", "registers")
    reps = buckets.select("rep").distinct()

    stars = buckets.filter("rep != a").select("a", F.col("rep").alias("b")).distinct()
    likely = _likely(stars, registers).checkpoint()
    groups = linked_groups(reps, likely)
    members = buckets.select(F.col("bucket").alias("key"), "rep").join(
        groups.join(registers, "rep").withColumnRenamed("registers", "payload"), "rep"
    )
    likely = likely.unionAll(_apart(members, _compare_registers, REGISTER_BLOCK)).checkpoint()

    joined = components(likely).withColumnRenamed("node", "rep").checkpoint()
    text = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .join(joined.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .checkpoint()
    )
    links = similar_pairs(_with_texts(likely, text)).checkpoint()
    # Verification may have split what the estimates had joined: compare there again.
    parts = linked_groups(joined.select("rep"), links).join(joined, "rep")
    members = parts.select(F.col("component").alias("key"), "rep", "group").join(
        text.select(F.col("doc_id").alias("rep"), F.col("text").alias("payload")), "rep"
    )
    return links.unionAll(_apart(members, _compare_texts, TEXT_BLOCK))


def _with_texts(pairs, text):
    a = text.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = text.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b")
