"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text, h = 2 h + G[byte] in 16 bits, and a
chunk ends where its upper bits are zero. A cut depends on the last 16 bytes
only, so an insertion moves the cuts near it and no others. Chunks are compared
by digest over all documents. The document with the smallest id keeps a chunk;
in every other one, runs of repeated chunks with at least `min_words` whole
words are taken out, from the first to the last whole word of the run.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F

from echolex.llm import texts as T

WINDOW = 16
CUT_BITS = 5  # a chunk has 2 ** CUT_BITS bytes on average
MAX_CHUNK = 256
MIN_WORDS = 12  # of a run; a shared passage loses some words to cut chunks at both ends
_GEAR = np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 16, 256).astype(np.uint16)


def gear(data):
    """The rolling hash after every byte, over the last 16 bytes."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint16(step)
        h = longer
    return h


def chunks(data, offsets):
    """(start, end, row, digest) of the chunks of a slice, in order."""
    cut = (gear(data) >> np.uint16(16 - CUT_BITS)) == 0
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    cut &= np.arange(len(data)) - begin >= WINDOW - 1  # not from another text's bytes
    edges = np.union1d(np.flatnonzero(cut) + 1, offsets)
    gap = np.diff(edges)
    if len(gap) and gap.max() > MAX_CHUNK:
        parts = -(-gap // MAX_CHUNK)
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        edges = np.append(np.repeat(edges[:-1], parts) + at * MAX_CHUNK, edges[-1])
    start, end = edges[:-1], edges[1:]
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row, T.hash_spans(data, start, end)


def _first_in_row(row, digest):
    """True for the first chunk of each (row, digest)."""
    keys = T.mix(digest + row.astype(np.uint64) * T.ROLL)
    _, first = np.unique(keys, return_index=True)
    out = np.zeros(len(row), bool)
    out[first] = True
    return out


def _positions(row, rows):
    first = np.searchsorted(row, np.arange(rows))
    return np.arange(len(row)) - first[row] if len(row) else row


def chunk_table(docs):
    """digest, doc_id, pos: every distinct chunk of every document at its first place."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, data, offsets in T.slices(batch.column(1)):
                _, _, row, digest = chunks(data, offsets)
                pos = _positions(row, len(offsets) - 1)
                first = _first_in_row(row, digest)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digest[first].view(np.int64)),
                        ids.take(pa.array(row[first] + at)),
                        pa.array(pos[first], pa.int32()),
                    ],
                    names=["digest", "doc_id", "pos"],
                )

    return docs.mapInArrow(run, "digest long, doc_id long, pos int")


def repeated_chunks(docs):
    """doc_id and the positions of its chunks that an earlier document has."""
    table = chunk_table(docs)
    # Combined per task first, so a chunk of very many documents is no hot key here.
    owners = table.groupBy("digest").agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("n"))
    owners = owners.filter("n > 1").select("digest", "owner")
    # Unique on the right side: adaptive execution may split a hot digest on the left.
    return (
        table.join(owners, "digest")
        .filter(F.col("doc_id") > F.col("owner"))
        .groupBy("doc_id")
        .agg(F.collect_list("pos").alias("repeated"))  # at most the chunks of one document
    )


def _spans(data, offsets, repeated, min_words):
    """(first byte, last byte, row, words) of what is taken out of a slice."""
    start, end, row, digest = chunks(data, offsets)
    rows = len(offsets) - 1
    dup = ~_first_in_row(row, digest)
    first = np.searchsorted(row, np.arange(rows))
    for r, positions in enumerate(repeated):
        if positions is not None:
            dup[first[r] + np.asarray(positions)] = True
    joined = np.zeros(len(dup), bool)  # continues the run of the chunk before it
    joined[1:] = dup[1:] & dup[:-1] & (row[1:] == row[:-1])
    opens = np.flatnonzero(dup & ~joined)
    closes = np.flatnonzero(dup & ~np.append(joined, False)[1:])
    words = T.find_words(data, offsets)
    w0 = np.searchsorted(words.start, start[opens])
    w1 = np.searchsorted(words.end, end[closes], "right")
    enough = w1 - w0 >= min_words
    w0, w1 = w0[enough], w1[enough]
    return words.start[w0], words.end[w1 - 1], row[opens[enough]], w1 - w0


def _without(data, offsets, begin, end):
    """Bytes and bounds of the texts without the spans and the space after each."""
    keep = np.ones(len(data) + 1, np.int8)
    delta = np.zeros(len(data) + 1, np.int64)
    np.add.at(delta, begin, 1)
    np.add.at(delta, end, -1)
    keep = np.cumsum(delta)[:-1] == 0
    follows = end[end < len(data)]
    follows = follows[T.IS_SPACE[data[follows]] & ~np.isin(follows, offsets)]
    keep[follows] = False
    left = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=left[1:])
    return data[keep], left[offsets]


def dedup_substrings(docs, min_words=MIN_WORDS):
    """`docs` with shortened texts and a struct `_removed`: words, spans (bytes of the old text).

    Needs doc_id (long) and text. A null text stays null and has no spans; an
    empty one stays empty; a document without an id is left as it is but for
    its own repeats. Rows that repeat a doc_id are the same document: they do
    not repeat each other. A text all of which occurs earlier becomes empty.
    Ties do not occur: of documents with a chunk the smallest id keeps it. An
    empty table gives no rows.
    """
    names = docs.columns
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    repeated = repeated_chunks(slim.filter("doc_id is not null and text is not null"))
    others = [F.col(f"`{c}`") for c in names if c != "text"]
    inner = docs.select(
        F.struct(F.lit(0).alias("_"), *others).alias("row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.col("text").cast("string").alias("text"),
    ).join(repeated.withColumnRenamed("doc_id", "_id"), "_id", "left")

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(1), batch.column(2).to_pylist()
            for at, data, offsets in T.slices(texts):
                rows = len(offsets) - 1
                begin, end, row, words = _spans(data, offsets, lists[at : at + rows], min_words)
                left, bounds = _without(data, offsets, begin, end)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), _strings(left, bounds, texts.slice(at, rows))]
                    + [_removed(begin - offsets[row], end - offsets[row], row, words, rows)],
                    names=["row", "text", "_removed"],
                )

    kind = inner.schema["row"].dataType.simpleString()
    schema = f"row {kind}, text string, _removed struct<words:long,spans:array<struct<start:long,end:long>>>"
    out = inner.select("row", "text", "repeated").mapInArrow(run, schema)
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in names], "_removed")


def _strings(data, bounds, old):
    made = pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    ).cast(pa.string())
    return pa.compute.if_else(old.is_valid(), made, pa.scalar(None, pa.string())) if old.null_count else made


def _removed(begin, end, row, words, rows):
    pair = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], ["start", "end"])
    bounds = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(bounds), pair)
    total = np.bincount(row, words, minlength=rows).astype(np.int64)
    return pa.StructArray.from_arrays([pa.array(total), spans], ["words", "spans"])
