"""Token ids of whole texts by a public tokenizer that works word by word.

Words between white space are encoded independently by such a tokenizer, and
so are a run of letters and the punctuation after it; it also lowers letters
(a test holds this against encoding whole texts). So every distinct piece of a
slice is encoded once and found again in a per-worker cache.
"""

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
# Pieces in each of the two generations a worker keeps, some 150 bytes each.
CACHE_WORDS = 250_000
MISS_CHARS = 1 << 17
WORD_END = "</w>"  # suffix of a token at the end of a word
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True


def pieces_of(data, offsets):
    """(bytes of all pieces, start of each, number of pieces before each row) of some rows.

    White space is left out, ASCII letters are lowered, and a piece ends where
    a letter (ASCII or of the Latin-1 block) stands before one of `.,;:!?`.
    """
    n = len(data)
    solid = ~_SPACE[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    begins = begins[:-1]
    begins[1:] |= ~solid[:-1]
    if n > 1:
        letter = _ASCII_LETTER[data[:-1]]
        wide = np.zeros(n - 1, bool)
        wide[1:] = (data[:-2] == 0xC3) & (data[1:-1] >= 0x80) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
        begins[1:] |= _STOP[data[1:]] & (letter | wide)
    kept = np.concatenate([[0], np.cumsum(solid)])
    start = kept[:-1][begins & solid]
    return _LOWER[data[solid]], start, np.searchsorted(start, kept[offsets])


@lru_cache(maxsize=2)
def tokenizer(path):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def token_bytes(path):
    """Bytes of text that each token id stands for: a character of a byte-level token is a byte."""
    vocab = tokenizer(path).get_vocab()
    size = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, number in vocab.items():
        size[number] = len(token.removesuffix(WORD_END))
    return size


class WordIds:
    """ids of texts, with a cache of the ids of pieces in two generations.

    When the young one is full it becomes the old one; a piece that is met
    again comes back from there, the others go with it.
    """

    def __init__(self, path, limit=CACHE_WORDS):
        self.tokenizer, self.limit = tokenizer(path), limit
        self.token_bytes = token_bytes(path)
        self.young, self.old = {}, {}

    def encode(self, texts):
        """(uint32 ids of all texts, bounds of each text). `texts`: Arrow strings, no nulls."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        data, start, bounds = pieces_of(data, offsets - offsets[0])
        ends = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
        words = pa.LargeStringArray.from_buffers(len(start), ends, pa.py_buffer(data)).dictionary_encode()
        index = words.indices.to_numpy(zero_copy_only=False)
        known = self._ids(words.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(known), np.uint32)
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(size) - size
        length = size[index]
        ends = np.zeros(len(index) + 1, np.int64)
        np.cumsum(length, out=ends[1:])
        take = np.repeat(first[index] - ends[:-1], length) + np.arange(ends[-1])
        return flat[take], ends[bounds]

    def _ids(self, words):
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = [word for word in words if word not in young]
        if old:
            young.update((word, old[word]) for word in missing if word in old)
            missing = [word for word in missing if word not in young]
        at = 0
        while at < len(missing):
            stop, chars = at, 0
            while stop < len(missing) and (stop == at or chars < MISS_CHARS):
                chars += len(missing[stop]) + 1
                stop += 1
            self._learn(missing[at:stop])
            at = stop
        return list(map(young.__getitem__, words))

    def _learn(self, words):
        """Encode many words in few calls.

        ASCII words keep their bytes, so the lengths of the tokens tell where
        each ends, and the call may skip the character offsets. Where the
        lengths do not meet the ends, and for other words, offsets tell.
        """
        plain = [word for word in words if word.isascii()]
        wide = [word for word in words if not word.isascii()] if len(plain) < len(words) else []
        if plain:
            found = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0]
            ids = np.array(found.ids, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)))
            read = np.cumsum(self.token_bytes[ids])
            cut = np.searchsorted(read, ends)
            if len(read) and read[-1] == ends[-1] and (read[cut] == ends).all():
                self._keep(plain, ids, cut + 1)
            else:
                wide = words
        if wide:
            found = self.tokenizer.encode(" ".join(wide), add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            first = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
            self._keep(wide, ids, np.searchsorted(first, np.cumsum([len(w) + 1 for w in wide])))

    def _keep(self, words, ids, cut):
        data, high = ids.tobytes(), (cut * 4).tolist()
        self.young.update(zip(words, map(data.__getitem__, map(slice, [0, *high[:-1]], high))))


@lru_cache(maxsize=2)
def word_ids(path):
    return WordIds(path)


def text_slices(texts, limit=SLICE_BYTES):
    """(first row, rows) of consecutive ranges of Arrow strings; nulls become empty."""
    texts = texts.fill_null("")
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        before = size[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(size, before + limit, "right")))
        yield row, texts.slice(row, end - row)
        row = end


def encode_pieces(
    docs, path, capacity=2048, end_id=0, id_col="doc_id", text_col="text", slice_bytes=SLICE_BYTES
):
    """Pieces of at most `capacity` token ids: doc_id, piece, start, length, ids.

    Every document is its ids and then `end_id`; a null text is an empty one. A
    longer document is cut into pieces of `capacity`, the last one may be
    shorter. `ids` holds little-endian unsigned 32-bit numbers. Repeated rows
    give repeated pieces; an empty table gives none; other columns are ignored.
    Texts of some `slice_bytes` are encoded at once; smaller slices take less memory and more time.
    """
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = word_ids(path)
        for batch in batches:
            keys = batch.column(0)
            for row, texts in text_slices(batch.column(1), slice_bytes):
                yield _pieces(keys.slice(row, len(texts)), *encoder.encode(texts), capacity, end_id)

    return source.mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids binary"
    )


def _pieces(keys, ids, bounds, capacity, end_id):
    rows = len(keys)
    full = np.insert(ids, bounds[1:], np.uint32(end_id)).astype("<u4")
    bounds = bounds + np.arange(rows + 1)
    total = np.diff(bounds)
    count = -(-total // capacity)
    doc = np.repeat(np.arange(rows), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = piece * capacity
    length = np.minimum(capacity, total[doc] - start)
    ends = np.concatenate([[0], np.cumsum(length)]) * 4
    binary = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(doc), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(full)]
    )
    return pa.RecordBatch.from_arrays(
        [
            keys.take(pa.array(doc)),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            binary.cast(pa.binary()),
        ],
        names=["doc_id", "piece", "start", "length", "ids"],
    )
