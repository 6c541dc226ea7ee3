"""Whole texts of an Arrow batch as flat numpy arrays: words, hashes, windows.

Everything here works on slices of whole rows with a bounded number of bytes,
so memory follows the longest single text and not the batch.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
BLOCK_BYTES = 1 << 20
_SEED = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODES = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ROLL = np.uint64(0x9E3779B97F4A7C15)
UNROLL = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# A word is a run of anything but these: space and the controls 9 to 13.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = r"[^\x20\x09-\x0D]+"


def mix(x):
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(texts, limit=SLICE_BYTES):
    """(first row, bytes, offsets) of consecutive row ranges. Null texts are empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        part = offsets[row : end + 1]
        yield row, data[part[0] : part[-1]], part - part[0]
        row = end


@dataclass
class Words:
    """Words of a slice in order: byte spans, row number, and per-row bounds."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # of each row, the number of its first word; one entry more than rows

    @property
    def counts(self):
        return np.diff(self.first)


def find_words(data, offsets):
    """Words of every row of a slice; a word never crosses two rows."""
    rows = len(offsets) - 1
    solid = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(rows), np.diff(first))
    return Words(start, end, row, first)


_POWERS = {}


def _powers(n, base):
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        size = max(n, BLOCK_BYTES)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[int(base)] = known
    return known[:n]


def hash_spans(data, start, end):
    """64-bit hash of each byte span; the spans are in order and do not overlap."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        stop = int(np.searchsorted(end, start[at] + BLOCK_BYTES, "right"))
        stop = min(max(stop, at + 1), len(start))
        low, high = int(start[at]), int(end[stop - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(BYTE_CODES[data[low:high]] * _powers(high - low, ROLL), out=sums[1:])
        s, e = start[at:stop] - low, end[at:stop] - low
        value = (sums[e] - sums[s]) * _powers(int(s[-1]) + 1, UNROLL)[s]
        out[at:stop] = mix(value + (e - s).astype(np.uint64) * ROLL)
        at = stop
    return out


def windows(hashes, words, size, short=False):
    """(hash, row, first word) of every run of `size` words inside one row.

    With `short`, a row of fewer words (but at least one) gives one window of
    all its words.
    """
    n = len(hashes)
    if n >= size:
        value = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            value = (value + hashes[k : n - size + 1 + k]) * (ROLL + np.uint64(2 * k))
            value ^= value >> np.uint64(29)
        whole = words.row[: n - size + 1] == words.row[size - 1 :]
        at = np.flatnonzero(whole)
        value, row = mix(value[at]), words.row[at]
    else:
        value, row, at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not short:
        return value, row, at
    small = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(small):
        extra = np.array(
            [_run(hashes[words.first[r] : words.first[r + 1]], size) for r in small], np.uint64
        )
        value, row = np.concatenate([value, extra]), np.concatenate([row, small])
        at = np.concatenate([at, words.first[small]])
        order = np.argsort(row, kind="stable")
        value, row, at = value[order], row[order], at[order]
    return value, row, at


def _run(hashes, size):
    value = np.full(1, size - len(hashes), np.uint64)
    for h in hashes:
        value = (value ^ h) * ROLL
        value ^= value >> np.uint64(29)
    return mix(value)[0]


def stream_code(k):
    """The k-th of a row of well-spread 64-bit numbers."""
    return np.uint64(k * int(ROLL) % (1 << 64))
