"""Sum-of-squares packing of pieces into sequences of a fixed length.

A piece goes where the sum of the squared numbers of open sequences per
remaining gap becomes smallest; opening a new sequence is one of the choices.
The rule keeps all gaps about equally frequent, so that coming pieces find a
fitting one.

Pieces are dealt by hash into groups of some `GROUP_PIECES`, packed in
parallel. What each group leaves in sequences that are not full is dealt anew
into (far fewer) groups and packed again, until one group remains. The loss is
then that of one group, some dozens of sequences, at any size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

GROUP_PIECES = 250_000
MAX_LEVELS = 8


def sum_of_squares(lengths, capacity):
    """(sequence number, offset) of every piece, and the gap left in each sequence."""
    open_at = [[] for _ in range(capacity + 1)]  # sequences by their gap
    count = np.zeros(capacity + 1, np.int64)
    never = np.int64(1) << 60
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    gaps = []
    for i, size in enumerate(lengths.tolist()):
        if not 0 < size <= capacity:
            raise ValueError(f"a piece of length {size} does not fit {capacity}")
        new = 2 * int(count[capacity - size]) + 1 if size < capacity else 0
        here, after = count[size:capacity], count[: capacity - size]
        # The change of the sum; a sequence that becomes full leaves it.
        change = np.where(here > 0, 2 * (after - here) + 2, never)
        best, into = never, 0
        if len(change):
            change[0] -= here[0] > 0
            into = int(change.argmin())
            best = change[into]
        if best < new:
            gap = into + size
            at = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, at, into = capacity, len(gaps), capacity - size
            gaps.append(capacity)
        bins[i], offsets[i] = at, capacity - gap
        gaps[at] = into
        if into:
            open_at[into].append(at)
            count[into] += 1
    return bins, offsets, np.array(gaps, np.int64)


def _packer(level, capacity):
    def pack_group(key, rows):
        # Hash order: sums of squares want sizes as they come, not sorted.
        rows = rows.sort_by([("_order", "ascending"), ("length", "ascending"), ("_row", "ascending")])
        bins, offsets, gaps = sum_of_squares(rows["length"].to_numpy(), capacity)
        number = (level << 58) + (key[0].as_py() << 32) + bins
        rows = rows.drop_columns("_group").append_column("sequence_id", pa.array(number))
        rows = rows.append_column("offset", pa.array(offsets))
        return rows.append_column("gap", pa.array(gaps[bins] if len(rows) else offsets))

    return pack_group


def pack(pieces, capacity=2048, group_pieces=GROUP_PIECES):
    """`pieces` with sequence_id and offset; at most `capacity` per sequence.

    Needs columns doc_id, piece and length (1 to `capacity`, else an error);
    others are carried along. Repeated rows are packed as often as they occur,
    an empty table gives no rows. The pieces of a sequence lie gapless from
    offset 0. Sequence numbers are any numbers, no two sequences share one.
    """
    carried = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_row", "_order", "_group")]
    order = F.xxhash64("doc_id", "piece", "length").alias("_order")
    # Numbered before they are stored, so the numbers stay; only lengths go through the groups.
    stored = pieces.select(*carried, order, F.monotonically_increasing_id().alias("_row")).checkpoint()
    left, done = stored.select("_row", "_order", "length"), None
    schema = "_row long, _order long, length long, sequence_id long, offset long, gap long"
    for level in range(MAX_LEVELS):
        groups = max(1, -(-left.count() // group_pieces))
        last = groups == 1 or level == MAX_LEVELS - 1
        dealt = left.withColumn("_group", F.pmod(F.xxhash64("_order", F.lit(level)), F.lit(groups)))
        packed = dealt.groupBy("_group").applyInArrow(_packer(level, capacity), schema)
        if not last:
            packed = packed.checkpoint()
        full = packed if last else packed.filter("gap = 0")
        full = full.select("_row", "sequence_id", "offset")
        done = full if done is None else done.unionByName(full)
        if last:
            return stored.join(done, "_row").select(*carried, "sequence_id", "offset")
        left = packed.filter("gap > 0").select("_row", "_order", "length")


def sequences(packed):
    """One row per sequence: sequence_id, length, doc_ids in order (of `ids`, see join)."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece"))), lambda x: x["doc_id"]
        ).alias("doc_ids"),
    )
