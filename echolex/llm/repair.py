"""Cheapest repair of the role order of conversations, by branch and bound.

Rows of a conversation stand in the order of their turns. A repaired
conversation is empty, or an optional system row and then pairs of a user and
an assistant row. Keeping a row is free, another role costs 2, deletion 3, an
inserted row without text 2, and a row that stays although it is cut off 1.
Blank and repeated rows must go. Among the cheapest edits those whose initials
(D, I, K, R) come first in ASCII order are taken.

The rows are sorted by conversation and turn over all tasks and cut into blocks
of at most `BLOCK_ROWS`. A block is searched on its own, from each state it may
be entered in to each it may be left in. The blocks of a conversation are then
read one after the other with the best edits for each of the four states, so no
task holds a conversation; the digest of a repaired conversation is a chain
over its whole text and is carried along block by block.
"""

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import functions as F

BLOCK_ROWS = 256
BLOCK_CHARS = 1 << 22
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
# What stands before the next row: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
_NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_AFTER = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # by an inserted or rerolled row


@dataclass(slots=True)
class Row:
    """One row after damage: its role, text and first fault ('', blank, duplicate, truncated)."""

    role: str
    text: str
    fault: str

    @property
    def initial(self):
        return self.role[:1]

    @property
    def must_go(self):
        return self.fault in ("blank", "duplicate")

    @property
    def stay_cost(self):
        return CUT_OFF if self.fault == "truncated" else 0


def _legal(state, initial):
    return state in _NEXT.get(initial, ())


def suffix_bounds(rows, exits):
    """Lower bounds: for every place and state, what the rest costs at least.

    Rows that must go are deleted, cut-off rows cost 1, rows of unknown role at
    least 2. Besides, two neighbours of the rest that may not follow each other
    need an edit of 2 or more: a change of one of them or a row between. Pairs
    that share no row need one edit each; the most such pairs are counted from
    the end, with the state as the first element and the exits as the last.
    """
    entered = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
    # Pairs of the rest when the element before it is already used up, or stands for a state.
    free, by_state = 0, [0 if s in exits else 1 for s in range(4)]
    base, bounds = 0, [None] * (len(rows) + 1)
    bounds[-1] = [2 * n for n in by_state]
    for i in range(len(rows) - 1, -1, -1):
        row = rows[i]
        if row.must_go:
            base += DELETE
        else:
            base += row.stay_cost
            into = entered.get(row.initial)
            if into is None:
                base += REROLE if row.stay_cost == 0 else DELETE - row.stay_cost
                by_state, free = [free] * 4, free
            else:
                follows = by_state[into]
                by_state = [
                    follows if _legal(s, row.initial) else max(1 + free, follows) for s in range(4)
                ]
                free = follows
        bounds[i] = [base + 2 * n for n in by_state]
    return bounds


def search(rows, entry, exits, counter=None):
    """{exit: (cost, edits)} for one exit each, the cheapest and then first in ASCII order.

    Depth first with an explicit stack. A prefix is dropped if its cost and the
    bound of the rest exceed the incumbent's cost, or equal it with later
    letters, or if the same place and state was reached by a better prefix.
    """
    return {e: found for e in exits if (found := _search(rows, entry, e, counter))}


def _search(rows, entry, exit_state, counter):
    bounds = suffix_bounds(rows, (exit_state,))
    best, seen, n = None, {}, len(rows)
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if counter is not None:
            counter.append(1)
        if best is not None:
            least = cost + bounds[i][state]
            if least > best[0] or (least == best[0] and audit > best[1][: len(audit)]):
                continue
        known = seen.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        seen[i, state] = (cost, audit)
        if i == n and state == exit_state and (best is None or (cost, audit) < best):
            best = (cost, audit)
            continue
        moves = [(i, _AFTER[state], cost + INSERT, audit + "I")]
        if i < n:
            row = rows[i]
            moves.append((i + 1, state, cost + DELETE, audit + "D"))
            if not row.must_go:
                if (after := _NEXT.get(row.initial, {}).get(state)) is not None:
                    moves.append((i + 1, after, cost + KEEP + row.stay_cost, audit + "K"))
                moves.append((i + 1, _AFTER[state], cost + REROLE + row.stay_cost, audit + "R"))
        # The most promising last, so that it is taken first.
        moves.sort(key=lambda m: (m[2] + bounds[m[0]][m[1]], m[3]), reverse=True)
        stack.extend(moves)
    return best


def repaired(rows, entry, audit):
    """(role, text) of the rows that the edits leave, entered in state `entry`."""
    out, state, i = [], entry, 0
    for edit in audit:
        if edit == "D":
            i += 1
        elif edit == "K":
            state = _NEXT[rows[i].initial][state]
            out.append((rows[i].role, rows[i].text))
            i += 1
        else:
            state = _AFTER[state]
            out.append((_ROLE[state], "" if edit == "I" else rows[i].text))
            i += edit == "R"
    return out


def _text(pairs):
    return [f"{role}:{text}" for role, text in pairs]


# --- blocks ----------------------------------------------------------------------

FAULTS = ("blank", "duplicate", "truncated")
BLOCK_SCHEMA = (
    "conv_id {id}, part int, number long, n_rows long, min_turn long, max_turn long, turns long, "
    "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "opens boolean, roles array<string>, texts array<string>, faults array<string>, "
    "paths array<struct<entry:int,exit:int,cost:long,audit:string>>"
)


@dataclass
class Block:
    """Consecutive rows of one conversation."""

    conv_id: object
    opens: bool  # no row of this conversation stands before it
    rows: list = field(default_factory=list)
    turns: list = field(default_factory=list)
    chars: int = 0

    def full(self):
        return len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def record(self, part, number):
        rows = self.rows
        known = [t for t in self.turns if t is not None]
        initials = [r.initial for r in rows]
        entries = (START,) if self.opens else range(4)
        paths = [
            {"entry": entry, "exit": e, "cost": cost, "audit": audit}
            for entry in entries
            for e, (cost, audit) in search(rows, entry, range(4)).items()
        ]
        return {
            "conv_id": self.conv_id,
            "part": part,
            "number": number,
            "n_rows": len(rows),
            "min_turn": min(known, default=None),
            "max_turn": max(known, default=None),
            "turns": len(set(known)),
            **{fault: sum(r.fault == fault for r in rows) for fault in FAULTS},
            "illegal": illegal_pairs(initials),
            "first_initial": initials[0] if rows else None,
            "last_initial": initials[-1] if rows else None,
            "opens": self.opens,
            "roles": [r.role for r in rows],
            "texts": [r.text for r in rows],
            "faults": [r.fault for r in rows],
            "paths": paths,
        }


def illegal_pairs(initials):
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _blocks(batches, part, schema):
    """Block records of sorted rows: conv_id, turn, role, text, fault, copies (0: the row is gone)."""
    block, number, out = None, 0, []
    for batch in batches:
        for r in batch.to_pylist():
            if block is None or block.conv_id != r["conv_id"]:
                # The first conversation of a task may have begun in the one before.
                opens = block is not None
                if block is not None:
                    out.append(block.record(part, number))
                    number += 1
                block = Block(r["conv_id"], opens)
            for copy in range(r["copies"]):
                if block.full():
                    out.append(block.record(part, number))
                    number += 1
                    block = Block(r["conv_id"], False)
                fault = r["fault"] if copy == 0 or r["fault"] == "blank" else "duplicate"
                block.rows.append(Row(r["role"], r["text"], fault))
                block.turns.append(r["turn"])
                block.chars += len(r["text"]) + len(r["role"])
            if len(out) >= 64:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
    if block is not None:
        out.append(block.record(part, number))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


@dataclass
class Path:
    """The best edits up to a place for one state, and the digest of what they leave."""

    cost: int
    audit: str
    digest: object
    empty: bool

    def onward(self, cost, audit, lines):
        digest, empty = self.digest, self.empty
        if lines:
            digest = digest.copy()
            digest.update((("" if empty else "\n") + "\n".join(lines)).encode())
            empty = False
        return Path(self.cost + cost, self.audit + audit, digest, empty)


class Conversation:
    """Folds the blocks of one conversation in order."""

    def __init__(self, conv_id):
        self.conv_id, self.paths = conv_id, {START: Path(0, "", hashlib.sha256(), True)}
        self.counts = dict.fromkeys((*FAULTS, "illegal", "turns"), 0)
        self.low, self.high, self.last_initial = None, None, None

    def add(self, block):
        if not block["n_rows"]:
            return
        for name in (*FAULTS, "illegal"):
            self.counts[name] += block[name]
        if self.last_initial is not None:
            self.counts["illegal"] += illegal_pairs([self.last_initial, block["first_initial"]])
        self.last_initial = block["last_initial"]
        if block["turns"]:
            # Turns come in order, so only the border may be met twice.
            self.counts["turns"] += block["turns"] - (self.high == block["min_turn"])
            self.low = block["min_turn"] if self.low is None else self.low
            self.high = block["max_turn"]
        rows = [Row(*x) for x in zip(block["roles"], block["texts"], block["faults"])]
        best = {}
        for p in block["paths"]:
            if p["entry"] in self.paths:
                before = self.paths[p["entry"]]
                key = (before.cost + p["cost"], before.audit + p["audit"])
                if p["exit"] not in best or key < best[p["exit"]][0]:
                    best[p["exit"]] = (key, p)
        self.paths = {
            e: self.paths[p["entry"]].onward(
                p["cost"], p["audit"], _text(repaired(rows, p["entry"], p["audit"]))
            )
            for e, (_, p) in best.items()
        }

    def result(self):
        best = min((p for s, p in self.paths.items() if s in FINAL), key=lambda p: (p.cost, p.audit))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.counts.pop("turns")
        self.counts.pop("turns", None)
        return {
            "conv_id": self.conv_id,
            "gaps": gaps,
            **self.counts,
            "cost": best.cost,
            "audit": best.audit,
            "repaired_sha256": best.digest.hexdigest(),
        }


RESULT_SCHEMA = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def _arrow(ddl):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def with_faults(rows):
    """Equal rows of one turn as one row with `copies`, and the first fault of the first copy.

    `rows` has conv_id, turn, role, text and copies; a row of 0 copies is gone
    but its conversation stays. A row is a duplicate if its conversation has
    the same role and text in an earlier turn.
    """
    key = F.md5(F.concat(F.col("role"), F.lit("\x1f"), F.col("text"))).alias("_said")
    merged = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    merged = merged.select("*", key, F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("_at"))
    first = merged.filter("copies > 0").groupBy("conv_id", "_said").agg(F.min("_at").alias("_first"))
    first = first.select(F.col("conv_id").alias("_conv"), F.col("_said").alias("_key"), "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_said") == F.col("_key"))
    seen = merged.join(first, same, "left")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(last == "", "blank")
        .when(F.col("_first") < F.col("_at"), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return seen.select("conv_id", "turn", "role", "text", fault.alias("fault"), "copies")


def repair(conversations, partitions=None):
    """One row per conversation: conv_id, gaps, counts of faults, cost, audit, repaired_sha256.

    `conversations` has conv_id, turn (a number), role, text, and may have
    `copies` (a number: how often the row stands there, 0 for a row that is
    gone); other columns are ignored. Null roles, texts and empty roles count
    as one space. Rows stand in the order of their turn, null turns first, and
    in that of role and text inside one turn. A null conv_id is a conversation
    of its own. Repeated rows are duplicates; a conversation whose rows are all
    gone has zeros, no edits and the digest of nothing; an empty table gives no
    rows. `gaps` counts missing turns between the first and the last.

    Texts are read whole. All rows of one conversation go through one task once
    more for the digest, a block at a time.
    """
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    block_ddl, result_ddl = BLOCK_SCHEMA.format(id=id_type), RESULT_SCHEMA.format(id=id_type)
    block_schema, result_schema = _arrow(block_ddl), _arrow(result_ddl)
    copies = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1).cast("long")
    spaced = [
        F.when(F.coalesce(c, F.lit("")) == "", " ").otherwise(F.col(c)).alias(c) if c == "role"
        else F.coalesce(c, F.lit(" ")).alias(c)
        for c in ("role", "text")
    ]
    rows = with_faults(
        conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *spaced, copies.alias("copies"))
    )
    order = ["conv_id", "turn", "role", "text"]
    number = partitions or int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(number, *order).sortWithinPartitions(*order)

    def cut(batches):
        from pyspark import TaskContext

        yield from _blocks(batches, TaskContext.get().partitionId(), block_schema)

    blocks = dealt.mapInArrow(cut, block_ddl)

    def fold(batches):
        held, out = None, []
        for batch in batches:
            for block in batch.to_pylist():
                if held is None or held.conv_id != block["conv_id"]:
                    if held is not None:
                        out.append(held.result())
                    held = Conversation(block["conv_id"])
                held.add(block)
            if out:
                yield pa.RecordBatch.from_pylist(out, result_schema)
                out = []
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.result()], result_schema)

    chains = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")
    return chains.mapInArrow(fold, result_ddl)


def damaged(conversations):
    """The rows with `copies` after the damage that crc32 of `conv_id:turn` decides (nulls: one space).

    By its remainder of 20: 0 drops a row, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes it a user row.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    how = F.crc32(key) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    gone = how == 0
    return conversations.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, " ").when(how == 4, "user").otherwise(role).alias("role"),
        F.when(gone, " ").when(how == 1, "").when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(gone, 0).when(how == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
