"""Chat formatting: roles of transcript lines by a hidden Markov model.

A line is in one of six states: the first line of a turn, or a later one, of
each of three roles. It shows a speaker marker or none, a length class and
whether it asks. Counts of labelled lines, taken by Spark, give the start,
transition and emission probabilities; Viterbi finds the best states, and the
lines of a turn are joined and rendered in one form.

Scores compose: a block of lines is a matrix of best scores from the state
before it to its last one. A long transcript is cut into blocks, whose matrices
are computed in parallel and chained, and each block is then decoded between
its known end states. No transcript is held in one task.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
STATES = tuple((role, first) for role in ROLES for first in (True, False))
MARKERS = ("none", *ROLES, "other")
LENGTHS = (0, 3, 8, 20, 60)  # a class starts at each number of words
BLOCK_LINES = 4096
POOLED_SHARE = 0.1

# Names that introduce a speaker.
SPEAKERS = {
    "system": ("system", "instructions"),
    "user": ("user", "human", "question", "q", "customer", "prompt", "you"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "response", "gpt"),
}
_NAMES = "|".join(sorted((n for names in SPEAKERS.values() for n in names), key=len, reverse=True))
# <|user|>, [user], ### User, **User:**, User: - the rest of the line is text.
MARKER = (
    rf"^\s*(?:<\|(?:im_start\|>)?(?:{_NAMES})(?:\|>)?|\[(?:{_NAMES})\]:?|#{{1,4}}\s*(?:{_NAMES})\s*:?\s*$"
    rf"|\*\*(?:{_NAMES}):?\*\*:?|(?:{_NAMES})\s*[:>])\s*"
)
UNKNOWN_MARKER = r"^\s*[\p{L}][\p{L} ]{0,20}:\s"


def line_features(line):
    """Columns marker, length, asks and content of a line (null: an empty one)."""
    line = F.coalesce(line, F.lit(""))
    found = F.lower(F.regexp_extract(line, f"(?i){MARKER}", 0))
    name = F.regexp_extract(found, r"([a-z]+)(?:\|>|\]|:|>|\*|\s)*$", 1)
    marker = F.lit("none")
    marker = F.when(F.regexp_like(line, F.lit(UNKNOWN_MARKER)), F.lit("other")).otherwise(marker)
    for role, names in SPEAKERS.items():
        marker = F.when(name.isin(*names), F.lit(role)).otherwise(marker)
    content = F.regexp_replace(line, f"(?i){MARKER}", "")
    n = F.regexp_count(content, F.lit(r"[^\x20\x09-\x0D]+"))
    length = sum((F.when(n > edge, 1).otherwise(0) for edge in LENGTHS[1:]), F.when(n > 0, 1).otherwise(0))
    return {
        "marker": marker,
        "length": length.cast("int"),
        "asks": F.rtrim(content).endswith("?").cast("int"),
        "content": content,
    }


@dataclass
class Model:
    """Log probabilities: start (6), move (6, 6), and shown (6, observations)."""

    start: np.ndarray
    move: np.ndarray
    shown: np.ndarray


N_LENGTHS = len(LENGTHS) + 1
N_OBSERVED = len(MARKERS) * N_LENGTHS * 2


def _observed():
    marker = F.array_position(F.array(*[F.lit(m) for m in MARKERS]), F.col("marker")).cast("int") - 1
    return ((marker * N_LENGTHS + F.col("length")) * 2 + F.col("asks")).alias("observed")


def observe(lines):
    """conv_id, line_no, observed, content of a table (conv_id, line_no, line)."""
    named = lines.select("conv_id", "line_no", *[c.alias(k) for k, c in line_features(F.col("line")).items()])
    return named.select("conv_id", "line_no", _observed(), "content")


def train(labelled, smoothing=0.5):
    """Model from lines with their state: conv_id, line_no, line, role, first (boolean).

    Counted by Spark; what reaches the driver has a fixed number of cells. Length
    and question depend on whether there is a marker, but not on which.
    """
    state = sum((F.when((F.col("role") == r) & (F.col("first") == f), k).otherwise(0)
                 for k, (r, f) in enumerate(STATES)), F.lit(0))
    rows = labelled.filter(F.col("role").isin(*ROLES))
    rows = rows.select("conv_id", "line_no", state.alias("state"),
                       *[c.alias(k) for k, c in line_features(F.col("line")).items()])
    before = F.lag("state").over(Window.partitionBy("conv_id").orderBy("line_no"))
    counts = rows.groupBy("state", "marker", "length", "asks").agg(F.count(F.lit(1)).alias("n")).collect()
    moves = (
        rows.select("state", before.alias("before")).groupBy("before", "state")
        .agg(F.count(F.lit(1)).alias("n")).collect()
    )
    k = len(STATES)
    start, move = np.full(k, smoothing), np.full((k, k), smoothing)
    for r in moves:
        if r["before"] is None:
            start[r["state"]] += r["n"]
        else:
            move[r["before"], r["state"]] += r["n"]
    for a, (role, _) in enumerate(STATES):  # a later line belongs to the turn before it
        start[a] = start[a] if STATES[a][1] else 0
        for b, (other, first) in enumerate(STATES):
            if not first and other != role:
                move[a, b] = 0
    marker, shape = np.zeros((k, len(MARKERS))), np.zeros((2, k, N_LENGTHS * 2))
    for r in counts:
        marker[r["state"], MARKERS.index(r["marker"])] += r["n"]
        shape[int(r["marker"] != "none"), r["state"], r["length"] * 2 + r["asks"]] += r["n"]
    marker, shape = _pooled(marker, smoothing), np.stack([_pooled(x, smoothing) for x in shape])
    with np.errstate(divide="ignore"):
        part = [np.log(x / x.sum(axis=-1, keepdims=True)) for x in (start, move, marker, shape)]
    of_marker = np.array([int(m != "none") for m in MARKERS])
    shown = (part[2][:, :, None] + part[3][of_marker].transpose(1, 0, 2)).reshape(k, N_OBSERVED)
    return Model(part[0], part[1], shown)


def _pooled(counts, smoothing):
    """Shares of what each state shows, a part of them from all roles, first and later lines apart.

    That part is the same in every state: what training did not show in a rare
    state is as unlikely there as in a frequent one.
    """
    out = np.empty(counts.shape)
    for first in (True, False):
        rows = [a for a, state in enumerate(STATES) if state[1] == first]
        pool = counts[rows].sum(axis=0) + smoothing
        pool /= pool.sum()
        total = counts[rows].sum(axis=1, keepdims=True)
        own = np.where(total > 0, counts[rows] / np.maximum(total, 1), pool)
        out[rows] = (1 - POOLED_SHARE) * own + POOLED_SHARE * pool
    return out


def block_matrix(model, observed, opening):
    """Best score from each state before the block to each state at its end.

    An opening block starts a transcript; its rows are all alike.
    """
    first = model.start[None, :] if opening else model.move
    scores = np.broadcast_to(first + model.shown[:, observed[0]][None, :], model.move.shape)
    for o in observed[1:]:
        scores = (scores[:, :, None] + model.move[None]).max(axis=1) + model.shown[:, o]
    return scores


def viterbi(model, observed, before=None, last=None):
    """Best states of the lines, given the state before them and that of the last line.

    Equal scores go to the earlier state of STATES.
    """
    first = model.start if before is None else model.move[before]
    score = first + model.shown[:, observed[0]]
    back = []
    for o in observed[1:]:
        ways = score[:, None] + model.move
        came = ways.argmax(axis=0)
        back.append(came)
        score = ways[came, np.arange(len(score))] + model.shown[:, o]
    state = int(score.argmax()) if last is None else last
    path = [state]
    for came in reversed(back):
        state = int(came[state])
        path.append(state)
    return path[::-1]


def _chain(model):
    """End states of the blocks of one transcript, from their matrices in order."""

    def run(key, rows):
        rows = rows.sort_by("block")
        matrices = np.array(rows["scores"].to_pylist()).reshape(-1, len(STATES), len(STATES))
        score, back = matrices[0][0], []
        for matrix in matrices[1:]:
            ways = score[:, None] + matrix
            came = ways.argmax(axis=0)
            back.append(came)
            score = ways[came, np.arange(len(score))]
        state = int(score.argmax())
        ends = [state]
        for came in reversed(back):
            state = int(came[state])
            ends.append(state)
        ends.reverse()
        return pa.table(
            {
                "conv_id": rows["conv_id"],
                "block": rows["block"],
                "before": pa.array([None, *ends[:-1]], pa.int32()),
                "last": pa.array(ends, pa.int32()),
            }
        )

    return run


def decode(lines, model, block_lines=BLOCK_LINES):
    """conv_id, block, line_no, role, first, content of every line of (conv_id, line_no, line)."""
    kind = lines.schema["conv_id"].dataType.simpleString()
    number = F.col("line_no").cast("long")
    seen = observe(lines.select("conv_id", number.alias("line_no"), "line"))
    seen = seen.withColumn("block", F.floor(F.col("line_no") / block_lines).cast("long"))
    # Only transcripts of several blocks need their blocks chained.
    long_ones = (
        seen.filter(F.col("block") > 0).select("conv_id").distinct().withColumnRenamed("conv_id", "_long")
    )
    in_blocks = seen.join(long_ones, F.col("conv_id") == F.col("_long"), "left_semi")
    earliest = in_blocks.groupBy("conv_id").agg(F.min("block").alias("opening"))

    def matrices(key, rows):
        rows = rows.sort_by("line_no")
        opening = key[1].as_py() == rows["opening"][0].as_py()
        scores = block_matrix(model, rows["observed"].to_numpy(), opening)
        scores = np.where(np.isneginf(scores), -1e300, scores)
        return pa.table(
            {
                "conv_id": rows["conv_id"][:1],
                "block": pa.array([key[1].as_py()]),
                "scores": pa.array([scores.ravel().tolist()]),
            }
        )

    def states(key, rows):
        rows = rows.sort_by([("line_no", "ascending"), ("content", "ascending")])
        before, last = rows["before"][0].as_py(), rows["last"][0].as_py()
        path = viterbi(model, rows["observed"].to_numpy(), before, last)
        return pa.table(
            {
                "conv_id": rows["conv_id"],
                "block": rows["block"],
                "line_no": rows["line_no"],
                "role": pa.array([STATES[s][0] for s in path]),
                "first": pa.array([STATES[s][1] for s in path]),
                "content": rows["content"],
            }
        )

    scored = (
        in_blocks.join(earliest, "conv_id")
        .select("conv_id", "block", "line_no", "observed", "opening")
        .groupBy("conv_id", "block")
        .applyInArrow(matrices, f"conv_id {kind}, block long, scores array<double>")
    )
    ends = scored.groupBy("conv_id").applyInArrow(
        _chain(model), f"conv_id {kind}, block long, before int, last int"
    )
    return (
        seen.filter(F.col("conv_id").isNotNull())
        .join(ends, ["conv_id", "block"], "left")
        .groupBy("conv_id", "block")
        .applyInArrow(
            states,
            f"conv_id {kind}, block long, line_no long, role string, first boolean, content string",
        )
    )


def parse_transcripts(lines, model, block_lines=BLOCK_LINES):
    """conv_id, turn, role, first_line, n_lines, text: the recovered turns.

    `lines`: conv_id, line_no, line. A turn's text is its lines without their
    marker, joined by line breaks and trimmed. Lines without a conv_id belong
    to no transcript and are left out; a null or empty line is an empty one of
    its turn; lines that repeat a number stay side by side in text order. An
    empty table gives no rows; other columns are ignored.
    """
    decoded = decode(lines, model, block_lines).checkpoint()
    opened = decoded.groupBy("conv_id", "block").agg(F.count_if("first").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = opened.select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("conv_id", "block").orderBy("line_no", "content")
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = F.col("base") + F.sum(F.col("first").cast("int")).over(within) - 1
    numbered = decoded.join(opened, ["conv_id", "block"]).withColumn("turn", turn)
    # One turn at most is gathered into a row.
    said = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "content"))), lambda x: x["content"])
    return numbered.groupBy("conv_id", "turn").agg(
        F.min("role").alias("role"),
        F.min("line_no").alias("first_line"),
        F.count(F.lit(1)).alias("n_lines"),
        F.trim(F.array_join(said, "\n")).alias("text"),
    )


def render(turns):
    """conv_id, text: all turns of a transcript in the canonical form, one message each."""
    message = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", message.alias("message"))))
    return turns.groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["message"]), "\n").alias("text")
    )


# --- transcripts written from labelled turns -----------------------------------------

# How a conversation marks its speakers; a style is chosen by the conversation's id.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "### System\n", "user": "### Question\n", "assistant": "### Answer\n"},
    {"system": "[system] ", "user": "[user] ", "assistant": "[assistant] "},
    {"system": "<|system|> ", "user": "<|user|> ", "assistant": "<|assistant|> "},
    {"system": "", "user": "Q: ", "assistant": "A: "},
)
UNMARKED = 7  # one in so many turns, but for the first, has lost its marker


def written(conversations):
    """conv_id, line_no, line, role, first: turns as lines of marked-up text.

    Line numbers follow turn, role and text; they are counted per turn first,
    so a conversation of very many turns is numbered in one task only by its
    turns' line counts. Null texts are empty turns.
    """
    known = conversations.filter(F.col("conv_id").isNotNull() & F.lower("role").isin(*ROLES))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    lost = (F.col("turn") > 0) & (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(UNMARKED)) == 0)
    mark = F.lit("")
    for k, marks in enumerate(STYLES):
        for role, text in marks.items():
            mark = F.when((style == k) & (F.lower("role") == role) & ~lost, F.lit(text)).otherwise(mark)
    turns = known.select(
        "conv_id",
        "turn",
        F.lower("role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.split(F.concat(mark, F.coalesce("text", F.lit(""))), "\n").alias("lines"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    order = order.rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum(F.size("lines")).over(order), F.lit(0))
    placed = turns.withColumn("base", base).select("conv_id", "turn", "role", "base", F.posexplode("lines"))
    return placed.select(
        "conv_id",
        (F.col("base") + F.col("pos")).alias("line_no"),
        F.col("col").alias("line"),
        "role",
        (F.col("pos") == 0).alias("first"),
        "turn",
    )
