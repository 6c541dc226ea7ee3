"""Roles of transcripts: held-out accuracy, blocks against whole Viterbi, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from echolex.llm import transcripts as C


@pytest.fixture(scope="module")
def lines(spark):
    return C.written(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).cache()


@pytest.fixture(scope="module")
def model(lines):
    return C.train(lines.filter("conv_id % 3 != 0"))


def test_held_out_accuracy(lines, model):
    decoded = C.decode(lines.filter("conv_id % 3 = 0"), model)
    met = lines.select("conv_id", "line_no", F.col("role").alias("r"), F.col("first").alias("f")).join(
        decoded, ["conv_id", "line_no"]
    )
    right = met.agg(F.avg((F.col("r") == F.col("role")).cast("int")), F.avg((F.col("f") == F.col("first")).cast("int")))
    role, first = right.first()
    assert role >= 0.93 and first >= 0.93
    assert decoded.count() == lines.filter("conv_id % 3 = 0").count()


@pytest.mark.parametrize("block", [1, 5])
def test_blocks_give_the_same_states(lines, model, block):
    some = lines.filter("conv_id % 3 = 0")
    keys = ["conv_id", "line_no", "role", "first"]
    whole, parts = (C.decode(some, model, b).select(keys) for b in (4096, block))
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_viterbi_against_all_paths(model):
    rng = np.random.default_rng(1)
    observed = rng.integers(0, C.N_OBSERVED, 5)
    best = max(
        np.ndindex(*[len(C.STATES)] * 5),
        key=lambda p: model.start[p[0]] + sum(model.shown[s, o] for s, o in zip(p, observed))
        + sum(model.move[a, b] for a, b in zip(p, p[1:])),
    )
    assert tuple(C.viterbi(model, observed)) == best


def test_marked_transcript(spark, model):
    text = ["System: be kind", "User: what is this?", "still the user?", "Assistant: it is", "", "a test", "[user] ok"]
    rows = [(7, i, t, "x") for i, t in enumerate(text)] + [(8, 3, None, "x"), (None, 0, "User: lost", "x")]
    df = spark.createDataFrame(rows, "conv_id long, line_no int, line string, role string")
    turns = {(r["conv_id"], r["turn"]): r for r in C.parse_transcripts(df, model).collect()}
    assert [turns[7, k]["role"] for k in range(4)] == ["system", "user", "assistant", "user"]
    assert turns[7, 1]["text"] == "what is this?\nstill the user?" and turns[7, 2]["text"] == "it is\n\na test"
    assert turns[8, 0]["text"] == "" and {k[0] for k in turns} == {7, 8}
    shown = C.render(C.parse_transcripts(df, model)).filter("conv_id = 7").first()["text"]
    assert shown.startswith("<|system|>\nbe kind\n<|end|>\n<|user|>\n")


def test_repeated_lines_and_empty_table(spark, model):
    df = spark.createDataFrame([(1, 0, "User: hi")] * 2, "conv_id long, line_no int, line string")
    assert sum(r["n_lines"] for r in C.parse_transcripts(df, model).collect()) == 2
    assert C.parse_transcripts(df.limit(0), model).count() == 0
