"""The pipeline stage by stage, and the registered queries against their SQL twins."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline as P  # noqa: E402
import oracle  # noqa: E402
from llm_fixtures import frame, rows, words  # noqa: E402

from echolex.llm import queries as Q  # noqa: E402


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    got, expected, types, expected_types = oracle.compare(
        Q.QUERIES[name](spark, folder), oracle.connect(folder), Q.ORACLES[name]
    )
    assert types == expected_types and got == expected


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in Q.QUERIES] == list(range(1, 14))


def test_stages_over_awkward_documents(spark):
    docs = frame(spark, rows(21, 60)).drop("_scores", "kept", "row")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, None).cache()
        assert docs.columns == columns, name
    for name, stage in P.STAGES[:1]:
        kept = {r["doc_id"] for r in stage(spark, frame(spark, rows(21, 60)).drop("_scores", "kept"), None).collect()}
        assert all(len(words(before[d])) >= 50 for d in kept)
        clean = {d for d in range(60)}
        assert len(clean - kept) <= 1
    ids = [r["doc_id"] for r in docs.collect() if r["doc_id"] is not None]
    assert len(ids) == len(set(ids))
    packed = P.STAGES[-1][1](spark, docs, None).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_stages_over_an_empty_table(spark):
    docs = frame(spark, []).drop("_scores", "kept", "row")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, None)
    assert docs.count() == 0


def test_run_over_the_small_tables(spark):
    got = P.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and {"doc_id", "piece", "ids", "sequence_id", "offset"} <= set(got.columns)
