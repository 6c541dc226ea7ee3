"""Flat text helpers against plain Python."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import words as plain_words

from echolex.llm import graph
from echolex.llm import texts as T

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té日\x0b\x85", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXT, st.sampled_from([3, 40, 1 << 20]))
def test_words_and_windows(values, limit):
    seen = 0
    for row, data, offsets in T.slices(pa.array(values, pa.string()), limit):
        words = T.find_words(data, offsets)
        raw = data.tobytes()
        got = [raw[s:e].decode() for s, e in zip(words.start, words.end)]
        expected = [w for v in values[row : row + len(offsets) - 1] for w in plain_words(v)]
        assert got == expected
        hashes = T.hash_spans(data, words.start, words.end)
        known = {}
        for word, h in zip(got, hashes.tolist()):
            assert known.setdefault(word, h) == h
        assert len(set(known.values())) == len(known)
        value, at_row, first = T.windows(hashes, words, 3, short=True)
        expected = []
        for k, v in enumerate(values[row : row + len(offsets) - 1]):
            w = plain_words(v)
            expected += [(k, tuple(w[i : i + 3])) for i in range(max(1, len(w) - 2))] if w else []
        assert at_row.tolist() == [k for k, _ in expected]
        groups = {}
        for (_, gram), h in zip(expected, value.tolist()):
            assert groups.setdefault(gram, h) == h
        assert len(set(groups.values())) == len(groups)
        seen += len(offsets) - 1
    assert seen == len(values)


def test_hash_does_not_depend_on_place():
    blob = b"xx" * (T.BLOCK_BYTES // 2 + 7) + b" needle " + b"y" * 50 + b" needle"
    data = np.frombuffer(blob, np.uint8)
    words = T.find_words(data, np.array([0, len(data)]))
    hashes = T.hash_spans(data, words.start, words.end)
    assert len(hashes) == 4 and hashes[1] == hashes[3]


@pytest.mark.parametrize("n", [1, 7, 60])
def test_components_of_a_path_and_a_star(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(1000, 1000 + k) for k in range(1, n)] + [(5000, 5000), (None, 3)]
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    got = {r["node"]: r["component"] for r in got}
    expected = {i: 0 for i in range(n + 1)}
    if n > 1:
        expected |= {1000 + k: 1000 for k in range(n)}
    assert got == expected


def test_components_without_links(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
