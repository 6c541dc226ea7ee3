"""Near-duplicate classes against all pairs of shingle sets."""

import random

import numpy as np
import pytest
from llm_fixtures import SCHEMA, Union, frame, sentence, shingles

from echolex.llm import near_dups as N


def similarity(x, y):
    common, every = set(x) & set(y), set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in every) for i in common)


def expected(rows):
    sets, union = {}, Union()
    for doc_id, text, *_ in rows:
        if doc_id is not None and text is not None:
            sets[doc_id] = (text, shingles(text))
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            (ta, sa), (tb, sb) = sets[a], sets[b]
            if ta == tb or (set(sa) & set(sb) and similarity(sa, sb) >= 0.8 - 1e-12):
                union.join(a, b)
    return {d: union.root(d) for d in {r[0] for r in rows} if d is not None}


def near_family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check(df, rows):
    got = df.collect()
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["class_id"] == (want[r["doc_id"]] if r["doc_id"] is not None else None)
        assert r["kept"] == (r["doc_id"] == r["class_id"])


def test_awkward_documents(docs, doc_rows):
    check(N.near_duplicates(docs), doc_rows)


@pytest.mark.parametrize("blocks", [(2048, 256), (7, 3)])
def test_families_around_the_threshold(spark, monkeypatch, blocks):
    monkeypatch.setattr(N, "REGISTER_BLOCK", blocks[0])
    monkeypatch.setattr(N, "TEXT_BLOCK", blocks[1])
    rng = random.Random(11)
    base = sentence(rng, 130)
    texts = [base] + [t for e in (1, 2, 3, 4, 5, 6) for t in near_family(rng, base, 9, e)]
    rng.shuffle(texts)
    rows = [(i, t, "en", "s", 0, 0, "x", 1) for i, t in enumerate(texts)]
    check(N.near_duplicates(frame(spark, rows)), rows)


def test_empty_table(no_docs):
    assert N.near_duplicates(no_docs).count() == 0
    assert "row" in SCHEMA  # columns with clashing names are there


def test_estimate_follows_probability_jaccard():
    rng = np.random.default_rng(2)
    a = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.sort(np.concatenate([a[:300], rng.integers(0, 2**63, 60).astype(np.uint64)]))
    x, y = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
    exact = N.probability_jaccard(a, x, b, y)
    value, row = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
    signature = N.prob_minhash(value, row, np.concatenate([x, y]).astype(float), 2, registers=8000)
    assert abs((signature[0] == signature[1]).mean() - exact) < 0.025
