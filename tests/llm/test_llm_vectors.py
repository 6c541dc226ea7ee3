"""Near-duplicate embeddings against all pairs in double precision."""

import numpy as np
import pytest
from llm_fixtures import Union

from echolex.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, n int, rep string"


def cases():
    rng = np.random.default_rng(3)
    out, vec_id = [], 0
    for label, size in ((0, 120), (1, 60), (None, 5)):
        centres = rng.standard_normal((6, 16))
        for k in range(size):
            v = centres[k % 6] + rng.standard_normal(16) * rng.choice([0.05, 0.25, 0.9])
            out.append((vec_id, v.astype(np.float32).tolist(), label, 1, "x"))
            vec_id += 1
    copy = out[0][1]
    out += [(vec_id + k, copy, 0, 1, "x") for k in range(9)]
    out.append((vec_id + 9, [2 * x for x in copy], 0, 1, "x"))
    out.append((vec_id + 10, copy, 1, 1, "x"))
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15]
    out += [(vec_id + 20 + k, v, 0, 1, "x") for k, v in enumerate(odd)]
    out += [(vec_id + 40, [1.0, 2.0], 0, 1, "x"), (None, copy, 0, 1, "x"), out[3]]
    # One id with several vectors: its links are counted apart, its components are one.
    near = lambda v: [x * 1.001 for x in v[:-1]] + [v[-1] * 0.99]
    out += [(5000, out[0][1], 0, 1, "x"), (5000, near(out[121][1]), 1, 1, "x"), (5000, near(out[1][1]), 0, 1, "x")]
    out += [(5001, out[122][1], 1, 1, "x"), (5001, out[2][1], 0, 1, "x"), (None, near(out[5][1]), 0, 1, "x")]
    return out


def expected(rows):
    good = []
    for i, (vec_id, v, label, *_) in enumerate(rows):
        ok = label is not None and v and None not in v
        if ok and np.isfinite(v).all() and np.any(v):
            good.append((i, vec_id, label, np.array(v, np.float64)))
    links, union = [0] * len(rows), Union()
    for x, (i, a, la, u) in enumerate(good):
        for j, b, lb, v in good[:x]:
            if la == lb and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.93:
                links[i] += 1
                links[j] += 1
                union.join(*((10**9 + k, 1) if x is None else (x, 0) for k, x in ((i, a), (j, b))))
    least = {}
    for r in rows:
        if r[0] is not None:
            root = union.root((r[0], 0))
            least[root] = min(least.get(root, r[0]), r[0])
    return sorted(
        ((r[0] is None, r[0] or 0, links[i], None if r[0] is None else least[union.root((r[0], 0))]) for i, r in enumerate(rows)),
        key=str,
    )


@pytest.mark.parametrize("block", [2048, 24, 5])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    rows = cases()
    got = V.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    found = sorted(((r[0] is None, r[0] or 0, r[1], r[2]) for r in got), key=str)
    assert found == expected(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_an_id_with_two_vectors(spark):
    rng = np.random.default_rng(9)
    a, c = rng.standard_normal((2, 16)).astype(np.float32).tolist()
    rows = [(1, a), (2, [x * 1.01 for x in a]), (1, c), (3, [x * 0.99 for x in c])]
    df = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)
    got = sorted(map(tuple, V.near_vectors(df).collect()))
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def test_empty_table(spark):
    assert V.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    o = rng.standard_normal((4000, 64))
    q = 0.93 * o / np.linalg.norm(o, axis=1)[:, None]
    side = rng.standard_normal(o.shape)
    side -= (side * o).sum(1)[:, None] * o / (o * o).sum(1)[:, None]
    q += np.sqrt(1 - 0.93**2) * side / np.linalg.norm(side, axis=1)[:, None]
    turn = V.rotation(64, 0).T
    coded, rotated = o / np.linalg.norm(o, axis=1)[:, None] @ turn, q @ turn
    signs, a = np.sign(coded), np.abs(coded).sum(1) / 8
    estimate = (signs * rotated).sum(1) / 8 / a
    assert abs(estimate.mean() - 0.93) < 0.005
    assert all(V.may_reach(signs[i : i + 1], a[i : i + 1], rotated[i : i + 1], 0.93)[0, 0] for i in range(len(o)))
    random_pairs = V.may_reach(signs[:500], a[:500], rotated[500:1000], 0.93)
    assert random_pairs.mean() < 0.001
