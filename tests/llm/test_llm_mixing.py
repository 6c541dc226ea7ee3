"""Budgets by plain water filling, prefixes by plain sorting."""

import hashlib
from collections import defaultdict

import pytest
from llm_fixtures import words

from echolex.llm import mixing as M


def fill(amount, caps, weights):
    given, left = {}, dict(caps)
    while left:
        total = sum(weights[k] for k in left)
        full = [k for k in left if left[k] <= amount * weights[k] / total]
        if not full:
            return given | {k: amount * weights[k] / total for k in left}
        for k in full:
            given[k] = left.pop(k)
            amount -= given[k]
    return given


def expected(rows, share, weights, epochs, seed):
    leaves = defaultdict(list)
    for doc_id, text, lang, source, *_, domain in rows:
        leaves[(domain, lang or "-", source or "-")].append((doc_id, len(words(text))))
    tokens = {k: sum(n for _, n in v) for k, v in leaves.items()}
    given = {(): share * sum(tokens.values())}
    for depth in (1, 2, 3):
        nodes = {k[:depth] for k in tokens}
        caps = {n: epochs * sum(t for k, t in tokens.items() if k[:depth] == n) for n in nodes}
        for parent in {n[:-1] for n in nodes}:
            own = {n: caps[n] for n in nodes if n[:-1] == parent}
            given |= fill(given[parent], own, {n: weights.get(n, 1.0) for n in own})
    out = []
    for leaf, members in leaves.items():
        target = round(given[leaf])
        whole = target // tokens[leaf] if tokens[leaf] else 0
        rest, before = target - whole * tokens[leaf], 0

        def place(m):
            name = "-" if m[0] is None else str(m[0])
            return hashlib.md5(f"{seed}:{whole}:{name}".encode()).hexdigest(), m[1]

        for doc_id, n in sorted(members, key=place):
            if n:
                copies = whole + (before < rest)
                before += n
                if copies:
                    out.append((doc_id, leaf, n, copies))
    return sorted(out, key=str)


@pytest.mark.parametrize("share,epochs", [(0.4, 1), (0.9, 1), (1.7, 3)])
def test_mix_against_plain_python(spark, docs, doc_rows, share, epochs):
    rows = [(*r, f"d{(r[0] or 0) % 3}") for r in doc_rows]
    df = spark.createDataFrame(rows, docs.schema.simpleString()[7:-1].replace(":", " ") + ", domain string")
    domain = spark.createDataFrame([("d0", 5.0), ("d1", 1.0)], "domain string, weight double")
    lang = spark.createDataFrame([("d0", "en", 4.0)], "domain string, lang string, weight double")
    got = M.mix(df, share, {"domain": domain, "lang": lang}, epochs, seed=3)
    found = sorted(((r[0], (r[1], r[2], r[3]), r[4], r[5]) for r in got.collect()), key=str)
    weights = {("d0",): 5.0, ("d1",): 1.0, ("d0", "en"): 4.0}
    assert found == expected(rows, share, weights, epochs, 3)
    taken = M.take(df, got).count()
    ids = {}
    for doc_id, _, _, copies in found:
        ids[doc_id] = max(copies, ids.get(doc_id, 0))
    assert taken == sum(ids.get(r[0], 0) for r in rows)


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("a", "en", "s1", 10, 10), ("a", "en", "s2", 500, 500), ("b", "en", "s3", 500, 500)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long, cap long")
    got = {r["source"]: r["target"] for r in M.leaf_targets(df, 200).collect()}
    assert got == {"s1": 10, "s2": 90, "s3": 100}
    assert {r["source"]: r["target"] for r in M.leaf_targets(df, 5000).collect()} == {"s1": 10, "s2": 500, "s3": 500}


def test_empty_table(no_docs):
    from pyspark.sql import functions as F

    assert M.mix(no_docs.withColumn("domain", F.lit("d")), 0.5).count() == 0
