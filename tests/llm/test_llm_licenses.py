"""License scans: planted notices, edits, long templates, clean texts."""

import random

import pytest
from llm_fixtures import frame, sentence, words

from echolex.llm import licenses as L


def planted(rng):
    mit, gpl = L.TEMPLATES["mit"], L.TEMPLATES["gpl-3.0 notice"]
    return {
        0: (f"{sentence(rng, 30)}\n{gpl}\n{sentence(rng, 30)}", {"gpl-3.0 notice": 1.0}),
        1: (f"{sentence(rng, 400)} {mit.upper().replace(' ', chr(10))} {sentence(rng, 9)}", {"mit": 1.0}),
        2: (mit.replace("free of charge", "gratis").replace("copy of this", "good copy of this"), {"mit": 0.85}),
        3: (f"{gpl} {sentence(rng, 5)} {gpl}", {"gpl-3.0 notice": 1.0}),
        4: (sentence(rng, 500), {}),
        5: ("licensed under the terms of nothing in particular", {}),
        6: (None, {}),
        7: ("", {}),
        8: ("mit", {}),
    }


def test_planted_notices(spark):
    cases = planted(random.Random(3))
    rows = [(i, t, "en", "s", 0, 0, "x", 1) for i, (t, _) in cases.items()]
    got = L.scan_licenses(frame(spark, [*rows, rows[0], (None, cases[0][0], "en", "s", 0, 0, "x", 1)])).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append(r)
    assert len(found[0]) == 2 and len(found[3]) == 2 and len(found[None]) == 1
    for i, (text, expected) in cases.items():
        assert {r["license"] for r in found.get(i, [])} == set(expected)
        for r in found.get(i, []):
            assert r["coverage"] >= expected[r["license"]]
            assert text.encode()[r["start"] : r["end"]].decode() == r["span"]
    assert len(words(found[1][0]["span"])) == len(words(L.TEMPLATES["mit"]))


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_counts_words_in_order():
    rng = random.Random(8)
    for _ in range(40):
        template = [rng.randrange(30) for _ in range(20)]
        text = [w for w in template if rng.random() > 0.15]
        text.insert(rng.randrange(len(text)), 99)
        n, first, last = L.align(text, template, 0, 25)
        assert n == longest_common(text, template)
        assert longest_common(text[first : last + 1], template) == n


def test_own_templates_and_limits(spark, no_docs):
    df = frame(spark, [(1, "alpha beta gamma delta epsilon", "en", "s", 0, 0, "x", 1)])
    got = L.scan_licenses(df, {"own": "Beta, gamma; delta - epsilon!"}).collect()
    assert [(r["license"], r["span"]) for r in got] == [("own", "beta gamma delta epsilon")]
    assert L.scan_licenses(no_docs).count() == 0
    with pytest.raises(ValueError):
        L.Index({"big": "x" * (L.MAX_TEMPLATE_BYTES + 1)})
