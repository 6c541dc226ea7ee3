"""Content-defined chunks: gear hash, shifts, repeated passages."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_fixtures import SCHEMA, frame, sentence, words

from echolex.llm import substrings as S
from echolex.llm import texts as T


def gear_by_definition(data):
    out = []
    for i in range(len(data)):
        h = 0
        for b in data[max(0, i - 15) : i + 1]:
            h = (2 * h + int(S._GEAR[b])) & 0xFFFF
        out.append(h)
    return out


def test_gear_and_chunks():
    data = np.frombuffer(sentence(random.Random(1), 200).encode(), np.uint8)
    assert S.gear(data).tolist() == gear_by_definition(data)
    start, end, row, _ = S.chunks(data, np.array([0, 0, 300, len(data)]))
    assert start[0] == 0 and end[-1] == len(data) and (start[1:] == end[:-1]).all()
    assert set(row) == {1, 2} and (end - start).max() <= S.MAX_CHUNK


def test_an_insertion_moves_no_other_chunks():
    text = sentence(random.Random(2), 3000).encode()
    digests = []
    for t in (text, text[:5000] + b" inserted here" + text[5000:]):
        data = np.frombuffer(t, np.uint8)
        digests.append(Counter(S.chunks(data, np.array([0, len(data)]))[3].tolist()))
    assert (digests[0] - digests[1]).total() <= 3


def test_awkward_documents(docs, doc_rows):
    got = S.dedup_substrings(docs)
    assert got.columns == [*docs.columns, "_removed"]
    got = got.collect()
    assert len(got) == len(doc_rows)
    before, after = Counter(), Counter()
    for r in got:
        if r["doc_id"] is None:
            continue
        w = words(r["text"])
        after.update({tuple(w[k : k + 50]) for k in range(len(w) - 49)})
    for doc_id, text in {r[0]: r[1] for r in doc_rows if r[0] is not None}.items():
        w = words(text)
        before.update({tuple(w[k : k + 50]) for k in range(len(w) - 49)})
    assert any(n > 1 for n in before.values())
    repeated_row = doc_rows[4][0]  # the same document twice stays as it is
    same = {g for r in got if r["doc_id"] == repeated_row for g in [tuple(words(r["text"]))]}
    assert len(same) == 1
    kept = Counter({g: n for g, n in after.items() if n > 1})
    own = words(doc_rows[4][1])
    for k in range(len(own) - 49):
        kept.pop(tuple(own[k : k + 50]), None)
    assert not kept
    for r in got:  # what is taken out are whole words of the old text, at the reported bytes
        old = {(x[0], x[5]): x[1] for x in doc_rows}[(r["doc_id"], r["row"])]
        assert (r["text"] is None) == (old is None)
        if old is not None:
            removed = [old.encode()[s["start"] : s["end"]].decode() for s in r["_removed"]["spans"]]
            assert sum(len(words(x)) for x in removed) == r["_removed"]["words"]
            assert len(words(r["text"])) + r["_removed"]["words"] == len(words(old))


def test_clean_documents_stay(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, 120), "en", "s", 0, 0, "x", 1) for i in range(60)]
    got = S.dedup_substrings(frame(spark, rows)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {r[0]: r[1] for r in rows}


def test_passages_of_just_over_fifty_words(spark):
    rng = random.Random(4)
    passages = [sentence(rng, 52) for _ in range(40)]
    rows = []
    for i, p in enumerate(passages):
        for k in range(3):
            rows.append((3 * i + k, f"{sentence(rng, 30)} {p} {sentence(rng, 30)}", "en", "s", 0, 0, "x", 1))
    got = {r["doc_id"]: r["text"] for r in S.dedup_substrings(frame(spark, rows)).collect()}
    still = sum(p in got[3 * i + k] for i, p in enumerate(passages) for k in (1, 2))
    assert all(p in got[3 * i] for i, p in enumerate(passages))
    assert still <= 2


def test_empty_table(no_docs):
    assert S.dedup_substrings(no_docs).count() == 0
    assert "_scores" in SCHEMA


def test_slices_do_not_matter():
    texts = [sentence(random.Random(k), 80) for k in range(12)] * 2
    whole = [S.chunks(d, o)[3].tolist() for _, d, o in T.slices(pa.array(texts))]
    parts = [S.chunks(d, o)[3].tolist() for _, d, o in T.slices(pa.array(texts), 700)]
    assert sum(whole, []) == sum(parts, [])
