import hashlib
from collections import Counter

import llm_fixtures
import numpy as np
import pyarrow as pa
import pytest

from echolex.llm import alignment as al
from echolex.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, op11_arrow_alignment, tokenizer_path
from echolex.llm.texts import slices

A, B = tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)
ODD = [
    "a   b", "x　 y", "x  y  z \u0085 q", "a \n b\n\nc", "<|endoftext|> <s> <0x41> x", "▁a b", "don't  stop ", "\nfoo",
    "foo\n", " ", "  ", "a\tb c", "日本語 テキスト\nた", "é è ü", "\x00 a \x00b", "🙂 🙂\n🙂 \n", "a  b \nc",
    "é ́x", "a\r\nb c \r", "1 2\n3 '\n's", None, "",
]


def whole(known, text):
    """(a ids, b ids, groups, links) of a text encoded in one piece, by plain loops."""
    if not text:
        return [], [], [], []
    a, b = known.a.encode(" " + text), known.b.model.encode(text)
    spelled = [[v.of_id[i] for i in ids] for v, ids in ((known.a.vocabulary, a), (known.b.vocabulary, b))]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return [], [], [], []
    ends = [np.cumsum([len(t) for t in s]).tolist() for s in spelled]
    starts = [[0, *e[:-1]] for e in ends]
    common, groups, j = set(ends[0]) & set(ends[1]), [], 0
    left = []
    for i, end in zip(a, ends[0]):
        left.append(i)
        if end in common:
            k = ends[1].index(end) + 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, b[j:k])))
            left, j = [], k
    links, first = [], 0
    for i, s, e in zip(a, starts[0], ends[0]):
        while ends[1][first] <= s:
            first += 1
        k = first
        while k < len(b) and starts[1][k] < e:
            links.append((i, b[k]))
            k += 1
    return a, b, groups, links


def expected(known, rows):
    """Result rows for (doc_id, text), by plain counting."""
    found = [(i, *whole(known, t)) for i, t in rows]
    count = Counter(pair for *_, links in found for pair in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for i, a, b, groups, links in found:
        n = [count[p] for p in links]
        best = sum(count[p] == top[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(n), digest))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def known():
    return al.Aligner(A, B)


def test_segments_give_what_whole_texts_give(known, spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    texts += ODD
    for row, data, offsets in slices(al._spaced(pa.array(texts)), 1 << 12):
        part = al.Slice(data, offsets, known)
        groups = part.groups().to_pylist()
        n_a, n_b = part.sums(part.numbers("n_a")), part.sums(part.numbers("n_b"))
        for k, text in enumerate(texts[row : row + part.rows]):
            a, b, want, _ = whole(known, text)
            assert (n_a[k], n_b[k], groups[k]) == (len(a), len(b), ";".join(want)), text


def test_a_trimmed_cache_gives_the_same(known):
    small = al.Aligner(A, B, limit=3)
    for keys in ([" a", " bc", " d", " e"], [" a", " f"], [" bc", " a", " g", " h"], [" x ", "\ny"]):
        assert small.segments(keys).to_pylist() == known.segments(keys).to_pylist()


def result(rows):
    digest = lambda r: hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else ""
    return sorted(((*list(r)[:7], digest(r)) for r in rows), key=str)


@pytest.fixture(scope="module")
def awkward(doc_rows):
    rows = [(r[0], r[1]) for r in doc_rows] + [(1000 + i, t) for i, t in enumerate(ODD)]
    return rows + [(1002, "another text"), (None, "a   b")]


@pytest.mark.parametrize("lookup", [1 << 21, 40, 0])
def test_counts_with_and_without_lookup(spark, known, awkward, lookup):
    frame = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in awkward], "doc_id long, text string, n_a int, others string, _row int")
    rows = al.align(frame.repartition(3), A, B, lookup_pairs=lookup)
    assert rows.columns == ["doc_id", *al.FIELDS, "n_best", "count_sum", "groups"]
    assert result(rows.collect()) == expected(known, awkward)


def test_no_rows(spark, no_docs):
    assert al.align(no_docs, A, B).count() == 0
    assert al.align(llm_fixtures.frame(spark, [(1, None, *[None] * 6), (1, "", *[None] * 6)]), A, B).count() == 2


def test_query(spark, sf_dir, known):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = op11_arrow_alignment(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == expected(known, map(tuple, rows))
