import hashlib
import random
from collections import Counter, defaultdict

import llm_fixtures
import numpy as np
import pytest

from echolex.llm import suffixes as S
from echolex.llm.queries import op12_column_suffixes


def matrix(strings):
    width = max(map(len, strings))
    out = np.zeros((len(strings), width), np.uint8)
    for i, s in enumerate(strings):
        out[i, width - len(s) :] = np.frombuffer(s, np.uint8)
    return out, np.array([len(s) for s in strings])


def shared(a, b, cap):
    n = 0
    while n < min(len(a), len(b), cap) and a[n] == b[n]:
        n += 1
    return n


def test_collection_is_the_order_of_all_suffixes():
    rng = random.Random(1)
    for k in range(200):
        alphabet = b"ab" if k % 2 else b"abcdef\x00\xf4"
        strings = [bytes(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 12))]
        strings += strings[:3] if k % 3 == 0 else []
        cap = rng.choice([1, 2, 3, 5, 9])
        transform, common = S.collection(*matrix(strings), cap)
        order = sorted(
            ((s[p:], i, p) for i, s in enumerate(strings) for p in range(len(s) + 1)),
            key=lambda x: ([c + 1 for c in x[0]] + [0], x[1]),
        )
        assert transform.tolist() == [strings[i][p - 1] if p else S.END for _, i, p in order]
        assert common.tolist() == [0] + [shared(x[0], y[0], cap) for x, y in zip(order, order[1:])]
        count = Counter(s[p : p + cap] for s in strings for p in range(len(s) - cap + 1))
        want = {(i, len(s) - p) for i, s in enumerate(strings) for p in range(len(s) - cap + 1) if count[s[p : p + cap]] > 1}
        assert set(zip(*map(np.ndarray.tolist, S.repeated_starts(*matrix(strings), cap)))) == want


def test_equal_windows_have_one_hash():
    rng = random.Random(2)
    passage = bytes(rng.choices(b"abcdefgh ", k=500))
    texts = [bytes(rng.choices(b"abcdefgh ", k=rng.randrange(200))) + passage + bytes([65 + i]) * 300 for i in range(5)]
    hashes = defaultdict(set)
    whole = b"".join(texts)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, least, digest, first, count, again = S.runs(np.frombuffer(whole, np.uint8), offsets)
    assert count.sum() == sum(len(t) - S.WINDOW + 1 for t in texts) and count.max() <= S.RUN_WINDOWS
    for r, value, f, n, twice in zip(*map(np.ndarray.tolist, (row, least, first, count, again))):
        assert offsets[r] <= f and f + n + S.WINDOW - 1 <= offsets[r + 1]
        windows = [whole[p : p + S.WINDOW] for p in range(f, f + n)]
        assert twice or len(set(windows)) == n
        for window in windows:
            hashes[window].add(value)
    by_string = defaultdict(set)
    for d, f, n in zip(*map(np.ndarray.tolist, (digest, first, count))):
        by_string[whole[f : f + n + S.WINDOW - 1]].add(d)
    assert all(len(found) == 1 for found in by_string.values()) and len(set(digest.tolist())) == len(by_string)
    assert all(len(found) == 1 for found in hashes.values())


def expected(rows):
    """By a dictionary of all windows."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[p : p + 200] for _, t in raw for p in range(len(t) - 199))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - 199):
            if count[t[p : p + 200]] > 1:
                gone[p : p + 200] = b"\x01" * 200
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(rows):
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows),
        key=str,
    )


def awkward(doc_rows):
    rng = random.Random(7)
    rows = [(r[0], r[1]) for r in doc_rows if len(r[1] or "") < 5000]
    passage = llm_fixtures.sentence(rng, 50)
    texts = [f"{llm_fixtures.sentence(rng, 30)} {passage[: 199 + k]}|{llm_fixtures.sentence(rng, 30)}" for k in range(5)]
    texts += ["a" * 900, "ab" * 300, "xyz " * 150, "a" * 199, "b" * 200, "b" * 200, "c" * 201, "日本語" * 90, "\x00" * 450]
    base = llm_fixtures.sentence(rng, 300).split()
    for _ in range(60):  # near copies
        words = list(base)
        for at in rng.sample(range(300), 3):
            words[at] = llm_fixtures.sentence(rng, 1)
        texts.append(" ".join(words))
    return rows + [(1000 + i, t) for i, t in enumerate(texts)] + [(1000, "same id " + passage)]


@pytest.mark.parametrize("hot", [1 << 14, 5, 0])
def test_whole_texts(spark, doc_rows, hot):
    rows = awkward(doc_rows)
    frame = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, k1 int, kept string, windows int")
    found = S.remove_repeats(frame.repartition(5), hot_strings=hot)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"]
    assert got(found.collect()) == expected(rows)


def ordered_bytes(monkeypatch, strings):
    """Bytes of the strings of one hash that are ordered, and the repeated windows found in each."""
    import pyarrow as pa

    least = int(S.Hasher(np.frombuffer(strings[0], np.uint8)).grams(S.GRAM).view(np.int64)[137])
    rows = pa.table({"least": [least] * len(strings), "digest": range(len(strings)), "string": strings})
    ordered, seen = S.repeated_starts, []
    monkeypatch.setattr(S, "repeated_starts", lambda m, n: seen.append(int(n.sum())) or ordered(m, n))
    found = [(r["digest"], r["ahead"], r["windows"]) for b in S._ordered(rows.to_batches()) for r in b.to_pylist()]
    return sum(seen), sorted(found)


def test_only_what_may_repeat_is_ordered(monkeypatch):
    rng = random.Random(3)
    gram = bytes(rng.choices(b"abcdefgh ", k=64))
    side = lambda k: bytes(rng.choices(b"ijklmnop ", k=k))
    # All have the gram, none has 166 equal bytes about it.
    assert ordered_bytes(monkeypatch, [side(137) + gram + side(136) for _ in range(20)]) == (0, [])
    # Equal in 210 bytes, from 10 before the gram: 11 windows of two strings.
    tail = side(136)
    pair = [side(127) + b"=" * 10 + gram + tail for _ in range(2)]
    size, found = ordered_bytes(monkeypatch, [side(137) + gram + side(136) for _ in range(20)] + pair)
    assert found == [(20, 127, 11), (21, 127, 11)]
    assert size < 2 * 260 < sum(map(len, pair))


def test_no_rows(spark, no_docs):
    assert S.remove_repeats(no_docs).count() == 0


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, op12_column_suffixes(spark, sf_dir).collect()), key=str) == expected(map(tuple, rows))
