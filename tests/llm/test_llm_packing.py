"""Token pieces against the tokenizer; packing against its rule; shards against their law."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import frame
from pyspark.sql import functions as F

from echolex.llm import packing, sharding, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_equal_whole_encoding(docs, doc_rows):
    encode = tokens.tokenizer(PATH).encode
    got = {}
    for r in tokens.encode_pieces(docs, PATH, 100).collect():
        got.setdefault(r["doc_id"], {}).setdefault(r["piece"], (r["start"], r["length"], bytes(r["ids"])))
    for doc_id, text, *_ in doc_rows:
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = [got[doc_id][k] for k in sorted(got[doc_id])]
        assert b"".join(p[2] for p in pieces) == ids.tobytes()
        assert [p[0] for p in pieces] == list(range(0, len(ids), 100))
        assert [p[1] for p in pieces] == [len(p[2]) // 4 for p in pieces]


def test_odd_characters_and_a_small_cache(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    monkeypatch.setattr(tokens, "MISS_CHARS", 5)
    texts = ["", " a", "İstanbul ΣΑΣ x y  z q ́e é Å don't IT'S 12,5", "<|endoftext|> a<|endoftext|>b",
             "👍🏽 日本語　全角 \x85x \x1cy  z", "'s 't !!?? ‍ ﻿x"]
    encoder = tokens.WordIds(PATH)
    for _ in range(2):
        ids, bounds = encoder.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def by_the_rule(lengths, capacity):
    """Sum of squares by trying every choice."""
    bins = []

    def cost(gaps):
        return sum(v * v for v in np.unique([g for g in gaps if g], return_counts=True)[1].tolist())

    for size in lengths:
        options = {}
        for i, gap in enumerate(bins):
            if gap >= size:
                options.setdefault(gap, i)
        ways = [(cost([*bins[:i], gap - size, *bins[i + 1 :]]), 0, gap) for gap, i in options.items()]
        ways.append((cost([*bins, capacity - size]), 1, 0))
        _, new, gap = min(ways)
        if new:
            bins.append(capacity - size)
        else:
            bins[bins.index(gap)] = gap - size
    return sorted(bins)


def test_plain_words_are_encoded_without_offsets(monkeypatch):
    """Their ends follow from the lengths of the tokens; wide and odd words fall back to offsets."""
    calls = []

    class Counted:
        def __init__(self, real):
            self.real = real

        def __getattr__(self, name):
            calls.append(name)
            return getattr(self.real, name)

    real = tokens.tokenizer(PATH)
    odd = ["naïve", "</w>", "a</w>b</w>", "<|endoftext|>", "it's", "x\x1cy", "\x85", "\x00", "ü", "a\u00a0b"]
    for words, methods in ((["plain", "w0rds", "don't", "#$%", "a,b"], ["encode_batch_fast"]), (odd, ["encode_batch_fast", "encode"])):
        encoder = tokens.WordIds(PATH)
        encoder.tokenizer = Counted(real)
        calls.clear()
        encoder._learn(words)
        assert calls == methods
        for word in words:
            assert np.frombuffer(encoder.young[word], np.uint32).tolist() == real.encode(word, add_special_tokens=False).ids, word


def test_sum_of_squares_follows_its_rule():
    rng = np.random.default_rng(4)
    for capacity in (7, 20):
        lengths = rng.integers(1, capacity + 1, 120)
        bins, offsets, gaps = packing.sum_of_squares(lengths, capacity)
        assert sorted(gaps.tolist()) == by_the_rule(lengths.tolist(), capacity)
        for b in range(len(gaps)):
            at = np.argsort(offsets[bins == b])
            size = lengths[bins == b][at]
            assert offsets[bins == b][at].tolist() == (np.cumsum(size) - size).tolist()
    with pytest.raises(ValueError):
        packing.sum_of_squares(np.array([8]), 7)


@pytest.mark.parametrize("group", [10**6, 60])
def test_packed_sequences_are_whole_and_full(spark, group):
    rng = np.random.default_rng(2)
    data = [(None if i == 3 else i // 2, i % 2, int(n), "x") for i, n in enumerate(rng.integers(1, 101, 1500))]
    data.append(data[7])
    df = spark.createDataFrame(data, "doc_id long, piece int, length long, sequence_id string")
    got = packing.pack(df.drop("sequence_id"), 100, group)
    rows = got.collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["length"]) for r in rows) == sorted(
        (str(d), p, n) for d, p, n, _ in data
    )
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    # The rule's loss grows as the root of the number of pieces when sizes are uniform.
    assert len(by) <= sum(n for _, _, n, _ in data) / 100 + 3 * len(data) ** 0.5
    assert packing.pack(df.drop("sequence_id").limit(0), 100).count() == 0


def test_tree_and_best_fit():
    tree = sharding.Tree()
    for k in (5, 1, 9, 3, 7):
        tree.add((k, k))
    assert [tree.take((k, -1)) for k in (4, 4, 8, 10, 0)] == [(5, 5), (7, 7), (9, 9), None, (1, 1)]
    rng = np.random.default_rng(3)
    items = [(int(s), i) for i, s in enumerate(rng.integers(1, 60, 300))]
    placed, bins = sharding.best_fit_decreasing(items, 100)
    left, expected = [], {}
    for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
        fits = [(gap, b) for b, gap in enumerate(left) if gap >= size]
        b = min(fits)[1] if fits else len(left)
        if not fits:
            left.append(100)
        left[b] -= size
        expected[item] = b
    assert placed == expected and bins == len(left)
    assert sharding.best_fit_decreasing([(500, "a"), (1, "b")], 100)[1] == 2


def test_shards(docs, doc_rows):
    got = sharding.assign_shards(docs, 5, grains=40).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in doc_rows
    )
    by_text, slots = {}, {}
    for r in got:
        by_text.setdefault(r["text_key"], set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(5))


def test_shards_of_many_texts_are_near_equal(spark):
    rows = [(i, "x" * (i % 97) + str(i % 900), "en", "s", 0, 0, "x", 1) for i in range(2000)]
    got = sharding.assign_shards(frame(spark, rows), 6).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    sizes = [r["n"] for r in got]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 6


def test_empty_tables(no_docs):
    assert sharding.assign_shards(no_docs).count() == 0
    assert tokens.encode_pieces(no_docs, PATH).count() == 0


def test_workers_get_bounded_bytes(spark):
    """An executor of the pipeline holds two JVM batches and the arrays of two slices at a time."""
    import pyarrow as pa

    import corpus_pipeline
    from echolex.llm.sizes import prepare

    texts = pa.array(["some words " * 1000] * 300)
    slices = list(tokens.text_slices(texts, corpus_pipeline.SLICE_BYTES))
    assert [row for row, _ in slices] == [sum(len(t) for _, t in slices[:k]) for k in range(len(slices))]
    assert sum(len(t) for _, t in slices) == len(texts)
    assert max(sum(len(x) for x in t.to_pylist()) for _, t in slices) <= 1 << 19
    prepare(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
