"""Token counts after edits against encoding the whole edited text."""

import random

import public_tokenizers
import pytest

from echolex.llm import token_trees as K

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LETTERS = " \n\t'sltvermd ab12,.é!日 "


@pytest.fixture(scope="module")
def count():
    return K.counter(PATH, PATTERN)


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_edits_keep_the_tree_right(count, monkeypatch, segment):
    monkeypatch.setattr(K, "SEGMENT", segment)
    rng = random.Random(segment)

    def text_of(n):
        return "".join(rng.choice(LETTERS) for _ in range(n))

    for _ in range(250):
        text = text_of(rng.choice((0, 1, 3, 30, 300)))
        pieces = count.split(text)
        tree = K.TokenTree([len(p) for p in pieces], count.counts(pieces))
        for _ in range(5):
            pos, remove = rng.randint(0, len(text) + 2), rng.choice((0, 0, 1, 2, 5, 50, 400))
            text, _ = K.edit(tree, text, pos, remove, text_of(rng.choice((0, 0, 1, 2, 9, 200))), count)
            pieces = count.split(text)
            assert tree.arrays() == ([len(p) for p in pieces], count.counts(pieces))
            assert tree.n_tokens == len(count.encoding.encode_ordinary(text)) and tree.n_chars == len(text)


def test_few_pieces_are_encoded_again(count):
    text = " ".join(f"word{i}" for i in range(20_000))
    pieces = count.split(text)
    tree = K.TokenTree([len(p) for p in pieces], count.counts(pieces))
    _, n = K.edit(tree, text, len(text) // 2, 4, "some new words", count)
    assert n < 15


def test_frames(spark, docs, doc_rows, no_docs):
    trees = K.build_trees(docs.select("doc_id", "text", "row"), PATH, PATTERN)
    edits = "array(struct(3L as pos, 2L as remove, 'new text' as insert), struct(99999L as pos, cast(null as long) as remove, '!' as insert))"
    got = K.apply_edits(trees.selectExpr("*", f"{edits} as edits"), PATH, PATTERN).collect()
    encode = K.counter(PATH, PATTERN).encoding.encode_ordinary
    old = {(r[0], r[5]): r[1] for r in doc_rows}
    assert len(got) == len(doc_rows)
    for r in got:
        text = old[r["doc_id"], r["row"]]
        want = None if text is None else text[:3] + "new text" + text[5:] + "!"
        assert r["text"] == want and r["n_tokens"] == (0 if want is None else len(encode(want)))
        assert (r["tree"] is None) == (want is None)
    none = K.build_trees(no_docs.select("doc_id", "text"), PATH, PATTERN)
    assert K.apply_edits(none.selectExpr("*", f"{edits} as edits"), PATH, PATTERN).count() == 0
