"""Small document tables with the awkward cases every operator must bear."""

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, kept string, _scores int"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows(seed=5, n=40):
    """Ordinary texts, copies, near copies, shared passages, nulls, empty and long ones, repeated rows."""
    rng = random.Random(seed)
    passage = sentence(rng, 70)
    texts = [sentence(rng, rng.randint(55, 160)) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1]]
    for k in range(6):
        words = texts[2 + k % 2].split()
        words[rng.randrange(len(words))] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [f"{sentence(rng, 60)}\n{passage}\n{sentence(rng, 60)}" for _ in range(4)]
    texts += [None, None, "", " \t\n", "one", "two words", "a\n" * 30, "日本語 テキスト é ü", sentence(rng, 9000)]
    out = [
        (i, t, ("en", "de", None)[i % 3], f"src{i % 5}" if i % 7 else None, 0, i, "x", 1)
        for i, t in enumerate(texts)
    ]
    out.append((None, texts[3], "en", "src1", 0, 0, "x", 1))
    out.append(out[4])
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words(text)
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


class Union:
    def __init__(self):
        self.up = {}

    def root(self, i):
        self.up.setdefault(i, i)
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
