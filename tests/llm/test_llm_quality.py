"""Text statistics by plain Python; perplexities by a plain Kneser-Ney model; bands by sorting."""

import math
from collections import Counter, defaultdict

import pytest
from llm_fixtures import frame, rows, words

from echolex.llm import quality as Q


def statistics(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = list(zip(w, w[1:], w[2:]))
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in Q.SYMBOLS), dup, len(covered)


def units(text):
    raw = (Q.PAD + text).encode("utf-16-le")
    return [raw[i : i + 2] for i in range(0, len(raw), 2)]


def log_perplexities(data):
    """(lang, text) to mean negative log probability, by dictionaries."""
    out = {}
    texts = defaultdict(list)
    for _, text, lang, *_ in data:
        if text is not None:
            texts[lang or ""].append(text)
    for lang, values in texts.items():
        split = {t: units(t) for t in values}
        grams = {t: [tuple(u[i : i + 4]) for i in range(len(u) - 3)] for t, u in split.items()}
        level = Counter(g for t in values for g in grams[t])
        levels = [level]
        for _ in range(3):
            level = Counter(g[1:] for g in level)
            levels.append(level)
        probability = None
        for level in reversed(levels):
            n = [max(1, sum(v == k for v in level.values())) for k in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1])
            d = [max(0.0, k - (k + 1) * y * n[k] / n[k - 1]) for k in (1, 2, 3)]
            total, freed, types = Counter(), Counter(), Counter()
            for g, v in level.items():
                total[g[:-1]] += v
                freed[g[:-1]] += d[min(v, 3) - 1]
                types[g[:-1]] += 1
            below, probability = probability, {}
            for g, v in level.items():
                c = g[:-1]
                share = 1 / types[c] if below is None else below[g[1:]]
                probability[g] = (v - d[min(v, 3) - 1]) / total[c] + freed[c] / total[c] * share
        for t in values:
            if grams[t]:
                out[lang, t] = -sum(math.log(probability[g]) for g in grams[t]) / len(grams[t])
    return out


@pytest.fixture(scope="module")
def judged(docs):
    df = docs.withColumnRenamed("kept", "kept_").withColumnRenamed("_scores", "scores_")
    return Q.judge(df, hash_bits=32).collect()  # no two grams share a hash


def test_statistics_and_perplexities(judged, doc_rows):
    assert len(judged) == len(doc_rows)
    expected = log_perplexities(doc_rows)
    for r in judged:
        s = r["_scores"]
        assert tuple(s)[:5] == statistics(r["text"])
        want = expected.get((r["lang"] or "", r["text"]))
        assert (s["log_perplexity"] is None) == (want is None)
        if want is not None:
            assert s["log_perplexity"] == pytest.approx(want, rel=1e-4)
        fails = s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]
        assert r["base_failed"] == fails
        assert not (r["kept"] and fails)
        if not fails:
            assert r["kept"] == (r["_lower"] <= s["log_perplexity"] <= r["_upper"])


def test_bands_are_exact_medians(judged):
    by_lang = defaultdict(list)
    for r in judged:
        if not r["base_failed"]:
            by_lang[r["lang"] or ""].append(round(r["_scores"]["log_perplexity"] / Q.STEP))
    for r in judged:
        values = sorted(by_lang[r["lang"] or ""])
        middle = values[(len(values) + 1) // 2 - 1]
        away = sorted(abs(v - middle) for v in values)
        width = max(1, away[(len(away) + 1) // 2 - 1])
        assert r["_lower"] == pytest.approx((middle - Q.LOWER_DEVIATIONS * width) * Q.STEP, abs=1e-6)


def test_few_hash_bits_still_score_all(spark):
    df = frame(spark, rows(8, 12)).drop("kept", "_scores")
    got = Q.judge(df, hash_bits=6).filter("text != ''").collect()
    assert all(r["_scores"]["log_perplexity"] is not None for r in got)


def test_no_gram_takes_the_value_of_another(docs, judged):
    """Most grams are joined; scores and verdicts stay those of the whole table."""
    df = docs.withColumnRenamed("kept", "kept_").withColumnRenamed("_scores", "scores_")

    def plain(rows):
        return Counter((r["doc_id"], r["text"], r["_scores"], r["_lower"], r["_upper"], r["kept"]) for r in rows)

    assert plain(Q.judge(df, hash_bits=6).collect()) == plain(judged)


def test_empty_table_and_no_language(no_docs, docs):
    assert Q.judge(no_docs.drop("_scores", "kept")).count() == 0
    assert Q.judge(docs.select("doc_id", "text")).count() == docs.count()
