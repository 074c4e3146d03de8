"""The three learned operators against plain versions: a network stepped byte by
byte, counts kept in dictionaries, rates moved document by document."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoreline.llm import langid, mixing, quality

TEXTS = ["hello world", "", None, "123 456", "é" * 100, "The quick brown fox " * 20, "x", "中文字 and more\n" * 9]


# ------------------------------------------------------------------ op1
def plain_gru(table, rec, raw):
    """States of one direction, one byte and one unit at a time."""
    size = len(rec[0])
    h, out = [0.0] * size, []
    sig = lambda v: 1 / (1 + math.exp(-v))
    for byte in raw:
        u = [sum(rec[g][k] * h[k] for k in range(size)) for g in range(3 * size)]
        z = [sig(table[g][byte] + u[g]) for g in range(size)]
        r = [sig(table[size + g][byte] + u[size + g]) for g in range(size)]
        n = [math.tanh(table[2 * size + g][byte] + r[g] * u[2 * size + g]) for g in range(size)]
        h = [(1 - z[g]) * n[g] + z[g] * h[g] for g in range(size)]
        out.append(h)
    return out


def plain_language(model, text):
    if not text or not langid.LETTER.search(text):
        return "und", 0.0
    p = [x.tolist() for x in model.params]
    raw, total = text.encode(), [0.0] * len(model.langs)
    for at in range(0, len(raw), langid.WINDOW):
        part = raw[at:at + langid.WINDOW]
        ahead, behind = plain_gru(p[0], p[1], part), plain_gru(p[2], p[3], part[::-1])[::-1]
        for f, b in zip(ahead, behind):
            logit = [sum(w * v for w, v in zip(row, f + b)) + bias[0] for row, bias in zip(p[4], p[5])]
            top = max(logit)
            e = [math.exp(v - top) for v in logit]
            for k, v in enumerate(e):
                total[k] += v / sum(e)
    best = max(range(len(total)), key=lambda k: (total[k], -k))
    return model.langs[best], total[best] / len(raw)


def test_language_equals_plain_network(spark):
    model = langid.BiGru(["de", "en", "fr"], hidden=5, seed=3)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, model).collect()}
    for i, text in enumerate(TEXTS):
        lang, score = plain_language(model, text)
        assert got[i][0] == lang and abs(got[i][1] - score) < 2e-3, text  # the operator runs in single precision


# ------------------------------------------------------------------ op6
def plain_grams(text):
    """Hashed byte triples, words, word pairs and marks of repeated words, one by one."""
    raw, cut, found = (text or "").encode(), 32 - quality.BITS, set()
    mask = (1 << 32) - 1
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        found.add(((a << 16 | b << 8 | c) * 2654435761 & mask) >> cut)
    words = raw.split()
    hashes = [zlib.crc32(w) for w in words]
    for h in hashes:
        found.add((h * 2246822519 & mask) >> cut)
    for a, b in zip(hashes, hashes[1:]):
        found.add((((a * 3266489917 & mask) + b & mask) * 668265263 & mask) >> cut)
    longest = run = 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 0
        longest = max(longest, run)
    return found | {k * 97 + 11 for k in range(min(3, longest))}


def test_quality_equals_plain_score(spark):
    rows = [(i, t, i % 2) for i, t in enumerate([t or "" for t in TEXTS] + ["good prose " * 3, "buy buy buy buy now", "good words here", "now now now"])]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(99, None)], "doc_id long, text string")
    model = quality.train(df, spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, quality int"))
    counts = [Counter(), Counter()]
    for _, t, k in rows:
        assert set(quality.ngrams(t).tolist()) == plain_grams(t), t
        counts[k].update(plain_grams(t))
    sizes = [sum(c.values()) + quality.SIZE for c in counts]  # one is added to every bucket
    ratio = lambda g: math.log((counts[1][g] + 1) / sizes[1]) - math.log((counts[0][g] + 1) / sizes[0])
    got = {r.doc_id: (r.score, r.predicted) for r in quality.score(df, model).collect()}
    for i, t, _ in rows + [(99, None, 0)]:
        grams = plain_grams(t)
        norm = math.sqrt(sum(ratio(g) ** 2 for g in grams))
        margin = model.bias + (sum(ratio(g) * float(model.weights[g]) for g in grams) / norm if norm else 0.0)
        want = 1 / (1 + math.exp(-(model.slope * margin + model.shift)))
        assert abs(got[i][0] - want) < 1e-4 and got[i][1] == int(got[i][0] >= 0.7), t


# ------------------------------------------------------------------ op5
@pytest.mark.parametrize("budget,keep", [(None, False), (None, True), (900.0, False), (200.0, False)])
def test_rates_equal_plain_descent(spark, budget, keep):
    """Every document's rate is the fold of the steps, and no plain projected
    gradient over single documents comes nearer to the targets."""
    rng = np.random.default_rng(3)
    tokens, p = rng.integers(0, 40, 60), rng.dirichlet([0.3, 0.3, 0.3], 60)
    members = spark.createDataFrame([(i, int(n), row.tolist()) for i, (n, row) in enumerate(zip(tokens, p))], "doc_id long, n_tokens long, p array<double>")
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    rates, expected = mixing.fit_rates(members, ["a", "b", "c"], targets, budget, keep=keep)
    x = np.array([rates.of(row) for row in p])
    got = {r.doc_id: r.x for r in members.select("doc_id", rates.column(F.col("p"), 3).alias("x")).collect()}
    assert np.allclose(x, [got[i] for i in range(60)])
    totals = (tokens * x) @ p
    assert np.allclose(totals, [expected[d] for d in "abc"])
    least = 1.0 if budget is None else 0.0
    assert x.min() >= least
    want = np.array([0.6, 0.3, 0.1]) * (budget or totals.sum())
    y, a = np.ones(60), tokens[:, None] * p
    for _ in range(20_000):  # least squares over the documents' own rates
        y = np.maximum(least, y + a @ (want - y @ a) / (np.linalg.norm(a, 2) ** 2))
    assert np.linalg.norm(totals - want) <= np.linalg.norm(y @ a - want) + 1e-3 * want.sum()
