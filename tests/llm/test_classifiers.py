"""The two classifiers' parts against plain loops, and the bound of what they are fitted on."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labormart.llm import quality, toxicity
from labormart.llm.common import fitted_rows, labelled_sample

rng = random.Random(11)
SCHEMA = "doc_id long, text string, label int, score double"


def prose(n):
    return " ".join("".join(rng.choices("abcdefgÉé日", k=rng.randint(1, 7))) for _ in range(n))


def walk(t, row):
    """One row through the trees, node by node."""
    z = t.base
    for k in t.roots.tolist():
        while t.left[k] != k:
            k = int(t.left[k] if row[t.feature[k]] <= t.threshold[k] else t.right[k])
        z += t.value[k]
    return 1 / (1 + math.exp(-z))


def test_trees_by_a_plain_walk():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, quality.N_STATISTICS))
    x[:, 3] = r.integers(0, 3, 400)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] == 1)).astype(float)
    t = quality.boost(x, y)
    new = np.concatenate((x, r.normal(size=(50, quality.N_STATISTICS)) * 100))
    assert np.allclose(t.score(new), [walk(t, row) for row in new])
    assert np.mean((t.score(x) >= 0.5) == y) > 0.97


def test_first_split_by_all_cuts():
    """The root's split and the leaves' values of a tree of one level."""
    r = np.random.default_rng(2)
    x = r.integers(0, 9, size=(200, quality.N_STATISTICS)).astype(float)
    y = (x[:, 5] + r.normal(size=200) > 5).astype(float)
    t = quality.boost(x, y, trees=1, depth=1)
    p = y.mean()
    g, h = p - y, np.full(200, p * (1 - p))
    gain = {}
    for f in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1])):
            left = x[:, f] <= cut
            if h[left].sum() > 1 and h[~left].sum() > 1:
                gain[f, cut] = sum(g[s].sum() ** 2 / (h[s].sum() + quality.RIDGE) for s in (left, ~left))
    best = max(gain.values())
    k = int(t.roots[0])
    assert math.isclose(gain[int(t.feature[k]), float(t.threshold[k])], best)
    left = x[:, t.feature[k]] <= t.threshold[k]
    for child, side in ((t.left[k], left), (t.right[k], ~left)):
        assert math.isclose(t.value[child], -quality.RATE * g[side].sum() / (h[side].sum() + quality.RIDGE))


def grams(text):
    t = " " + (text or "").lower() + " "
    return {t[i : i + n] for n in toxicity.ORDERS for i in range(len(t) - n + 1)}


def slot(gram):
    return int(toxicity.gram_slots(gram)[0]) if len(gram) == 4 else None


@pytest.mark.parametrize("step", [1 << 16, 64])
def test_ngrams_are_characters(monkeypatch, step):
    """Slots of a text are those of its n-grams one by one, also across the pieces of a long text."""
    monkeypatch.setattr(toxicity, "_STEP", step)
    for text in ["", "a", "ÉCOLE été İx", prose(200), "日本語のテキスト " * 30]:
        one = set()
        for g in grams(text):
            # The last order of a gram by itself is the whole gram.
            own = toxicity.gram_slots(g)
            at = sum(max(0, len(g) - n + 1) for n in toxicity.ORDERS if n < len(g))
            one.add(int(own[at]))
        assert set(toxicity.present(text).tolist()) == one


def test_counts_and_ratios(spark):
    rows = [(i, prose(30) + (" vile" if i % 3 == 0 else ""), int(i % 3 == 0), 0.5) for i in range(90)] + [(90, None, 0, 0.5), (91, "", 1, 0.5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    t = [sum(r[2] == y for r in rows) for y in (0, 1)]
    n = [np.zeros(1 << toxicity.BITS) for _ in (0, 1)]
    for _, text, y, _ in rows:
        for s in toxicity.present(text or "").tolist():
            n[y][s] += 1
    got = toxicity.class_counts(df).select("slot", "n0", "n1", toxicity.log_ratio(*t).alias("r"), toxicity.likelihood_ratio(*t).alias("g")).collect()
    assert {r.slot for r in got} == set(np.flatnonzero(n[0] + n[1]).tolist())
    for r in got:
        assert (r.n0, r.n1) == (n[0][r.slot], n[1][r.slot])
        assert math.isclose(r.r, math.log((r.n1 + 1) / (t[1] + 2)) - math.log((r.n0 + 1) / (t[0] + 2)), abs_tol=1e-12)
        share, g = (r.n0 + r.n1) / sum(t), 0
        for seen, size in ((r.n0, t[0]), (r.n1, t[1])):
            g += (seen * math.log(seen / (size * share)) if seen else 0) + ((size - seen) * math.log((size - seen) / (size * (1 - share))) if size > seen else 0)
        assert math.isclose(r.g, g, abs_tol=1e-9)


def test_scores_by_a_plain_sum(spark):
    rows = [(i, prose(20) + (" scum and moron" if i % 2 else ""), i % 2, 0.5) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.train(spark, df, df.select("doc_id", F.col("label").alias("toxic")))
    weight = dict(zip(model.slots.tolist(), model.weights.tolist(), strict=True))
    for r in toxicity.score(df, model).collect():
        text = rows[r.doc_id][1]
        z = model.intercept + sum(weight.get(s, 0.0) for s in toxicity.present(text).tolist())
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-9) and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_logistic_gradient():
    """The weights found lie where the loss is least, by finite differences."""
    r = np.random.default_rng(3)
    rows = [np.flatnonzero(r.random(6) < 0.4) for _ in range(60)]
    y = np.array([float(0 in x or r.random() < 0.1) for x in rows])
    ratio = r.normal(size=6)
    w, b = toxicity.logistic(np.concatenate(rows).astype(np.int16), np.cumsum([0, *map(len, rows)]), y, ratio, steps=6000)

    def loss(w, b):
        z = np.array([b + (w * ratio)[x].sum() for x in rows])
        return np.mean(np.log1p(np.exp(z)) - y * z) + 0.5 * (w**2).sum() / len(rows)

    at = loss(w, b)
    for i in range(6):
        for d in (-1e-2, 1e-2):
            assert loss(w + d * (np.arange(6) == i), b) > at - 1e-7


def test_repeated_ids_stay_within_the_bound(spark):
    """A third of all rows under one labelled id is one fitted row, the least text."""
    rows = [(7, prose(5), 1, 0.5) for _ in range(300)] + [(7, None, 1, 0.5)] + [(i, prose(5), 0, 0.5) for i in range(20, 60)] + [(None, "x", 0, 0.5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(7, 1), (7, 0)] + [(i, 0) for i in range(20, 60)], "doc_id long, toxic int")
    sample = labelled_sample(spark, labels, "toxic", F.lit(True), 25)
    got = fitted_rows(docs, sample).collect()
    assert len(got) <= 25
    whole = fitted_rows(docs, labelled_sample(spark, labels, "toxic", F.lit(True), 1000)).collect()
    assert len(whole) == 41 and [r.text for r in whole if r.label == 1] == [""]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_held_out_of_null_ids_is_null(spark, module):
    docs = spark.createDataFrame([(None, "some text", 0, 0.1), (3, None, 0, 0.1)], SCHEMA)
    model = module.train(spark, docs, spark.createDataFrame([], "doc_id long, toxic int, quality int"))
    got = {r.doc_id: r for r in module.score(docs, model).collect()}
    assert got[None].held_out is None and got[3].held_out is not None and got[None].score == got[3].score
