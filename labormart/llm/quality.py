"""Quality classifier: histogram gradient-boosted trees over document statistics.

``statistics`` gives numbers of one text (lengths, character classes, repetition). A bounded,
documented sample of labelled rows (``SAMPLE``) is cut into at most ``BINS`` quantile bins per
statistic, and trees are grown level by level on gradient histograms. The trees are flattened into
arrays (feature, threshold, children, value) and applied to whole batches by numpy.

A null text is an empty text, whose statistics are zeros; without labels of both classes every
score is the share of label 1 (0 without labels). Labels that are null or of no document are not
used; of several labels of one document the larger counts, and of several rows of one labelled id the
least text. Repeated rows are scored each on its own; ``held_out`` is null for a null id. Only doc_id and text
of the documents are read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from labormart.llm.common import crc_mod, fitted_rows, give_back, labelled_sample, load, map_batches, text_bytes

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
BINS, TREES, DEPTH, RATE, RIDGE = 64, 80, 4, 0.15, 1.0
THRESHOLD = 0.3

#: Character classes by byte: 0 other, 1 lower, 2 upper, 3 digit, 4 white, 5 sentence mark, 6 symbol, 7 not ASCII.
_CLASS = np.zeros(256, np.uint8)
for _c, _members in ((1, range(97, 123)), (2, range(65, 91)), (3, range(48, 58)), (4, b" \t\n\r\v\f"), (5, b".,;:?'\"()-"), (6, b"#*$%&|<>!@^_=+~\\/[]{}"), (7, range(128, 256))):
    _CLASS[list(_members)] = _c

N_STATISTICS = 22


def statistics(text: bytes) -> list[float]:
    raw = np.frombuffer(text, np.uint8)
    n = max(1, len(raw))
    per = np.bincount(_CLASS[raw], minlength=8) / n
    by = np.bincount(raw, minlength=256)
    p = by[by > 0] / n
    words = text.split()
    w = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    seen = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    runs = np.flatnonzero(np.diff(raw)) if len(raw) > 1 else np.zeros(0)
    stops = sum(x.endswith((b".", b"?", b"!")) for x in lines)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), lengths.mean(), lengths.std(), float(lengths.max()), *per,
        float(-(p * np.log2(p)).sum()), len(seen) / w, max(seen.values(), default=0) / w,
        sum(map(eq, words, words[1:])) / w, len(set(lines)) / max(1, len(lines)), w / max(1, len(lines)),
        stops / max(1, len(lines)), 1 - len(runs) / n, by[124] / w,
    ]


def matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), N_STATISTICS)


@dataclass
class Trees:
    """All nodes of all trees in one row of arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            z += self.value[at]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Fit on numbers x (rows, statistics) and labels y (0 / 1)."""
    p = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
    base = float(np.log(p / (1 - p)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        for column, v in ((feature, 0), (threshold, 0.0), (left, k), (right, k), (value, 0.0)):
            column.append(v)
        return k

    def done() -> Trees:
        return Trees(np.array(roots, np.int64), np.array(feature, np.int64), np.array(threshold), np.array(left, np.int64), np.array(right, np.int64), np.array(value), base, depth)

    if len(np.unique(y)) < 2:
        return done()
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], 1)
    d = x.shape[1]
    flat = binned + np.arange(d) * BINS
    valid = np.arange(BINS - 1)[None, :] < np.array([len(c) for c in cuts])[:, None]
    z = np.full(len(y), base)
    for _ in range(trees):
        q = 1 / (1 + np.exp(-z))
        g, h = q - y, q * (1 - q)
        roots.append(node())
        at = np.full(len(y), roots[-1])
        level = [roots[-1]]
        for deep in range(depth + 1):
            nxt = []
            place = {k: i for i, k in enumerate(level)}
            slot = np.array([place.get(k, -1) for k in range(len(feature))])[at]
            live = slot >= 0
            if not live.any():
                break
            key = (slot[live, None] * d * BINS + flat[live]).ravel()
            shape = (len(level), d, BINS)
            size = len(level) * d * BINS
            hg = np.bincount(key, np.repeat(g[live], d), size).reshape(shape)
            hh = np.bincount(key, np.repeat(h[live], d), size).reshape(shape)
            for i, k in enumerate(level):
                G, H = hg[i, 0].sum(), hh[i, 0].sum()
                value[k] = -rate * G / (H + RIDGE)
                if deep == depth:
                    continue
                gl, hl = np.cumsum(hg[i], 1)[:, :-1], np.cumsum(hh[i], 1)[:, :-1]
                gain = gl**2 / (hl + RIDGE) + (G - gl) ** 2 / (H - hl + RIDGE) - G**2 / (H + RIDGE)
                gain = np.where(valid & (hl > 1.0) & (H - hl > 1.0), gain, -1.0)
                f, b = divmod(int(gain.argmax()), BINS - 1)
                if gain[f, b] <= 1e-6:
                    continue
                feature[k], threshold[k] = f, float(cuts[f][b])
                left[k], right[k] = node(), node()
                here = at == k
                at[here] = np.where(binned[here, f] <= b, left[k], right[k])
                nxt += [left[k], right[k]]
            level = nxt
            if not level:
                break
        z += np.array(value)[at]
    return done()


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Trees:
    sample = labelled_sample(spark, labels, "quality", crc_mod("doc_id", 5) != 0, limit)
    rows = fitted_rows(docs, sample)

    def run(batch) -> dict:
        x = matrix(text_bytes(batch.column("text")))
        return {"label": batch.column("label"), "x": pa.array(list(x), pa.list_(pa.float64()))}

    got = map_batches(rows, run, "label int, x array<double>").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, N_STATISTICS)
    trees = boost(x, got["label"].to_numpy().astype(float))
    del got, x
    give_back()
    return trees


def score(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score and prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batch) -> dict:
        p = shared.value.score(matrix(text_bytes(batch.column("text"))))
        return {"doc_id": batch.column("doc_id"), "score": p, "predicted": (p >= threshold).astype(np.int32)}

    out = map_batches(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int")
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score(docs, train(spark, docs, load(spark, sf_dir, "labels")))
