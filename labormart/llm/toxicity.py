"""Toxicity: linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed n-grams of characters (``ORDERS`` code points) of the lower-cased text, counted once
per text. From a bounded, documented sample of labelled rows (``SAMPLE``) come the documents per n-gram and
class; their smoothed log ratio r scales the feature. The n-grams whose counts differ most between the
classes (likelihood ratio), ``FEATURES`` at most and ``PER_ROW`` per fitted row, enter a logistic regression
on the scaled features. Counts and ratios stay in Spark; the driver gets the chosen n-grams alone.

A null text is an empty text; a text without any learnt n-gram gets the score of the intercept;
without labels of both classes every score is the share of label 1 (0 without labels). Labels that
are null or of no document are not used; of several labels of one document the larger counts, and of
several rows of one labelled id the least text. Repeated rows are scored each on its own; ``held_out`` is
null for a null id. Only doc_id and text of the documents are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.common import SLICE, constants, crc_mod, fitted_rows, give_back, labelled_sample, load, map_batches, ship_package

# Orders, features per row and ridge were chosen on a fold of the training rows.
ORDERS = (4, 5, 6)
BITS = 20
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
FEATURES, PER_ROW = 4096, 2 / 3
THRESHOLD = 0.3
_K = (constants(max(ORDERS), 5) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_STEP = 1 << 16


def texts_of(column) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def gram_slots(text: str) -> np.ndarray:
    """Slots (0 .. 2^BITS) of all n-grams of a lower-cased text; repeats stay."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for n in ORDERS:
        m = len(raw) - n + 1
        if m > 0:
            h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                h += (raw[j : j + m] + np.uint32(1)) * _K[j]
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x85EBCA6B)
            out.append(h >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def present(text: str, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct slots of a text between two blanks, ``wanted`` ones only; long texts go by overlapping pieces."""
    found, text = [], f" {text.lower()} "
    for at in range(0, len(text), _STEP):
        s = gram_slots(text[at : at + _STEP + max(ORDERS) - 1])
        found.append(s if wanted is None else s[wanted[s]])
    return np.unique(np.concatenate(found))


@dataclass
class Model:
    slots: np.ndarray  # chosen slots, sorted
    weights: np.ndarray  # per chosen slot: regression weight times log-count ratio
    intercept: float
    used: np.ndarray | None = field(default=None, repr=False)

    def score(self, texts: list[str]) -> np.ndarray:
        if self.used is None:
            self.used = chosen(self.slots)
        z = np.array([self.intercept + float(self.weights[np.searchsorted(self.slots, present(t, self.used))].sum()) for t in texts])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def chosen(slots: np.ndarray) -> np.ndarray:
    used = np.zeros(1 << BITS, bool)
    used[slots] = True
    return used


def _constant(p: float) -> Model:
    p = min(max(p, 1e-9), 1 - 1e-9)
    return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(p / (1 - p))))


def class_counts(rows: DataFrame) -> DataFrame:
    """(slot, n0, n1): documents with each slot, by label."""

    def run(batches):
        n = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                for t, y in zip(texts_of(part.column("text")), part.column("label").to_pylist(), strict=True):
                    n[y, present(t)] += 1
        at = np.flatnonzero(n.any(0))
        for i in range(0, len(at), 1 << 16):
            a = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"slot": a.astype(np.int32), "n0": n[0, a].astype(np.int64), "n1": n[1, a].astype(np.int64)})
        give_back()

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, "slot int, n0 long, n1 long").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def log_ratio(t0: int, t1: int) -> Column:
    """Smoothed log ratio of the classes' shares of documents with an n-gram."""
    return F.log((F.col("n1") + 1.0) / (t1 + 2.0)) - F.log((F.col("n0") + 1.0) / (t0 + 2.0))


def likelihood_ratio(t0: int, t1: int) -> Column:
    """G statistic of 'has the n-gram' against the label."""
    share = (F.col("n0") + F.col("n1")) / float(t0 + t1)
    g = F.lit(0.0)
    for n, t in ((F.col("n0"), t0), (F.col("n1"), t1)):
        for seen, part in ((n, share), (F.lit(t) - n, 1 - share)):
            g = g + F.when(seen > 0, seen * F.log(seen / (part * float(t)))).otherwise(0.0)
    return g


def logistic(col: np.ndarray, at: np.ndarray, y: np.ndarray, r: np.ndarray, steps: int = 300, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights of features scaled by r, by full-batch Adam on the mean loss plus ridge / n. Row i has the
    features col[at[i]:at[i + 1]]."""
    n, d = len(y), len(r)
    owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(at))
    w, b = np.zeros(d), float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for k in range(1, steps + 1):
        z = b + np.bincount(owner, weights=(w * r)[col], minlength=n)
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.append(r * np.bincount(col, weights=e[owner], minlength=d) / n + ridge * w / n, e.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit(docs: DataFrame, sample: DataFrame) -> Model:
    """Model from ``sample`` (doc_id, label), which is of a bounded size and so broadcast."""
    rows = fitted_rows(docs, sample)
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    t0, t1 = totals.get(0, 0), totals.get(1, 0)
    if not t0 or not t1:
        return _constant(t1 / max(1, t0 + t1))
    most = min(FEATURES, max(1, int((t0 + t1) * PER_ROW)))
    best = class_counts(rows).select("slot", log_ratio(t0, t1).alias("r"), likelihood_ratio(t0, t1).alias("g"))
    best = best.orderBy(F.desc("g"), "slot").limit(most).select("slot", "r").toArrow().sort_by("slot")
    slots, ratio = best["slot"].to_numpy().astype(np.int64), best["r"].to_numpy()

    def run(batch) -> dict:
        used = chosen(slots)
        own = [np.searchsorted(slots, present(t, used)).astype(np.int16) for t in texts_of(batch.column("text"))]
        return {"label": batch.column("label"), "x": pa.array(own, pa.list_(pa.int16()))}

    got = map_batches(rows.select("label", "text"), run, "label int, x array<short>").toArrow()
    x = got["x"].combine_chunks()
    w, b = logistic(x.flatten().to_numpy(), x.offsets.to_numpy() - x.offsets[0].as_py(), got["label"].to_numpy().astype(float), ratio)
    del got, x
    give_back()
    return Model(slots, w * ratio, b)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    return fit(docs, labelled_sample(spark, labels, "toxic", crc_mod("doc_id", 4) != 2, limit))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score and prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch) -> dict:
        p = shared.value.score(texts_of(batch.column("text")))
        return {"doc_id": batch.column("doc_id"), "score": p, "predicted": (p >= threshold).astype(np.int32)}

    out = map_batches(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int")
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch) -> dict:
        kept = batch.filter(pa.array(shared.value.score(texts_of(batch.column("text"))) < threshold))
        return {name: kept.column(i) for i, name in enumerate(kept.schema.names)}

    return map_batches(docs, run, docs.schema)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score(docs, train(spark, docs, load(spark, sf_dir, "labels")))
