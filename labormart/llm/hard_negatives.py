"""Hard-negative mining by anchor spanning-tree bounds.

Rows take part whose label and vector are there and whose components are all finite numbers; a component
x becomes floor(256 * x), shorter vectors are read as if padded with zeros. The score of a row for an anchor is
their integer inner product (exact up to 2^63 in size). An anchor's positives are the ``POSITIVES`` first other
rows of its label; for each positive, the negatives are the first ``NEGATIVES`` rows of other labels whose score is
80 to 100 hundredths of the positive's. Higher scores come first, then smaller ids (nulls last), then the
rows' own numbers: repeated rows are separate rows.

Anchors are dealt by label into blocks of up to ``BLOCK``, and each block is joined into a minimum spanning
tree by the distance of its vectors. Against a batch of candidates, the root is scored exactly; a child's score
lies within edge length times the candidate's norm of its parent's, so a candidate's bounds are handed down the
tree, and only candidates whose bounds overlap a window are scored anew, which makes their bounds exact.
The window of the positives is what reaches the least of the best found so far; a negative's window is its
positive's range, cut off below in the same way.

All anchors are asked of all rows, in passes: a pass broadcasts at most ``PASS_BYTES`` of trees, and each task
streams its rows by and keeps a few rows per anchor. Nulls and non-finite components leave a row out; a row without
an id is a candidate, never an anchor; an empty table, or one without anchors, gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labormart.llm.common import _array, _arrow_schema, load, materialize, ship_package
from labormart.session import scratch_path

POSITIVES, NEGATIVES = 5, 5
#: Hundredths of the positive's score that a negative reaches at least.
LEAST = 80
BLOCK, BATCH, PASS_BYTES, ROWS_PER_TASK = 512, 4096, 16 << 20, 1 << 16
_LAST_ID = np.iinfo(np.int64).max
_KINDS = {"trees": "tree int, uid array<long>, vec_id array<long>, label array<long>, v binary, parent array<int>, edge array<double>",
          "positives": "auid long, anchor_id long, vec_id long, uid long, score long",
          "negatives": "auid long, anchor_id long, pos int, positive_id long, positive_score long, vec_id long, uid long, score long"}


def prepare(embeddings: DataFrame) -> DataFrame:
    """(uid, vec_id, label, v) of the rows that take part: whole-number components, shifted labels."""
    good = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & good)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))
    return rows


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree by distance (Prim): order of joining, parent and edge length per vector."""
    n = len(v)
    near, parent, order = np.full(n, np.inf), np.full(n, -1), []
    outside = np.ones(n, bool)
    at = 0
    for _ in range(n):
        order.append(at)
        outside[at] = False
        distance = ((v - v[at]) ** 2).sum(1)
        closer = outside & (distance < near)
        near[closer], parent[closer] = distance[closer], at
        at = int(np.argmin(np.where(outside, near, np.inf)))
    near[0] = 0
    return np.array(order), parent, np.sqrt(near)


class Best:
    """The first ``k`` of the rows seen so far, and the score that the next one must reach."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, -np.inf
        self.score, self.vec_id, self.uid = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score, vec_id, uid) -> None:
        s, i, u = np.concatenate((self.score, score)), np.concatenate((self.vec_id, vec_id)), np.concatenate((self.uid, uid))
        first = np.lexsort((u, i, -s))[: self.k]
        self.score, self.vec_id, self.uid = s[first], i[first], u[first]
        if len(first) == self.k:
            self.least = int(self.score[-1])


class Tree:
    """A block of anchors with its spanning tree, in the order in which vectors joined it."""

    def __init__(self, row: dict) -> None:
        self.uid, self.vec_id, self.label = (np.array(row[k], np.int64) for k in ("uid", "vec_id", "label"))
        self.v = np.frombuffer(row["v"], np.int64).reshape(len(self.uid), -1)
        self.parent, self.edge = row["parent"], row["edge"]
        self.children = np.bincount([p for p in self.parent if p >= 0], minlength=len(self.uid))
        self.norm = float(np.sqrt((self.v.astype(float) ** 2).sum(1).max(initial=0)))

    def scan(self, rows: dict, wanted, found) -> int:
        """Hand bounds down the tree over one batch. ``wanted(a, low, high)`` says which candidates of anchor
        a overlap its windows, ``found(a, which, scores)`` gets their exact scores. Returns how many were scored."""
        v, norm = rows["v"], rows["norm"]
        width = max(v.shape[1], self.v.shape[1])
        v, own = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (v, self.v))
        # Products below 2^53 are exact as doubles, and much faster.
        exact = self.norm * float(norm.max(initial=0)) < 2.0**52
        v, own = (v.astype(float), own.astype(float)) if exact else (v, own)
        # The bounds are widened by more than the rounding of norms and edges.
        reach, slack = norm * (1 + 1e-9), 1 + self.norm * norm * 1e-9
        bounds, left, scored = {}, self.children.copy(), 0
        for a in range(len(own)):
            p = self.parent[a]
            if p < 0:
                which = np.arange(len(v))
                low = high = None
            else:
                low, high = bounds[p]
                low, high = low - (reach * self.edge[a] + slack), high + (reach * self.edge[a] + slack)
                which = np.flatnonzero(wanted(a, low, high))
                left[p] -= 1
                if not left[p]:
                    del bounds[p]
            s = (v @ own[a])[which] if 2 * len(which) > len(v) else v[which] @ own[a]
            scored += len(which)
            if low is None:
                low, high = s.astype(float), s.astype(float)
                keep = wanted(a, low, high)
                found(a, which[keep], s[keep].astype(np.int64))
            else:
                low[which] = high[which] = s
                found(a, which, s.astype(np.int64))
            if left[a]:
                bounds[a] = low, high
        return scored


def trees(anchors: DataFrame, blocks: int) -> DataFrame:
    """Blocks of anchors by label, each with its spanning tree; ``tree`` is the number of its range."""
    ship_package(anchors.sparkSession)
    kind = _arrow_schema(_KINDS["trees"])

    def build(batches):
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        for i in range(0, table.num_rows if table else 0, BLOCK):
            rows = columns(table.slice(i, BLOCK))
            order, parent, edge = spanning_tree(rows["v"].astype(float))
            place = np.empty(len(order), int)
            place[order] = np.arange(len(order))
            up = [int(place[p]) if p >= 0 else -1 for p in parent[order].tolist()]
            cols = {"tree": [TaskContext.get().partitionId()], **{k: [rows[k][order].tolist()] for k in ("uid", "vec_id", "label")},
                    "v": [np.ascontiguousarray(rows["v"][order]).tobytes()], "parent": [up], "edge": [edge[order].tolist()]}
            yield pa.RecordBatch.from_arrays([_array(cols[f.name], f.type) for f in kind], schema=kind)

    dealt = anchors.repartitionByRange(blocks, "label", "uid").sortWithinPartitions("label", "uid")
    return materialize(dealt.mapInArrow(build, _KINDS["trees"]), "negatives-trees")


def columns(table) -> dict:
    """Rows as arrays; shorter vectors are padded, null ids are largest."""
    v = table["v"]
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    size = np.diff(v.offsets.to_numpy())
    flat, width = v.flatten().to_numpy(zero_copy_only=False), int(size.max(initial=0))
    if len(size) and size.min() == width:
        dense = flat.reshape(len(size), width)
    else:
        dense = np.zeros((len(size), width), np.int64)
        dense[np.arange(width)[None, :] < size[:, None]] = flat
    ids = table["vec_id"].fill_null(_LAST_ID) if hasattr(table["vec_id"], "fill_null") else table["vec_id"]
    return {"uid": table["uid"].to_numpy(), "label": table["label"].to_numpy(), "vec_id": ids.to_numpy(), "v": dense,
            "norm": np.sqrt((dense.astype(float) ** 2).sum(1))}


def _batches(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, BATCH):
            yield columns(pa.Table.from_batches([batch.slice(i, BATCH)]).combine_chunks())


def find_positives(forest: list[Tree], batches) -> dict:
    """The first positives of every anchor among these rows."""
    best = [[Best(POSITIVES) for _ in t.uid] for t in forest]
    for rows in batches:
        for t, own in zip(forest, best, strict=True):
            def wanted(a, low, high, t=t, own=own):
                return (high >= own[a].least) & (rows["label"] == t.label[a]) & (rows["uid"] != t.uid[a])

            def found(a, which, s, own=own):
                own[a].add(s, rows["vec_id"][which], rows["uid"][which])

            t.scan(rows, wanted, found)
    out = [(t.uid[a], t.vec_id[a], b) for t, own in zip(forest, best, strict=True) for a, b in enumerate(own) if len(b.uid)]
    n = [len(b.uid) for *_, b in out]
    many = lambda k: np.concatenate([getattr(b, k) for *_, b in out]) if out else np.zeros(0, np.int64)
    return {"auid": np.repeat([u for u, *_ in out], n).astype(np.int64), "anchor_id": np.repeat([i for _, i, _ in out], n).astype(np.int64),
            **{k: many(k) for k in ("vec_id", "uid", "score")}}


def find_negatives(forest: list[Tree], positives: dict, batches) -> dict:
    """The first negatives of every anchor and positive among these rows. ``positives``: per anchor's uid
    a list of (number, id, score)."""
    best: dict = {}
    windows: dict = {}
    for t in forest:
        for u in t.uid.tolist():
            # A negative score has an empty range: 80 hundredths of it are more than all of it.
            windows[u] = [(p, i, s, -(-LEAST * s // 100)) for p, i, s in positives.get(u, []) if s >= 0]
            for p, *_ in windows[u]:
                best[u, p] = Best(NEGATIVES)
    for rows in batches:
        for t in forest:
            uid = t.uid.tolist()

            def wanted(a, low, high, t=t, uid=uid):
                near = np.zeros(len(low), bool)
                for p, _, s, least in windows[uid[a]]:
                    near |= (high >= max(least, best[uid[a], p].least)) & (low <= s)
                return near & (rows["label"] != t.label[a])

            def found(a, which, scores, uid=uid):
                for p, _, s, least in windows[uid[a]]:
                    own = best[uid[a], p]
                    here = (scores <= s) & (scores >= max(least, own.least))
                    if here.any():
                        own.add(scores[here], rows["vec_id"][which[here]], rows["uid"][which[here]])

            t.scan(rows, wanted, found)
    name = {u: i for t in forest for u, i in zip(t.uid.tolist(), t.vec_id.tolist(), strict=True)}
    out: dict = {k: [] for k in ("auid", "anchor_id", "pos", "positive_id", "positive_score", "vec_id", "uid", "score")}
    for u, held in windows.items():
        for p, i, s, _ in held:
            b = best[u, p]
            for k, x in (("auid", u), ("anchor_id", name[u]), ("pos", p), ("positive_id", i), ("positive_score", s)):
                out[k] += [x] * len(b.uid)
            for k in ("vec_id", "uid", "score"):
                out[k] += getattr(b, k).tolist()
    return out


def _asked(rows: DataFrame, kind: str, search) -> DataFrame:
    """``search(batches)`` over every partition of the rows; null ids come back as nulls."""
    ship_package(rows.sparkSession)
    schema = _arrow_schema(_KINDS[kind])

    def run(batches):
        cols = search(_batches(batches))
        cols["vec_id"] = pa.array([None if x == _LAST_ID else x for x in np.asarray(cols["vec_id"]).tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([_array(cols[f.name], f.type) for f in schema], schema=schema)

    return rows.mapInArrow(run, _KINDS[kind])


def _first(df: DataFrame, n: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return df.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= n)


def mine(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives of the anchors, the rows whose vec_id is divisible by ``every``: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score, and the number of the positive (``pos``, from 1)."""
    spark = embeddings.sparkSession
    rows = prepare(embeddings)
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    rows = materialize(rows.repartition(tasks).withColumn("uid", F.monotonically_increasing_id()), "negatives-rows")
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = -(-anchors.count() // BLOCK)
    forest = trees(anchors, max(1, blocks))
    # A range of anchors is about one block, and twice that at most but for ties and a poor sample.
    per_pass = max(1, PASS_BYTES // (2 * BLOCK * (8 * (dims or 0) + 64)))
    out = scratch_path(spark, "negatives-found")
    spark.createDataFrame([], _KINDS["negatives"] + ", rank int").write.parquet(f"{out}/pass=-1")
    for i in range(0, blocks, per_pass):
        here = forest.where(F.col("tree").between(i, i + per_pass - 1)).toArrow().to_pylist()
        sent = spark.sparkContext.broadcast([Tree(x) for x in here])
        mine_ = _asked(rows, "positives", lambda batches, sent=sent: find_positives(sent.value, batches))
        first = _first(mine_, POSITIVES, "auid").orderBy("auid", "rank").toArrow().to_pylist()
        known: dict = {}
        for r in first:
            known.setdefault(r["auid"], []).append((r["rank"], r["vec_id"], r["score"]))
        asked = spark.sparkContext.broadcast(known)
        found = _asked(rows, "negatives", lambda batches, sent=sent, asked=asked: find_negatives(sent.value, asked.value, batches))
        _first(found, NEGATIVES, "auid", "pos").write.parquet(f"{out}/pass={i}")
        sent.destroy()
        asked.destroy()
    found = spark.read.schema(_KINDS["negatives"] + ", rank int").parquet(out)
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), "pos")


def negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(load(spark, sf_dir, "embeddings")).drop("pos")


#: The same rows in DuckDB: every anchor's scores against all rows.
ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.uid AS auid, a.vec_id AS anchor_id, c.uid, c.vec_id, a.label = c.label AS same, list_dot_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.uid <> c.uid WHERE a.vec_id % 100 = 0
), p AS (
  SELECT auid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY auid ORDER BY score DESC, vec_id NULLS LAST) AS pos
  FROM s WHERE same QUALIFY pos <= 5
), f AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.auid, p.pos ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank,
         s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON p.auid = s.auid AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM f WHERE rank <= 5
"""
