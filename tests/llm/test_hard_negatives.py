"""Hard negatives against all scores, on vectors with nulls, odd numbers, ties, repeated rows and ids."""

import math

import numpy as np
import pytest

from labormart.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id long, score double"


def table(seed, clusters):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(clusters, 8))
    rows = []
    for i in range(600):
        c = int(r.integers(clusters))
        v = centre[c] + r.normal(size=8) * r.choice([0.01, 0.3])
        rows.append((i if i < 500 else None if i < 510 else int(r.integers(500)), [float(np.float32(x)) for x in v], int(r.integers(3)), 1, 0.5))
    rows[7] = (7, None, 1, 1, 0.5)
    rows[8] = (8, [1.0, None] + [0.0] * 6, 1, 1, 0.5)
    rows[9] = (9, [1.0, math.nan] + [0.0] * 6, 1, 1, 0.5)
    rows[10] = (10, [math.inf] + [0.0] * 7, 1, 1, 0.5)
    rows[11] = (11, rows[12][1], None, 1, 0.5)
    rows[13] = (13, [], 0, 1, 0.5)
    rows[14] = (14, rows[12][1][:3], 0, 1, 0.5)
    rows[15] = (15, [0.0] * 8, 2, 1, 0.5)
    rows[100] = (100, [0.0] * 8, 2, 1, 0.5)
    return rows + [rows[200], rows[201], rows[300]] + [(700 + i, rows[201][1], 1, 1, 0.5) for i in range(40)]


def expected(rows, every=100):
    good = []
    for i, v, label, *_ in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (i, label, v) in enumerate(good):
        if i is None or i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), math.inf if j is None else j, j, other) for b, (j, other, w) in enumerate(good) if b != a]
        scored.sort(key=lambda x: x[:2])
        for p in [x for x in scored if x[3] == label][:5]:
            hits = [x for x in scored if x[3] != label and -80 * p[0] <= -100 * x[0] <= -100 * p[0]][:5]
            out += [(i, p[2], k, x[2], -p[0], -x[0]) for k, x in enumerate(hits, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "every"), [(1, 100), (2, 7)])
def test_mine(spark, seed, every):
    rows = table(seed, 12)
    got = H.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), every).drop("pos")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, every)


def test_passes_and_blocks(spark, monkeypatch):
    """Several passes give the rows of one."""
    rows = table(3, 5)
    monkeypatch.setattr(H, "PASS_BYTES", 1)
    monkeypatch.setattr(H, "BLOCK", 16)
    got = H.mine(spark.createDataFrame(rows, SCHEMA), 5).drop("pos")
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, 5)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.mine(none).count() == 0
    assert H.mine(spark.createDataFrame([(1, [1.0], 1, 1, 0.5)], SCHEMA)).count() == 0
    assert H.mine(spark.createDataFrame([(100, [1.0], 1, 1, 0.5)], SCHEMA)).count() == 0


def test_bounds_save_scores():
    """Candidates far from a window are not scored: close anchors, so short edges."""
    r = np.random.default_rng(4)
    own = (1000 * r.normal(size=16))[None] + r.normal(size=(64, 16)) * 10
    v = np.floor(np.concatenate((own, r.normal(size=(2000, 16)) * 1000))).astype(np.int64)
    order, parent, edge = H.spanning_tree(v[:64].astype(float))
    place = np.argsort(order)
    tree = H.Tree({"uid": order, "vec_id": order, "label": np.zeros(64), "v": v[:64][order].tobytes(),
                   "parent": [int(place[p]) if p >= 0 else -1 for p in parent[order]], "edge": edge[order].tolist()})
    rows = {"uid": np.arange(len(v)), "vec_id": np.arange(len(v)), "label": np.zeros(len(v), np.int64), "v": v, "norm": np.sqrt((v.astype(float) ** 2).sum(1))}
    least = int(np.sort(v @ v[0])[-20])
    seen = {}
    scored = tree.scan(rows, lambda a, low, high: high >= least, lambda a, which, s: seen.__setitem__(a, dict(zip(which.tolist(), s.tolist(), strict=True))))
    for a, u in enumerate(order.tolist()):
        s = v @ v[u]
        assert {i: x for i, x in seen[a].items() if x >= least} == {i: int(s[i]) for i in np.flatnonzero(s >= least)}
    assert scored < 0.2 * 64 * len(v)


def test_oracle(spark):
    import duckdb

    path = "/root/testdata/sf0.001/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = sorted(con.execute(H.ORACLE).fetchall())
    got = sorted(map(tuple, H.negatives_query(spark, "/root/testdata/sf0.001").collect()))
    assert got == want and len(got) > 0
