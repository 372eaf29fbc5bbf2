"""Hot keys: one group holding well over a third of all rows. Results must stay exact, and
plans must pre-aggregate before the shuffle."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from labormart.operators import aggregates as A
from labormart.operators import distribution as D
from labormart.operators.clean import dedup_first


def _skewed(spark, n=6000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        area = "HOT" if i % 5 < 3 else (None if i % 5 == 3 else f"A{i % 11}")
        rows.append((str(i), area, rnd.randint(1, 2000) * 100 if i % 17 else 0))
    df = spark.createDataFrame(rows, "id STRING, area_name STRING, salary_from BIGINT")
    return rows, df.withColumn("salary_to", F.col("salary_from") + 1000)


def _nearest(vals):
    s = sorted(vals)
    return float(s[int((len(s) - 1) * 0.5 + 0.5)])


def _linear(vals, p):
    s = sorted(vals)
    pos = (len(s) - 1) * p
    lo, hi = int(pos // 1), -int(-pos // 1)
    return s[lo] + (pos - lo) * (s[hi] - s[lo])


def test_exact_medians_under_skew(spark):
    rows, df = _skewed(spark)
    by = {}
    for _, a, v in rows:
        if v > 0:
            by.setdefault(a, []).append(v)
    got = {r.area_name: r.median for r in D.median_nearest(df).collect()}
    assert got == {a: _nearest(v) for a, v in by.items()}
    cont = {r.area_name: r.median_salary for r in D.median_by_area(df, min_count=5).collect()}
    want = {a: _linear(v, 0.5) for a, v in by.items() if a is not None and len(v) >= 5}
    assert cont.keys() == want.keys()
    assert all(cont[a] == pytest.approx(want[a]) for a in want)
    builtin = {r.area_name: r.median_salary
               for r in D.median_by_area(df, min_count=5, method="builtin").collect()}
    assert all(builtin[a] == pytest.approx(want[a]) for a in want)


def test_quantiles_with_few_buckets_and_ties(spark):
    rows = [("g", v) for v in [5] * 500 + list(range(1, 300)) + [7] * 200] + [(None, 3), (None, 9)]
    df = spark.createDataFrame(rows, "k STRING, v BIGINT")
    q = {r.k: (r.n, r.q0, r.q1, r.q2) for r in
         D.exact_quantiles(df, ["k"], "v", [0.1, 0.5, 0.99]).collect()}
    vals = [v for k, v in rows if k == "g"]
    assert q["g"] == (len(vals), _linear(vals, 0.1), _linear(vals, 0.5), _linear(vals, 0.99))
    assert q[None] == (2, 3.6, 6.0, 8.94)


def test_box_matches_brute_force(spark):
    rows, df = _skewed(spark)
    box = {r.area_name: r for r in D.salary_box(df, n=3).collect()}
    vals = [v for _, a, v in rows if a == "HOT" and v > 0]
    hot = box["HOT"]
    q1, q3 = _linear(vals, 0.25), _linear(vals, 0.75)
    assert (hot["count"], hot["min"], hot["max"]) == (len(vals), min(vals), max(vals))
    assert hot.q1 == pytest.approx(q1) and hot.q3 == pytest.approx(q3)
    assert hot.median == pytest.approx(statistics.median(vals))
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert hot.outliers == sum(1 for v in vals if v < lo or v > hi)


def test_dedup_hot_id(spark):
    rows = [("same", f"2025-01-01T00:00:{i % 60:02d}Z", i) for i in range(3000)] + \
           [(str(i), "2025-01-01T00:00:00Z", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "id STRING, collected_at STRING, x INT")
    out = dedup_first(df)
    assert out.count() == 2001
    kept = out.filter("id = 'same'").first()
    assert kept.collected_at == "2025-01-01T00:00:00Z" and kept.x % 60 == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partial_aggregation_before_shuffle(spark):
    _, df = _skewed(spark)
    for q in (A.aggregate_by_area(df), A.top_areas(df), dedup_first(df)):
        p = _plan(q)
        assert "partial_" in p and "Exchange" in p
    assert "partial_count" in _plan(D.value_counts(df, ["area_name"], "salary_from"))  # what the medians begin with
    p = _plan(D.median_nearest(df))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_a_hot_group_of_near_values_is_ranked_in_many_tasks(spark):
    """Nine tenths of the rows in one group, all values within one part in a thousand (and below one):
    its values go to many ranges, none of which is large, and the ranks are exact."""
    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") % 10 < 9, "HOT").otherwise(F.concat(F.lit("A"), F.col("id") % 7)).alias("k"),
                               (0.5 + F.pmod(F.col("id") * 7919, F.lit(n)) / 1e8).alias("v"))
    pairs = D.value_counts(df, ["k"], "v")
    targets = lambda n: [("lo", F.lit(1)), ("mid", F.floor((n + 1) / 2)), ("hi", n)]
    ranked = D.rank_counted(pairs, ["k"], "v", targets, ranges=16)
    by = {}
    for r in df.collect():
        by.setdefault(r.k, []).append(r.v)
    want = {(k, name, sorted(v)[i - 1]) for k, v in by.items() for name, i in (("lo", 1), ("mid", (len(v) + 1) // 2), ("hi", len(v)))}
    assert {(r.k, r._name, r._value) for r in ranked.collect()} == want
    dealt = pairs.repartitionByRange(16, "k", "v").groupBy("k", F.spark_partition_id().alias("p")).count().collect()
    hot = [r["count"] for r in dealt if r.k == "HOT"]
    assert len(hot) >= 12 and max(hot) < 3 * n / 16
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan.split("Window")[0]  # the last ranking is by group and range


def test_nearest_median_by_builtin(spark):
    rows, df = _skewed(spark, n=700)
    a, b = ({r.area_name: r.median for r in D.median_nearest(df, method=m).collect()} for m in ("ranks", "builtin"))
    assert a == b and len(a) > 5
