"""Salary distributions: bands, medians, histogram, box summary, top-area rows
(A4, A5, A13, A14, A16-A18, J1).

Exact medians and quartiles are computed by :func:`rank_values`: counts per (group, value) are dealt
by ranges of (group, value), sums per (group, range) tell which range holds each target rank, and only
that range is ranked. A group holding a third of all rows is therefore spread over the cluster by
value, however close its values lie, instead of being merged in one task, which is what Spark's
``percentile`` aggregate would do (kept as ``method="builtin"``; ``"approx"`` is ``percentile_approx``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labormart.functions import band
from labormart.schema import SALARY_BANDS_4, SALARY_BANDS_5
from labormart.session import written


def salary_distribution(df: DataFrame, s_from: str = "salary_from",
                        bands: Sequence[tuple[int | None, str]] = SALARY_BANDS_5) -> DataFrame:
    """Rows with salary > 0 per band, bands ordered by their smallest salary."""
    g = (df.filter(F.col(s_from) > 0)
           .groupBy(band(s_from, bands).alias("salary_range"))
           .agg(F.count(F.lit(1)).alias("count"), F.min(s_from).alias("_lo")))
    return g.orderBy("_lo").drop("_lo")


def salary_distribution4(df: DataFrame, s_from: str = "salary_from") -> DataFrame:
    """The four-band form with ``range``/``cnt`` columns."""
    return (salary_distribution(df, s_from, SALARY_BANDS_4)
            .withColumnsRenamed({"salary_range": "range", "count": "cnt"}))


def median_by_area(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
                   min_count: int = 5, method: str = "ranks", with_count: bool = True,
                   median_name: str = "median_salary") -> DataFrame:
    """Interpolated median of salary > 0 per non-null area, groups with at least
    ``min_count`` rows, median descending.

    ``method``: ``"ranks"`` (exact, distributed: :func:`exact_quantiles`), ``"builtin"``
    (Spark's exact ``percentile``: one task merges a group's value counts) or ``"approx"``
    (``percentile_approx``)."""
    base = df.filter((F.col(s_from) > 0) & F.col(area).isNotNull())
    if method == "ranks":
        g = (exact_quantiles(base, [area], s_from, [0.5])
             .select(area, F.col("q0").alias(median_name), F.col("n").alias("count"))
             .filter(F.col("count") >= min_count))
    elif method in ("builtin", "approx"):
        m = (F.percentile_approx(s_from, 0.5, 100000) if method == "approx"
             else F.percentile(s_from, 0.5))
        g = (base.groupBy(area).agg(m.cast("double").alias(median_name),
                                    F.count(F.lit(1)).alias("count"))
                 .filter(F.col("count") >= min_count))
    else:
        raise ValueError(f"unknown method {method!r}")
    g = g.select(area, median_name, "count")
    if not with_count:
        g = g.drop("count")
    return g.orderBy(F.col(median_name).desc_nulls_last(), F.col(area).asc_nulls_last())


def _join_ns(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
             ) -> DataFrame:
    """Equi-join on ``keys`` where null equals null (a null group is still a group)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows per (group, value) as ``_c``: a partial aggregate whose shuffle spreads even a huge
    group over all reducers by value."""
    return df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c"))


def rank_values(df: DataFrame, group: Sequence[str], value: str,
                targets: Callable[[Column], list[tuple[str, Column]]]) -> DataFrame:
    """Exact values at given ranks inside each group, without sending a group to one task.

    ``targets(n)`` maps the group size to named 1-based ranks. Output: group columns, ``_name``,
    ``_k``, ``_value`` (the k-th smallest, ties repeated) and ``_n`` (the group size); the
    leading underscores keep them apart from any group column. Null values are no values.

    1. rows are counted per (group, value);
    2. the counts are sorted by ranges of (group, value), as an ``orderBy`` would deal them, and written
       with the number of their range: a range holds a bounded number of distinct values, and a group
       goes to as many ranges as its values fill;
    3. running sums over the ranges of a group find the range of each rank;
    4. the ranges that hold a rank are ranked, each by itself.
    """
    return rank_counted(value_counts(df, group, value), group, value, targets)


def rank_counted(pairs: DataFrame, group: Sequence[str], value: str,
                 targets: Callable[[Column], list[tuple[str, Column]]],
                 ranges: int | None = None) -> DataFrame:
    """:func:`rank_values` from the counts of :func:`value_counts`. ``ranges``: their number (default: the
    shuffle's width, coalesced by AQE where the counts are few). Runs a job: the ranges are written."""
    g = list(group)
    pairs = pairs.filter(F.col(value).isNotNull()).select(*g, value, "_c")
    dealt = pairs.repartitionByRange(ranges, *g, value) if ranges else pairs.repartitionByRange(*g, value)
    dealt = written(dealt.withColumn("_p", F.spark_partition_id()), "ranks")
    within = [*g, "_p"]
    whole = Window.partitionBy(*g)  # of the sums: one row per range of a group
    sums = dealt.groupBy(*within).agg(F.sum("_c").alias("_pc")).select(
        *within, "_pc", F.sum("_pc").over(whole).alias("_n"), F.sum("_pc").over(
            whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"))
    wanted = sums.select("*", F.inline(F.array(*[
        F.struct(F.lit(name).alias("_name"), k.cast("bigint").alias("_k"))
        for name, k in targets(F.col("_n"))])))
    before = F.col("_upto") - F.col("_pc")
    wanted = wanted.filter((F.col("_upto") >= F.col("_k")) & (before < F.col("_k")))
    # A row per range that holds a rank, with a list of at most all targets.
    wanted = wanted.groupBy(*within).agg(F.collect_list(F.struct(
        "_name", "_k", "_n", (F.col("_k") - before).alias("_in"))).alias("_want"))
    inside = Window.partitionBy(*within).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hit = (_join_ns(dealt, wanted, within).withColumn("_cum", F.sum("_c").over(inside))
           .select("*", F.inline("_want"))
           .filter((F.col("_cum") >= F.col("_in")) & (F.col("_cum") - F.col("_c") < F.col("_in"))))
    return hit.select(*g, "_name", "_k", F.col(value).alias("_value"), "_n")


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles (as ``percentile`` / ``percentile_cont``) per group,
    computed from exact ranks: position p·(n-1), interpolated between its floor and ceiling.
    Output: group columns, ``n`` and one DOUBLE column ``q<i>`` per probability."""
    return quantiles_counted(value_counts(df, group, value), group, value, probs)


def quantiles_counted(pairs: DataFrame, group: Sequence[str], value: str, probs: Sequence[float],
                      ranges: int | None = None) -> DataFrame:
    """:func:`exact_quantiles` from the counts of :func:`value_counts`."""
    def targets(n):
        out = []
        for i, p in enumerate(probs):
            pos = (n - 1) * p
            out += [(f"lo{i}", F.floor(pos) + 1), (f"hi{i}", F.ceil(pos) + 1)]
        return out

    vals = rank_counted(pairs, group, value, targets, ranges)
    aggs = [F.max(F.when(F.col("_name") == nm, F.col("_value"))).alias(f"_{nm}")
            for i in range(len(probs)) for nm in (f"lo{i}", f"hi{i}")]
    wide = vals.groupBy(*group).agg(F.max("_n").alias("_n"), *aggs)
    cols = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * p
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        cols.append((lo + frac * (hi - lo)).alias(f"q{i}"))
    return wide.select(*group, F.col("_n").alias("n"), *cols)


def median_nearest(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
                   method: str = "ranks") -> DataFrame:
    """Nearest-rank median of salary > 0 per area (null area kept), no minimum count.

    The picked rank is ``floor((n - 1) * 0.5 + 0.5) + 1``: the middle value, the upper middle
    one for even ``n``. Exact, via :func:`rank_values` (no group is ranked in one task), or with
    ``method="builtin"`` by Spark's ``percentile_disc`` from above, where one task merges a group.
    """
    pos = df.filter(F.col(s_from) > 0)
    if method == "builtin":
        # Of the values in descending order, the first whose share of the rows reaches one half.
        upper = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{s_from}` DESC)")
        return (pos.groupBy(area).agg(upper.cast("double").alias("median"))
                .orderBy(F.col("median").desc(), F.col(area).asc_nulls_last()))
    if method != "ranks":
        raise ValueError(f"unknown method {method!r}")
    picked = rank_values(pos, [area], s_from,
                         lambda n: [("median", F.floor((n - 1) * 0.5 + 0.5) + 1)])
    return (picked.select(area, F.col("_value").cast("double").alias("median"))
                  .orderBy(F.col("median").desc(), F.col(area).asc_nulls_last()))


def salary_histogram(df: DataFrame, s_from: str = "salary_from", bins: int = 30) -> DataFrame:
    """Equal-width histogram of salary > 0 between its min and max; the top edge falls in
    the last bin. Min and max are scalar subqueries (one merged aggregate, no join)."""
    pos = df.filter(F.col(s_from) > 0)
    stats = pos.agg(F.min(s_from).alias("mn"), F.max(s_from).alias("mx"))
    mn = stats.select("mn").scalar()
    mx = stats.select("mx").scalar()
    width = (mx - mn) / F.lit(float(bins))
    idx = F.when(width > 0, F.least(F.floor((F.col(s_from) - mn) / width),
                                    F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    g = pos.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return (g.select("bin",
                     (mn + F.col("bin") * width).cast("double").alias("bin_start"),
                     (mn + (F.col("bin") + 1) * width).cast("double").alias("bin_end"),
                     "count")
             .orderBy("bin"))


def top_areas_by_salaried(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
                          n: int = 10) -> DataFrame:
    """The ``n`` areas with most rows having salary > 0 (at most ``n`` rows)."""
    return (df.filter(F.col(s_from) > 0).groupBy(area).agg(F.count(F.lit(1)).alias("_n"))
              .orderBy(F.col("_n").desc(), F.col(area).asc_nulls_last())
              .limit(n).select(area))


def top_area_rows(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
                  n: int = 10) -> DataFrame:
    """Rows with salary > 0 whose area is among the top ``n`` (null area never matches).

    The top list has at most ``n`` rows, so broadcasting it is safe at any input size.
    """
    top = top_areas_by_salaried(df, area, s_from, n)
    return df.filter(F.col(s_from) > 0).join(F.broadcast(top), area, "left_semi")


def salary_box(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
               n: int = 10, method: str = "ranks") -> DataFrame:
    """Box summary per top-``n`` area: min, quartiles (linear), max, 1.5·IQR fences and
    the number of points outside them. ``method`` as in :func:`median_by_area`."""
    # top areas, quartiles and outliers all come from the rows per (area, value)
    pairs = value_counts(df.filter(F.col(s_from) > 0), [area], s_from)
    top = (pairs.groupBy(area).agg(F.sum("_c").alias("_n"))
           .orderBy(F.col("_n").desc(), F.col(area).asc_nulls_last()).limit(n).select(area))
    pairs = pairs.join(F.broadcast(top), area, "left_semi")  # at most n rows
    if method == "ranks":
        # min and max are ranks 1 and n of the same exact rank selection as the quartiles
        q = quantiles_counted(pairs, [area], s_from, [0.0, 0.25, 0.5, 0.75, 1.0])
        stats = q.select(area, F.col("n").alias("count"), F.col("q0").cast("bigint").alias("min"),
                         F.col("q4").cast("bigint").alias("max"), F.col("q1").alias("q1"),
                         F.col("q2").alias("median"), F.col("q3").alias("q3"))
    elif method in ("builtin", "approx"):
        rows = top_area_rows(df, area, s_from, n)
        basic = rows.groupBy(area).agg(F.count(F.lit(1)).alias("count"),
                                       F.min(s_from).alias("min"), F.max(s_from).alias("max"))
        qa = (F.percentile_approx(s_from, [0.25, 0.5, 0.75], 100000) if method == "approx"
              else F.percentile(s_from, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
        stats = basic.join(rows.groupBy(area).agg(qa.alias("_q")), area).select(
            area, "count", "min", "max", F.col("_q")[0].cast("double").alias("q1"),
            F.col("_q")[1].cast("double").alias("median"), F.col("_q")[2].cast("double").alias("q3"))
    else:
        raise ValueError(f"unknown method {method!r}")
    stats = (stats.select(area, "count", "min", "q1", "median", "q3", "max")
                  .withColumn("lower_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
                  .withColumn("upper_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    # stats has one row per top area (at most n): a bounded broadcast.
    outside = (F.col(s_from) < F.col("lower_fence")) | (F.col(s_from) > F.col("upper_fence"))
    out_cnt = (pairs.join(F.broadcast(stats.select(area, "lower_fence", "upper_fence")), area)
                    .groupBy(area)
                    .agg(F.sum(F.when(outside, F.col("_c")).otherwise(0)).alias("outliers")))
    return (stats.join(F.broadcast(out_cnt), area, "left")
                 .orderBy(F.col("count").desc(), F.col(area).asc_nulls_last()))
