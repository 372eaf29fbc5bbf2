"""Grouped aggregates over the clean vacancy table.

Every aggregate is a plain ``groupBy().agg()``: Spark plans a partial aggregate before the
shuffle, so a group holding a large share of the rows is reduced map-side and reaches the
reducer as one partial row per map task. Sorting plus ``limit`` becomes a top-k
(``TakeOrderedAndProject``), not a full sort. Ties are broken on the group name, ascending,
nulls last, so every limited result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.functions import n_unique, positive_or_null


def _top(df: DataFrame, measure: str, name: str, n: int | None, ascending: bool = False
         ) -> DataFrame:
    m = F.col(measure).asc_nulls_last() if ascending else F.col(measure).desc_nulls_last()
    out = df.orderBy(m, F.col(name).asc_nulls_last())
    return out.limit(n) if n is not None else out


def aggregate_by_area(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
                      s_to: str = "salary_to") -> DataFrame:
    """A1: per area (null area kept) count and salary figures over values > 0 only. Without
    an area column the result is an empty table."""
    if area not in df.columns:
        return df.sparkSession.createDataFrame(
            [], f"`{area}` STRING, count BIGINT, avg_salary_from DOUBLE, avg_salary_to DOUBLE, "
                "min_salary BIGINT, max_salary BIGINT")
    g = df.groupBy(area).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(positive_or_null(s_from)).alias("avg_salary_from"),
        F.avg(positive_or_null(s_to)).alias("avg_salary_to"),
        F.min(positive_or_null(s_from)).alias("min_salary"),
        F.max(positive_or_null(s_to)).alias("max_salary"),
    )
    return _top(g, "count", area, None)


def aggregate_by_employer(df: DataFrame, employer: str = "employer_name",
                          s_from: str = "salary_from", n: int = 20) -> DataFrame:
    """A2: top ``n`` employers by vacancy count with the average salary > 0 (an empty table
    without an employer column)."""
    if employer not in df.columns:
        return df.sparkSession.createDataFrame(
            [], f"`{employer}` STRING, vacancy_count BIGINT, avg_salary DOUBLE")
    g = df.groupBy(employer).agg(
        F.count(F.lit(1)).alias("vacancy_count"),
        F.avg(positive_or_null(s_from)).alias("avg_salary"),
    )
    return _top(g, "vacancy_count", employer, n)


def employers_table(df: DataFrame, employer: str = "employer_name", s_from: str = "salary_from",
                    n: int = 10) -> DataFrame:
    """A10: the employer table of the dashboard: top ``n``, display column names."""
    return aggregate_by_employer(df, employer, s_from, n).withColumnsRenamed(
        {employer: "employer", "vacancy_count": "vacancies", "avg_salary": "avg_salary_from"})


def top_areas(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
              s_to: str = "salary_to", n: int | None = 10) -> DataFrame:
    """A3: areas (null excluded) by count with averages that include the zeros."""
    g = df.filter(F.col(area).isNotNull()).groupBy(area).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(s_from).alias("avg_from"),
        F.avg(s_to).alias("avg_to"),
    )
    return _top(g, "count", area, n)


def area_avg_with_zeros(df: DataFrame, area: str = "area_name", s_from: str = "salary_from"
                        ) -> DataFrame:
    """All non-null areas: count and the average salary including zeros, no limit."""
    g = df.filter(F.col(area).isNotNull()).groupBy(area).agg(
        F.count(F.lit(1)).alias("count"), F.avg(s_from).alias("avg_salary"))
    return _top(g, "count", area, None)


def bench_top_areas(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
                    n: int = 10) -> DataFrame:
    """Top areas with ``cnt`` and ``avg_sal`` (zeros included)."""
    g = df.filter(F.col(area).isNotNull()).groupBy(area).agg(
        F.count(F.lit(1)).alias("cnt"), F.avg(s_from).alias("avg_sal"))
    return _top(g, "cnt", area, n)


def area_counts(df: DataFrame, area: str = "area_name", n: int | None = 15) -> DataFrame:
    """Rows per area (null kept), top ``n``."""
    g = df.groupBy(area).agg(F.count(F.lit(1)).alias("count"))
    return _top(g, "count", area, n)


def group_count(df: DataFrame, area: str = "area_name", keep_null: bool = True) -> DataFrame:
    """Rows per area; the SQL form (``keep_null=False``) drops the null area."""
    src = df if keep_null else df.filter(F.col(area).isNotNull())
    return _top(src.groupBy(area).agg(F.count(F.lit(1)).alias("count")), "count", area, None)


def salary_stats_by_area(df: DataFrame, area: str = "area_name", s_from: str = "salary_from",
                         keep_null: bool = True) -> DataFrame:
    """Avg / min / max of salary > 0 per area, average descending."""
    cond = F.col(s_from) > 0
    if not keep_null:
        cond = cond & F.col(area).isNotNull()
    g = df.filter(cond).groupBy(area).agg(
        F.avg(s_from).alias("avg"), F.min(s_from).alias("min"), F.max(s_from).alias("max"))
    return _top(g, "avg", area, None)


def timeline(df: DataFrame, published: str = "published_at") -> DataFrame:
    """Postings per day, the day being the first 10 characters of the ISO text."""
    return (df.groupBy(F.substring(published, 1, 10).alias("date"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy("date"))


def headline(df: DataFrame, area: str = "area_name", employer: str = "employer_name",
             s_from: str = "salary_from") -> DataFrame:
    """One row of headline figures; distinct counts treat null as one value."""
    return df.agg(
        F.count(F.lit(1)).alias("vacancies"),
        n_unique(area).alias("areas"),
        n_unique(employer).alias("employers"),
        F.avg(positive_or_null(s_from)).alias("avg_salary_from"),
    )


def salary_accumulator_exprs(s_from: str | Column, s_to: str | Column,
                             has_salary: str | Column) -> list[Column]:
    """The five salary figures of a window, as aggregate expressions.

    ``s_from``/``s_to`` are null when not given. Averages run over given values (a given 0
    counts) and default to 0.0; ``min_from`` ignores zeros; ``max_to`` is floored at 0;
    ``with_salary`` counts rows whose salary record exists even if both bounds are missing.
    """
    f = F.col(s_from) if isinstance(s_from, str) else s_from
    t = F.col(s_to) if isinstance(s_to, str) else s_to
    h = F.col(has_salary) if isinstance(has_salary, str) else has_salary
    f = F.when(h, f)
    t = F.when(h, t)
    return [
        F.coalesce(F.avg(f), F.lit(0.0)).alias("avg_from"),
        F.coalesce(F.avg(t), F.lit(0.0)).alias("avg_to"),
        F.coalesce(F.min(F.nullif(f, F.lit(0))), F.lit(0)).cast("bigint").alias("min_from"),
        F.greatest(F.coalesce(F.max(t), F.lit(0)), F.lit(0)).cast("bigint").alias("max_to"),
        F.count_if(h).alias("with_salary"),
    ]


def salary_accumulator(df: DataFrame, by: str | list[str] = "area_name",
                       s_from: str = "salary_from", s_to: str = "salary_to",
                       has_salary: str | Column | None = None) -> DataFrame:
    """A19 over a flat table where 0 means "not given": per group count and the five figures."""
    keys = [by] if isinstance(by, str) else list(by)
    f = F.nullif(F.col(s_from), F.lit(0))
    t = F.nullif(F.col(s_to), F.lit(0))
    h = has_salary if has_salary is not None else (f.isNotNull() | t.isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"),
                                 *salary_accumulator_exprs(f, t, h))
