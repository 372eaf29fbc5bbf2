"""Skill keywords in requirement texts.

A text is matched against every keyword in a single pass: one ``count_if`` per keyword inside
one aggregate, then ``stack`` turns the one wide row into (skill, count) rows. There is no
explode of rows × keywords and no join; the whole text of every row is searched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labormart.functions import (
    ascii_lower, drop_nulls, literal_regex_prefix, regex_ci, unicode_fold,
)
from labormart.schema import LITERAL_SKILLS, REGEX_SKILLS, TOP_SKILLS_N


def literal_match(text: Column, keyword: str) -> Column:
    """Literal, ASCII case-insensitive substring test: "Go" matches "MongoDB"."""
    # ``contains`` is a byte-level search; ``instr`` would also count characters up to the hit.
    return text.contains(keyword.translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def _stack(df: DataFrame, keep: Sequence[str], names: Sequence[str], cols: Sequence[str]
           ) -> DataFrame:
    """One wide row per group → one (skill, count) row per keyword."""
    pairs = ", ".join(f"'{n.replace(chr(39), chr(92) + chr(39))}', `{c}`" for n, c in zip(names, cols))
    return df.selectExpr(*[f"`{k}`" for k in keep],
                         f"stack({len(names)}, {pairs}) AS (skill, count)")


def skill_counts(df: DataFrame, text: str = "snippet_requirement",
                 keywords: Sequence[str] = LITERAL_SKILLS, mode: str = "literal",
                 by: Sequence[str] = (), keep_zero: bool = False) -> DataFrame:
    """Rows matched per keyword (a row counts once per keyword), optionally per group ``by``.

    ``mode="literal"``: ASCII-lower-cased substring test. ``mode="regex"``: the keyword is an
    unescaped case-insensitive regular expression (so "C++" means "contains c").
    """
    # The text is lower-cased once per row in a projection, then tested per keyword (inside
    # the aggregate the shared sub-expression would be evaluated once per keyword).
    if mode == "literal":
        src = df.select(*by, ascii_lower(text).alias("_txt"))
        tests = [literal_match(F.col("_txt"), k) for k in keywords]
    elif mode == "array":  # ``text`` is an array of already matched keywords (row_skills)
        src = df.select(*by, F.col(text).alias("_txt"))
        tests = [F.array_contains("_txt", k) for k in keywords]
    elif mode == "regex":
        # Keywords that are plain literals (the usual case) are tested as substrings of the
        # case-folded text, which is exactly the regex result and much cheaper; the
        # rest go through the regex engine on the original text.
        lits = [literal_regex_prefix(k) for k in keywords]
        src = df.select(*by, F.col(text).alias("_raw"), unicode_fold(text).alias("_txt"))
        tests = [F.col("_txt").contains(lit.lower()) if lit is not None else regex_ci("_raw", k)
                 for k, lit in zip(keywords, lits)]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    cols = [f"_k{i}" for i in range(len(keywords))]
    flags = src.select(*by, *[F.when(t, 1).otherwise(0).alias(c) for t, c in zip(tests, cols)])
    aggs = [F.sum(c).cast("bigint").alias(c) for c in cols]
    wide = flags.groupBy(*by).agg(*aggs) if by else flags.agg(*aggs)
    long = _stack(wide, list(by), keywords, cols)
    return long if keep_zero else long.filter(F.col("count") > 0)


def top_skills(df: DataFrame, text: str = "snippet_requirement",
               keywords: Sequence[str] = LITERAL_SKILLS, n: int = TOP_SKILLS_N, mode: str = "literal"
               ) -> DataFrame:
    """K2 / K4: the ``n`` keywords matched by most rows; ties by keyword."""
    return (skill_counts(df, text, keywords, mode)
            .orderBy(F.col("count").desc(), F.col("skill").asc()).limit(n))


def regex_skill_counts(df: DataFrame, text: str = "snippet_requirement",
                       keywords: Sequence[str] = REGEX_SKILLS) -> DataFrame:
    """K3: dashboard skill counts, zero counts omitted, count descending."""
    return (skill_counts(df, text, keywords, mode="regex")
            .orderBy(F.col("count").desc(), F.col("skill").asc()))


def top_n_per_group(counts: DataFrame, group: Sequence[str], n: int,
                    measure: str = "count", name: str = "skill") -> DataFrame:
    """Top ``n`` rows per group by ``measure`` (ties by ``name``), with their ``rank``.

    Used on already aggregated tables (one row per group × keyword), so each window partition
    holds at most one row per keyword.
    """
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc(), F.col(name).asc())
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def row_skills(df: DataFrame, text: str = "snippet_requirement",
               keywords: Sequence[str] = LITERAL_SKILLS, out: str = "skills") -> DataFrame:
    """J3 per row: the array of keywords the text contains (built-in array ops, no UDF)."""
    # Lower-case once per row in its own projection; the keyword tests then read that column.
    tmp = "_low_" + out
    low = df.withColumn(tmp, ascii_lower(text))
    arr = drop_nulls(F.array(*[F.when(literal_match(F.col(tmp), k), F.lit(k))
                               for k in keywords]))
    return low.withColumn(out, arr).drop(tmp)
