"""Event-time windows in batch form.

The streaming forms in ``labormart.streaming`` build on the same expressions. Input is a flat
vacancy table with an event-time column; salary bounds use 0 or null for "not given".
Windows are epoch-aligned on event time (the collector's processing-time phase cannot be
reproduced) and reported as ``yyyy-MM-ddTHH:mm:ssZ`` text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labormart.functions import iso_text
from labormart.operators.aggregates import salary_accumulator_exprs
from labormart.operators.skills import skill_counts, top_n_per_group
from labormart.schema import (
    LITERAL_SKILLS, SLIDING_REPORT_EVERY, SLIDING_WINDOW, TOP_SKILLS_N, TUMBLING_WINDOW,
)


def _seconds(duration: str) -> int:
    num, unit = duration.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
            "hours": 3600, "day": 86400, "days": 86400}[unit.lower()]
    return int(num) * mult


def salary_inputs(s_from: str, s_to: str, has_salary: str | None = None
                  ) -> tuple[Column, Column, Column]:
    """(from, to, has_salary) for the salary figures.

    With ``has_salary`` (a boolean column, see ``clean.given_salaries``) the bounds are taken as
    they are: null is missing, a given 0 counts, and a salary record may lack both. Without it
    the table is a clean one: 0 stands for "not given" and a salary is present when either
    bound is."""
    if has_salary:
        return F.col(s_from), F.col(s_to), F.col(has_salary)
    f = F.nullif(F.col(s_from), F.lit(0))
    t = F.nullif(F.col(s_to), F.lit(0))
    return f, t, f.isNotNull() | t.isNotNull()


def _bounds(w: str = "w") -> list[Column]:
    return [iso_text(F.col(f"{w}.start")).alias("window_start"),
            iso_text(F.col(f"{w}.end")).alias("window_end")]


def tumbling_by_area(df: DataFrame, ts: str = "ts", area: str = "area_name",
                     s_from: str = "salary_from", s_to: str = "salary_to",
                     size: str = TUMBLING_WINDOW, has_salary: str | None = None) -> DataFrame:
    """Per window and area: count and the five salary figures. Empty windows give no row."""
    f, t, h = salary_inputs(s_from, s_to, has_salary)
    g = df.groupBy(F.window(ts, size).alias("w"), F.col(area).alias("area")).agg(
        F.count(F.lit(1)).alias("area_count"), *salary_accumulator_exprs(f, t, h))
    return g.select(*_bounds(), "area", "area_count", "avg_from", "avg_to", "min_from",
                    "max_to", "with_salary")


def tumbling_total(df: DataFrame, ts: str = "ts", s_from: str = "salary_from",
                   s_to: str = "salary_to", size: str = TUMBLING_WINDOW,
                   has_salary: str | None = None) -> DataFrame:
    """Per window over all areas: total count and the five salary figures."""
    f, t, h = salary_inputs(s_from, s_to, has_salary)
    g = df.groupBy(F.window(ts, size).alias("w")).agg(
        F.count(F.lit(1)).alias("total_count"), *salary_accumulator_exprs(f, t, h))
    return g.select(*_bounds(), "total_count", "avg_from", "avg_to", "min_from", "max_to",
                    "with_salary")


def tumbling_top_skills(df: DataFrame, ts: str = "ts", text: str = "snippet_requirement",
                        keywords: Sequence[str] = LITERAL_SKILLS, n: int = TOP_SKILLS_N,
                        size: str = TUMBLING_WINDOW, skills: str | None = None) -> DataFrame:
    """Per window the ``n`` keywords matched by most rows (ties by keyword), with rank.

    ``skills`` names an array column of keywords already matched per row (see
    ``row_skills``); when given, texts are not searched again.
    """
    win = df.withColumn("_w", F.window(ts, size))
    if skills:
        counts = skill_counts(win, skills, keywords, mode="array", by=["_w"])
    else:
        counts = skill_counts(win, text, keywords, by=["_w"])
    top = top_n_per_group(counts, ["_w"], n)
    return top.select(*_bounds("_w"), "rank", "skill", "count")


def window_report(df: DataFrame, ts: str = "ts", area: str = "area_name",
                  s_from: str = "salary_from", s_to: str = "salary_to",
                  text: str = "snippet_requirement", keywords: Sequence[str] = LITERAL_SKILLS,
                  size: str = TUMBLING_WINDOW, skills: str | None = None,
                  has_salary: str | None = None) -> DataFrame:
    """W4 (+J2): one row per (window, area) with the window total and the window's top skill
    repeated; '' and 0 when no keyword matched in the window."""
    per_area = tumbling_by_area(df, ts, area, s_from, s_to, size, has_salary)
    return report_from_parts(per_area,
                             tumbling_top_skills(df, ts, text, keywords, 1, size, skills))


def report_from_parts(per_area: DataFrame, top_skills: DataFrame) -> DataFrame:
    """Per-area rows ⋈ window totals ⋈ top-1 skill (left) on the window bounds.

    The total is a sum over the window's area rows (a window function over already aggregated
    rows: one row per area in a window)."""
    key = ["window_start", "window_end"]
    total = F.sum("area_count").over(Window.partitionBy(*key))
    top1 = top_skills.filter(F.col("rank") == 1).select(
        *key, F.col("skill").alias("top_skill"), F.col("count").alias("skill_count"))
    rep = per_area.withColumn("total_count", total).join(top1, key, "left")
    return rep.select(
        "window_start", "window_end", F.col("total_count").cast("bigint").alias("total_count"),
        "area", F.col("area_count").cast("bigint").alias("area_count"),
        F.col("avg_from").alias("avg_salary_from"), F.col("avg_to").alias("avg_salary_to"),
        F.coalesce(F.col("top_skill"), F.lit("")).alias("top_skill"),
        F.coalesce(F.col("skill_count"), F.lit(0)).cast("bigint").alias("skill_count"))


def sliding_by_area(df: DataFrame, ts: str = "ts", area: str = "area_name",
                    s_from: str = "salary_from", size: str = SLIDING_WINDOW,
                    slide: str = SLIDING_REPORT_EVERY) -> DataFrame:
    """Per hopping window and area: count, and sum and count of salaries > 0.

    Rows are first aggregated per (slide-long pane, area); each pane row is then copied to
    the size/slide windows that contain it. Raw rows are never multiplied by size/slide, only
    the pane aggregates are. Window starts are epoch-aligned multiples of ``slide``, as with
    ``window(ts, size, slide)``.
    """
    size_s, slide_s = _seconds(size), _seconds(slide)
    if size_s % slide_s:
        raise ValueError("size must be a multiple of slide")
    k = size_s // slide_s
    pos = F.when(F.col(s_from) > 0, F.col(s_from))
    panes = df.groupBy(F.window(ts, slide).start.alias("_p"), F.col(area).alias("area")).agg(
        F.count(F.lit(1)).alias("_c"), F.sum(pos).alias("_s"), F.count(pos).alias("_n"))
    spread = panes.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = F.col("_p") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("_i") * slide_s)
    per = spread.groupBy(start.alias("_ws"), "area").agg(
        F.sum("_c").alias("cnt"), F.sum("_s").alias("salary_sum"), F.sum("_n").alias("salary_n"))
    end = F.col("_ws") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(size_s))
    return per.select(iso_text("_ws").alias("window_start"), iso_text(end).alias("window_end"),
                      "area", "cnt", "salary_sum", "salary_n")


def sliding_stats(df: DataFrame, ts: str = "ts", area: str = "area_name",
                  s_from: str = "salary_from", size: str = SLIDING_WINDOW,
                  slide: str = SLIDING_REPORT_EVERY, spine: bool = False) -> DataFrame:
    """W7 + W9: per hopping window: total, average salary > 0 (0.0 if none), the top area and
    its count (ties: smallest name). Windows without events give no row, or with ``spine=True``
    an empty report each, from the first window to the last."""
    stats = stats_from_by_area(sliding_by_area(df, ts, area, s_from, size, slide), _seconds(size))
    return with_empty_reports(stats, _seconds(size), _seconds(slide)) if spine else stats


#: Report instants per row of the coarse spine: what one row unfolds to.
SPINE_ROWS = 10_000


def with_empty_reports(stats: DataFrame, window_sec: int, step_sec: int,
                       after: str | None = None) -> DataFrame:
    """Sliding statistics with a row for every report instant between the first window (or the
    window end ``after``, exclusive) and the last one: total 0, average 0.0 and no top area where no event
    was. The instants are generated in two steps, stretches of ``SPINE_ROWS`` of them first, so they are dealt
    over tasks and no row unfolds to more than that; they meet the statistics in an equi-join."""
    step = F.make_dt_interval(secs=F.lit(step_sec))
    stretch = F.make_dt_interval(secs=F.lit(step_sec * SPINE_ROWS))
    bounds = stats.agg(F.min("window_end").alias("lo"), F.max("window_end").alias("hi"))
    first = F.least("lo", F.lit(after)) if after is not None else F.col("lo")
    bounds = bounds.select((F.to_timestamp(first) + (step if after is not None else F.expr("INTERVAL '0' SECOND"))).alias("lo"), F.to_timestamp("hi").alias("hi"))
    coarse = bounds.filter("lo <= hi").select("hi", F.explode(F.sequence("lo", "hi", stretch)).alias("at"))
    instants = coarse.repartition("at").select(
        F.explode(F.sequence(F.col("at"), F.least(F.col("at") + stretch - step, "hi"), step)).alias("_end"))
    size = F.make_dt_interval(secs=F.lit(window_sec))
    instants = instants.select(iso_text(F.col("_end") - size).alias("window_start"), iso_text("_end").alias("window_end"))
    all_ = instants.join(stats, ["window_start", "window_end"], "left")
    return all_.select("window_start", "window_end", F.lit(window_sec).alias("window_sec"),
                       F.coalesce("total", F.lit(0)).cast("bigint").alias("total"),
                       F.coalesce("avg_salary_from", F.lit(0.0)).alias("avg_salary_from"),
                       F.when(F.col("total").isNull(), "").otherwise(F.col("top_area")).alias("top_area"),
                       F.coalesce("top_area_count", F.lit(0)).cast("bigint").alias("top_area_count"))


def stats_from_by_area(by_area: DataFrame, window_sec: int) -> DataFrame:
    g = by_area.groupBy("window_start", "window_end").agg(
        F.sum("cnt").alias("total"),
        F.try_divide(F.sum("salary_sum"), F.sum("salary_n")).alias("_avg"),
        F.min_by("area", F.struct((-F.col("cnt")).alias("c"), F.col("area").alias("a"))
                 ).alias("top_area"),
        F.max("cnt").alias("top_area_count"))
    return g.select("window_start", "window_end", F.lit(window_sec).alias("window_sec"),
                    F.col("total").cast("bigint").alias("total"),
                    F.coalesce(F.col("_avg"), F.lit(0.0)).alias("avg_salary_from"),
                    "top_area", F.col("top_area_count").cast("bigint").alias("top_area_count"))


def sliding_top_areas(df: DataFrame, ts: str = "ts", area: str = "area_name",
                      s_from: str = "salary_from", n: int = 5, size: str = SLIDING_WINDOW,
                      slide: str = SLIDING_REPORT_EVERY) -> DataFrame:
    """Per hopping window the ``n`` areas with most events (ties by name)."""
    per = sliding_by_area(df, ts, area, s_from, size, slide)
    top = top_n_per_group(per, ["window_start", "window_end"], n, measure="cnt", name="area")
    return top.select("window_start", "window_end", "rank", "area",
                      F.col("cnt").cast("bigint").alias("cnt"))


def trailing_count(df: DataFrame, ts: str = "ts", key: str = "id", size: str = SLIDING_WINDOW,
                   bucket: str | None = None) -> DataFrame:
    """For every event, the events in [ts - size, ts] (equal timestamps included); null for
    an event without a timestamp.

    Exact, partitioned and linear in the number of timestamps, in three steps:

    1. events are counted per distinct timestamp (a partial aggregate: a timestamp shared by
       a large share of all events is reduced map-side);
    2. a timestamp's n events come in at it (+n) and leave just after it plus ``size`` (-n); the
       count at a timestamp is the running sum. Time is cut into buckets (default 12 × size), and
       what leaves only in a later bucket is also carried in at the start of each bucket up to
       that one, so each bucket sums by itself;
    3. the per-timestamp result is joined back to the events on the timestamp (AQE splits a
       skewed timestamp on the event side).
    """
    size_us = _seconds(size) * 1_000_000
    b_us = _seconds(bucket) * 1_000_000 if bucket else 12 * size_us
    if b_us < size_us:
        raise ValueError("bucket must not be shorter than the window")
    per_ts = (df.filter(F.col(ts).isNotNull()).groupBy(F.col(ts).alias("_ts"))
                .agg(F.count(F.lit(1)).alias("_n")))
    per_ts = per_ts.withColumn("_t", F.unix_micros(F.col("_ts").cast("timestamp")))

    def bucket_of(t: Column) -> Column:
        return F.floor(t / b_us).cast("bigint")

    def step(t: Column, b: Column, n: Column, own: bool) -> Column:
        return F.struct(b.alias("_b"), t.cast("bigint").alias("_t"), n.alias("_d"),
                        F.lit(own).alias("_own"))

    t, n = F.col("_t"), F.col("_n")
    gone = t + size_us + 1
    here, there = bucket_of(t), bucket_of(gone)
    steps = [step(t, here, n, True), step(gone, there, -n, False)]
    carried = F.transform(F.sequence(here + 1, there), lambda b: step(b * b_us, b, n, False))
    moves = F.when(there > here, F.concat(F.array(*steps), carried)).otherwise(F.array(*steps))
    spread = per_ts.select("_ts", F.explode(moves).alias("_x")).select("_ts", "_x.*")
    w = (Window.partitionBy("_b").orderBy("_t")
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    counts = (spread.withColumn("trailing_count", F.sum("_d").over(w))
                    .filter("_own").select("_ts", "trailing_count"))
    return (df.select(key, ts).join(counts, F.col(ts) == F.col("_ts"), "left")
              .select(key, ts, F.col("trailing_count").cast("bigint").alias("trailing_count")))
