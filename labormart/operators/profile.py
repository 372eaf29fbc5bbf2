"""Data profiles and stage counters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labormart.schema import BYTES_PER_ROW_ESTIMATE


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows for display."""
    return df.limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark type and null count, from a single
    aggregate pass over the table."""
    cols = df.columns
    if not cols:
        return df.sparkSession.createDataFrame([], "position INT, column STRING, type STRING, nulls BIGINT")
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                 F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(cols)])))


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def stage_counts(stages: Sequence[tuple]) -> DataFrame:
    """Rows out of each named stage, and rows in (the previous stage's out), as a table.

    A stage is (name, table) or (name, table, condition): the rows of the table that meet the
    condition. Stages on the same table are counted in one aggregate, so only what changes the
    rows by more than a filter costs a pass of its own. :func:`observe_rows` adds no pass to a
    pipeline that runs anyway, but counts the rows of a recomputed task again.
    """
    tables: list[DataFrame] = []
    for _, df, *_ in stages:
        if not any(df is t for t in tables):
            tables.append(df)
    counted = []
    for table in tables:
        mine = [(i, name, cond[0] if cond else F.lit(True))
                for i, (name, df, *cond) in enumerate(stages) if df is table]
        wide = table.agg(*[F.count_if(cond).alias(f"_n{i}") for i, _, cond in mine])
        counted.append(wide.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"),
                     F.col(f"_n{i}").alias("rows_out")) for i, name, _ in mine]))))
    allc = reduce(DataFrame.unionByName, counted)
    from pyspark.sql import Window

    prev = F.lag("rows_out").over(Window.orderBy("step"))  # a handful of rows
    return allc.withColumn("rows_in", prev).withColumn(
        "removed", F.col("rows_in") - F.col("rows_out")).orderBy("step")


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter to a stage; read ``obs.get`` after the action that runs it."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stage_table(spark: SparkSession, rows_out: Sequence[tuple[str, int]]) -> DataFrame:
    """A21 as a table (a small row per stage: rows in, rows out, removed) from the stages' row counts."""
    rows, prev = [], None
    for i, (name, out) in enumerate(rows_out):
        rows.append((i, name, prev, int(out), None if prev is None else prev - int(out)))
        prev = int(out)
    return spark.createDataFrame(
        rows, "step INT, stage STRING, rows_in BIGINT, rows_out BIGINT, removed BIGINT")


def observed_stages(spark: SparkSession, stages: Sequence[tuple[str, Observation]]) -> DataFrame:
    """A21 without extra passes: the stage table from row counters attached with
    :func:`observe_rows`, read after the action that ran them."""
    return stage_table(spark, [(name, obs.get["rows"]) for name, obs in stages])


def file_sizes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of the files under a folder, sub-folders too. Only the two columns of the file
    listing are read of the binary source, never the contents; names that begin with _ or . are no data."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path).select("path", "length"))


def file_volume(spark: SparkSession, path: str, label: str, rows: DataFrame, glob: str = "*",
                bytes_per_row: int = BYTES_PER_ROW_ESTIMATE) -> DataFrame:
    """Bytes on disk of the files under ``path``, from the file listing, plus a transport estimate of
    ``rows × bytes_per_row``. Of a Parquet table ``rows`` is counted from the files' footers (no column is
    read); for JSON lines give the staged table (:class:`StagedLines`), which is Parquet too."""
    vol = file_sizes(spark, path, glob).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    n = rows.agg(F.count(F.lit(1)).alias("rows")).select("rows").scalar()
    return (vol.select(F.lit(label).alias("format"), "files", "bytes", (F.col("bytes") / 1048576.0).alias("mb"))
            .withColumn("rows", n).withColumn("transport_mb_estimate", n * bytes_per_row / 1048576.0))


def volume_report(volumes: Sequence[DataFrame]) -> DataFrame:
    """Formats side by side with the size ratio to the smallest one."""
    allv = reduce(DataFrame.unionByName, volumes)
    smallest = allv.agg(F.min("bytes")).scalar()
    return allv.withColumn("ratio_to_smallest", F.col("bytes") / smallest)
