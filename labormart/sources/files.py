"""File sources and sinks: JSONL directory scan with bad-file handling, Parquet round trip,
snapshot (S1-S5, S12, D2, D3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labormart.schema import CORRUPT_COLUMN, RAW_SCHEMA
from labormart.session import path_exists, scratch_path, written
from labormart.sources.messages import is_json_object


def _is_missing(error: Exception) -> bool:
    """Whether a read failed because nothing matches its path."""
    return "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error)


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame | None:
    """The lines of the matching files that are not blank, with their file; None without such a file."""
    try:
        if path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):  # a stream's sink: its log lists the committed files
            lines = spark.read.option("pathGlobFilter", glob).text(path)
            return (lines.select("value", F.col("_metadata.file_path").alias("_file"))
                    .filter(F.trim("value") != ""))
        # "dir/*.jsonl" is expanded by the file system glob: files directly in the folder only,
        # never files of sub-folders (which a directory read would list too).
        lines = spark.read.text(f"{path.rstrip('/')}/{glob}")
    except Exception as e:
        if _is_missing(e):
            return None
        raise
    return (lines.select("value", F.col("_metadata.file_path").alias("_file"))
            .filter(F.trim("value") != ""))


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The lines parsed with ``schema`` plus the corrupt-record text and the file path. Lines are read as
    text and parsed by ``from_json`` with options, whose schema is never narrowed to the columns a query
    reads: a line is bad or not for every query."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    return (lines.select("_file", F.from_json("value", full, options).alias("_r"))
            .select(*[F.col(f"_r.`{f.name}`").alias(f.name) for f in full.fields], "_file"))


class StagedLines:
    """S1 + S3: the lines of a folder read and parsed once, into a table with each line's file and,
    for a bad line, its text. All that a job asks of its input (rows, bad files, counts) is read from there."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str = RAW_SCHEMA,
                 glob: str = "*.jsonl"):
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)  # type: ignore[attr-defined]
        self.names = [f.name for f in schema.fields]
        full = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType()),
                             T.StructField("_file", T.StringType())])
        lines = _lines(spark, path, glob)
        self.table = (spark.createDataFrame([], full) if lines is None
                      else written(_parsed(lines, schema), "staged-lines"))
        self.bad_line = F.col(CORRUPT_COLUMN).isNotNull()

    def bad_files(self) -> DataFrame:
        """Files with bad lines, and how many: a sum of flags per file."""
        return (self.table.filter(self.bad_line).groupBy(F.col("_file").alias("file"))
                .agg(F.count(F.lit(1)).alias("bad_lines")))

    def counts(self) -> DataFrame:
        """One row: lines, bad lines, and the lines of files without a bad line."""
        per_file = self.table.groupBy("_file").agg(F.count(F.lit(1)).alias("n"),
                                                   F.count_if(self.bad_line).alias("b"))
        return per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
                            F.coalesce(F.sum("b"), F.lit(0)).alias("bad_lines"),
                            F.coalesce(F.sum(F.when(F.col("b") == 0, F.col("n"))), F.lit(0)).alias("kept_lines"))

    def rows(self, bad_input: str = "drop_file") -> DataFrame:
        if bad_input == "keep":
            return self.table.drop("_file")
        if bad_input == "drop_row":
            return self.table.filter(~self.bad_line).select(*self.names)
        if bad_input != "drop_file":
            raise ValueError(f"unknown bad_input {bad_input!r}")
        # The bad files are a small table of their own; rows are read back without the bad lines' text.
        bad = self.bad_files().select(F.col("file").alias("_file"))
        return self.table.join(bad, "_file", "left_anti").select(*self.names)


def load_jsonl(spark: SparkSession, path: str, schema: T.StructType | str = RAW_SCHEMA,
               bad_input: str = "drop_file", glob: str = "*.jsonl") -> DataFrame:
    """S1 + S3: every ``*.jsonl`` file directly in ``path`` as one table with ``schema``.

    An empty directory gives an empty table with the schema. ``bad_input``:

    * ``"drop_file"`` (default): a file with any unparsable line is left out entirely, the other files
      load. Whether a file is bad is known after its last line, so the lines are staged
      (:class:`StagedLines`: one scan and one parse) and read back without the bad files.
    * ``"drop_row"``: only unparsable lines are left out; one lazy scan.
    * ``"keep"``: a bad line gives a row of nulls plus the raw text in ``_corrupt_record``; one lazy scan.
    """
    if bad_input == "drop_file":
        return StagedLines(spark, path, schema, glob).rows()
    if bad_input not in ("drop_row", "keep"):
        raise ValueError(f"unknown bad_input {bad_input!r}")
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)  # type: ignore[attr-defined]
    lines = _lines(spark, path, glob)
    if lines is None:
        return spark.createDataFrame([], schema)
    df = _parsed(lines, schema)
    if bad_input == "keep":
        return df.drop("_file")
    return df.filter(F.col(CORRUPT_COLUMN).isNull()).select(*[f.name for f in schema.fields])


def bad_files(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
              glob: str = "*.jsonl") -> DataFrame:
    """The files ``load_jsonl`` leaves out, with their number of bad lines (for the log)."""
    return StagedLines(spark, path, schema, glob).bad_files()


def load_jsonl_inferred(spark: SparkSession, path: str, glob: str = "*.jsonl",
                        bad_input: str = "drop_file") -> DataFrame:
    """S2 + S3: the files' columns unioned by name, missing ones null, types widened, as inferred from the
    lines that are kept. With ``"drop_file"`` (default) a file with a line that is no JSON object is left out
    first, so it adds neither rows nor columns nor wider types; ``"drop_row"`` leaves out such lines only.

    The lines are scanned and judged once; the kept ones are written as they are, and the schema is
    inferred from that copy, over all of them. No kept line gives an empty table without columns."""
    if bad_input not in ("drop_file", "drop_row"):
        raise ValueError(f"unknown bad_input {bad_input!r}")
    lines = _lines(spark, path, glob)
    if lines is None:
        return spark.createDataFrame([], T.StructType([]))
    judged = written(lines.withColumn("_ok", is_json_object("value")), "judged-lines")
    kept = judged.filter("_ok")
    if bad_input == "drop_file":
        kept = kept.join(judged.filter("not _ok").select("_file").distinct(), "_file", "left_anti")
    copy = scratch_path(spark, "kept-lines")
    kept.select("value").write.option("compression", "gzip").text(copy)
    return spark.read.json(copy)


def union_all_by_name(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union all by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def save_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 mode: str = "overwrite", rows_per_file: int | None = None) -> None:
    """Write the table as Parquet (optionally partitioned, e.g. by collection day, so later scans
    prune partitions). With ``rows_per_file`` the rows are clustered by partition first, see
    :func:`clustered`: a partition of n rows gets at most ceil(n / rows_per_file) files, instead of one per
    task that holds some of it."""
    if partition_by and rows_per_file:
        df = clustered(df, partition_by, rows_per_file)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def clustered(df: DataFrame, by: Sequence[str], rows_per_file: int) -> DataFrame:
    """The rows dealt so that a task holds whole shares of the values of ``by``. Rows per value are counted
    first; a value is cut into as many shares as its rows fill files, so one with a third of all rows is
    spread, and a small one is a single share. ``df`` is read twice: give a written or cached table."""
    by = list(by)
    shares = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_shares"))
    shares = shares.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_shares")
    match = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    # One small row per output folder: Catalyst sees its size; the rows need no shuffle of their own for it.
    salted = numbered.join(shares, match).withColumn("_share", F.pmod(F.xxhash64("_row"), F.col("_shares")))
    return salted.repartition(*by, "_share").select(*df.columns)


def part_per_task(df: DataFrame, part: str) -> DataFrame | None:
    """The rows dealt so that each task holds one value of ``part`` (null and "" are one value), as a partitioned
    folder keeps them: written as plain files, a value is one file, and no task sorts its rows. A partitioned
    write sorts them, and a task then holds all values that hash to it in memory. The values are listed
    first, so they must be few. None without rows."""
    name = F.nullif(F.col(part), F.lit(""))
    names = sorted((r[0] for r in df.select(name).distinct().collect()), key=lambda v: (v is not None, v or ""))
    if not names:
        return None
    spark = df.sparkSession
    listed = F.array(*[F.lit(n).cast("string") for n in names])
    numbered = spark.range(len(names)).select(F.col("id").cast("int").alias("_number"), F.get(listed, F.col("id")).alias("_name"))
    # One small row per file to be: a broadcast as small as that list.
    placed = df.join(F.broadcast(numbered), name.eqNullSafe(F.col("_name")))
    return placed.repartitionById(len(names), F.col("_number")).select(*df.columns)


def parquet_view(spark: SparkSession, path: str, name: str = "vacancies",
                 empty: T.StructType | None = None) -> DataFrame:
    """A Parquet file or folder as a SQL relation (temp view) for ``spark.sql``. A partitioned table
    without rows has no file to tell its schema: it is read with ``empty``, if given."""
    try:
        df = spark.read.parquet(path)
    except Exception as e:
        if empty is None or "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        df = spark.createDataFrame([], empty)
    df.createOrReplaceTempView(name)
    return df


def save_jsonl(df: DataFrame, path: str, max_records_per_file: int | None = None,
               mode: str = "overwrite", compression: str = "none") -> None:
    """JSONL sink: one JSON object per line (``to_json`` of each row). With ``compression="gzip"`` the files
    end in ``.json.gz`` and take about a tenth of the disk; all readers here open both."""
    w = df.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.json(path)


class Snapshot:
    """Load + clean once and keep it for repeated reports; ``refresh()`` drops the kept
    copy so the next use reads the folder again."""

    def __init__(self, spark: SparkSession, path: str, bad_input: str = "drop_file",
                 glob: str = "*.jsonl"):
        self.spark, self.path, self.bad_input, self.glob = spark, path, bad_input, glob
        self._df: DataFrame | None = None

    def get(self) -> DataFrame:
        if self._df is None:
            from labormart.operators.clean import clean

            self._df = clean(load_jsonl(self.spark, self.path, bad_input=self.bad_input,
                                        glob=self.glob)).persist()
        return self._df

    def refresh(self) -> DataFrame:
        if self._df is not None:
            self._df.unpersist()
            self._df = None
        return self.get()
