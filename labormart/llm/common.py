"""Shared helpers: scratch tables, vectorised word hashing, Arrow batch plumbing."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import labormart
from labormart.session import drop_path, scratch_path, shuffles_freed

U64 = np.uint64
#: Bytes hashed at once: the working arrays then stay in the processor's cache.
CHUNK = 1 << 19


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per session: their Python workers import
    the functions that run there, also where the package is only on the driver's path."""
    sc = spark.sparkContext
    if getattr(sc, "_labormart_shipped", False):
        return
    root = Path(labormart.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="labormart-py-")) / "labormart.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._labormart_shipped = True


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared scratch folder and read it again: later jobs and retried
    tasks find these very rows, and the lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    scratch_list(df.sparkSession).append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables as ``materialize`` gave them, which nothing reads any more."""
    for table in tables:
        drop_path(table.sparkSession, table._scratch)
        scratch_list(table.sparkSession).remove(table._scratch)


def drop_others(spark: SparkSession, since: int, *kept: DataFrame) -> None:
    """Delete the tables written since the list had ``since`` entries, but for those named, as ``materialize`` gave them."""
    stay, paths = {table._scratch for table in kept}, scratch_list(spark)
    for path in paths[since:]:
        if path not in stay:
            drop_path(spark, path)
    paths[since:] = [path for path in paths[since:] if path in stay]


def scratch_list(spark: SparkSession) -> list[str]:
    """The tables that ``materialize`` has written in this session, in order."""
    sc = spark.sparkContext
    if not hasattr(sc, "_labormart_scratch"):
        sc._labormart_scratch = []
    return sc._labormart_scratch


def drop_scratch(spark: SparkSession, since: int) -> None:
    """Delete the tables written since the list had ``since`` entries, but for the last one, which no other is
    needed for any more."""
    paths = scratch_list(spark)
    for path in paths[since:-1]:
        drop_path(spark, path)
    del paths[since:-1]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INV = U64(pow(int(_BASE), -1, 1 << 64))
_BYTE = constants(256, 11)
#: White space of a word pattern ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of the hash base and of its inverse, as long as asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, b in (("up", _BASE), ("down", _INV)):
                p = np.full(max(n, CHUNK + 1), b, U64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))
        return self.up, self.down


_POWERS = _Powers()


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any stretch of ``values`` (uint64)."""
    up, _ = _POWERS.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches [start, end); equal stretches have equal hashes."""
    _, down = _POWERS.upto(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def _groups(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < limit):
            size += len(texts[j]) + 1
            j += 1
        yield i, j
        i = j


def hash_words(texts: list[bytes], lower: bool = False, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and where each text's words begin (len(texts) + 1).

    Words are maximal runs of bytes outside ``apart``; ``lower`` folds A-Z.
    """
    table = _BYTE[_LOWER] if lower else _BYTE
    hashes, counts = [], np.zeros(len(texts) + 1, np.int64)
    for i, j in _groups(texts):
        raw = np.frombuffer(b"\n".join(texts[i:j]) + b"\n", np.uint8)
        inside = ~apart[raw]
        step = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
        start, end = step[0::2], step[1::2]
        hashes.append(span_hash(prefix_hash(table[raw]), start, end))
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
        counts[i + 1 : j + 1] = np.diff(np.searchsorted(start, ends), prepend=0)
    return (np.concatenate(hashes) if hashes else np.zeros(0, U64)), np.cumsum(counts)


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n successive words (len(words) - n + 1 of them)."""
    m = max(0, len(words) - n + 1)
    out = np.zeros(m, U64)
    for j, k in enumerate(constants(n, 23)):
        out += words[j : j + m] * k
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def crc_mod(column: str, n: int):
    """crc32 of the number as text, modulo n (null: null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def labelled_sample(spark: SparkSession, labels: DataFrame, label: str, train, limit: int) -> DataFrame:
    """At most ``limit`` labelled rows (doc_id, label 0/1) chosen by hash; of several labels of one
    document the larger counts. The bound makes the table fit for broadcasting."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def fitted_rows(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(label, text) of the sample's documents: one row per id however often the id occurs, with the least
    of its texts (null is empty), so the sample's bound holds for what a model is fitted on."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")


def give_back() -> None:
    """What Arrow and Python have freed goes back to the system: processes live on from one step to the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Rows that ``map_batches`` hands on at once: bounds what a task holds of its texts.
SLICE = 2000
#: Called in a Python worker at the end of each partition: what it keeps from task to task is cut down there.
AT_END: list = []


def map_batches(df: DataFrame, fn, schema: str, rows: int = SLICE) -> DataFrame:
    """``mapInArrow`` where ``fn`` gets a record batch of at most ``rows`` rows and returns a dict of columns."""
    ship_package(df.sparkSession)
    out_type = _arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                cols = fn(batch.slice(i, rows))
                yield pa.RecordBatch.from_arrays([_array(cols[f.name], f.type) for f in out_type], schema=out_type)
        for trim in AT_END:
            trim()
        give_back()

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(schema if isinstance(schema, StructType) else StructType.fromDDL(schema))
