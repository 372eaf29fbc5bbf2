"""Corpus pipeline: five stages over ``documents``, each on what its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a table that ``run`` writes into the shared
scratch folder and reads again; a stage's own tables are deleted when its output is written. The
first four return the columns of ``documents``; the last returns the packed pieces. The rows cannot
be expressed in SQL, so there is no ``ORACLE_SQL``; the stages are tested one by one against brute
force (tests/llm).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm import decontaminate, minhash, packing, secret_scan, toxicity
from labormart.llm.common import drop_scratch, load, materialize, scratch_list
from labormart.llm.tokens import vocabulary_path

#: Column of row numbers within the near-duplicate stage; no input column has this name.
ROW = "_pipeline_row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The model is fitted on the labelled rows of the full table."""
    model = toxicity.train(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that of the least id (nulls last): shingles of five words,
    similarity of 0.8 or more. Rows are told apart by a number of their own, so ids may repeat or
    be null. Rows without words stay."""
    numbered = materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-numbered")
    dropped = minhash.copies(numbered.select(F.col(ROW).alias("uid"), "doc_id", "text"), words=5, percent=80)
    return numbered.join(dropped.withColumnRenamed("uid", ROW), ROW, "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, by sequence and offset."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    since = len(scratch_list(spark))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_scratch(spark, since)  # what the stage wrote on its way, and its input
    return docs
