"""Session helpers.

The library never changes settings of a session it is handed, except that it fills in
``spark.checkpoint.dir`` when the cluster left it unset (tests, local runs), and that one setting
is changed while a scratch table is written (:func:`shuffles_freed`).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a query's shuffle files go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, app_name: str = "labormart",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with settings suited to this library.

    On a cluster pass ``master=None`` and let spark-submit decide; the knobs set here are the
    ones every run wants: AQE (coalescing small shuffles, splitting skewed ones), UTC session
    time, no UI server.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:  # else the cluster's own width holds
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("LABORMART_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as is. Only when the setting is unset and
    the master is local a fresh folder under the system temp dir is created and registered;
    elsewhere each executor would write to its own disk, so that is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="labormart-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder, for stream checkpoints and written tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """A table written while this is open leaves no shuffle files: they go when it is written, not when the
    driver happens to collect its garbage. The setting is put back afterwards."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """The table written to the checkpoint folder and read again: what follows and every retried
    task reads these rows, and nothing before them is worked out twice."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of a path (any store that Spark can write to)."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _file_system(spark, path)
    fs.mkdirs(hadoop)


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder (none if it does not exist)."""
    fs, hadoop = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written table of this library's own (a scratch folder), if it is there."""
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop, True)
