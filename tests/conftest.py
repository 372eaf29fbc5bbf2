import os
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labormart.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="labormart-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="labormart-test-")


# The five fixture vacancies; the last repeats the first.
FIVE = [
    ("1", "Go Developer", "1", "Москва", "150000", "250000", "ООО Ромашка"),
    ("2", "Python Engineer", "1", "Москва", "120000", "200000", "ООО Ромашка"),
    ("3", "Backend Dev", "2", "Санкт-Петербург", "100000", "180000", "ООО Василёк"),
    ("4", "Data Engineer", "3", "Екатеринбург", None, None, "ПАО Трубы"),
    ("1", "Go Developer", "1", "Москва", "150000", "250000", "ООО Ромашка"),
]
FLAT = "id STRING, name STRING, area_id STRING, area STRING, low STRING, high STRING, employer STRING"
COLLECTED = "2025-05-01T10:01:00Z"


def vacancies(spark, rows, collected_at=COLLECTED):
    """Raw records (``RAW_SCHEMA``) of flat rows; without both bounds the salary record is null."""
    from labormart.schema import RAW_SCHEMA

    flat = spark.createDataFrame(rows, FLAT)
    salary = F.struct(F.col("low").alias("from"), F.col("high").alias("to"), F.lit("RUR").alias("currency"), F.lit(False).alias("gross"))
    columns = {
        "id": F.col("id"), "name": F.col("name"), "salary": F.when(F.coalesce("low", "high").isNotNull(), salary),
        "area": F.struct(F.col("area_id").alias("id"), F.col("area").alias("name")),
        "employer": F.struct(F.lit("e1").alias("id"), F.col("employer").alias("name")),
        "snippet": F.struct(F.lit("Python Go Docker").alias("requirement"), F.lit("разработка").alias("responsibility")),
        "published_at": F.lit("2025-05-01T10:00:00Z"), "collected_at": F.lit(collected_at),
    }
    return flat.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def as_lines(df):
    """One JSON object per row, in the order of the rows."""
    return [r.line for r in df.select(F.to_json(F.struct(*df.columns)).alias("line")).collect()]


def write_lines(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(f"{line}\n" for line in lines)
    return path


@pytest.fixture
def five(spark):
    """The five records as JSON lines."""
    return as_lines(vacancies(spark, FIVE))


@pytest.fixture
def five_dir(five, tmpdir_path):
    write_lines(tmpdir_path, "test.jsonl", five)
    return tmpdir_path
