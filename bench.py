"""Benchmark: the analyzer pipeline stages and the heavier registered queries at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Every figure is the median of 3 warm runs (one untimed warm-up run
first). Each run executes the whole plan into Spark's ``noop`` sink, so nothing is collected
to the driver. The pipeline stages mirror the reference's stage table: load the JSONL folder,
clean, aggregate by area, write Parquet, then three SQL queries over the Parquet file; the
JSONL input is the raw vacancy records derived from the driver tables (one per line item),
written once, untimed, before the runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from labormart.operators import aggregates as A  # noqa: E402
from labormart.operators.clean import clean  # noqa: E402
from labormart.plans import adapters as AD  # noqa: E402
from labormart.plans.catalog import QUERIES  # noqa: E402
from labormart.schema import SALARY_BANDS_4  # noqa: E402
from labormart.session import get_session, scratch_path  # noqa: E402
from labormart.sources.files import load_jsonl, save_jsonl, save_parquet  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))

CATALOG = [
    "aggregate_by_area", "top_areas", "percentile_salary", "median_nearest",
    "salary_histogram30", "salary_box_top10", "dedup_first", "clean", "validate_base",
    "validation_summary", "skills_literal_top10", "skills_regex", "window_report",
    "sliding_stats", "trailing_count", "stream_tumbling", "jsonl_stream_sink",
]


def run_noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int = RUNS) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app_name="labormart-bench",
                        shuffle_partitions=max(8, 2 * cpus))
    try:
        sf = float(os.path.basename(sf_dir).replace("sf", ""))
    except ValueError:
        sf = None

    # Untimed input: the raw records as JSON lines, 20 000 per file.
    jsonl_dir = scratch_path(spark, "bench-jsonl")
    save_jsonl(AD.raw_vacancies(spark, sf_dir), jsonl_dir, max_records_per_file=20000)
    glob = "*.json"
    parquet_dir = scratch_path(spark, "bench-parquet")

    q: dict[str, float] = {}
    rows: dict[str, int] = {}

    # Load: the folder scanned, parsed and staged without its bad files. Clean: from the loaded rows in
    # memory, so nothing is loaded twice.
    q["load_jsonl"] = timed(lambda: run_noop(load_jsonl(spark, jsonl_dir, glob=glob)))
    raw = load_jsonl(spark, jsonl_dir, glob=glob).persist()
    rows["load_jsonl"] = raw.count()
    cleaned = clean(raw)
    q["clean"] = timed(lambda: run_noop(cleaned))

    # The aggregate and the Parquet write run on the cleaned table kept in memory, as the
    # reference does with its in-memory frame (load + clean are timed above).
    snap = cleaned.persist()
    rows["clean"] = snap.count()
    q["aggregate_by_area"] = timed(lambda: run_noop(A.aggregate_by_area(snap)))
    q["write_parquet"] = timed(lambda: save_parquet(snap, parquet_dir))
    snap.unpersist()
    raw.unpersist()

    spark.read.parquet(parquet_dir).createOrReplaceTempView("bench_vacancies")
    view = "bench_vacancies"
    bands = " ".join(f"WHEN salary_from < {top} THEN '{label}'" if top else f"ELSE '{label}'" for top, label in SALARY_BANDS_4)
    sql = {
        "sql_top_areas": f"SELECT area_name, COUNT(*) AS cnt, AVG(salary_from) AS avg_sal FROM {view} "
                         "WHERE area_name IS NOT NULL GROUP BY area_name ORDER BY cnt DESC, area_name LIMIT 10",
        "sql_salary_distribution": f"SELECT CASE {bands} END AS range, COUNT(*) AS cnt FROM {view} "
                                   "WHERE salary_from > 0 GROUP BY range ORDER BY MIN(salary_from)",
        "sql_median": f"SELECT area_name, PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY salary_from) AS median FROM {view} "
                      "WHERE salary_from > 0 AND area_name IS NOT NULL GROUP BY area_name HAVING COUNT(*) >= 3 ORDER BY median DESC",
    }
    for name, text in sql.items():
        q[name] = timed(lambda t=text: run_noop(spark.sql(t)))
    stages_total = round(sum(q.values()), 3)

    # The reference's DataFrame-vs-SQL comparison, both forms here on the Parquet table.
    from labormart.operators import distribution as D

    pq = spark.table("bench_vacancies")
    compare = {
        "df_group_count": A.group_count(pq, keep_null=True),
        "sql_group_count": spark.sql("""SELECT area_name, COUNT(*) AS count FROM bench_vacancies
            WHERE area_name IS NOT NULL GROUP BY area_name ORDER BY count DESC"""),
        "df_salary_stats": A.salary_stats_by_area(pq, keep_null=True),
        "sql_salary_stats": spark.sql("""SELECT area_name, AVG(salary_from) AS avg,
            MIN(salary_from) AS min, MAX(salary_from) AS max FROM bench_vacancies
            WHERE salary_from > 0 AND area_name IS NOT NULL GROUP BY area_name ORDER BY avg DESC"""),
        # At this size one task merges a group's values in no time, so the caller chooses that; the ranks that
        # hold at any size are timed below (they run a job when they are built).
        "df_median_nearest": D.median_nearest(pq, method="builtin"),
        "df_median_cont_min3": D.median_by_area(pq, min_count=3, method="builtin"),
    }
    for name, df in compare.items():
        q[name] = timed(lambda d=df: run_noop(d))
    q["df_median_nearest_ranks"] = timed(lambda: run_noop(D.median_nearest(pq)))
    q["df_median_cont_min3_ranks"] = timed(lambda: run_noop(D.median_by_area(pq, min_count=3)))

    # Volume figures: JSONL folder, Parquet folder, ratio, 100 bytes per raw row.
    from labormart.operators.profile import file_volume

    vj = file_volume(spark, jsonl_dir, "jsonl", load_jsonl(spark, jsonl_dir, glob=glob), glob="*.json").first()
    vp = file_volume(spark, parquet_dir, "parquet", pq, glob="*.parquet").first()
    volume = {"jsonl_mb": round(vj.mb, 3), "parquet_mb": round(vp.mb, 3),
              "jsonl_to_parquet": round(vj.bytes / vp.bytes, 1),
              "transport_estimate_mb": round(vj.transport_mb_estimate, 3)}

    # Queries that run jobs while they are built (ranks, streams, sinks) are built in every run.
    for name in CATALOG:
        q[f"q_{name}"] = timed(lambda n=name: run_noop(QUERIES[n](spark, sf_dir)))

    print(json.dumps({
        "metric": "stages_total_sec",
        "value": stages_total,
        "unit": "sec",
        "queries": q,
        "sf": sf,
        "rows": rows,
        "records_per_sec": round(rows["load_jsonl"] / stages_total) if stages_total else None,
        "volume": volume,
        "cpus": cpus,
        "driver_memory": spark.sparkContext.getConf().get("spark.driver.memory", "default"),
        "runs": RUNS,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
