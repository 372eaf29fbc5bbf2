"""Load, clean, aggregate, Parquet and SQL cases on the five-record fixture, plus the cleaning
edge cases (bad files, lenient casts, dedup order)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import as_lines, vacancies, write_lines
from labormart.operators import aggregates as A
from labormart.operators import distribution as D
from labormart.operators.clean import available_columns, clean, dedup_first
from labormart.operators.profile import null_profile, shape, stage_counts
from labormart.sources.files import (
    Snapshot, bad_files, load_jsonl, load_jsonl_inferred, parquet_view, save_parquet,
    union_all_by_name,
)


def test_load_jsonl(spark, five_dir):
    df = load_jsonl(spark, five_dir)
    assert df.count() == 5
    assert "id" in df.columns and "name" in df.columns


def test_load_empty_dir(spark, tmpdir_path):
    df = load_jsonl(spark, tmpdir_path)
    assert df.count() == 0
    assert "salary" in df.columns  # explicit schema even without files


def test_clean_removes_duplicates(spark, five_dir):
    df = clean(load_jsonl(spark, five_dir))
    rows = df.collect()
    assert len(rows) == 4
    assert len({r.id for r in rows}) == 4


def test_aggregate_by_area(spark, five_dir):
    res = A.aggregate_by_area(clean(load_jsonl(spark, five_dir))).collect()
    assert res[0].area_name == "Москва" and res[0]["count"] == 2
    assert res[0].avg_salary_from == pytest.approx(135000)
    ekb = [r for r in res if r.area_name == "Екатеринбург"][0]
    assert ekb.avg_salary_from is None and ekb.min_salary is None  # only > 0 counted


def test_aggregate_by_employer(spark, five_dir):
    res = A.aggregate_by_employer(clean(load_jsonl(spark, five_dir))).collect()
    assert res and res[0].employer_name == "ООО Ромашка" and res[0].vacancy_count == 2


def test_parquet_roundtrip_and_sql(spark, five_dir, tmpdir_path):
    df = clean(load_jsonl(spark, five_dir))
    path = os.path.join(tmpdir_path, "out.parquet")
    save_parquet(df, path)
    assert spark.read.parquet(path).count() == 4
    parquet_view(spark, path, "vac_test")
    top = spark.sql("""SELECT area_name, COUNT(*) AS count, AVG(salary_from) AS avg_from
                       FROM vac_test WHERE area_name IS NOT NULL GROUP BY area_name
                       ORDER BY count DESC LIMIT 10""").collect()
    assert top and top[0].area_name == "Москва"
    # the SQL form averages the zeros of "no salary" in
    assert A.top_areas(df).filter("area_name = 'Екатеринбург'").first().avg_from == 0.0


def test_bad_file_is_dropped_whole(spark, five, tmpdir_path):
    write_lines(tmpdir_path, "good.jsonl", five[:2])
    write_lines(tmpdir_path, "bad.jsonl", [*five[2:4], "{not json"])
    write_lines(tmpdir_path, "other.txt", five[:1])  # not a .jsonl file
    assert load_jsonl(spark, tmpdir_path).count() == 2
    assert load_jsonl(spark, tmpdir_path, bad_input="drop_row").count() == 4
    bf = bad_files(spark, tmpdir_path).collect()
    assert len(bf) == 1 and bf[0].file.endswith("bad.jsonl") and bf[0].bad_lines == 1


def test_only_top_level_jsonl_files(spark, five, tmpdir_path):
    write_lines(tmpdir_path, "top.jsonl", five[:2])
    sub = os.path.join(tmpdir_path, "sub")
    os.makedirs(sub)
    write_lines(sub, "deeper.jsonl", five[2:])
    assert load_jsonl(spark, tmpdir_path).count() == 2


def test_aggregates_without_columns(spark):
    df = spark.createDataFrame([("1",)], "id STRING")
    assert A.aggregate_by_area(df).count() == 0
    assert A.aggregate_by_employer(df).count() == 0


def test_lenient_salary_cast(spark, tmpdir_path):
    lines = [f'{{"id": "{i}", "name": "Developer", "salary": {salary}}}' for i, salary in enumerate((
        '{"from": 1.5e5, "to": "200000"}',  # float and text
        '{"from": "abc", "to": 100}',       # bad text → 0
        '{"from": "12.9", "to": null}',     # decimal text truncates
        "null"))]
    write_lines(tmpdir_path, "s.jsonl", lines)
    got = {r.id: (r.salary_from, r.salary_to)
           for r in clean(load_jsonl(spark, tmpdir_path)).collect()}
    assert got["0"] == (150000, 200000)
    assert got["1"] == (0, 100)
    assert got["2"] == (12, 0)
    assert got["3"] == (0, 0)


def test_dedup_before_name_filter(spark, tmpdir_path):
    row = lambda name: [("9", name, "1", "A", "1", "2", "E")]
    later = vacancies(spark, row("Good Name"), collected_at="2025-05-02T00:00:00Z")
    write_lines(tmpdir_path, "d.jsonl", as_lines(later) + as_lines(vacancies(spark, row("Go"))))  # the kept copy has a bad name
    assert clean(load_jsonl(spark, tmpdir_path)).count() == 0
    kept = dedup_first(load_jsonl(spark, tmpdir_path)).first()
    assert kept.name == "Go"


def test_name_filter_counts_characters(spark, tmpdir_path):
    names = vacancies(spark, [(str(i), name, "1", "A", "1", "2", "E") for i, name in enumerate(("Го", "Гоу", None), 1)])
    write_lines(tmpdir_path, "n.jsonl", as_lines(names))
    assert [r.id for r in clean(load_jsonl(spark, tmpdir_path)).collect()] == ["2"]


def test_null_ids_form_one_group(spark):
    df = spark.createDataFrame([(None, "a", "1"), (None, "b", "2"), ("x", "c", "3")],
                               "id STRING, name STRING, collected_at STRING")
    assert dedup_first(df).count() == 2


def test_schema_merge_and_union(spark, tmpdir_path):
    write_lines(tmpdir_path, "a.jsonl", ['{"id": "1", "x": 1}'])
    write_lines(tmpdir_path, "b.jsonl", ['{"id": "2", "y": "t", "x": 2.5}'])
    df = load_jsonl_inferred(spark, tmpdir_path)
    assert set(df.columns) == {"id", "x", "y"}
    assert dict(df.dtypes)["x"] == "double"
    a = spark.createDataFrame([("1", 1)], "id STRING, a INT")
    b = spark.createDataFrame([("2", "z")], "id STRING, b STRING")
    u = union_all_by_name([a, b]).collect()
    assert len(u) == 2 and u[1].a is None


def test_headline_counts_null_as_value(spark):
    df = spark.createDataFrame([("A", "e", 10), (None, "e", 0), ("B", None, 30)],
                               "area_name STRING, employer_name STRING, salary_from BIGINT")
    r = A.headline(df).first()
    assert (r.vacancies, r.areas, r.employers) == (3, 3, 2)
    assert r.avg_salary_from == 20.0


def test_group_forms_and_null_area(spark):
    df = spark.createDataFrame([("A", 10), (None, 20), ("A", 0)],
                               "area_name STRING, salary_from BIGINT")
    assert A.group_count(df, keep_null=True).count() == 2
    assert A.group_count(df, keep_null=False).count() == 1
    s = A.salary_stats_by_area(df, keep_null=False).collect()
    assert [(r.area_name, r.avg, r.min, r.max) for r in s] == [("A", 10.0, 10, 10)]


def test_medians(spark):
    rows = [("A", v) for v in (10, 20, 30, 40)] + [("B", v) for v in (5, 7, 9)]
    df = spark.createDataFrame(rows, "area_name STRING, salary_from BIGINT")
    near = {r.area_name: r.median for r in D.median_nearest(df).collect()}
    assert near == {"A": 30.0, "B": 7.0}  # upper middle for even n
    cont = {r.area_name: r.median_salary for r in D.median_by_area(df, min_count=3).collect()}
    assert cont == {"A": 25.0, "B": 7.0}
    assert D.median_by_area(df, min_count=4).count() == 1


def test_bands_edges(spark):
    df = spark.createDataFrame([(v,) for v in (49999, 50000, 299999, 300000, 0)],
                               "salary_from BIGINT")
    got = {r.salary_range: r["count"] for r in D.salary_distribution(df).collect()}
    assert got == {"< 50K": 1, "50K-100K": 1, "200K-300K": 1, "> 300K": 1}
    order = [r.salary_range for r in D.salary_distribution(df).collect()]
    assert order == ["< 50K", "50K-100K", "200K-300K", "> 300K"]
    got4 = {r.range: r.cnt for r in D.salary_distribution4(df).collect()}
    assert got4 == {"< 50K": 1, "50K-100K": 1, "> 200K": 2}


def test_histogram_top_edge_in_last_bin(spark):
    df = spark.createDataFrame([(v,) for v in (100, 200, 300, 400)], "salary_from BIGINT")
    rows = D.salary_histogram(df, bins=3).collect()
    assert [r["count"] for r in rows] == [1, 1, 2]
    assert rows[-1].bin == 2 and rows[-1].bin_end == 400.0
    one = spark.createDataFrame([(5,), (5,)], "salary_from BIGINT")
    assert [(r.bin, r["count"]) for r in D.salary_histogram(one, bins=30).collect()] == [(0, 2)]


def test_box_summary(spark):
    rows = [("A", v) for v in (1, 2, 3, 4, 100)] + [("B", 7)] + [(None, 9)] * 3
    df = spark.createDataFrame(rows, "area_name STRING, salary_from BIGINT")
    box = {r.area_name: r for r in D.salary_box(df, n=2).collect()}
    assert set(box) == {"A"}  # null area takes a slot but never matches
    a = box["A"]
    assert (a.min, a.q1, a.median, a.q3, a.max) == (1, 2.0, 3.0, 4.0, 100)
    assert a.outliers == 1


def test_profile_and_stage_counts(spark, five_dir):
    raw = load_jsonl(spark, five_dir)
    prof = {r.column: r.nulls for r in null_profile(raw).collect()}
    assert prof["salary"] == 1 and prof["id"] == 0
    assert shape(raw).first().asDict() == {"rows": 5, "columns": len(raw.columns)}
    sc = stage_counts([("load", raw), ("clean", clean(raw))]).collect()
    assert [(r.stage, r.rows_in, r.rows_out) for r in sc] == [("load", None, 5), ("clean", 5, 4)]


def test_available_columns(spark, five_dir):
    df = available_columns(clean(load_jsonl(spark, five_dir)))
    assert df.columns == ["id", "name", "area_name", "employer_name", "salary_from",
                          "salary_to", "published_at"]


def test_snapshot_refresh(spark, five, tmpdir_path):
    write_lines(tmpdir_path, "a.jsonl", five[:2])
    snap = Snapshot(spark, tmpdir_path)
    assert snap.get().count() == 2
    write_lines(tmpdir_path, "b.jsonl", five[2:3])
    assert snap.get().count() == 2
    assert snap.refresh().count() == 3


def test_timeline_and_area_counts(spark, five_dir):
    df = clean(load_jsonl(spark, five_dir))
    assert [(r.date, r["count"]) for r in A.timeline(df).collect()] == [("2025-05-01", 4)]
    assert A.area_counts(df, n=1).first().area_name == "Москва"
    assert A.employers_table(df).columns == ["employer", "vacancies", "avg_salary_from"]
    assert F is not None


def test_volume_report(spark, five_dir, tmpdir_path):
    from labormart.operators.profile import file_volume, volume_report

    raw = load_jsonl(spark, five_dir)
    pq = os.path.join(tmpdir_path, "p")
    save_parquet(clean(raw), pq)
    rep = {r.format: r for r in volume_report([
        file_volume(spark, five_dir, "jsonl", glob="*.jsonl", rows=raw),
        file_volume(spark, pq, "parquet", rows=spark.read.parquet(pq))]).collect()}
    assert rep["jsonl"].files == 1 and rep["jsonl"].rows == 5
    assert rep["jsonl"].bytes == os.path.getsize(os.path.join(five_dir, "test.jsonl"))
    assert abs(rep["jsonl"].transport_mb_estimate - 5 * 100 / 1048576) < 1e-12
    assert min(r.ratio_to_smallest for r in rep.values()) == 1.0


def test_observed_stage_rows(spark, five_dir):
    from labormart.operators.profile import observe_rows

    raw, obs_in = observe_rows(load_jsonl(spark, five_dir), "loaded")
    out, obs_out = observe_rows(clean(raw), "cleaned")
    out.write.format("noop").mode("overwrite").save()   # one action runs both counters
    assert obs_in.get["rows"] == 5 and obs_out.get["rows"] == 4
    from labormart.operators.profile import observed_stages

    table = observed_stages(spark, [("load", obs_in), ("clean", obs_out)]).collect()
    assert [(r.stage, r.rows_in, r.rows_out, r.removed) for r in table] == [
        ("load", None, 5, None), ("clean", 5, 4, 1)]


def test_parquet_partition_pruning_and_pushdown(spark, five_dir, tmpdir_path):
    df = clean(load_jsonl(spark, five_dir)).withColumn("published_date",
                                                       F.substring("published_at", 1, 10))
    path = os.path.join(tmpdir_path, "by_day")
    save_parquet(df, path, partition_by=["published_date"])
    q = (spark.read.parquet(path)
         .filter((F.col("published_date") == "2025-05-01") & (F.col("salary_from") > 0))
         .select("area_name", "salary_from"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(published_date" in plan
    assert "PushedFilters: [IsNotNull(salary_from), GreaterThan(salary_from,0)]" in plan
    assert "ReadSchema: struct<salary_from:bigint,area_name:string>" in plan
    assert q.count() == 3


def test_dataframe_and_sql_forms_agree_without_null_areas(spark):
    rows = [(f"A{i % 4}", (i * 37) % 500 * 100) for i in range(203)]
    df = spark.createDataFrame(rows, "area_name STRING, salary_from BIGINT")
    df.createOrReplaceTempView("parity_vac")
    gc_df = {tuple(r) for r in A.group_count(df, keep_null=True).collect()}
    gc_sql = {tuple(r) for r in spark.sql("""SELECT area_name, COUNT(*) AS count FROM parity_vac
        WHERE area_name IS NOT NULL GROUP BY area_name""").collect()}
    assert gc_df == gc_sql
    st_df = {tuple(r) for r in A.salary_stats_by_area(df, keep_null=True).collect()}
    st_sql = {tuple(r) for r in spark.sql("""SELECT area_name, AVG(salary_from) AS avg,
        MIN(salary_from) AS min, MAX(salary_from) AS max FROM parity_vac
        WHERE salary_from > 0 AND area_name IS NOT NULL GROUP BY area_name""").collect()}
    assert st_df == st_sql
    med_df = {r.area_name: r.median for r in D.median_by_area(df, min_count=3, with_count=False,
                                                             median_name="median").collect()}
    med_sql = {r.area_name: r.median for r in spark.sql("""SELECT area_name,
        PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY salary_from) AS median FROM parity_vac
        WHERE salary_from > 0 AND area_name IS NOT NULL GROUP BY area_name
        HAVING COUNT(*) >= 3""").collect()}
    assert med_df == med_sql


def test_all_salaries_null_keeps_columns(spark, tmpdir_path):
    none = vacancies(spark, [(str(i), "Developer", "1", "A", None, None, "E") for i in range(3)])
    write_lines(tmpdir_path, "n.jsonl", as_lines(none))
    df = clean(load_jsonl(spark, tmpdir_path))
    assert {"salary_from", "salary_to"} <= set(df.columns)
    r = A.aggregate_by_area(df).first()
    assert (r["count"], r.avg_salary_from, r.max_salary) == (3, None, None)


def test_keep_mode_returns_bad_lines_with_text(spark, five, tmpdir_path):
    write_lines(tmpdir_path, "k.jsonl", [*five[:2], "{broken"])
    df = load_jsonl(spark, tmpdir_path, bad_input="keep")
    rows = df.collect()
    assert len(rows) == 3
    bad = [r for r in rows if r["_corrupt_record"] is not None]
    assert len(bad) == 1 and bad[0]["_corrupt_record"] == "{broken" and bad[0].id is None


def test_inferred_schema_leaves_bad_files_out(spark, tmpdir_path):
    """A broken file adds no rows, no columns and no wider types; ``drop_row`` keeps its good lines."""
    write_lines(tmpdir_path, "a.jsonl", ['{"id": 1, "x": 1}', "", '{"id": 2, "x": 2, "n": {"u": 1}}'])
    write_lines(tmpdir_path, "b.jsonl", ['{"id": 3, "x": 2.5, "n": {"v": "t"}}'])
    write_lines(tmpdir_path, "bad.jsonl", ['{"id": "text", "only_bad": 1}', '{"id": 4'])
    write_lines(tmpdir_path, "twice.jsonl", ['{"id": 5, "also_bad": 1}{"id": 6}'])
    df = load_jsonl_inferred(spark, tmpdir_path)
    assert dict(df.dtypes) == {"id": "bigint", "x": "double", "n": "struct<u:bigint,v:string>"}
    assert sorted((r.id, r.x) for r in df.collect()) == [(1, 1.0), (2, 2.0), (3, 2.5)]
    rows = load_jsonl_inferred(spark, tmpdir_path, bad_input="drop_row")
    assert dict(rows.dtypes)["id"] == "string" and "only_bad" in rows.columns and rows.count() == 4
    empty = os.path.join(tmpdir_path, "none")
    os.makedirs(empty)
    assert load_jsonl_inferred(spark, empty).count() == 0
    write_lines(empty, "bad.jsonl", ["[1]"])
    assert load_jsonl_inferred(spark, empty).count() == 0


def test_clustered_write_bounds_the_files_of_a_day(spark, tmpdir_path):
    """A third of the rows on one day, many small days, rows dealt over many tasks: a day has as many files as its
    rows fill at most, and every row is written once."""
    n = 6000
    df = spark.range(n).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "2025-05-01").when(
        F.col("id") % 3 == 1, F.concat(F.lit("2025-06-"), F.col("id") % 20)).alias("day")).repartition(16).cache()
    path = os.path.join(tmpdir_path, "days")
    # So few rows would be put together again after the shuffle; with many they are not.
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    save_parquet(df, path, partition_by=["day"], rows_per_file=500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = {d: len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")]) for d in os.listdir(path) if d.startswith("day=")}
    rows = {r.day: r["count"] for r in df.groupBy("day").count().collect()}
    assert len(files) == len(rows) == 22
    for day, c in rows.items():
        assert files[f"day={day or '__HIVE_DEFAULT_PARTITION__'}"] <= -(-c // 500)
    assert files["day=2025-05-01"] >= 2
    back = spark.read.parquet(path)
    assert back.count() == n and back.select("id").distinct().count() == n


def test_sizes_come_from_the_file_listing(spark, five_dir):
    from labormart.operators.profile import file_sizes

    sizes = file_sizes(spark, five_dir, "*.jsonl")
    assert [os.path.basename(r.path) for r in sizes.collect()] == ["test.jsonl"]
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_staged_lines_are_parsed_once(spark, five, tmpdir_path):
    from labormart.sources.files import StagedLines

    write_lines(tmpdir_path, "good.jsonl", five)
    write_lines(tmpdir_path, "bad.jsonl", [*five[:2], "{broken"])
    staged = StagedLines(spark, tmpdir_path)
    assert staged.counts().first().asDict() == {"lines": 8, "bad_lines": 1, "kept_lines": 5}
    for mode, n in (("drop_file", 5), ("drop_row", 7), ("keep", 8)):
        df = staged.rows(mode)
        assert df.count() == n and "Scan text" not in df._jdf.queryExecution().executedPlan().toString()
    none = os.path.join(tmpdir_path, "none")
    os.makedirs(none)
    empty = StagedLines(spark, none)
    assert empty.rows().count() == 0 and empty.counts().first().lines == 0 and empty.bad_files().count() == 0


def test_gzipped_lines_are_read_as_plain_ones(spark, five_dir, tmpdir_path):
    """A gzipped sink takes less disk; loading, the snapshot and the sizes find its files."""
    from labormart.operators.profile import file_sizes
    from labormart.sources.files import save_jsonl

    raw = load_jsonl(spark, five_dir)
    path = os.path.join(tmpdir_path, "gz")
    save_jsonl(raw, path, compression="gzip")
    assert sorted(map(str, load_jsonl(spark, path, glob="*.json.gz").collect())) == sorted(map(str, raw.collect()))
    snap = Snapshot(spark, path, glob="*.json.gz")
    assert snap.get().count() == clean(raw).count() and file_sizes(spark, path, "*.json.gz").count() >= 1
    snap.get().unpersist()


def test_a_task_holds_one_part_and_sorts_nothing(spark, tmpdir_path):
    """More parts than shuffle partitions: each is one file all the same, null and empty ones together."""
    from labormart.plans.catalog import _write_by_part
    from labormart.sources.files import part_per_task

    lines = spark.range(400).select(F.col("id").cast("string").alias("value"), F.when(F.col("id") % 20 == 0, F.lit(""))
                                    .when(F.col("id") % 20 == 1, F.lit(None)).otherwise(F.concat(F.lit("p"), F.col("id") % 20)).alias("part"))
    dealt = part_per_task(lines, "part")
    per_task = dealt.groupBy(F.spark_partition_id().alias("t")).agg(F.count_distinct(F.coalesce("part", F.lit(""))).alias("n")).collect()
    assert len(per_task) == 19 and {r.n for r in per_task} == {1}
    assert not any(x in dealt._jdf.queryExecution().executedPlan().toString() for x in ("Sort", "Window"))
    out = os.path.join(tmpdir_path, "parts")
    _write_by_part(lines, out)
    files = spark.read.text(f"{out}/*.txt.gz").groupBy(F.col("_metadata.file_path")).agg(F.collect_list(F.col("value").cast("int") % 20).alias("v")).collect()
    assert sorted(tuple(sorted(set(r.v))) for r in files) == [(0, 1), *[(k,) for k in range(2, 20)]]
    assert sum(len(r.v) for r in files) == 400
    assert part_per_task(lines.filter("false"), "part") is None
