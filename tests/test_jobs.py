"""The analyzer job end to end on the five-record fixture."""

import json
import os
import signal
import subprocess
import sys
import time

import pytest

from conftest import as_lines, vacancies, write_lines
from labormart.jobs import analyze


def test_analyze_writes_every_report(spark, five_dir, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    written = analyze(spark, five_dir, out)
    assert {"by_area", "top_areas", "salary_distribution", "percentile_salary", "timeline",
            "salary_box", "skills", "profile_nulls"} <= set(written)
    by_area = spark.read.parquet(written["by_area"]).orderBy("count", ascending=False).first()
    assert (by_area.area_name, by_area["count"], by_area.avg_salary_from) == ("Москва", 2, 135000.0)
    assert spark.read.parquet(os.path.join(out, "vacancies.parquet")).count() == 4
    skills = {r.skill: r["count"] for r in spark.read.parquet(written["skills"]).collect()}
    assert skills["Python"] == 4 and skills["Go"] == 4 and skills["Docker"] == 4
    assert spark.read.parquet(written["top_areas"]).count() == 3
    stages = {r.stage: (r.rows_in, r.rows_out) for r in spark.read.parquet(written["stages"]).collect()}
    assert stages == {"lines": (None, 5), "load": (5, 5), "dedup": (5, 4), "clean": (4, 4)}
    assert spark.read.parquet(written["bad_files"]).count() == 0


def test_analyze_reads_the_text_once(spark, five, tmpdir_path):
    """Clean table, null profile, shape, bad files and stage log come from one staged copy."""
    from conftest import write_lines
    from labormart.jobs import analysis_tables

    write_lines(tmpdir_path, "good.jsonl", five)
    write_lines(tmpdir_path, "bad.jsonl", [*five[:2], "{broken"])
    tables = analysis_tables(spark, tmpdir_path, os.path.join(tmpdir_path, "out"))
    for df in tables.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Scan text" not in plan and "FileScan text" not in plan
    bad = tables["bad_files"].collect()
    assert [(os.path.basename(r.file), r.bad_lines) for r in bad] == [("bad.jsonl", 1)]
    assert [(r.stage, r.rows_out) for r in tables["stages"].collect()] == [("lines", 8), ("load", 5), ("dedup", 4), ("clean", 4)]
    assert tables["profile_shape"].first().rows == 5


def test_consume_starts_and_processes(spark, tmpdir_path):
    from labormart.jobs import consume

    topic = os.path.join(tmpdir_path, "topic")
    recs = [json.dumps({"id": str(i), "area_name": "A", "salary_from": 100 + i,
                        "collected_at": f"2025-05-01T10:{i:02d}:00Z"}) for i in range(30)]
    spark.createDataFrame([(r,) for r in recs], "value STRING").write.text(topic)
    q = consume(spark, topic, os.path.join(tmpdir_path, "out"), window_sec=300, every_sec=10)
    try:
        q.processAllAvailable()
        assert sum(p["numInputRows"] for p in q.recentProgress) == 30
    finally:
        q.stop()


# Items of one page: two good ones, a short name, no area id.
ITEMS = [("1", "Go Developer", "1", "Москва", "150000", "250000", "E"), ("2", "Python Engineer", "1", "Москва", "120000", "200000", "E"),
         ("3", "Go", "2", "СПб", "100000", "180000", "E"), ("4", "Backend Dev", "", "СПб", "100000", "180000", "E")]


def page(spark, rows):
    """One stored result page with these items."""
    from pyspark.sql import functions as F

    items = vacancies(spark, rows).agg(F.collect_list(F.struct("*")).alias("items"))
    return as_lines(items.withColumns({"found": F.lit(len(rows)), "pages": F.lit(1), "page": F.lit(0)}))


def outputs(folder):
    return {k: os.path.join(folder, k) for k in ("files", "topic", "report")}


def held(spark, out):
    """Ids in the files and in the topic, and the rows that the windows hold."""
    from labormart.streaming.windows import read_report, reported_rows

    files = sorted(r.id for r in spark.read.json(out["files"]).collect())
    topic = sorted(json.loads(r.value)["id"] for r in spark.read.text(out["topic"]).collect())
    return files, topic, reported_rows(read_report(spark, out["report"])).first().reported


def test_collect_pages_to_files_topic_and_report(spark, tmpdir_path):
    from labormart.jobs import collect, finish_collect
    from labormart.streaming.windows import read_report

    pages, out = os.path.join(tmpdir_path, "pages"), outputs(tmpdir_path)
    os.makedirs(pages)
    write_lines(pages, "p.txt", [*page(spark, ITEMS), "no page"])
    queries = collect(spark, pages, out["files"], out["topic"], out["report"],
                      trigger={"availableNow": True}, watermark="0 seconds", checkpoint_root=os.path.join(tmpdir_path, "ck"))
    for q in queries:
        q.awaitTermination()
    seen = [p.observedMetrics["pages"] for p in queries[0].recentProgress if "pages" in p.observedMetrics]
    assert (sum(m["read"] for m in seen), sum(m["rejected"] for m in seen)) == (2, 1)
    # the window of the collection time is still open when the input ends: the tail holds it
    finish_collect(spark, out["files"], out["report"])
    finish_collect(spark, out["files"], out["report"])
    assert held(spark, out) == (["1", "2"], ["1", "2"], 2)
    report = read_report(spark, out["report"]).collect()
    assert [(r.area, r.area_count, r.total_count) for r in report] == [("Москва", 2, 2)]
    # one stamp for the file, the message and the window
    stamps = {r.collected_at for r in spark.read.json(out["files"]).collect()}
    stamps |= {json.loads(r.value)["collected_at"] for r in spark.read.text(out["topic"]).collect()}
    assert len(stamps) == 1
    assert report[0].window_start <= stamps.pop() < report[0].window_end
    commits = spark.read.json(out["topic"] + "_commits").collect()
    assert [(r.messages, r.files) for r in commits] == [(2, 1)]


@pytest.mark.parametrize("reached", ["files", "topic"])
def test_collect_stopped_between_two_batches(spark, tmpdir_path, reached):
    """A stop after some of the outputs have a batch: the next start brings all to the same records."""
    from labormart.jobs import collect, finish_collect, valid_items
    from labormart.schema import RAW_SCHEMA
    from labormart.sources.messages import observe_rejects
    from labormart.streaming.windows import beside, committed_records, start_jsonl_sink, start_topic

    pages, out, now = os.path.join(tmpdir_path, "pages"), outputs(tmpdir_path), {"availableNow": True}
    os.makedirs(pages)
    write_lines(pages, "a.txt", page(spark, ITEMS))
    raw = spark.readStream.schema("value STRING").text(pages).select("value", "_metadata")
    start_jsonl_sink(valid_items(observe_rejects(raw, "pages")), out["files"], checkpoint=beside(out["files"]), trigger=now).awaitTermination()
    if reached == "topic":
        start_topic(committed_records(spark, out["files"], RAW_SCHEMA), out["topic"], trigger=now).awaitTermination()
    write_lines(pages, "b.txt", page(spark, [(str(10 + i), *x[1:]) for i, x in enumerate(ITEMS)]))
    for q in collect(spark, pages, out["files"], out["topic"], out["report"], trigger=now):
        q.awaitTermination()
    finish_collect(spark, out["files"], out["report"])
    ids = ["1", "10", "11", "2"]
    assert held(spark, out) == (ids, ids, 4)


def test_collect_into_packed_files(spark, tmpdir_path, monkeypatch):
    """Files and messages of a given compression hold the records, and no batch of the topic is kept in the meantime."""
    from pyspark.sql import DataFrame

    from labormart.jobs import collect, finish_collect

    pages, out = os.path.join(tmpdir_path, "pages"), outputs(tmpdir_path)
    os.makedirs(pages)
    write_lines(pages, "a.txt", [*page(spark, ITEMS), "no page"])
    levels, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: (levels.append(self.columns), persist(self, *a))[1])
    for q in collect(spark, pages, out["files"], out["topic"], out["report"], trigger={"availableNow": True}, compression="gzip"):
        q.awaitTermination()
    assert not any("collected_at" in columns for columns in levels)
    finish_collect(spark, out["files"], out["report"])
    assert held(spark, out) == (["1", "2"], ["1", "2"], 2)
    for name, kind in (("files", ".json.gz"), ("topic", ".txt.gz")):
        data = [f for _, _, fs in os.walk(out[name]) for f in fs if f.startswith("part-")]
        assert data and all(f.endswith(kind) for f in data)
    assert [(r.messages, r.files) for r in spark.read.json(out["topic"] + "_commits").collect()] == [(2, 1)]
    assert os.listdir(out["topic"] + "_commits_staged") == []


def run_job(args, wait_for, timeout=120):
    """Start a job as a process, wait for a file or folder, stop it with SIGTERM; its exit code and output."""
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "SPARK_LOCAL_IP": "127.0.0.1",
           "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=2 --conf spark.ui.enabled=false pyspark-shell"}
    job = subprocess.Popen([sys.executable, "-m", "labormart.jobs", *args], env=env, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True)
    try:
        end = time.time() + timeout
        while not wait_for() and time.time() < end and job.poll() is None:
            time.sleep(0.5)
        job.send_signal(signal.SIGTERM)
        text, _ = job.communicate(timeout=timeout)
    finally:
        job.kill()
    return job.returncode, text


def test_collect_ends_on_sigterm_with_its_windows_written(spark, tmpdir_path):
    pages, out = os.path.join(tmpdir_path, "pages"), outputs(tmpdir_path)
    os.makedirs(pages)
    write_lines(pages, "p.txt", page(spark, ITEMS))
    code, text = run_job(["collect", "--pages-dir", pages, "--files-out", out["files"], "--topic-dir", out["topic"], "--report-out", out["report"]],
                         lambda: os.path.isdir(os.path.join(out["topic"], "batch_id=0")))
    assert code == 0 and "stopped" in text, text[-2000:]
    assert held(spark, out) == (["1", "2"], ["1", "2"], 2)
    from labormart.streaming.windows import progress_totals

    totals = {r.name: r for r in progress_totals(spark, out["report"] + "_progress").collect()}
    assert totals["collect_topic"].received == 2 and totals["collect_files"].rejected == 0


def test_consume_ends_on_sigterm_with_its_windows_written(spark, tmpdir_path):
    from labormart.streaming.windows import read_report

    topic, out = os.path.join(tmpdir_path, "topic"), os.path.join(tmpdir_path, "out")
    os.makedirs(topic)
    write_lines(topic, "m.txt", [json.dumps({"id": str(i), "area_name": "A", "salary_from": 100, "collected_at": f"2025-05-01T10:00:{i:02d}Z"}) for i in range(30)] + ["no message"])
    code, text = run_job(["consume", "--topic-dir", topic, "--out", out, "--window", "20", "--every", "10"],
                         lambda: os.path.isdir(os.path.join(out, "stats")))
    assert code == 0 and "stopped" in text, text[-2000:]
    got = read_report(spark, f"{out}/stats").orderBy("window_start").collect()
    assert [(r.window_start[14:19], r.total) for r in got] == [("59:50", 10), ("00:00", 20), ("00:10", 20), ("00:20", 10)]


def test_dashboard_tables(spark, five_dir, tmpdir_path):
    from labormart.jobs import dashboard

    written = dashboard(spark, five_dir, os.path.join(tmpdir_path, "dash"), every_sec=1, rounds=2)
    head = spark.read.parquet(written["headline"]).first()
    assert (head.vacancies, head.areas, head.employers) == (4, 3, 3)
    skills = {r.skill: r["count"] for r in spark.read.parquet(written["skills"]).collect()}
    assert skills["Python"] == 4
    assert skills["C++"] == 4  # unescaped C++ means "contains c": "Docker" has one
    assert spark.read.parquet(written["raw_data"]).columns[:2] == ["id", "name"]


def test_analyze_with_bad_files_only(spark, tmpdir_path):
    """Where every file has a bad line nothing is left: the reports are empty, not an error."""
    from labormart.jobs import analysis_tables

    write_lines(tmpdir_path, "a.jsonl", ['{"id": "1", "name": "abc"}', '{"id":'])
    tables = analysis_tables(spark, tmpdir_path, os.path.join(tmpdir_path, "out"))
    assert [(r.stage, r.rows_out) for r in tables["stages"].collect()] == [("lines", 2), ("load", 0), ("dedup", 0), ("clean", 0)]
    assert tables["bad_files"].count() == 1 and tables["by_area"].count() == 0 and tables["timeline"].count() == 0
