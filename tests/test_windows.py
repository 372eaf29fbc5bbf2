"""Tumbling and sliding windows, batch and streaming forms, with the operators' defaults."""

import datetime as dt
import os

from pyspark.sql import functions as F

from labormart.operators import windows as W
from labormart.streaming import windows as SW

T0 = dt.datetime(2025, 5, 1, 10, 0, 5)
SCHEMA = "id STRING, ts TIMESTAMP, area_name STRING, salary_from BIGINT, salary_to BIGINT, " \
         "snippet_requirement STRING"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_tumbling_aggregate(spark):
    df = _rows(spark, [("1", T0, "Москва", 150000, 250000, "Go Docker"),
                       ("2", T0, "Москва", 120000, 200000, "Python"),
                       ("3", T0, "СПб", 100000, 180000, "Go")])
    total = W.tumbling_total(df).first()
    assert total.total_count == 3
    by_area = {r.area: r for r in W.tumbling_by_area(df).collect()}
    assert by_area["Москва"].area_count == 2
    rep = W.window_report(df).collect()
    assert len(rep) == 2 and {r.top_skill for r in rep} == {"Go"}
    assert rep[0].window_start == "2025-05-01T10:00:00Z"
    assert rep[0].window_end == "2025-05-01T10:01:00Z"


def test_tumbling_empty(spark):
    assert W.tumbling_total(_rows(spark, [])).count() == 0


def test_tumbling_salary(spark):
    df = _rows(spark, [("1", T0, "Москва", 100000, 200000, None),
                       ("2", T0, "Москва", 200000, 300000, None)])
    r = W.tumbling_by_area(df).first()
    assert r.with_salary == 2 and r.avg_from == 150000.0
    assert (r.min_from, r.max_to) == (100000, 300000)


def test_salary_accumulator_zero_rules(spark):
    df = _rows(spark, [("1", T0, "A", 0, 500, None), ("2", T0, "A", 300, 0, None),
                       ("3", T0, "A", 0, 0, None)])
    r = W.tumbling_by_area(df).first()
    assert r.with_salary == 2          # no salary record when both bounds are absent
    assert r.min_from == 300 and r.max_to == 500
    assert r.avg_from == 300.0 and r.avg_to == 500.0


def test_given_zeros_and_empty_salary_records_count(spark):
    """Averages take a given 0; a salary record without bounds still counts as one."""
    from labormart.operators.clean import given_salaries

    s = "struct<from:string,to:string,currency:string,gross:boolean>"
    df = spark.createDataFrame(
        [("1", ("0", "100", None, None)), ("2", ("100", "100", None, None)),
         ("3", (None, None, None, None)), ("4", None)], f"id string, salary {s}")
    df = given_salaries(df).withColumns({"ts": F.lit(T0), "area_name": F.lit("A")})
    r = W.tumbling_by_area(df, has_salary="has_salary").first()
    assert (r.area_count, r.with_salary, r.avg_from, r.avg_to) == (4, 3, 50.0, 100.0)
    assert (r.min_from, r.max_to) == (100, 100)


def test_trailing_count_keeps_events_without_time(spark):
    base = dt.datetime(2025, 5, 1, 0, 59, 59, 999999)
    offs = [0, 0, 300, None, 300.000001, 3600, None]
    df = _rows(spark, [(str(i), o if o is None else base + dt.timedelta(seconds=o), "A", 0, 0, None)
                       for i, o in enumerate(offs)])
    out = W.trailing_count(df, bucket="300 seconds")
    assert {r.id: r.trailing_count for r in out.collect()} == {
        "0": 2, "1": 2, "2": 3, "3": None, "4": 2, "5": 1, "6": None}


def test_report_without_skills(spark):
    df = _rows(spark, [("1", T0, "Москва", 1, 2, "none"), ("2", T0, "Санкт-Петербург", 1, 2, None)])
    rep = W.window_report(df).collect()
    assert {(r.top_skill, r.skill_count) for r in rep} == {("", 0)}
    assert {r.total_count for r in rep} == {2}


def test_sliding_defaults(spark):
    t = dt.datetime(2025, 5, 1, 10, 0, 0)
    df = _rows(spark, [("1", t, "A", 100, 0, None), ("2", t + dt.timedelta(seconds=15), "B", 0, 0, None),
                       ("3", t + dt.timedelta(seconds=15), "B", 300, 0, None)])
    stats = W.sliding_stats(df).collect()
    assert len(stats) == 31     # 300 s windows every 10 s covering the three events
    full = [s for s in stats if s.total == 3]
    assert full and all(s.top_area == "B" and s.top_area_count == 2 for s in full)
    assert all(s.avg_salary_from == 200.0 for s in full)
    only_b = [s for s in stats if s.total == 2]
    assert all(s.avg_salary_from == 300.0 for s in only_b)
    top = W.sliding_top_areas(df, n=1).collect()
    assert all(r.rank == 1 for r in top)


def test_sliding_matches_spark_hopping_window(spark):
    base = dt.datetime(2025, 5, 1, 10, 0, 0)
    rows = [(str(i), base + dt.timedelta(seconds=7 * i), "A" if i % 3 else "B", i * 10, 0, None)
            for i in range(60)]
    df = _rows(spark, rows)
    mine = {(r.window_start, r.area): r.cnt for r in W.sliding_by_area(df).collect()}
    ref = (df.groupBy(F.window("ts", "300 seconds", "10 seconds").alias("w"), "area_name").count()
             .select(F.date_format("w.start", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("s"),
                     "area_name", "count").collect())
    assert mine == {(r.s, r.area_name): r["count"] for r in ref}


def test_trailing_count_brute_force(spark):
    base = dt.datetime(2025, 5, 1, 0, 0, 0)
    offs = [0, 100, 299, 300, 300, 301, 1000, 3599, 3600, 3700, 3899, 3900, 7300]
    df = _rows(spark, [(str(i), base + dt.timedelta(seconds=o), "A", 0, 0, None)
                       for i, o in enumerate(offs)])
    got = {r.id: r.trailing_count for r in W.trailing_count(df, bucket="600 seconds").collect()}
    want = {str(i): sum(1 for p in offs if o - 300 <= p <= o) for i, o in enumerate(offs)}
    assert got == want


def test_trailing_count_hot_timestamp(spark):
    base = dt.datetime(2025, 5, 1, 0, 0, 0)
    offs = [0] * 50 + [10, 10, 200, 301, 301]
    df = _rows(spark, [(str(i), base + dt.timedelta(seconds=o), "A", 0, 0, None)
                       for i, o in enumerate(offs)])
    got = {r.id: r.trailing_count for r in W.trailing_count(df).collect()}
    want = {str(i): sum(1 for p in offs if o - 300 <= p <= o) for i, o in enumerate(offs)}
    assert got == want and got["0"] == 50 and got["54"] == 5


def test_stream_equals_batch(spark, tmpdir_path):
    base = dt.datetime(2025, 5, 1, 10, 0, 0)
    rows = [(str(i), base + dt.timedelta(seconds=13 * i), ["A", "B", "C"][i % 3], 1000 + i,
             2000 + i, "Go" if i % 2 else "Rust Kafka") for i in range(40)]
    src = os.path.join(tmpdir_path, "src")
    _rows(spark, rows).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    out = os.path.join(tmpdir_path, "rep")
    q = SW.start_tumbling_report(SW.event_time(stream, watermark="1 minute"), out,
                                 checkpoint=os.path.join(tmpdir_path, "ck1"),
                                 output_mode="complete", trigger={"availableNow": True})
    q.awaitTermination()
    got = SW.read_report(spark, out, complete_mode=True)
    want = W.window_report(_rows(spark, rows))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    out2 = os.path.join(tmpdir_path, "sl")
    q = SW.start_sliding_report(SW.event_time(stream, watermark="1 minute"), out2,
                                checkpoint=os.path.join(tmpdir_path, "ck2"),
                                output_mode="complete", trigger={"availableNow": True})
    q.awaitTermination()
    got = SW.read_report(spark, out2 + "/stats", complete_mode=True)
    want = W.sliding_stats(_rows(spark, rows))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(p.numInputRows for p in q.recentProgress) == 40


def test_stream_append_mode_then_flush_tail(spark, tmpdir_path):
    base = dt.datetime(2025, 5, 1, 10, 0, 0)
    rows = [(str(i), base + dt.timedelta(seconds=30 * i), "A" if i % 2 else "B", 1, 1, "Go")
            for i in range(10)]
    src = os.path.join(tmpdir_path, "src")
    _rows(spark, rows).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    out = os.path.join(tmpdir_path, "rep")
    q = SW.start_tumbling_report(SW.event_time(stream, watermark="0 seconds"), out,
                                 checkpoint=os.path.join(tmpdir_path, "ck"),
                                 trigger={"availableNow": True})
    q.awaitTermination()
    # append mode emits a window only after the watermark passed its end: the last window
    # (10:04, still open when the input ended) is missing
    emitted = SW.read_report(spark, out).collect() if os.path.exists(out) else []
    assert all(r.window_start < "2025-05-01T10:04:00Z" for r in emitted)
    SW.flush_tail(spark.read.parquet(src), out)
    got = sorted(map(tuple, SW.read_report(spark, out).collect()))
    want = sorted(map(tuple, W.window_report(_rows(spark, rows)).collect()))
    assert got == want


def test_stream_sliding_panes_append(spark, tmpdir_path):
    base = dt.datetime(2025, 5, 1, 10, 0, 0)
    rows = [(str(i), base + dt.timedelta(seconds=7 * i), ["A", "B"][i % 2], 100 * (i % 4), 0, None)
            for i in range(200)]
    src = os.path.join(tmpdir_path, "src")
    _rows(spark, rows).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    out = os.path.join(tmpdir_path, "sl")
    q = SW.start_sliding_report(SW.event_time(stream, watermark="0 seconds"), out,
                                checkpoint=os.path.join(tmpdir_path, "ck"),
                                trigger={"availableNow": True})   # append → panes
    q.awaitTermination()
    got = {r.window_start: tuple(r) for r in SW.read_report(spark, out + "/stats").collect()}
    want = {r.window_start: tuple(r) for r in W.sliding_stats(_rows(spark, rows)).collect()}
    last = max(r[1] for r in rows)
    finished = {k for k, v in want.items() if v[1] <= last.strftime("%Y-%m-%dT%H:%M:%SZ")}
    assert got and set(got) <= set(want)
    assert {k: want[k] for k in got} == got
    assert set(got) == finished  # every window that ended by the last event, no other


def test_flush_tail_without_emitted_windows(spark, tmpdir_path):
    rows = [("1", T0, "A", 1, 1, None), ("2", T0, "B", 1, 1, None)]
    out = os.path.join(tmpdir_path, "nothing-yet")
    tail = SW.flush_tail(_rows(spark, rows), out)
    assert tail.count() == 2
    assert SW.read_report(spark, out).count() == 2


def test_flush_tail_reads_its_source_once(spark, tmpdir_path):
    """Areas and skills of the tail come from one pass over the source."""
    rows = [(str(i), T0, "A", 1, 1, "Go Docker") for i in range(40)]
    read = spark.sparkContext.accumulator(0)

    def seen(area):
        read.add(1)
        return area

    noted = F.udf(seen, "string").asNondeterministic()
    out = os.path.join(tmpdir_path, "once")
    source = _rows(spark, rows).withColumn("area_name", noted("area_name")).withColumn("snippet_requirement", noted("snippet_requirement"))
    SW.flush_tail(source, out)
    assert read.value == 2 * len(rows)
    got = SW.read_report(spark, out).first()
    assert (got.area, got.total_count, got.top_skill, got.skill_count) == ("A", 40, "Docker", 40)


def test_jsonl_stream_sink(spark, tmpdir_path):
    base = dt.datetime(2025, 5, 1, 10, 0, 0)
    rows = [(str(i), base, "A", 1, 1, None) for i in range(120)]
    src = os.path.join(tmpdir_path, "src")
    _rows(spark, rows).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    out = os.path.join(tmpdir_path, "jsonl")
    q = SW.start_jsonl_sink(stream, out, checkpoint=os.path.join(tmpdir_path, "ck"),
                            trigger={"availableNow": True})
    q.awaitTermination()
    files = [f for f in os.listdir(out) if f.endswith(".json")]
    assert len(files) == 3  # 120 rows, at most 50 per file
    assert spark.read.json(out).count() == 120


def test_window_report_fixture_cases(spark):
    # one window: 42 rows, Москва 30 and Санкт-Петербург 12, no skills → 2 rows
    rows = [(str(i), T0, "Москва" if i < 30 else "Санкт-Петербург", 0, 0, None) for i in range(42)]
    rep = W.window_report(_rows(spark, rows)).collect()
    assert len(rep) == 2
    assert {(r.area, r.area_count, r.total_count, r.top_skill, r.skill_count) for r in rep} == {
        ("Москва", 30, 42, "", 0), ("Санкт-Петербург", 12, 42, "", 0)}
    # three windows with 10, 20, 30 rows of one area each → 3 rows
    rows = [(f"{w}-{i}", T0 + dt.timedelta(minutes=w), f"A{w}", 0, 0, None)
            for w, n in enumerate((10, 20, 30)) for i in range(n)]
    rep = W.window_report(_rows(spark, rows)).collect()
    assert sorted((r.area, r.total_count) for r in rep) == [("A0", 10), ("A1", 20), ("A2", 30)]
    # no rows → no window
    assert W.window_report(_rows(spark, [])).count() == 0


def test_stream_restart_from_checkpoint_no_duplicates(spark, tmpdir_path):
    base = dt.datetime(2025, 5, 1, 10, 0, 0)
    src = os.path.join(tmpdir_path, "src")
    ck = os.path.join(tmpdir_path, "ck")
    files, msgs = os.path.join(tmpdir_path, "files"), os.path.join(tmpdir_path, "msgs")

    def add(part, n):
        _rows(spark, [(f"{part}-{i}", base, "A", 1, 1, None) for i in range(n)]
              ).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        q = SW.start_fan_out(stream, files, msgs, checkpoint=ck, trigger={"availableNow": True})
        q.awaitTermination()

    add("a", 5)
    run()                       # first run: 5 records
    add("b", 7)
    run()                       # restart from the checkpoint: only the 7 new ones
    got = spark.read.json(files)
    assert got.count() == 12 and got.select("id").distinct().count() == 12
    assert spark.read.text(msgs).count() == 12


def test_tail_gives_way_to_a_restarted_stream(spark, tmpdir_path):
    """Windows of the tail that the stream, started again, emitted itself are read once."""
    from labormart.streaming.windows import read_report

    out = f"{tmpdir_path}/report"
    for batch, ends in ((0, ["01"]), ("final", ["02", "03"]), (1, ["02"])):
        rows = [(f"2024-01-01T{e}:00:00Z", str(batch)) for e in ends]
        spark.createDataFrame(rows, "window_end STRING, by STRING").write.parquet(
            f"{out}/batch_id={batch}")
    got = sorted((r.window_end[11:13], r.by) for r in read_report(spark, out).collect())
    assert got == [("01", "0"), ("02", "1"), ("03", "final")]
