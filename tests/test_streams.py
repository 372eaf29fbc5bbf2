"""Streams over restarts and long runs: progress totals, cadence, checkpoints, empty reports, trailing counts."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from labormart.operators import windows as W
from labormart.streaming import windows as SW

SCHEMA = "id STRING, ts TIMESTAMP, area_name STRING, salary_from BIGINT, salary_to BIGINT, snippet_requirement STRING"
T0 = dt.datetime(2025, 5, 1, 10, 0, 0)
NOW = {"availableNow": True}


def rows_at(seconds, area="A", start=0):
    return [(str(start + i), None if s is None else T0 + dt.timedelta(seconds=s), area, 100, 200, None) for i, s in enumerate(seconds)]


def add(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, **options):
    return spark.readStream.schema(SCHEMA).options(**options).parquet(folder)


def test_progress_totals_over_more_than_100_batches_and_a_restart(spark, tmpdir_path):
    """Spark keeps the last 100 reports of a run; the table has every batch of both runs."""
    from labormart.sources.messages import observe_rejects

    folder, out, log_path = (os.path.join(tmpdir_path, n) for n in ("in", "out", "log"))
    os.makedirs(folder)
    line = '{"id": "%d", "collected_at": "2025-05-01T10:00:00Z"}\n'

    def run(files):
        for i in files:
            with open(os.path.join(folder, f"{i:04d}.json"), "w", encoding="utf-8") as f:
                f.write(line % i + ("broken\n" if i % 10 == 0 else ""))
        log = SW.ProgressLog(spark, log_path, names=["many"])
        texts = spark.readStream.schema("value STRING").option("maxFilesPerTrigger", 1).text(folder)
        q = (observe_rejects(texts, "messages").writeStream.foreachBatch(lambda df, i: df.write.format("noop").mode("overwrite").save())
             .option("checkpointLocation", SW.checkpoint_for(spark, out)).queryName("many").trigger(**NOW).start())
        q.awaitTermination()
        log.close([q])
        return q

    q = run(range(105))
    assert len(q.recentProgress) <= 100
    run(range(105, 112))
    total = SW.progress_totals(spark, log_path).collect()
    assert [(r.name, r.received, r.rejected, r.batches) for r in total] == [("many", 112 + 12, 12, 112)]
    assert SW.progress_table(spark, log_path).agg(F.count_distinct("run_id")).first()[0] == 2


def test_replayed_batch_replaces_its_row(spark, tmpdir_path):
    """A batch that runs again after a restart is counted once."""
    folder, log_path = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "log")
    add(spark, folder, rows_at([0, 1, 2]))
    failed = {"now": True}

    def write(df, batch):
        df.write.format("noop").mode("overwrite").save()
        if failed["now"]:
            raise RuntimeError("lost")

    for _ in range(2):
        log = SW.ProgressLog(spark, log_path, names=["again"])
        q = (source(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
             .queryName("again").trigger(**NOW).start())
        if failed["now"]:
            with pytest.raises(Exception, match="lost"):
                q.awaitTermination()
        else:
            q.awaitTermination()
        log.close([q])
        failed["now"] = False
    assert [(r.received, r.batches) for r in SW.progress_totals(spark, log_path).collect()] == [(3, 1)]


def test_late_rows_are_dropped_and_counted(spark, tmpdir_path):
    folder, out, log_path = (os.path.join(tmpdir_path, n) for n in ("in", "out", "log"))
    log, queries = SW.ProgressLog(spark, log_path, names=["late"]), []
    for rows in (rows_at([0, 30, 600, 1200]), rows_at([10, 20, 610, 1210, 1300], start=10)):
        add(spark, folder, rows)
        q = SW.start_tumbling_report(SW.event_time(source(spark, folder), watermark="1 minute"), out, trigger=NOW, name="late")
        q.awaitTermination()
        queries.append(q)
    log.close(queries)
    SW.flush_tail(spark.read.parquet(folder), out)
    total = SW.progress_totals(spark, log_path).first()
    held = SW.reported_rows(SW.read_report(spark, out)).first().reported
    assert (total.received, held) == (9, 6) and total.late > 0


def test_reports_keep_their_cadence(spark, tmpdir_path):
    """While data keeps coming, a batch starts on the clock's multiples of the report interval; one that
    takes longer than the interval is followed at once."""
    from labormart.jobs import consume

    topic, every = os.path.join(tmpdir_path, "topic"), 4
    os.makedirs(topic)

    def send(i):
        with open(os.path.join(topic, f"{i}.txt"), "w", encoding="utf-8") as f:
            f.write('{"id": "%d", "area_name": "A", "collected_at": "2025-05-01T10:%02d:00Z"}\n' % (i, i))

    send(0)
    q = consume(spark, topic, os.path.join(tmpdir_path, "out"), window_sec=60, every_sec=every)
    try:
        for i in range(1, 50):
            time.sleep(0.5)
            send(i)
    finally:
        q.stop()
    runs = [(dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp(), p.durationMs["triggerExecution"] / 1000) for p in q.recentProgress]
    assert len(runs) >= 3 and sum(p.numInputRows for p in q.recentProgress) > 10
    for (start, took), (after, _) in zip(runs[:-1], runs[1:], strict=True):
        if took < every - 1:  # on time: the next one waits for the clock
            assert min(after % every, every - after % every) < 1 and after > start + took


def test_default_checkpoint_is_beside_the_output(spark, tmpdir_path):
    folder, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    for rows in (rows_at([0, 60, 120]), rows_at([180, 240, 300, 360], start=10)):
        add(spark, folder, rows)
        SW.start_tumbling_report(SW.event_time(source(spark, folder), watermark="0 seconds"), out, trigger=NOW).awaitTermination()
    SW.flush_tail(spark.read.parquet(folder), out)
    got = sorted(map(tuple, SW.read_report(spark, out).collect()))
    assert got == sorted(map(tuple, W.window_report(spark.read.parquet(folder)).collect()))
    assert os.path.isdir(out + "_checkpoint")


def test_start_without_the_checkpoint_is_refused(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "in")
    add(spark, folder, rows_at([0, 60, 120]))
    stream = SW.event_time(source(spark, folder), watermark="0 seconds")
    starts = {
        "report": lambda out, ck: SW.start_tumbling_report(stream, out, checkpoint=ck, trigger=NOW),
        "sliding": lambda out, ck: SW.start_sliding_report(stream, out, checkpoint=ck, trigger=NOW),
        "files": lambda out, ck: SW.start_jsonl_sink(stream, out, checkpoint=ck, trigger=NOW),
        "fan": lambda out, ck: SW.start_fan_out(stream, out, None, checkpoint=ck, trigger=NOW),
    }
    for name, start in starts.items():
        out = os.path.join(tmpdir_path, name)
        start(out, None).awaitTermination()
        start(out, None).awaitTermination()  # its own checkpoint: goes on
        with pytest.raises(ValueError, match="checkpoint"):
            start(out, os.path.join(tmpdir_path, name + "-other"))


def test_empty_windows_are_reported(spark):
    df = spark.createDataFrame(rows_at([5, 12, 100], area="B"), SCHEMA)
    got = {r.window_start[14:19]: tuple(r)[2:] for r in W.sliding_stats(df, size="20 seconds", slide="10 seconds", spine=True).collect()}
    want = {t: (20, 0, 0.0, "", 0) for t in ("00:20", "00:30", "00:40", "00:50", "01:00", "01:10", "01:20")}
    want |= {t: (20, 1, 100.0, "B", 1) for t in ("59:50", "00:10", "01:30", "01:40")} | {"00:00": (20, 2, 100.0, "B", 2)}
    assert got == want
    assert W.sliding_stats(df.limit(0), spine=True).count() == 0


def test_spine_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(W, "SPINE_ROWS", 7)
    df = spark.createDataFrame(rows_at([0, 500, 501, 1999]), SCHEMA)
    got = W.sliding_stats(df, size="30 seconds", slide="10 seconds", spine=True)
    starts = sorted(r.window_start for r in got.collect())
    assert len(starts) == len(set(starts)) == (1990 + 20) // 10 + 1
    some = W.sliding_stats(df, size="30 seconds", slide="10 seconds")
    assert {tuple(r) for r in got.where("total > 0").collect()} == {tuple(r) for r in some.collect()}


def test_streamed_empty_reports(spark, tmpdir_path):
    """Gaps within a batch, between batches and before the tail are all reported, each once."""
    folder, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "sl")
    for rows in (rows_at([0, 7, 95]), rows_at([300, 310, 480], start=10), rows_at([700], start=20)):
        add(spark, folder, rows)
        SW.start_sliding_report(SW.event_time(source(spark, folder), watermark="0 seconds"), out, size="20 seconds", slide="10 seconds",
                                spine=True, trigger=NOW).awaitTermination()
    whole = spark.read.parquet(folder)
    SW.flush_sliding_tail(whole, out, size="20 seconds", slide="10 seconds", spine=True)
    got = sorted(map(tuple, SW.read_report(spark, out + "/stats").collect()))
    assert got == sorted(map(tuple, W.sliding_stats(whole, size="20 seconds", slide="10 seconds", spine=True).collect()))


def streamed_counts(spark, folder, out, ck, watermark):
    stream = SW.event_time(source(spark, folder), watermark=watermark)
    (SW.trailing_count_stream(stream).writeStream.outputMode("append").foreachBatch(SW.write_per_batch(out))
     .option("checkpointLocation", ck).trigger(**NOW).start().awaitTermination())


def test_trailing_counts_on_a_stream(spark, tmpdir_path):
    """Equal to the batch form for every event that the watermark has passed; late and timeless events count nowhere."""
    folder, out, ck = (os.path.join(tmpdir_path, n) for n in ("in", "out", "ck"))
    batches = [rows_at([0, 0, 1, 299, 300, 300.5, None, 601]), rows_at([700, 1500, 1800, 1800, 1801], start=20), rows_at([5, 6, 9000], start=40)]
    for rows in batches:
        add(spark, folder, rows)
        streamed_counts(spark, folder, out, ck, "10 seconds")
    got = {(r.id, r.rows): r.trailing_count for r in spark.read.parquet(out).collect()}
    in_time = spark.createDataFrame([r for b in batches for r in b if r[0] not in ("40", "41")], SCHEMA)
    want = {(r.id, 1): r.trailing_count for r in W.trailing_count(in_time).collect() if r.trailing_count is not None and r.id != "42"}
    assert got == want and len(got) == 12


def test_repeated_rows_on_a_stream_are_counted(spark, tmpdir_path):
    folder, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    add(spark, folder, rows_at([0])[:1] * 3 + rows_at([9000], start=5))
    streamed_counts(spark, folder, out, os.path.join(tmpdir_path, "ck"), "0 seconds")
    assert [(r.id, r.rows, r.trailing_count) for r in spark.read.parquet(out).collect()] == [("0", 3, 3)]


def test_dense_events_are_counted_without_pairs(spark, tmpdir_path):
    """Many events in few spans: equal to the batch form, and no event meets the others of its window in a join."""
    folder, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    add(spark, folder, rows_at([i * 0.7 for i in range(1500)] + [9000]))
    plan = SW.trailing_count_stream(SW.event_time(source(spark, folder), watermark="1 second"))._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan
    streamed_counts(spark, folder, out, os.path.join(tmpdir_path, "ck"), "1 second")
    got = {r.id: (r.rows, r.trailing_count) for r in spark.read.parquet(out).collect()}
    want = {r.id: (1, r.trailing_count) for r in W.trailing_count(spark.read.parquet(folder)).collect() if r.id != "1500"}
    assert got == want and len(got) == 1500
