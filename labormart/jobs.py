"""Job entry points: the batch analyzer, the stream consumer and the collector as Spark jobs.

    python -m labormart.jobs analyze --data-dir DIR --out OUT [--glob '*.jsonl']
    python -m labormart.jobs consume --topic-dir DIR --out OUT [--window 300 --every 10]
    python -m labormart.jobs collect --pages-dir DIR --files-out F --topic-dir T --report-out R
    python -m labormart.jobs dashboard --data-dir DIR --out OUT [--every 30]

``analyze`` reads the JSONL folder once, cleans it, writes the clean table as Parquet (clustered by
day) and every report table (profile, stages, bad files, aggregates, SQL reports, distributions,
skills, timeline) as Parquet folders under ``OUT``.
``consume`` runs the sliding-window report over a message folder (or Kafka) until stopped.
``collect`` turns stored result pages into validated records in JSONL files; the topic and the tumbling
window report are made from the committed files, so all three hold the same records.
Both streams end on SIGINT, SIGTERM or a failed query: what has arrived is worked off, the windows
still open are written, then they stop. Their progress is written to ``<out>_progress``.
"""

from __future__ import annotations

import argparse
import signal
import sys
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labormart.functions import iso_text
from labormart.operators import aggregates as A
from labormart.operators import distribution as D
from labormart.operators import profile as PR
from labormart.operators import skills as K
from labormart.operators.clean import cast_salaries, dedup_first, filter_names, flatten
from labormart.schema import RAW_SCHEMA
from labormart.session import written
from labormart.sources.files import StagedLines, parquet_view, save_parquet

#: Rows per file of the clean table: a day of more rows gets more files.
ROWS_PER_FILE = 2_000_000


def analysis_tables(spark: SparkSession, data_dir: str, parquet_dir: str,
                    view: str = "vacancies", glob: str = "*.jsonl",
                    rows_per_file: int = ROWS_PER_FILE) -> dict[str, DataFrame]:
    """Load + clean the folder, write the clean table to ``parquet_dir`` (partitioned by
    publication day) and return the report tables, lazily, by name.

    The text is scanned once (:class:`StagedLines`): rows, bad files, profile and counts come from
    the staged table. The stages' rows are counted by the job that cleans."""
    staged = StagedLines(spark, data_dir, glob=glob)
    raw = staged.rows()
    loaded, o_loaded = PR.observe_rows(raw, "loaded")
    unique, o_unique = PR.observe_rows(dedup_first(cast_salaries(flatten(loaded))), "unique")
    cleaned, o_clean = PR.observe_rows(filter_names(unique), "clean")
    vac = written(cleaned.withColumn("published_date", F.substring("published_at", 1, 10)), "clean")
    save_parquet(vac, parquet_dir, partition_by=["published_date"], rows_per_file=rows_per_file)
    # Where every file is bad nothing is left: an empty table whose dates are dates, as read back otherwise.
    schema = vac.withColumn("published_date", F.col("published_date").cast("date")).schema
    pq = parquet_view(spark, parquet_dir, view, empty=schema)
    lines = staged.counts().first()
    return {
        "bad_files": staged.bad_files(),
        "stages": PR.stage_table(spark, [("lines", lines["lines"]), ("load", o_loaded.get["rows"]),
                                         ("dedup", o_unique.get["rows"]), ("clean", o_clean.get["rows"])]),
        "profile_nulls": PR.null_profile(raw),
        "profile_shape": PR.shape(raw),
        "head": PR.head(pq.orderBy("id"), 5),
        "by_area": A.aggregate_by_area(pq),
        "by_employer": A.aggregate_by_employer(pq),
        "top_areas": A.top_areas(pq),
        "salary_distribution": D.salary_distribution(pq),
        "percentile_salary": D.median_by_area(pq, min_count=5),
        "compare_areas": A.area_avg_with_zeros(pq),
        "timeline": A.timeline(pq),
        "salary_histogram": D.salary_histogram(pq, bins=30),
        "salary_box": D.salary_box(pq, n=10),
        "area_counts": A.area_counts(pq, n=15),
        "skills": K.skill_counts(pq),
    }


def analyze(spark: SparkSession, data_dir: str, out: str, glob: str = "*.jsonl") -> dict[str, str]:
    """Run the batch analyzer; returns report name → written folder."""
    out = out.rstrip("/")
    tables = analysis_tables(spark, data_dir, f"{out}/vacancies.parquet", glob=glob)
    written_to = {}
    for name, df in tables.items():
        path = f"{out}/{name}"
        df.write.mode("overwrite").parquet(path)
        written_to[name] = path
    return written_to


def dashboard_tables(vac: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the dashboard, from the clean table (a snapshot)."""
    from labormart.operators.clean import available_columns

    return {
        "headline": A.headline(vac),
        "area_counts": A.area_counts(vac, n=15),
        "employers": A.employers_table(vac, n=10),
        "salary_histogram": D.salary_histogram(vac, bins=25),
        "salary_box": D.salary_box(vac, n=8),
        "skills": K.regex_skill_counts(vac),
        "raw_data": available_columns(vac),
    }


def dashboard(spark: SparkSession, data_dir: str, out: str, every_sec: int | None = None,
              rounds: int | None = None, glob: str = "*.jsonl") -> dict[str, str]:
    """Write the dashboard tables from a cached snapshot of the folder; with ``every_sec``,
    drop the snapshot and rewrite them every ``every_sec`` seconds (``rounds`` times, or
    until stopped)."""
    import time

    from labormart.sources.files import Snapshot

    snap, written_to, n = Snapshot(spark, data_dir, glob=glob), {}, 0
    while True:
        vac = snap.refresh() if n else snap.get()
        for name, df in dashboard_tables(vac).items():
            path = f"{out.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            written_to[name] = path
        n += 1
        if not every_sec or (rounds is not None and n >= rounds):
            return written_to
        time.sleep(every_sec)


def _messages(spark: SparkSession, raw: DataFrame, kafka: bool) -> DataFrame:
    from labormart.streaming.windows import consume_messages

    return consume_messages(raw, arrival="timestamp" if kafka else None)


def consume(spark: SparkSession, topic_dir: str | None, out: str, window_sec: int = 300,
            every_sec: int = 10, kafka: dict[str, str] | None = None, watermark: str = "1 minute",
            checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start the sliding-window consumer (decode → fallbacks → windows), a report each ``every_sec``,
    empty ones too; returns the query. Messages that are no JSON objects are skipped and counted. The
    checkpoint stands beside the output unless given, so a restart goes on where it stopped."""
    from labormart.sources.messages import observe_rejects
    from labormart.streaming.windows import event_time, message_stream, start_sliding_report

    msgs = observe_rejects(message_stream(spark, path=topic_dir, kafka=kafka), "messages")
    stream = _messages(spark, msgs, bool(kafka))
    return start_sliding_report(event_time(stream, watermark=watermark), out,
                                size=f"{window_sec} seconds", slide=f"{every_sec} seconds",
                                trigger=trigger or {"processingTime": f"{every_sec} seconds"},
                                checkpoint=checkpoint, spine=True, name="consume",
                                area="area", s_from="salary")


def finish_consume(spark: SparkSession, topic_dir: str | None, out: str, window_sec: int = 300,
                   every_sec: int = 10, kafka: dict[str, str] | None = None) -> None:
    """The sliding windows that the stopped consumer still held open, from the stored messages."""
    from labormart.streaming.windows import flush_sliding_tail

    raw = (spark.read.format("kafka").options(**kafka).load().select(F.col("value").cast("string").alias("value"), "timestamp")
           if kafka else spark.read.text(topic_dir))
    flush_sliding_tail(_messages(spark, raw, bool(kafka)), out, size=f"{window_sec} seconds",
                       slide=f"{every_sec} seconds", spine=True, area="area", s_from="salary")


def valid_items(pages: DataFrame) -> DataFrame:
    """Items of stored pages that pass the rules. An item's collection time is the time its page
    was stored: the same in the files, the topic and the windows, and again after a replay."""
    from labormart.operators.validate import split_valid, validate_raw
    from labormart.sources.messages import unwrap_pages

    stored = pages.select("value", F.col("_metadata.file_modification_time").alias("_stored"))
    items = unwrap_pages(stored, collected_at=iso_text("_stored"))
    return split_valid(validate_raw(items))[0].select(*RAW_SCHEMA.names)


def timed(items: DataFrame) -> DataFrame:
    """Flat items with their salaries as given and their collection time as event time."""
    from labormart.operators.clean import given_salaries

    return given_salaries(items).withColumn("ts", F.to_timestamp("collected_at"))


def finish_collect(spark: SparkSession, files_out: str, report_out: str,
                   window: str = "60 seconds") -> DataFrame:
    """The windows that the stopped collector still held open, from the committed files: the
    records that the report stream has read, no others."""
    from labormart.streaming.windows import flush_tail

    records = spark.read.schema(RAW_SCHEMA).json(files_out)
    return flush_tail(timed(records), report_out, size=window, has_salary="has_salary")


def collect(spark: SparkSession, pages_dir: str, files_out: str, topic_dir: str | None,
            report_out: str, window: str = "60 seconds", watermark: str = "1 minute",
            trigger: dict | None = None, kafka: dict[str, str] | None = None,
            checkpoint_root: str | None = None, compression: str | None = None) -> list[StreamingQuery]:
    """The collector over a folder of stored result pages (one JSON page envelope per line).

    One query parses, stamps and validates the pages and appends the valid items to JSONL files; each
    batch is committed in the folder's log. The topic and the tumbling window report are two more queries
    that read the committed files only, in the order of the commits. So a record is parsed once, all three
    outputs hold the same records, and a stop at any point leaves outputs that the next start completes.
    ``compression``: of the files and the topic's folder (e.g. ``gzip``; else plain); readers go by the files' names.
    Returns the started queries, the files' first; :func:`finish_collect` after they stopped. With an
    ``availableNow`` trigger the files are complete before the others start."""
    from labormart.session import make_folder
    from labormart.sources.messages import observe_rejects
    from labormart.streaming.windows import (
        committed_records, event_time, start_jsonl_sink, start_topic, start_tumbling_report,
    )

    ck = (checkpoint_root.rstrip("/") + "/") if checkpoint_root else None  # else beside each output
    place = lambda n: (ck + n) if ck else None
    pages = spark.readStream.schema("value STRING").text(pages_dir).select("value", "_metadata")
    valid = valid_items(observe_rejects(pages, "pages"))
    queries = [start_jsonl_sink(valid, files_out, checkpoint=place("files"), trigger=trigger, name="collect_files",
                                compression=compression)]
    if (trigger or {}).get("availableNow"):
        queries[0].awaitTermination()
    make_folder(spark, files_out)
    records = committed_records(spark, files_out, RAW_SCHEMA)
    if topic_dir or kafka:
        queries.append(start_topic(records, topic_dir, checkpoint=place("topic"), trigger=trigger, kafka=kafka, name="collect_topic",
                                   compression=compression))
    queries.append(start_tumbling_report(event_time(timed(records), watermark=watermark), report_out,
                                         trigger=trigger, size=window, has_salary="has_salary",
                                         checkpoint=place("report"), name="collect_report"))
    return queries


class StopSignal:
    """SIGINT and SIGTERM set a flag, instead of ending the process, while this is open."""

    def __init__(self) -> None:
        self.asked = threading.Event()

    def __enter__(self) -> threading.Event:
        ask = lambda *_: self.asked.set()
        self.before = {s: signal.signal(s, ask) for s in (signal.SIGINT, signal.SIGTERM)}
        return self.asked

    def __exit__(self, *_) -> None:
        for s, handler in self.before.items():
            signal.signal(s, handler)


def run_until_stopped(queries: Sequence[StreamingQuery], finish: Callable[[], object],
                      poll: float = 0.5) -> int:
    """Wait for a stop signal, or for the first query that ends by itself. Then, in the order given, each
    query works off what has arrived and stops; ``finish`` writes what they held open, also after a
    failure. 0 if no query failed. Signals that come meanwhile do not cut this short."""
    with StopSignal() as asked:
        while not asked.is_set() and all(q.isActive for q in queries):
            asked.wait(poll)
        for q in queries:
            if q.isActive:
                try:
                    q.processAllAvailable()
                finally:
                    q.stop()
        finish()
    return 0 if all(q.exception() is None for q in queries) else 1


def main(argv: list[str] | None = None) -> int:
    from labormart.session import get_session

    p = argparse.ArgumentParser(prog="labormart.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("analyze")
    a.add_argument("--data-dir", required=True)
    a.add_argument("--out", required=True)
    c = sub.add_parser("consume")
    c.add_argument("--topic-dir")
    c.add_argument("--kafka-servers")
    c.add_argument("--kafka-topic", default="vacancies")
    c.add_argument("--out", required=True)
    c.add_argument("--window", type=int, default=300)
    c.add_argument("--every", type=int, default=10)
    c.add_argument("--checkpoint")
    k = sub.add_parser("collect")
    k.add_argument("--pages-dir", required=True)
    k.add_argument("--files-out", required=True)
    k.add_argument("--topic-dir")
    k.add_argument("--report-out", required=True)
    k.add_argument("--window", type=int, default=60)
    k.add_argument("--checkpoint")
    d = sub.add_parser("dashboard")
    d.add_argument("--data-dir", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--every", type=int, default=None)
    for x in (a, d):
        x.add_argument("--glob", default="*.jsonl")
    args = p.parse_args(argv)
    spark = get_session()
    if args.cmd == "dashboard":
        for name, path in dashboard(spark, args.data_dir, args.out, args.every, glob=args.glob).items():
            print(f"{name}\t{path}")
        return 0
    if args.cmd == "analyze":
        for name, path in analyze(spark, args.data_dir, args.out, args.glob).items():
            print(f"{name}\t{path}")
        return 0
    from labormart.streaming.windows import ProgressLog

    if args.cmd == "collect":
        log = ProgressLog(spark, f"{args.report_out.rstrip('/')}_progress")
        queries = collect(spark, args.pages_dir, args.files_out, args.topic_dir, args.report_out,
                          window=f"{args.window} seconds", checkpoint_root=args.checkpoint)
        end = lambda: finish_collect(spark, args.files_out, args.report_out, f"{args.window} seconds")
    else:
        kafka = ({"kafka.bootstrap.servers": args.kafka_servers, "subscribe": args.kafka_topic}
                 if args.kafka_servers else None)
        log = ProgressLog(spark, f"{args.out.rstrip('/')}_progress")
        queries = [consume(spark, args.topic_dir, args.out, args.window, args.every, kafka, checkpoint=args.checkpoint)]
        end = lambda: finish_consume(spark, args.topic_dir, args.out, args.window, args.every, kafka)
    print("started", flush=True)
    status = run_until_stopped(queries, end)
    log.close(queries)
    print("stopped", flush=True)
    return status


if __name__ == "__main__":
    sys.exit(main())
