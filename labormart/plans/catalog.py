"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each query reads the driver tables through ``labormart.plans.adapters`` (whole tables, whole
texts) and runs one operator of the library. The DuckDB form of each is in
``labormart.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.operators import aggregates as A
from labormart.operators import clean as C
from labormart.operators import distribution as D
from labormart.operators import profile as PR
from labormart.operators import skills as K
from labormart.operators import validate as V
from labormart.operators import windows as W
from labormart.plans import adapters as AD
from labormart.schema import SHARDS

Query = Callable[[SparkSession, str], DataFrame]

# Event-stream windows used by the registered queries: the events span 30 days, so hour-long
# tumbling windows and 6-hour windows sliding by 1 hour keep the outputs readable. The
# operators' own defaults (60 s, 300 s / 10 s) are covered by the unit tests.
EV_TUMBLING = "1 hour"
EV_SLIDING = "6 hours"
EV_SLIDE = "1 hour"
# Windows so short that many of them are empty.
SPARSE_SIZE, SPARSE_SLIDE = "10 minutes", "5 minutes"


def _ov(spark: SparkSession, sf: str) -> DataFrame:
    return AD.orders_vacancies(spark, sf)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(AD.raw_vacancies(spark, sf))


def _validated(spark: SparkSession, sf: str, profile: str = "base") -> DataFrame:
    return V.validate_raw(AD.raw_vacancies(spark, sf), profile)


def _validation_out(df: DataFrame) -> DataFrame:
    return df.select("id", "collected_at", "is_valid",
                     F.size("errors").alias("n_errors"),
                     V.error_text("errors").alias("error_text"))


def q_dedup_first(spark, sf):
    d = C.dedup_first(AD.raw_vacancies(spark, sf), "id", ("collected_at",))
    return d.select("id", "name", "collected_at", F.col("area.name").alias("area_name"))


def q_union_by_name(spark, sf):
    """Two sources with different columns unioned by name, missing → null."""
    ov = _ov(spark, sf).select("id", "name", "area_name", "salary_from")
    tv = AD.text_vacancies(spark, sf).select("id", "area_name", "employer_name")
    u = ov.unionByName(tv, allowMissingColumns=True)
    return u.groupBy("area_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count("name").alias("with_name"),
        F.count("employer_name").alias("with_employer"),
        F.sum("salary_from").alias("salary_sum"))


def q_available_columns(spark, sf):
    return C.available_columns(_clean(spark, sf))


def q_area_salary_fallback(spark, sf):
    """P8 / P9 over decoded messages: nested ones (raw records), flat ones (clean orders) and
    text that is not JSON (document texts, skipped)."""
    from labormart.sources.messages import decode_messages, message_fields, vacancy_messages

    nested = vacancy_messages(AD.raw_vacancies(spark, sf))
    flat = vacancy_messages(_ov(spark, sf).select("id", "name", "area_name", "salary_from"))
    junk = AD.table(spark, sf, "documents").select(F.col("text").alias("value"))
    msgs = decode_messages(nested.unionByName(flat).unionByName(junk))
    return (message_fields(msgs).groupBy("area")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.sum(F.when(F.col("salary") > 0, F.col("salary"))).alias("salary_sum"),
                 F.count_if(F.col("salary") > 0).alias("with_salary")))


def q_stage_counts(spark, sf):
    raw = AD.raw_vacancies(spark, sf)
    judged = V.validate_raw(raw)
    dedup = C.dedup_first(raw)
    named = F.col("name").isNotNull() & (F.length("name") >= 3)
    return PR.stage_counts([("load", judged), ("dedup", dedup), ("clean", dedup, named),
                            ("valid", judged, F.col("is_valid"))])


def q_volume_report(spark, sf):
    """The raw records as (gzipped) JSON lines and the clean table as Parquet: bytes on disk per
    format, ratio, and the 100-bytes-per-row transport estimate for the raw rows."""
    from labormart.session import scratch_path
    from labormart.sources.files import load_jsonl, save_jsonl, save_parquet

    jdir, pdir = scratch_path(spark, "vol-jsonl"), scratch_path(spark, "vol-parquet")
    save_jsonl(AD.raw_vacancies(spark, sf), jdir, max_records_per_file=20000, compression="gzip")
    raw = load_jsonl(spark, jdir, glob="*.json.gz")
    save_parquet(C.clean(raw), pdir)
    vols = [PR.file_volume(spark, jdir, "jsonl", raw, glob="*.json.gz"),
            PR.file_volume(spark, pdir, "parquet", spark.read.parquet(pdir), glob="*.parquet")]
    # The bytes depend on the writer; they are tested on a fixture.
    return PR.volume_report(vols).select("format", "rows", "transport_mb_estimate")


def q_validation_summary(spark, sf):
    """V5: per collection shard (query): records and valid records. The driver rows are
    spread over the six shards by id (id mod 6 + 1)."""
    shards = spark.createDataFrame([(s[0], s[1], s[3]) for s in SHARDS],
                                   "shard_id INT, shard_area_id STRING, query STRING")
    v = _validated(spark, sf)
    # 6 fixed shards: a constant-size broadcast.
    v = v.withColumn("shard_id", (F.col("id").cast("bigint") % len(SHARDS) + 1).cast("int"))
    v = v.join(F.broadcast(shards), "shard_id")
    return V.validation_summary(v, ["shard_id", "query"])


def q_validation_errors(spark, sf):
    return V.error_counts(_validated(spark, sf))


def q_text_skills_literal(spark, sf, n=10):
    return K.top_skills(AD.text_vacancies(spark, sf), n=n)


def q_event_vac(spark, sf):
    return AD.event_vacancies(spark, sf)


def q_tumbling_raw(spark, sf):
    """W1 over raw records, where a given 0 counts and a salary record may lack a bound: the
    negative lower bounds of the driver rows are taken as given zeros."""
    s_from = F.col("salary.from")
    zeros = F.when(s_from.startswith("-"), F.lit("0")).otherwise(s_from)
    raw = AD.raw_vacancies(spark, sf).withColumn("salary", F.col("salary").withField("from", zeros))
    rec = C.given_salaries(raw).withColumn("ts", F.to_timestamp("collected_at"))
    return W.tumbling_by_area(rec, size="1 day", has_salary="has_salary")


QUERIES: dict[str, Query] = {
    "tumbling_raw_by_area": q_tumbling_raw,
    # aggregates over the clean vacancy table
    "aggregate_by_area": lambda s, sf: A.aggregate_by_area(_ov(s, sf)),
    "aggregate_by_employer": lambda s, sf: A.aggregate_by_employer(_ov(s, sf)),
    "top_areas": lambda s, sf: A.top_areas(_ov(s, sf)),
    "salary_distribution": lambda s, sf: D.salary_distribution(_ov(s, sf)),
    "percentile_salary": lambda s, sf: D.median_by_area(_ov(s, sf), min_count=5),
    "area_avg_with_zeros": lambda s, sf: A.area_avg_with_zeros(_ov(s, sf)),
    "area_counts_top15": lambda s, sf: A.area_counts(_ov(s, sf), n=15),
    "timeline": lambda s, sf: A.timeline(_ov(s, sf)),
    "headline": lambda s, sf: A.headline(_ov(s, sf)),
    "employers_top10": lambda s, sf: A.employers_table(_ov(s, sf), n=10),
    "group_count_keep_null": lambda s, sf: A.group_count(_ov(s, sf), keep_null=True),
    "group_count_no_null": lambda s, sf: A.group_count(_ov(s, sf), keep_null=False),
    "salary_stats_by_area": lambda s, sf: A.salary_stats_by_area(_ov(s, sf), keep_null=True),
    "salary_stats_by_area_sql": lambda s, sf: A.salary_stats_by_area(_ov(s, sf), keep_null=False),
    "median_cont_min3": lambda s, sf: D.median_by_area(_ov(s, sf), min_count=3, with_count=False,
                                                       median_name="median"),
    "median_nearest": lambda s, sf: D.median_nearest(_ov(s, sf)),
    "bench_top_areas": lambda s, sf: A.bench_top_areas(_ov(s, sf)),
    "salary_distribution4": lambda s, sf: D.salary_distribution4(_ov(s, sf)),
    "salary_histogram30": lambda s, sf: D.salary_histogram(_ov(s, sf), bins=30),
    "salary_histogram25": lambda s, sf: D.salary_histogram(_ov(s, sf), bins=25),
    "salary_box_top10": lambda s, sf: D.salary_box(_ov(s, sf), n=10),
    "salary_box_top8": lambda s, sf: D.salary_box(_ov(s, sf), n=8),
    "top_area_rows": lambda s, sf: D.top_area_rows(_ov(s, sf), n=10).select(
        "id", "area_name", "salary_from"),
    "salary_accumulator": lambda s, sf: A.salary_accumulator(_ov(s, sf)),
    # profile
    "null_profile": lambda s, sf: PR.null_profile(_clean(s, sf)),
    "stage_counts": q_stage_counts,
    "volume_report": q_volume_report,
    # cleaning
    "dedup_first": q_dedup_first,
    "union_by_name": q_union_by_name,
    "clean": lambda s, sf: _clean(s, sf),
    "available_columns": q_available_columns,
    "area_salary_fallback": q_area_salary_fallback,
    # validation
    "validate_base": lambda s, sf: _validation_out(_validated(s, sf, "base")),
    "validate_extended": lambda s, sf: _validation_out(_validated(s, sf, "extended")),
    "validation_text": lambda s, sf: _validated(s, sf).filter(~F.col("is_valid")).select(
        "id", "collected_at", V.error_text("errors").alias("error_text")),
    "valid_rows": lambda s, sf: V.split_valid(_validated(s, sf))[0].select(
        "id", "collected_at", "name"),
    "validation_summary": q_validation_summary,
    "validation_errors": q_validation_errors,
    # skills
    "skills_literal_top10": q_text_skills_literal,
    "skills_regex": lambda s, sf: K.regex_skill_counts(AD.text_vacancies(s, sf)),
    "skills_top20": lambda s, sf: q_text_skills_literal(s, sf, 20),
    "skills_by_area": lambda s, sf: K.skill_counts(AD.text_vacancies(s, sf), by=["area_name"]),
    # windows (batch form)
    "tumbling_by_area": lambda s, sf: W.tumbling_by_area(q_event_vac(s, sf), size=EV_TUMBLING),
    "tumbling_total": lambda s, sf: W.tumbling_total(q_event_vac(s, sf), size=EV_TUMBLING),
    "tumbling_top_skills": lambda s, sf: W.tumbling_top_skills(q_event_vac(s, sf),
                                                               size=EV_TUMBLING, skills="skills"),
    "window_report": lambda s, sf: W.window_report(q_event_vac(s, sf), size=EV_TUMBLING,
                                                   skills="skills"),
    "sliding_stats": lambda s, sf: W.sliding_stats(q_event_vac(s, sf), size=EV_SLIDING,
                                                   slide=EV_SLIDE),
    "sliding_top5": lambda s, sf: W.sliding_top_areas(q_event_vac(s, sf), n=5, size=EV_SLIDING,
                                                      slide=EV_SLIDE),
    "sliding_top_area": lambda s, sf: W.sliding_stats(q_event_vac(s, sf), size=EV_SLIDING,
                                                      slide=EV_SLIDE).select(
        "window_start", "window_end", "top_area", "top_area_count"),
    "trailing_count": lambda s, sf: W.trailing_count(q_event_vac(s, sf), size="300 seconds"),
    "sliding_spine": lambda s, sf: W.sliding_stats(q_event_vac(s, sf), size=SPARSE_SIZE,
                                                   slide=SPARSE_SLIDE, spine=True),
}


# --------------------------------------------------------------------------------------------
# Sources, sinks and streams. Written data goes to fresh folders under the session's
# ``spark.checkpoint.dir`` (a shared folder on a cluster).
# --------------------------------------------------------------------------------------------

def q_jsonl_roundtrip(spark, sf):
    """Raw records written as JSON lines, read back with the explicit
    schema and bad-file handling, then cleaned."""
    from labormart.session import scratch_path
    from labormart.sources.files import load_jsonl, save_jsonl

    path = scratch_path(spark, "jsonl")
    save_jsonl(AD.raw_vacancies(spark, sf), path, max_records_per_file=None, compression="gzip")
    return C.clean(load_jsonl(spark, path, glob="*.json.gz"))


def q_parquet_roundtrip(spark, sf):
    """The clean table written as Parquet and queried back through a SQL view."""
    from labormart.session import scratch_path
    from labormart.sources.files import parquet_view, save_parquet

    path = scratch_path(spark, "parquet")
    save_parquet(_clean(spark, sf), path)
    view = f"vacancies_{abs(hash(path)) % 10**8}"
    parquet_view(spark, path, view)
    return spark.sql(f"""
        SELECT area_name, COUNT(*) AS count, AVG(salary_from) AS avg_from, AVG(salary_to) AS avg_to
        FROM {view} WHERE area_name IS NOT NULL GROUP BY area_name""")


def q_message_decode(spark, sf):
    """Every raw record encoded as a JSON message and decoded again."""
    from labormart.sources.messages import decode_messages, message_fields, vacancy_messages

    return message_fields(decode_messages(vacancy_messages(AD.raw_vacancies(spark, sf))))


def q_page_unwrap(spark, sf):
    """Records packed into page envelopes, serialised, then unwrapped to one row per item.
    A page holds the lines of one order: at most 7 items, a bound the generator of lineitem
    guarantees (a search page holds at most 100)."""
    from labormart.sources.messages import unwrap_pages

    raw = AD.raw_vacancies(spark, sf, "l_orderkey")
    # Each record is encoded where it is made; grouping, sorting and the envelope then handle its text as one value.
    # An order's records lie together behind the join: grouped by its key (``id`` is that key as text) they stay there.
    text = F.to_json(F.struct(*[c for c in raw.columns if c != "l_orderkey"]))
    lines = raw.select("l_orderkey", F.struct(F.col("collected_at").alias("line"), text.alias("item")).alias("_item"))
    packed = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("_item")).alias("items"))
    pages = packed.select(F.concat(
        F.lit('{"items":['), F.concat_ws(",", "items.item"), F.lit('],"found":'), F.size("items"),
        F.lit(',"pages":1,"page":0}')).alias("value"))
    items = unwrap_pages(pages, collected_at=F.lit("2025-05-01T10:01:00Z"))
    return items.select("id", "name", F.col("area.name").alias("area_name"), "collected_at")


def _event_stream(spark, sf):
    """The events table as a file stream, shaped as vacancies (stream-static join with the
    per-document skills)."""
    from labormart.operators.skills import row_skills

    schema = AD.table(spark, sf, "events").schema
    ev = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
          .option("maxFilesPerTrigger", 1).parquet(sf))
    docs = row_skills(AD.table(spark, sf, "documents").select(
        F.col("doc_id").alias("user_id"), F.col("text").alias("snippet_requirement")),
        "snippet_requirement")
    return ev.join(docs, "user_id", "left").select(
        F.col("event_id").cast("string").alias("id"), "ts",
        F.col("event_type").alias("area_name"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("salary_from"),
        F.floor(F.col("value") * 1500).cast("bigint").alias("salary_to"),
        "snippet_requirement", "skills")


def q_stream_tumbling(spark, sf):
    """W1-W6 streaming: the window report built by the stream equals the batch report."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import event_time, read_report, start_tumbling_report

    out = scratch_path(spark, "stream-tumbling")
    q = start_tumbling_report(event_time(_event_stream(spark, sf), watermark="1 hour"), out,
                              output_mode="complete", trigger={"availableNow": True},
                              size=EV_TUMBLING, skills="skills")
    q.awaitTermination()
    return read_report(spark, out, complete_mode=True)


def q_stream_sliding(spark, sf):
    """W7/W9/W12 streaming: sliding statistics from the stream equal the batch ones."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import event_time, read_report, start_sliding_report

    out = scratch_path(spark, "stream-sliding")
    q = start_sliding_report(event_time(_event_stream(spark, sf), watermark="6 hours"), out,
                             output_mode="complete", trigger={"availableNow": True},
                             size=EV_SLIDING, slide=EV_SLIDE)
    q.awaitTermination()
    return read_report(spark, f"{out}/stats", complete_mode=True)


def q_fan_out(spark, sf):
    """Validated stream records fanned out to JSONL files and messages; the files are
    read back (S11-style) and counted per area."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import start_fan_out

    stream = _event_stream(spark, sf).select(
        "id", F.col("area_name").alias("name"), "area_name", F.col("id").alias("area_id"),
        "salary_from", "salary_to")
    valid, _ = V.split_valid(V.validate(stream, "name", "salary_from", "salary_to", "area_id"))
    files, msgs = scratch_path(spark, "fan-files"), scratch_path(spark, "fan-msgs")
    q = start_fan_out(valid, files, msgs, trigger={"availableNow": True})
    q.awaitTermination()
    back = spark.read.schema("id STRING, area_name STRING, salary_from BIGINT").json(files)
    n_msgs = spark.read.text(msgs).agg(F.count(F.lit(1))).scalar()
    return (back.groupBy("area_name")
                .agg(F.count(F.lit(1)).alias("count"), F.sum("salary_from").alias("salary_sum"))
                .withColumn("messages", n_msgs))


def q_report_readback(spark, sf):
    """Window reports appended batch by batch are read back as one table."""
    from labormart.session import scratch_path
    from labormart.sources.files import union_all_by_name

    out = scratch_path(spark, "report")
    rep = W.window_report(q_event_vac(spark, sf), size=EV_TUMBLING, skills="skills")
    # two appended "batches": windows before and after the middle of the month
    first = rep.filter(F.col("window_start") < "2024-01-16")
    second = rep.filter(F.col("window_start") >= "2024-01-16")
    first.write.mode("overwrite").parquet(f"{out}/batch_id=0")
    second.write.mode("overwrite").parquet(f"{out}/batch_id=1")
    parts = [spark.read.parquet(f"{out}/batch_id={i}") for i in (0, 1)]
    return union_all_by_name(parts)


QUERIES.update({
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "message_decode": q_message_decode,
    "page_unwrap": q_page_unwrap,
    "stream_tumbling": q_stream_tumbling,
    "stream_sliding": q_stream_sliding,
    "fan_out": q_fan_out,
    "report_readback": q_report_readback,
})


def q_profile_head(spark, sf):
    """The first five rows of the clean table (ordered by id so the choice is fixed)."""
    return PR.head(_clean(spark, sf).orderBy("id"), 5)


def q_profile_shape(spark, sf):
    """Row and column counts of the clean table."""
    return PR.shape(_clean(spark, sf))


def q_quarantine_rows(spark, sf):
    """V4: invalid records go to a quarantine table with their error text."""
    _, quarantine = V.split_valid(_validated(spark, sf))
    return quarantine.select("id", "collected_at", F.col("area.id").alias("area_id"),
                             V.error_text("errors").alias("error_text"))


def q_stream_messages(spark, sf):
    """S7 → P8/P9 → W7/W9 as one stream: raw records published as JSON messages (a folder
    stands in for the topic), consumed, and summarised in 7-day windows sliding by a day on
    the records' collection time."""
    from labormart.session import scratch_path
    from labormart.sources.messages import vacancy_messages
    from labormart.streaming.windows import (
        consume_messages, event_time, read_report, start_sliding_report,
    )

    topic = scratch_path(spark, "topic")
    vacancy_messages(AD.raw_vacancies(spark, sf)).write.mode("overwrite").option("compression", "gzip").text(topic)
    stream = consume_messages(spark.readStream.schema("value STRING").text(topic))
    out = scratch_path(spark, "stream-messages")
    q = start_sliding_report(event_time(stream, watermark="7 days"), out,
                             output_mode="complete", trigger={"availableNow": True},
                             size="7 days", slide="1 day", area="area", s_from="salary")
    q.awaitTermination()
    return read_report(spark, f"{out}/stats", complete_mode=True)


QUERIES.update({
    "stream_messages": q_stream_messages,
    "profile_head": q_profile_head,
    "profile_shape": q_profile_shape,
    "quarantine_rows": q_quarantine_rows,
})


def q_jsonl_bad_input(spark, sf):
    """S3: raw records as JSON lines, a file per ten days, some lines cut and some with a
    mistyped field; rows per region that remain when bad files, or only bad lines, are left out."""
    from labormart.session import scratch_path
    from labormart.sources.files import load_jsonl

    path = scratch_path(spark, "bad-jsonl")
    _write_by_part(_broken_lines(spark, sf), path)
    kept = [load_jsonl(spark, path, bad_input=mode, glob="*.txt.gz")
            .groupBy(F.col("area.name").alias("area_name")).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(mode).alias("mode"), "area_name", "rows")
            for mode in ("drop_file", "drop_row")]
    return kept[0].unionByName(kept[1])


def q_schema_inferred(spark, sf):
    """Files with different columns in one folder, read with the schema of all of them."""
    from labormart.session import scratch_path
    from labormart.sources.files import load_jsonl_inferred, save_jsonl

    path = scratch_path(spark, "mixed-jsonl")
    save_jsonl(_ov(spark, sf).select("id", "name", "area_name", "salary_from"), path)
    save_jsonl(AD.text_vacancies(spark, sf).select("id", "area_name", "employer_name"), path,
               mode="append")
    return load_jsonl_inferred(spark, path, glob="*.json").groupBy("area_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count("name").alias("with_name"),
        F.count("employer_name").alias("with_employer"),
        F.sum("salary_from").alias("salary_sum"))


def q_jsonl_stream_sink(spark, sf):
    """The events appended as JSON lines by a stream, at most 5000 per file; read back."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import start_jsonl_sink

    path, most = scratch_path(spark, "sink-jsonl"), 5000
    stream = _event_stream(spark, sf).select("id", "area_name", "salary_from")
    start_jsonl_sink(stream, path, rows_per_file=most,
                     trigger={"availableNow": True}).awaitTermination()
    back = spark.read.schema("id STRING, area_name STRING, salary_from BIGINT").json(path)
    long = (back.groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > most)).scalar())
    return (back.groupBy("area_name")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("salary_from").alias("salary_sum"))
            .withColumn("files_too_long", long))


def q_snapshot(spark, sf):
    """A snapshot keeps its rows while the folder grows, until it is refreshed."""
    from labormart.session import scratch_path
    from labormart.sources.files import Snapshot, save_jsonl

    raw = AD.raw_vacancies(spark, sf)
    path, out = scratch_path(spark, "snap-jsonl"), scratch_path(spark, "snap-counts")
    save_jsonl(raw.filter(F.col("salary").isNotNull()), path, compression="gzip")
    snap = Snapshot(spark, path, glob="*.json.gz")

    def note(step: str, df: DataFrame) -> None:
        (df.groupBy("area_name").agg(F.count(F.lit(1)).alias("rows"))
           .withColumn("step", F.lit(step)).write.mode("append").parquet(out))

    note("first", snap.get())
    save_jsonl(raw.filter(F.col("salary").isNull()), path, mode="append", compression="gzip")
    note("kept", snap.get())
    note("refreshed", snap.refresh())
    snap.get().unpersist()
    return spark.read.parquet(out)


def q_stream_append(spark, sf):
    """W1-W6 as in production: append output with a watermark, then the tail, written twice."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import (
        event_time, flush_tail, read_report, start_tumbling_report,
    )

    out = scratch_path(spark, "stream-append")
    start_tumbling_report(event_time(_event_stream(spark, sf), watermark="1 hour"), out,
                          trigger={"availableNow": True}, size=EV_TUMBLING,
                          skills="skills").awaitTermination()
    for _ in range(2):  # the second call changes nothing
        flush_tail(event_time(q_event_vac(spark, sf), watermark=None), out, size=EV_TUMBLING,
                   skills="skills")
    return read_report(spark, out)


def q_stream_sliding_append(spark, sf):
    """W7-W9 as in production: append output over panes, then the tail."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import (
        event_time, flush_sliding_tail, read_report, start_sliding_report,
    )

    out = scratch_path(spark, "sliding-append")
    start_sliding_report(event_time(_event_stream(spark, sf), watermark="6 hours"), out,
                         trigger={"availableNow": True}, size=EV_SLIDING,
                         slide=EV_SLIDE).awaitTermination()
    flush_sliding_tail(event_time(q_event_vac(spark, sf), watermark=None), out, size=EV_SLIDING,
                       slide=EV_SLIDE)
    return read_report(spark, f"{out}/stats")


# Keywords that nearly every text holds, so that counts tie and the limit cuts within a tie.
COMMON_KEYWORDS = ("the", "a", "e", "i", "o", "t", "n", "s", "r", "l", "qz")

QUERIES.update({
    "jsonl_bad_input": q_jsonl_bad_input,
    "schema_inferred": q_schema_inferred,
    "jsonl_stream_sink": q_jsonl_stream_sink,
    "snapshot": q_snapshot,
    "stream_append": q_stream_append,
    "stream_sliding_append": q_stream_sliding_append,
    "skills_tied_top5": lambda s, sf: K.top_skills(AD.text_vacancies(s, sf),
                                                   keywords=COMMON_KEYWORDS, n=5),
})


def _broken_lines(spark, sf):
    """Raw records as JSON lines with the first nine characters of their date (``part``); some lines
    are cut, some have a mistyped field."""
    raw = AD.raw_vacancies(spark, sf)
    line, key = F.to_json(F.struct(*raw.columns)), F.col("id").cast("bigint")
    line = (F.when(key % 1009 == 0, F.substring(line, F.lit(1), F.length(line) - 1))
            .when(key % 1013 == 0, F.replace(line, F.lit('"gross":false'), F.lit('"gross":"maybe"')))
            .otherwise(line))
    return raw.select(line.alias("value"), F.substring("published_at", 1, 9).alias("part"))


def _write_by_part(lines, path):
    """A gzipped text file per ``part``: the lines repeat much, and whole parts are read anyway."""
    from labormart.sources.files import part_per_task

    dealt = part_per_task(lines, "part")
    if dealt is not None:
        dealt.select("value").write.option("compression", "gzip").mode("append").text(path)


def q_jsonl_staged(spark, sf):
    """S1/S3 in one read: lines, bad lines, bad files and the kept rows per region from one staged table."""
    from labormart.session import scratch_path
    from labormart.sources.files import StagedLines

    path = scratch_path(spark, "staged-jsonl")
    _write_by_part(_broken_lines(spark, sf), path)
    staged = StagedLines(spark, path, glob="*.txt.gz")
    kept = (staged.rows().groupBy(F.col("area.name").alias("area_name"))
            .agg(F.count(F.lit(1)).alias("rows")))
    counts = staged.counts()
    return kept.withColumns({c: counts.select(c).scalar() for c in ("lines", "bad_lines", "kept_lines")}).withColumn(
        "bad_files", staged.bad_files().agg(F.count(F.lit(1))).scalar())


def q_schema_inferred_bad(spark, sf):
    """S2 with S3: folders of line items, orders and documents as JSON lines with differing columns and types; a
    file with a broken line adds neither rows nor columns. A part's rows with a column of its own
    (``only_<part>``) show which parts' schemas were merged."""
    from labormart.session import scratch_path
    from labormart.sources.files import load_jsonl_inferred

    orders = AD.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"),
                                                   F.col("o_orderstatus").alias("kind"))
    items = AD.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("amount"),
                                                    F.col("l_linestatus").alias("only_items"))
    docs = AD.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("only_docs"))
    path = scratch_path(spark, "inferred-bad")
    for name, df in (("orders", orders), ("items", items), ("docs", docs)):
        line = F.to_json(F.struct(*df.columns))
        if name == "docs":  # one line of every part of documents is cut
            line = F.when(F.col("id") % 10 == 0, F.substring(line, F.lit(1), F.length(line) - 2)).otherwise(line)
        # A file per last digit of the id: bad where ids end in 0, but for the documents, all in one part.
        part = F.lit(f"{name}-") if name == "docs" else F.concat(F.lit(f"{name}-"), F.col("id") % 10)
        if name == "items":
            line = F.when((F.col("id") % 10 == 3) & (F.col("amount") == 1), F.lit("{not json")).otherwise(line)
        rows = df.select(line.alias("value"), part.alias("part"))
        _write_by_part(rows, path)
    got = load_jsonl_inferred(spark, path, glob="*.txt.gz")
    has = lambda c: F.count(c) if c in got.columns else F.lit(-1).cast("bigint")
    return got.groupBy((F.col("id") % 10).alias("digit")).agg(
        F.count(F.lit(1)).alias("rows"), has("kind").alias("with_kind"), has("only_items").alias("with_items"),
        has("only_docs").alias("with_docs"), F.sum(F.floor("amount")).cast("bigint").alias("amounts"),
        F.lit(dict(got.dtypes)["amount"]).alias("amount_type"))


def q_parquet_clustered(spark, sf):
    """The clean table by area, at most 2000 rows a file; per area the rows, and whether it has more files
    than its rows fill."""
    from labormart.session import scratch_path, written
    from labormart.sources.files import save_parquet

    path = scratch_path(spark, "clustered")
    save_parquet(written(_clean(spark, sf), "clustered-in"), path, partition_by=["area_name"], rows_per_file=2000)
    back = spark.read.parquet(path)
    files = back.groupBy("area_name", F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy("area_name").agg(
        F.sum("n").alias("rows"), (F.count(F.lit(1)) > F.ceil(F.sum("n") / 2000)).cast("int").alias("too_many_files"))


def q_message_rejects(spark, sf):
    """Messages and pages that are no JSON objects are counted, not lost: records, documents (texts that
    are no JSON) and records cut short, as one topic."""
    from labormart.session import written
    from labormart.sources.messages import decode_messages, judged, rejected, vacancy_messages

    # A record is joined and encoded once for its three forms, and each text is judged once: the topic is
    # written with its verdicts, and both counts read those.
    forms = {"records": F.col("value"), "cut": F.substring("value", F.lit(1), F.length("value") - 1),
             "twice": F.concat("value", "value")}
    good = vacancy_messages(AD.raw_vacancies(spark, sf)).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("source"), form.alias("value")) for name, form in forms.items()])).alias("m"))
    texts = AD.table(spark, sf, "documents").select(F.lit("documents").alias("source"), F.col("text").alias("value"))
    topic = written(judged(good.select("m.*").unionByName(texts)), "topic", compression="zstd")
    per = {name: df.groupBy("source").agg(F.count(F.lit(1)).alias(name)) for name, df in (
        ("decoded", decode_messages(topic, keep=("source",), judged="is_object")),
        ("rejected", rejected(topic, judged="is_object")))}
    sources = spark.createDataFrame([(name,) for name in (*forms, "documents")], "source STRING")
    none = F.lit(0).cast("bigint")
    return sources.join(per["decoded"], "source", "left").join(per["rejected"], "source", "left").select(
        F.coalesce("decoded", none).alias("decoded"), F.coalesce("rejected", none).alias("rejected"), "source")


def _late_parts(spark, sf):
    """The events as a folder that grows: nine tenths first, then every tenth event, most of them late."""
    ev = AD.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"), "ts", F.col("event_type").alias("area_name"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("salary_from"),
        F.lit(0).cast("bigint").alias("salary_to"))
    return [ev.filter(F.col("id").cast("bigint") % 10 != 0), ev.filter(F.col("id").cast("bigint") % 10 == 0)]


def q_stream_late_counts(spark, sf):
    """A stream that is stopped and started again while late rows come; its totals, over both runs, from
    the progress table, and the rows its windows hold (the tail written)."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import (
        ProgressLog, event_time, flush_tail, progress_totals, read_report, reported_rows,
        start_tumbling_report,
    )

    source, out, log_path = (scratch_path(spark, f"late-{n}") for n in ("events", "report", "progress"))
    name = "late-" + out.rsplit("-", 1)[1]
    log, queries = ProgressLog(spark, log_path, names=[name]), []
    for part in _late_parts(spark, sf):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        q = start_tumbling_report(event_time(stream, watermark="1 hour"), out, size=EV_TUMBLING,
                                  trigger={"availableNow": True}, text=None, name=name)
        q.awaitTermination()
        queries.append(q)
    log.close(queries)
    stored = event_time(spark.read.parquet(source), watermark=None)
    flush_tail(stored.withColumn("snippet_requirement", F.lit(None).cast("string")), out, size=EV_TUMBLING)
    held = reported_rows(read_report(spark, out)).scalar()
    return progress_totals(spark, log_path).withColumn("reported", held).select("received", "reported", (F.col("received") - F.col("reported")).alias("late"),
                         (F.col("late") > 0).cast("int").alias("late_noted"))


def q_stream_sliding_spine(spark, sf):
    """W7/Q12 as in production: sliding statistics of a stream with empty reports, then the tail."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import (
        event_time, flush_sliding_tail, read_report, start_sliding_report,
    )

    out = scratch_path(spark, "sliding-spine")
    start_sliding_report(event_time(_event_stream(spark, sf), watermark="1 hour"), out, spine=True,
                         trigger={"availableNow": True}, size=SPARSE_SIZE, slide=SPARSE_SLIDE).awaitTermination()
    flush_sliding_tail(event_time(q_event_vac(spark, sf), watermark=None), out, size=SPARSE_SIZE,
                       slide=SPARSE_SLIDE, spine=True)
    return read_report(spark, f"{out}/stats")


def q_stream_trailing_count(spark, sf):
    """W10 on a stream: counts of the events that the watermark has passed, and how many wait for it."""
    from labormart.session import scratch_path
    from labormart.streaming.windows import (
        checkpoint_for, event_time, trailing_count_stream, write_per_batch,
    )

    out = scratch_path(spark, "trailing")
    stream = event_time(_event_stream(spark, sf).select("id", "ts"), watermark="1 hour")
    (trailing_count_stream(stream, size="300 seconds").writeStream.outputMode("append")
     .foreachBatch(write_per_batch(out)).option("checkpointLocation", checkpoint_for(spark, out))
     .trigger(availableNow=True).start().awaitTermination())
    last = AD.table(spark, sf, "events").agg(F.max("ts")).scalar()
    done = spark.read.schema("id STRING, ts TIMESTAMP, rows BIGINT, trailing_count BIGINT").parquet(out)
    # What lies more than an hour and the window behind the last event has left the stream for good.
    sure = F.col("ts").cast("timestamp_ntz") < last - F.expr("INTERVAL '2' HOUR")
    return done.filter(sure).select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), "rows", "trailing_count")


def q_stream_collect(spark, sf):
    """The collector over stored pages, stopped after its files' first batch, started again when more pages
    are there: per area the records in the files, the topic and the windows (the tail written)."""
    from labormart.jobs import collect, finish_collect, valid_items
    from labormart.schema import RAW_SCHEMA
    from labormart.session import scratch_path, shuffles_freed
    from labormart.sources.messages import observe_rejects
    from labormart.streaming.windows import beside, read_report, start_jsonl_sink

    pages, files, topic, report = (scratch_path(spark, f"collect-{n}") for n in ("pages", "files", "topic", "report"))
    raw = AD.raw_vacancies(spark, sf)
    envelope = F.to_json(F.struct(F.array(F.struct(*raw.columns)).alias("items"), F.lit(1).alias("found"),
                                  F.lit(1).alias("pages"), F.lit(0).alias("page"))).alias("value")
    rows = raw.select(envelope, (F.col("id").cast("bigint") % 3 == 0).alias("later"))
    now, packed = {"availableNow": True}, "gzip"  # pages and records repeat the same names over and over
    for later in (False, True):
        with shuffles_freed(spark):
            rows.filter(F.col("later") == later).select("value").write.mode("append").text(pages, compression=packed)
        if later:
            for q in collect(spark, pages, files, topic, report, window="60 seconds", trigger=now, compression=packed):
                q.awaitTermination()
        else:  # a stop before the topic and the windows have seen anything
            stored = spark.readStream.schema("value STRING").text(pages).select("value", "_metadata")
            start_jsonl_sink(valid_items(observe_rejects(stored, "pages")), files, checkpoint=beside(files),
                             rows_per_file=5000, trigger=now, compression=packed).awaitTermination()
    finish_collect(spark, files, report, window="60 seconds")
    by = lambda df, name, n=F.count(F.lit(1)): df.groupBy("area_name").agg(n.cast("bigint").alias(name))
    in_files = by(spark.read.schema(RAW_SCHEMA).json(files).select(F.col("area.name").alias("area_name")), "files")
    sent = spark.read.text(topic).select(F.from_json("value", RAW_SCHEMA).alias("m"))
    in_topic = by(sent.select(F.col("m.area.name").alias("area_name")), "messages")
    windows = read_report(spark, report).select(F.col("area").alias("area_name"), "area_count")
    in_windows = by(windows, "windowed", F.sum("area_count"))
    return in_files.join(in_topic, "area_name", "full").join(in_windows, "area_name", "full")


def q_analyze_stages(spark, sf):
    """A21 in the analyzer job: stage log and clean rows of one read of a folder with bad files."""
    from labormart.jobs import analysis_tables
    from labormart.session import scratch_path

    path, out = scratch_path(spark, "analyze-in"), scratch_path(spark, "analyze-out")
    _write_by_part(_broken_lines(spark, sf), path)
    view = f"analyze_{abs(hash(out)) % 10**8}"
    return analysis_tables(spark, path, out, view=view, glob="*.txt.gz")["stages"]


QUERIES.update({
    "jsonl_staged": q_jsonl_staged,
    "schema_inferred_bad": q_schema_inferred_bad,
    "parquet_clustered": q_parquet_clustered,
    "message_rejects": q_message_rejects,
    "stream_late_counts": q_stream_late_counts,
    "stream_sliding_spine": q_stream_sliding_spine,
    "stream_trailing_count": q_stream_trailing_count,
    "stream_collect": q_stream_collect,
    "analyze_stages": q_analyze_stages,
})
