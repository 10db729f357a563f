"""Streaming queries. Input is derived from the event table, stored as record files, and
read by real streams that take what is there and stop."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from caseledger.schemas import CDC_ROWS
from caseledger.session import scratch_path
from caseledger.sources import readers, tables
from caseledger.streaming import cdc, sinks, transitions
from workloads import bindings as B
from workloads.registry import query

RECORD = "value string, timestamp timestamp, partition int, offset bigint"
LOADED_AT = datetime(2024, 2, 1)
CASES_SHARE = 20


def _status(shift):
    return (F.col("event_id") % 8 + shift).cast("int")


def change_records(spark, sf):
    """Application changes and history inserts of the same transitions, up to 75 s apart."""
    events = B.table(spark, sf, "events")
    e, micros = F.col("event_id"), F.unix_micros("ts")
    case = (F.col("user_id") % CASES_SHARE).cast("string")
    skew = e % 151 - 75

    def image(status, at):
        return F.struct(case.alias("id"), F.concat(F.lit("Case "), case).alias("name"),
                        micros.alias("created_at"), F.lit("A").alias("Applicantid"),
                        status.alias("Statusid"), F.lit(2).alias("Serviceid"),
                        (e % 25).cast("int").alias("Agencyid"), at.alias("updated_at"))

    before = F.when(e % 5 != 0, image(_status(0), micros - 3_600_000_000 + e % 2 * 7_200_000_000))
    application = F.struct(before.alias("before"), image(_status(1), micros).alias("after"),
                           F.struct(F.unix_millis("ts").alias("ts_ms"), e.alias("txId")).alias("source"),
                           F.when(e % 5 != 0, "u").otherwise("c").alias("op"))
    step = F.struct(F.concat(F.lit("H"), e).alias("id"), case.alias("Applicationid"),
                    _status(0).alias("Statusid"), _status(1).alias("Statusid2"),
                    F.when(e % 3 != 0, (e % 50).cast("int")).alias("Officerid"),
                    (micros + skew * 1_000_000).alias("action_time"), F.lit("n").alias("note"))
    history = F.struct(step.alias("after"),
                       F.struct((F.unix_millis("ts") + skew * 1000).alias("ts_ms"), e.alias("txId"))
                       .alias("source"), F.lit("c").alias("op"))

    def records(payload, delay, part):
        return events.select(F.to_json(F.struct(payload.alias("payload"))).alias("value"),
                             (F.col("ts") + B.seconds(F.lit(delay))).alias("timestamp"),
                             F.lit(part).alias("partition"), e.alias("offset"))
    return records(application, 2, 1), records(history, 3, 2)


# The records in SQL, with the milliseconds the envelope carries.
CHANGES = f"""app AS (
  SELECT event_id, CAST(user_id % {CASES_SHARE} AS VARCHAR) AS ho_so_id, CAST(event_id % 25 AS INTEGER) AS co_quan_id,
         CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 8 AS INTEGER) END AS before_status,
         CAST(event_id % 8 + 1 AS INTEGER) AS after_status, date_trunc('millisecond', ts) AS at,
         ts + INTERVAL 2 SECOND AS kafka_at, event_id % 5 <> 0 AND event_id % 2 = 0 AS timed FROM events),
hist AS (
  SELECT event_id, 'H' || event_id AS id, CAST(user_id % {CASES_SHARE} AS VARCHAR) AS ho_so_id,
         CAST(event_id % 8 AS INTEGER) AS old_status, CAST(event_id % 8 + 1 AS INTEGER) AS new_status,
         CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 50 AS INTEGER) END AS can_bo_id,
         ts + to_seconds(event_id % 151 - 75) AS action_time,
         date_trunc('millisecond', ts) + to_seconds(event_id % 151 - 75) AS at,
         ts + INTERVAL 3 SECOND AS kafka_at FROM events),
matched AS (
  SELECT h.id, h.ho_so_id, a.co_quan_id, h.old_status AS trang_thai_truoc_id, h.new_status AS trang_thai_id,
         h.can_bo_id, h.action_time, CASE WHEN a.timed THEN CAST(3600 AS BIGINT) END AS thoi_gian_xu_ly_seconds,
         CAST(strftime(h.action_time, '%Y%m%d') AS INTEGER) AS thoi_gian_id,
         a.at AS application_event_time, h.at AS history_event_time, greatest(a.kafka_at, h.kafka_at) AS kafka_event_time,
         abs(epoch_ms(a.at) - epoch_ms(h.at)) AS join_skew_ms,
         epoch_us(TIMESTAMP '{LOADED_AT}') // 1000 - epoch_us(greatest(a.kafka_at, h.kafka_at)) // 1000 AS kafka_to_fact_latency_ms,
         epoch_ms(TIMESTAMP '{LOADED_AT}') - epoch_ms(greatest(a.at, h.at)) AS source_to_fact_latency_ms,
         a.event_id AS application_kafka_offset, h.event_id AS history_kafka_offset
  FROM app a JOIN hist h ON a.ho_so_id = h.ho_so_id AND a.after_status = h.new_status
    AND (a.before_status IS NULL OR a.before_status = h.old_status)
    AND h.at BETWEEN a.at - INTERVAL 1 MINUTE AND a.at + INTERVAL 1 MINUTE)"""
MATCHED = """id, ho_so_id, co_quan_id, trang_thai_truoc_id, trang_thai_id, can_bo_id, action_time,
       thoi_gian_xu_ly_seconds, thoi_gian_id, application_event_time, history_event_time, kafka_event_time,
       join_skew_ms, kafka_to_fact_latency_ms, source_to_fact_latency_ms, application_kafka_offset,
       history_kafka_offset"""
MATCHED_COLUMNS = [c.strip() for c in MATCHED.split(",")]


def topics(spark, sf):
    """Both record sets on disk, as streams."""
    streams = []
    for name, records in zip(("app", "hist"), change_records(spark, sf)):
        path = scratch_path(spark, f"topic_{name}")
        records.write.parquet(path)
        streams.append(readers.stream_records(spark, "parquet", path, RECORD))
    return streams


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp")


@query("J11_interval_join_batch", f"WITH {CHANGES} SELECT {MATCHED} FROM matched")
def batch_join(spark, sf):
    """The same join over stored topics: a replay without a stream."""
    application, history = (readers.as_records(r) for r in change_records(spark, sf))
    return transitions.realtime_transitions(application, history, loaded_at=loaded_at()).select(
        *MATCHED_COLUMNS)


@query("C18_J11_stream_interval_join", f"WITH {CHANGES} SELECT {MATCHED} FROM matched")
def stream_join(spark, sf):
    """S4, P8, J11, T2-T8: two streams with watermarks, matches appended to files."""
    application, history = topics(spark, sf)
    fact = transitions.realtime_transitions(application, history, loaded_at=loaded_at())
    out, checkpoint = scratch_path(spark, "fact"), scratch_path(spark, "checkpoint")
    sinks.stream_files(fact, out, checkpoint, trigger=None, idle_batches=False).awaitTermination()
    return spark.read.schema(fact.schema).parquet(out).select(*MATCHED_COLUMNS)


@query("K12_T10_stream_upsert", f"""WITH {CHANGES}
SELECT id, ho_so_id, max(application_kafka_offset) AS application_kafka_offset FROM matched GROUP BY 1, 2""")
def stream_upsert(spark, sf):
    """One fact per history event, although an event may match several changes and the
    second run replays everything from a new checkpoint."""
    name, _ = B.new_table(spark, "fact_stream")
    application, history = topics(spark, sf)
    fact = transitions.realtime_transitions(application, history, loaded_at=loaded_at()).select(
        "ho_so_id", "id", "application_kafka_offset")
    for _ in range(2):
        sinks.stream_upsert(fact, name, ["ho_so_id", "id"], scratch_path(spark, "checkpoint"),
                            trigger=None, order=["application_kafka_offset"], buckets=4,
                            idle_batches=False).awaitTermination()
    return tables.fresh(spark, name).drop("key_bucket")


@query("C4_K11_T1_cdc_streams", f"""
SELECT 'application' AS topic, CAST(user_id % {CASES_SHARE} AS VARCHAR) AS ho_so_id, count(*) AS changes
FROM events GROUP BY 2
UNION ALL SELECT 'application_history', CAST(user_id % {CASES_SHARE} AS VARCHAR), count(*) FROM events GROUP BY 2""")
def cdc_streams(spark, sf):
    """One stream per captured table into day-partitioned Bronze tables."""
    name = {}
    application, history = topics(spark, sf)
    for topic, key, stream in (("application", "id", application),
                               ("application_history", "Applicationid", history)):
        name[topic] = B.new_table(spark, f"{topic}_cdc")[0]
        sinks.stream_append(cdc.parse_cdc(stream, CDC_ROWS[topic]), name[topic],
                            scratch_path(spark, "checkpoint"), trigger=None).awaitTermination()
    return (tables.fresh(spark, name["application"]).select(F.lit("application").alias("topic"),
                                                   F.col("id").alias("ho_so_id"))
            .unionByName(tables.fresh(spark, name["application_history"]).select(
                F.lit("application_history").alias("topic"), F.col("Applicationid").alias("ho_so_id")))
            .groupBy("topic", "ho_so_id").agg(F.count(F.lit(1)).alias("changes")))


@query("T5_unmatched_changes", f"""WITH {CHANGES}
SELECT id, ho_so_id FROM hist WHERE id NOT IN (SELECT id FROM matched)""")
def unmatched(spark, sf):
    application, history = (readers.as_records(r) for r in change_records(spark, sf))
    return transitions.unmatched_changes(
        cdc.application_changes(application, CDC_ROWS["application"]),
        cdc.history_changes(history, CDC_ROWS["application_history"])).select(
        "id", F.col("h_ho_so_id").alias("ho_so_id"))


@query("T11_cdc_lag_report", f"""WITH {CHANGES}
SELECT time_bucket(INTERVAL 1 DAY, kafka_event_time) AS window_start, count(*) AS events,
       count(*) / 86400.0::DOUBLE AS events_per_second, max(join_skew_ms) AS max_lag_ms,
       avg(join_skew_ms) AS mean_lag_ms, quantile_disc(join_skew_ms, 0.95) AS p95_lag_ms
FROM matched GROUP BY 1""")
def lag_report(spark, sf):
    application, history = (readers.as_records(r) for r in change_records(spark, sf))
    fact = transitions.realtime_transitions(application, history, loaded_at=loaded_at())
    return transitions.cdc_lag_report(fact, "1 day", lag="join_skew_ms")


# --- batches that run again, side tables, windows of a stream ------------------------------

def _forget_last_commit(spark, checkpoint):
    """What a crash between a batch's write and Spark's own commit leaves behind."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())
    fs.delete(path(folder, str(last)), False)
    return last


@query("K11_T9_retried_batch", f"""
SELECT CAST(user_id % {CASES_SHARE} AS VARCHAR) AS ho_so_id, count(*) AS changes, count(DISTINCT event_id) AS times
FROM events GROUP BY 1""")
def retried_batch(spark, sf):
    """Micro-batches into Bronze; the last one runs again after its commit was lost."""
    application, _ = change_records(spark, sf)
    path, checkpoint = scratch_path(spark, "topic_app"), scratch_path(spark, "checkpoint")
    application.repartition(3, "offset").write.parquet(path)
    name, location = B.new_table(spark, "application_cdc")
    for last_lost in (True, False):
        stream = readers.stream_records(spark, "parquet", path, RECORD, maxFilesPerTrigger="1")
        sinks.stream_append(cdc.parse_cdc(stream, CDC_ROWS["application"], keep_position=True), name, checkpoint,
                            trigger=None).awaitTermination()
        if last_lost:
            _forget_last_commit(spark, checkpoint)
    return tables.fresh(spark, name).groupBy(F.col("id").alias("ho_so_id")).agg(
        F.count(F.lit(1)).alias("changes"), F.countDistinct("kafka_offset").alias("times"))


def _closing(spark, sf, step):
    """A record of each topic, days after the last event, that moves the watermarks on."""
    application, history = change_records(spark, sf)
    last = B.table(spark, sf, "events").agg(F.max("ts")).first()[0]
    micros = F.unix_micros(F.lit(last).cast("timestamp")) + step * 86_400_000_000
    end = F.lit(f"end {step}")
    source = F.struct((micros / 1000).cast("bigint").alias("ts_ms"))
    payloads = (
        F.struct(F.struct(end.alias("id"), F.lit(2).alias("Statusid")).alias("after"), source.alias("source"), F.lit("c").alias("op")),
        F.struct(F.struct(end.alias("id"), end.alias("Applicationid"), F.lit(2).alias("Statusid2")).alias("after"), source.alias("source"), F.lit("c").alias("op")))
    return [spark.range(1).select(F.to_json(F.struct(p.alias("payload"))).alias("value"), F.timestamp_micros(micros).alias("timestamp"),
                                  F.lit(1).alias("partition"), F.lit(step).cast("bigint").alias("offset")).select(*application.columns)
            for p in payloads]


@query("T5_unmatched_stream", f"""WITH {CHANGES}
SELECT id, ho_so_id FROM hist WHERE id NOT IN (SELECT id FROM matched)""")
def unmatched_side(spark, sf):
    """The side stream over the same topics, stopped and resumed twice: what the batch report finds."""
    paths = [scratch_path(spark, f"topic_{name}") for name in ("app", "hist")]
    out, checkpoint = scratch_path(spark, "unmatched"), scratch_path(spark, "checkpoint")
    for step, frames in enumerate((change_records(spark, sf), _closing(spark, sf, 1), _closing(spark, sf, 2))):
        for path, frame in zip(paths, frames):
            frame.write.mode("append").parquet(path)
        application, history = (readers.stream_records(spark, "parquet", path, RECORD) for path in paths)
        side = transitions.unmatched_stream(cdc.application_changes(application, CDC_ROWS["application"]),
                                            cdc.history_changes(history, CDC_ROWS["application_history"]))
        side = side.select("id", F.col("h_ho_so_id").alias("ho_so_id"))
        sinks.stream_files(side, out, checkpoint, trigger=None).awaitTermination()
    return spark.read.schema(side.schema).parquet(out).where("id NOT LIKE 'end%'")


LATE = 50


@query("T11_lag_stream", f"""WITH {CHANGES},
timely AS (SELECT * FROM matched WHERE history_kafka_offset % {LATE} <> 0),
mark AS (SELECT max(kafka_event_time) - INTERVAL 1 MINUTE AS passed FROM timely),
seen AS (
  SELECT kafka_event_time, join_skew_ms FROM timely UNION ALL
  SELECT kafka_event_time, join_skew_ms FROM matched, mark WHERE history_kafka_offset % {LATE} = 0
    AND time_bucket(INTERVAL 1 MINUTE, kafka_event_time) + INTERVAL 1 MINUTE > passed)
SELECT time_bucket(INTERVAL 1 MINUTE, kafka_event_time) AS window_start, count(*) AS events,
       count(*) / 60.0::DOUBLE AS events_per_second, max(join_skew_ms) AS max_lag_ms,
       avg(join_skew_ms) AS mean_lag_ms, quantile_disc(join_skew_ms, 0.95) AS p95_lag_ms
FROM seen GROUP BY 1""")
def lag_stream(spark, sf):
    """Windows of a minute over the stored fact as a stream that is stopped and resumed; a part
    of the rows arrives after the watermark has passed their windows and is dropped."""
    path, out, checkpoint = (scratch_path(spark, n) for n in ("facts", "lags", "checkpoint"))
    application, history = (readers.as_records(r) for r in change_records(spark, sf))
    fact = transitions.realtime_transitions(application, history, loaded_at=loaded_at()).select(
        "kafka_event_time", "join_skew_ms", "history_kafka_offset")
    last = B.table(spark, sf, "events").agg(F.max("ts")).first()[0]
    ends = [spark.range(1).select((F.lit(last).cast("timestamp") + B.days(F.lit(n))).alias("kafka_event_time"),
                                  F.lit(0).cast("bigint").alias("join_skew_ms"), F.lit(-1).cast("bigint").alias("history_kafka_offset"))
            for n in (2, 3)]
    late = F.col("history_kafka_offset") % LATE == 0
    for frame in (fact.where(~late), fact.where(late), *ends):
        frame.write.mode("append").parquet(path)
        stream = spark.readStream.schema(fact.schema).parquet(path)
        report = transitions.cdc_lag_report(stream, "1 minute", lag="join_skew_ms", watermark="1 minute")
        sinks.stream_files(report, out, checkpoint, trigger=None).awaitTermination()
    rows = spark.read.schema(report.schema).parquet(out)
    return rows.where(F.col("window_start") < F.lit(last).cast("timestamp") + B.days(F.lit(1)))
