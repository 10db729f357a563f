import json
import pathlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caseledger.plans import bronze
from caseledger.schemas import CDC_ROWS, CONTRACTS, assert_schema
from caseledger.sources import readers
from caseledger.sources.tables import fresh
from caseledger.streaming import sinks, transitions
from tests.conftest import rows

RECORD = "value string, timestamp timestamp, partition int, offset bigint"
T = datetime(2024, 1, 1, 10)


def micros(at):
    return int((at - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def app_change(case, before, after, at, started=None, offset=0, ts=True):
    image = {"id": case, "name": "n", "Statusid": after, "Serviceid": 1, "Agencyid": 2, "created_at": micros(T), "updated_at": micros(at)}
    old = None if before is None else {**image, "Statusid": before, "updated_at": micros(started or at - timedelta(hours=2))}
    source = {"ts_ms": micros(at) // 1000, "txId": 5} if ts else {}
    return {"payload": {"before": old, "after": image, "op": "u", "source": source}}, at + timedelta(seconds=1), 0, offset


def hist_change(hid, case, old, new, at, offset=0, op="c"):
    row = {"id": hid, "Applicationid": case, "Statusid": old, "Statusid2": new, "Officerid": 3, "action_time": micros(at)}
    return {"payload": {"before": None, "after": row, "op": op, "source": {"ts_ms": micros(at) // 1000, "txId": 6}}}, at + timedelta(seconds=2), 1, offset


class Topic:
    """A folder that receives record files one after another."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, pathlib.Path(folder), 0
        self.folder.mkdir(parents=True, exist_ok=True)

    def send(self, *records):
        text = "\n".join(json.dumps({"value": json.dumps(v), "timestamp": at.isoformat(), "partition": p, "offset": o})
                         for v, at, p, o in records)
        (self.folder / f"{self.sent:04d}.json").write_text(text)
        self.sent += 1

    def stream(self):
        return readers.stream_records(self.spark, "json", str(self.folder), RECORD, maxFilesPerTrigger="1")

    def batch(self):
        return readers.as_records(self.spark.read.schema(RECORD).json(str(self.folder)))


@pytest.fixture
def topics(spark, folder):
    return Topic(spark, f"{folder}/app"), Topic(spark, f"{folder}/hist")


def fact(topics, **options):
    return transitions.realtime_transitions(topics[0].stream(), topics[1].stream(), **options)


def test_match_rules_and_measures(spark, folder, topics):
    app, hist = topics
    app.send(app_change("a", 1, 2, T, offset=7), app_change("b", None, 2, T), app_change("c", 4, 5, T),
             app_change("d", 1, 2, T), app_change("e", 1, 2, T), app_change("f", 1, 2, T, started=T + timedelta(hours=1)))
    hist.send(hist_change("exact", "a", 1, 2, T + timedelta(seconds=60), 8), hist_change("beyond", "a", 1, 2, T + timedelta(seconds=60, milliseconds=1)),
              hist_change("nobefore", "b", 9, 2, T - timedelta(seconds=60)), hist_change("wrongbefore", "c", 3, 5, T),
              hist_change("wrongafter", "d", 1, 3, T), hist_change("update", "e", 1, 2, T, op="u"), hist_change("backwards", "f", 1, 2, T))
    streamed = fact(topics, loaded_at=F.lit(T + timedelta(minutes=5)).cast("timestamp"))
    assert_schema(streamed, CONTRACTS["realtime.fact_xu_ly_ho_so_stream"])
    sinks.stream_files(streamed, f"{folder}/out", f"{folder}/ck", None).awaitTermination()
    got = {r["id"]: r for r in spark.read.parquet(f"{folder}/out").collect()}
    assert set(got) == {"exact", "nobefore", "backwards"}
    row = got["exact"]
    assert (row["thoi_gian_xu_ly_seconds"], row["thoi_gian_xu_ly"], row["thoi_gian_id"]) == (7200, 2.0, 20240101)
    assert (row["join_skew_ms"], row["kafka_to_fact_latency_ms"], row["source_to_fact_latency_ms"]) == (60_000, 238_000, 240_000)
    assert (row["application_kafka_partition"], row["application_kafka_offset"], row["history_kafka_partition"], row["history_kafka_offset"]) == (0, 7, 1, 8)
    assert got["nobefore"]["thoi_gian_xu_ly"] is None and got["backwards"]["thoi_gian_xu_ly_seconds"] is None
    # The batch replay of the same topics gives the same matches.
    batch = transitions.realtime_transitions(app.batch(), hist.batch())
    assert {r["id"] for r in batch.collect()} == set(got)


def test_restart_between_batches_and_late_rows(spark, folder, name, topics):
    app, hist = topics
    t = name("fact")

    def run(checkpoint):
        sinks.stream_upsert(fact(topics).select("ho_so_id", "id", "trang_thai_id"), t, ["ho_so_id", "id"],
                            f"{folder}/{checkpoint}", None, order=["trang_thai_id"], buckets=2).awaitTermination()
    with pytest.raises(ValueError, match="order"):
        sinks.stream_upsert(fact(topics), t, ["ho_so_id", "id"], f"{folder}/none", None)
    app.send(app_change("a", 1, 2, T))
    hist.send(hist_change("h0", "zzz", 1, 2, T))
    run("ck")
    # The partner arrives after a restart: the change is still in the state.
    hist.send(hist_change("h1", "a", 1, 2, T + timedelta(seconds=30)))
    app.send(app_change("b", 1, 2, T + timedelta(seconds=40)))
    run("ck")
    assert rows(fresh(spark, t), "id") == [("h1",)]
    # Both watermarks move on; a pair far behind them is late and dropped.
    app.send(app_change("c", 1, 2, T + timedelta(hours=1)))
    hist.send(hist_change("h2", "c", 1, 2, T + timedelta(hours=1)))
    run("ck")
    app.send(app_change("late", 1, 2, T))
    hist.send(hist_change("h3", "late", 1, 2, T))
    run("ck")
    assert rows(fresh(spark, t), "id") == [("h1",), ("h2",)]
    # A new checkpoint replays every record; keys make that harmless.
    before = rows(fresh(spark, t), "ho_so_id", "id", "trang_thai_id")
    run("other")
    assert set(before) <= set(rows(fresh(spark, t), "ho_so_id", "id", "trang_thai_id"))
    assert fresh(spark, t).groupBy("id").count().where("count > 1").isEmpty()


def test_the_report_of_lost_events(spark, topics):
    from caseledger.streaming import cdc
    app, hist = topics
    app.send(app_change("a", 1, 2, T))
    hist.send(hist_change("h1", "a", 1, 2, T), hist_change("lost", "a", 3, 4, T))
    lost = transitions.unmatched_changes(cdc.application_changes(app.batch(), CDC_ROWS["application"]),
                                         cdc.history_changes(hist.batch(), CDC_ROWS["application_history"]))
    assert rows(lost, "id") == [("lost",)]


def test_record_time_stands_in_for_a_missing_source_time(spark, topics):
    app, hist = topics
    app.send(app_change("a", 1, 2, T, ts=False))
    hist.send(hist_change("h1", "a", 1, 2, T))
    row = transitions.realtime_transitions(app.batch(), hist.batch()).first()
    assert row["application_event_time"] == T + timedelta(seconds=1)


def test_cdc_ingestion_resumes_from_its_checkpoint(spark, folder, name, topics):
    app, hist = topics
    prefix = name("cdc")
    app.send(app_change("a", 1, 2, T), app_change("b", None, 2, T))
    hist.send(hist_change("h1", "a", 1, 2, T))
    for _ in range(2):
        queries = bronze.ingest_cdc({"application": app.stream(), "application_history": hist.stream()},
                                    f"{folder}/ck", lambda n: f"{prefix}_{n}", trigger=None)
        assert len(queries) == 2
        for q in queries.values():
            q.awaitTermination()
    assert rows(fresh(spark, f"{prefix}_application"), "id", "op") == [("a", "u"), ("b", "u")]
    assert fresh(spark, f"{prefix}_application_history").count() == 1
    assert "ingest_date" in fresh(spark, f"{prefix}_application").columns


def test_stream_of_immutable_events(spark, folder, name, topics):
    app, hist = topics
    t = name("fact")
    app.send(app_change("a", 1, 2, T))
    hist.send(hist_change("h1", "a", 1, 2, T))
    for checkpoint in ("x", "y"):
        sinks.stream_new_only(fact(topics).select("ho_so_id", "id", "action_time"), t, ["ho_so_id", "id"],
                              f"{folder}/{checkpoint}", None, ("action_time", "action_date")).awaitTermination()
    assert fresh(spark, t).count() == 1


def test_lag_report(spark):
    facts = spark.createDataFrame([(T, 100), (T + timedelta(seconds=59), 300), (T + timedelta(seconds=60), 50)],
                                  "kafka_event_time timestamp, kafka_to_fact_latency_ms long")
    assert rows(transitions.cdc_lag_report(facts), "window_start", "events", "max_lag_ms", "mean_lag_ms") == [
        (T, 2, 300, 200.0), (T + timedelta(minutes=1), 1, 50, 50.0)]
    assert transitions.cdc_lag_report(facts).first()["events_per_second"] == pytest.approx(2 / 60)


def test_kafka_source_options(spark):
    """No Kafka connector is installed here, so only the request itself can be checked."""
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.stream_topic(spark, "localhost:1", "t")


def test_unmatched_history_leaves_by_the_side_stream(spark, folder, topics):
    """Every history insert ends in the fact or in the side stream, never in both."""
    from caseledger.streaming import cdc
    app, hist = topics

    def run():
        side = transitions.unmatched_stream(cdc.application_changes(app.stream(), CDC_ROWS["application"]),
                                            cdc.history_changes(hist.stream(), CDC_ROWS["application_history"]))
        sinks.stream_files(side.select("id"), f"{folder}/side", f"{folder}/ck", None).awaitTermination()
        return sorted(r["id"] for r in spark.read.schema("id string").parquet(f"{folder}/side").collect())
    app.send(app_change("a", 1, 2, T), app_change("b", 7, 2, T))
    hist.send(hist_change("in", "a", 1, 2, T + timedelta(seconds=60)), hist_change("beyond", "a", 1, 2, T + timedelta(seconds=61)),
              hist_change("wrongbefore", "b", 1, 2, T), hist_change("waits", "c", 1, 2, T + timedelta(seconds=30)))
    assert run() == []                       # a partner may still come
    app.send(app_change("c", 1, 2, T + timedelta(seconds=20)))
    hist.send(hist_change("later", "z", 1, 2, T + timedelta(hours=1)))
    run()
    app.send(app_change("end", 1, 2, T + timedelta(hours=2)))
    hist.send(hist_change("end", "end", 1, 2, T + timedelta(hours=2)))
    run()
    app.send(app_change("end2", 1, 2, T + timedelta(hours=4)))
    hist.send(hist_change("end2", "end2", 1, 2, T + timedelta(hours=4)))
    assert run() == ["beyond", "later", "wrongbefore"]


def test_lag_stream_closes_windows_once_and_drops_late_rows(spark, folder):
    source = pathlib.Path(folder) / "facts"
    source.mkdir()

    def run(*lags):
        text = "\n".join(json.dumps({"kafka_event_time": at.isoformat(), "kafka_to_fact_latency_ms": ms}) for at, ms in lags)
        (source / f"{len(list(source.iterdir()))}.json").write_text(text)
        stream = spark.readStream.schema("kafka_event_time timestamp, kafka_to_fact_latency_ms long").json(str(source))
        report = transitions.cdc_lag_report(stream, watermark="1 minute")
        sinks.stream_files(report, f"{folder}/out", f"{folder}/ck", None).awaitTermination()
        return rows(spark.read.schema(report.schema).parquet(f"{folder}/out"), "window_start", "events", "max_lag_ms")
    assert run((T, 10), (T + timedelta(seconds=59), 30), (T + timedelta(seconds=90), 5)) == []
    first = (T, 2, 30)
    assert run((T + timedelta(minutes=5), 7)) == [first, (T + timedelta(minutes=1), 1, 5)]
    # Behind the watermark: dropped. Not yet behind it: counted.
    assert run((T + timedelta(seconds=1), 99), (T + timedelta(minutes=4, seconds=30), 8)) == [first, (T + timedelta(minutes=1), 1, 5)]
    got = run((T + timedelta(minutes=9), 1))
    assert got == [first, (T + timedelta(minutes=1), 1, 5), (T + timedelta(minutes=4), 1, 8), (T + timedelta(minutes=5), 1, 7)]


def test_a_replayed_join_never_goes_through_the_driver(spark):
    """Records of a few bytes in the file hold large rows: the planner's sizes must not decide."""
    from workloads import streams
    application, history = (readers.as_records(r) for r in streams.change_records(spark, "/root/testdata/sf0.001"))
    facts = transitions.realtime_transitions(application, history).select("kafka_event_time", "join_skew_ms")
    lost = streams.unmatched(spark, "/root/testdata/sf0.001")
    for frame in (facts, facts.groupBy().count(), lost):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()


def test_the_report_of_lost_events_goes_by_id(spark, topics):
    from caseledger.streaming import cdc
    app, hist = topics
    app.send(app_change("a", 1, 2, T), app_change("a", 1, 2, T + timedelta(seconds=1)))
    # h1 arrived twice, once far from any change: it was found, so it is not lost.
    hist.send(hist_change("h1", "a", 1, 2, T), hist_change("h1", "a", 1, 2, T + timedelta(hours=3)), hist_change("lost", "a", 1, 2, T + timedelta(hours=3)))
    lost = transitions.unmatched_changes(cdc.application_changes(app.batch(), CDC_ROWS["application"]),
                                         cdc.history_changes(hist.batch(), CDC_ROWS["application_history"]))
    assert rows(lost, "id") == [("lost",)]


def test_the_percentile_of_a_large_window_is_exact(spark):
    n = 200_000
    fact = spark.range(n).select(F.lit(T).cast("timestamp").alias("kafka_event_time"), (F.col("id") * 7919 % n).alias("lag"))
    report = transitions.cdc_lag_report(fact, "1 day", lag="lag").first()
    assert (report["events"], report["p95_lag_ms"], report["max_lag_ms"]) == (n, n * 95 // 100 - 1, n - 1)


def test_the_side_stream_compares_neighbours_in_time(spark, folder, topics):
    from caseledger.streaming import cdc
    app, hist = topics
    app.send(*[app_change("a", 1, 2, T + timedelta(minutes=3 * n), offset=n) for n in range(4)])
    hist.send(*[hist_change(f"{n}{side}", "a", 1, 2, T + timedelta(minutes=3 * n) + gap) for n in range(4) for side, gap in (
        ("first", timedelta(seconds=-60)), ("last", timedelta(seconds=60)), ("beyond", timedelta(seconds=60, milliseconds=1)))])
    for hours in (5, 10):
        app.send(app_change("end", 1, 2, T + timedelta(hours=hours)))
        hist.send(hist_change("end", "end", 1, 2, T + timedelta(hours=hours)))
    side = transitions.unmatched_stream(cdc.application_changes(topics[0].stream(), CDC_ROWS["application"]),
                                        cdc.history_changes(topics[1].stream(), CDC_ROWS["application_history"]))
    assert "_l_bucket" in side._jdf.queryExecution().analyzed().toString()
    sinks.stream_files(side, f"{folder}/out", f"{folder}/ck", None).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/out"), "id") == [(f"{n}beyond",) for n in range(4)]


def test_a_replay_keeps_its_state_on_disk_and_runs_no_batch_to_clear_it(spark, folder, topics):
    app, hist = topics
    app.send(*[app_change(f"c{n}", 1, 2, T + timedelta(minutes=n)) for n in range(9)])
    hist.send(*[hist_change(f"h{n}", f"c{n}", 1, 2, T + timedelta(minutes=n, seconds=10 * n)) for n in range(9)])
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    runs = {}
    spark.conf.unset(provider)
    try:
        for idle in (True, False):
            out, checkpoint = f"{folder}/out_{idle}", f"{folder}/ck_{idle}"
            sinks.stream_files(fact(topics), out, checkpoint, None, idle_batches=idle).awaitTermination()
            runs[idle] = [rows(spark.read.parquet(out), "id", "ho_so_id", "join_skew_ms"), len(list(pathlib.Path(checkpoint, "commits").glob("[0-9]*")))]
        assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
        assert spark.conf.get("spark.sql.streaming.join.stateFormatVersion") == "2"
    finally:
        spark.conf.set(provider, before)
    assert runs[True][0] == runs[False][0] != []
    assert (runs[True][1], runs[False][1]) == (2, 1)
    started = json.loads(pathlib.Path(folder, "ck_False", "offsets", "0").read_text().split("\n")[1])["conf"]
    assert started[provider].endswith("RocksDBStateStoreProvider")
    assert started["spark.sql.streaming.join.stateFormatVersion"] == "3"
