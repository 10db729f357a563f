from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caseledger.plans import dims
from caseledger.schemas import CONTRACTS, FACT_BACKLOG, assert_schema, conform
from caseledger.sources import readers, tables
from tests.conftest import rows

T = datetime(2024, 1, 1)


def frame(spark, data, schema="id int, v string"):
    return spark.createDataFrame(data, schema)


def test_append_is_partitioned_by_day_and_prunes(spark, name):
    t = name("bronze")
    df = frame(spark, [(1, T), (2, T + timedelta(days=1))], "id int, ingested_at timestamp")
    tables.append_partitioned(df, t)
    tables.append_partitioned(df, t)
    assert spark.table(t).count() == 4
    plan = spark.table(t).where("ingest_date = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_append_new_only_is_idempotent_and_unique_within_a_batch(spark, name):
    t = name("events")
    batch = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n")])
    for _ in range(2):
        tables.append_new_only(batch, t, "id")
    assert rows(spark.table(t)) == [(None, "n"), (1, "a"), (2, "b")]
    tables.append_new_only(frame(spark, [(2, "changed"), (3, "c")]), t, "id")
    assert rows(spark.table(t)) == [(None, "n"), (1, "a"), (2, "b"), (3, "c")]


def test_upsert_twice_equals_once_and_handles_null_keys(spark, name):
    t = name("state")
    tables.upsert_current_state(frame(spark, [(i, "old") for i in range(40)] + [(None, "old")]), t, "id", buckets=4)
    batch = frame(spark, [(3, "new"), (None, "new"), (99, "new")])
    for _ in range(2):
        tables.upsert_current_state(batch, t, "id")
    got = rows(spark.table(t).drop("key_bucket"))
    assert len(got) == 42
    assert [r for r in got if r[1] == "new"] == [(None, "new"), (3, "new"), (99, "new")]


def test_upsert_rewrites_only_touched_buckets(spark, name):
    t = name("state")
    tables.upsert_current_state(frame(spark, [(i, "old") for i in range(200)]), t, "id", buckets=8)
    before = {r["f"] for r in spark.table(t).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    tables.upsert_current_state(frame(spark, [(5, "new")]), t, "id")
    after = {r["f"] for r in spark.table(t).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert len(before) == len(after) == 8 and len(before & after) == 7
    assert spark.table(t).count() == 200


def test_upsert_with_order_takes_the_newest_and_adds_columns(spark, name):
    t = name("state")
    tables.upsert_current_state(frame(spark, [(1, 1, "a"), (1, 2, "b")], "id int, seq int, v string"), t, "id", "seq")
    tables.upsert_current_state(frame(spark, [(2, 1, "c", "extra")], "id int, seq int, V string, more string"), t, "id")
    assert rows(spark.table(t), "id", "v", "more") == [(1, "b", None), (2, "c", "extra")]
    assert spark.table(t).columns.count("v") == 1 and "V" not in spark.table(t).columns


def test_replace_all_may_read_its_own_target_and_keeps_versions(spark, name, folder):
    t = name("dim")
    tables.replace_all(frame(spark, [(1, "a")]), t, folder)
    for _ in range(3):
        tables.replace_all(spark.table(t).withColumn("id", F.col("id") + 1), t)
    assert rows(spark.table(t)) == [(4, "a")]


def test_replace_partition_empties_a_day_and_leaves_the_others(spark, name):
    t = name("fact")
    df = frame(spark, [(1, 20240101), (2, 20240102)], "id int, thoi_gian_id int")
    for day in (20240101, 20240102):
        tables.replace_partition(df.where(F.col("thoi_gian_id") == day), t, "thoi_gian_id", day)
    with pytest.raises(Exception, match="a row belongs to thoi_gian_id = 20240101"):
        tables.replace_partition(df, t, "thoi_gian_id", 20240102)
    tables.replace_partition(df.where("id = 2").withColumn("note", F.lit("n")), t, "thoi_gian_id", 20240102)
    assert rows(spark.table(t), "id", "note", "thoi_gian_id") == [(1, None, 20240101), (2, "n", 20240102)]
    tables.replace_partition(df.where("id = 7"), t, "thoi_gian_id", 20240101)
    assert rows(spark.table(t), "id") == [(2,)]


def test_replace_partition_with_an_input_that_is_empty_at_run_time(spark, name):
    t = name("fact")
    df = frame(spark, [(1, 20240101)], "id int, thoi_gian_id int")
    tables.replace_partition(df, t, "thoi_gian_id", 20240101)
    nothing = df.join(frame(spark, [(5,)], "id int"), "id")
    tables.replace_partition(nothing.groupBy("id", "thoi_gian_id").count().drop("count"), t, "thoi_gian_id", 20240101)
    assert spark.table(t).count() == 0


def test_delete_where_and_drop_column(spark, name):
    t = name("plain")
    tables.replace_all(frame(spark, [(1, "a"), (2, None)]), t)
    tables.delete_where(spark, t, "v = 'a'")
    assert rows(spark.table(t)) == [(2, None)]
    tables.drop_column(spark.table(t), t, "v")
    assert spark.table(t).columns == ["id"]


def test_repartition_keeps_content(spark, name):
    t = name("history")
    tables.create_or_evolve(frame(spark, [], "id int, action_time timestamp"), t)
    tables.insert_rows(frame(spark, [(1, T), (2, None)], "id int, action_time timestamp"), t)
    tables.repartition_table(spark, t, "action_time", "action_date")
    assert rows(spark.table(t), "id", "action_date") == [(1, date(2024, 1, 1)), (2, None)]
    assert tables.partition_columns(spark, t) == ["action_date"]


def test_upsert_after_a_column_was_dropped_finds_the_buckets(spark, name):
    t = name("state")
    frame_ = spark.range(50).selectExpr("CAST(id AS int) AS id", "'a' AS v", "1 AS w")
    tables.upsert_current_state(frame_, t, "id", buckets=8)
    tables.drop_column(spark.table(t), t, "w")
    tables.upsert_current_state(frame_.drop("w").withColumn("v", F.lit("b")), t, "id")
    assert spark.table(t).count() == 50 and spark.table(t).where("v = 'b'").count() == 50


def test_upsert_hashes_keys_by_the_table_type(spark, name):
    t = name("state")
    tables.upsert_current_state(spark.range(50).selectExpr("id", "'a' AS v"), t, "id", buckets=8)
    tables.upsert_current_state(frame(spark, [(1, "x"), (2, "x"), (3, "x"), (99, "x")]), t, "id")
    assert spark.table(t).count() == 51 and spark.table(t).where("v = 'x'").count() == 4


def test_a_replayed_batch_keeps_the_newer_row(spark, name):
    t = name("state")
    old, new = frame(spark, [(1, 1, "old")], "id int, seq int, v string"), frame(spark, [(1, 2, "new")], "id int, seq int, v string")
    for batch in (old, new, old):
        tables.upsert_current_state(batch, t, "id", "seq")
    assert rows(spark.table(t), "id", "v") == [(1, "new")]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_delete_empties_a_null_partition(spark, name, kind):
    t = name("parts")
    df = frame(spark, [(1, None), (2, "7"), (3, "it's")] if kind == "string" else [(1, None), (2, 7)], f"id int, p {kind}")
    tables.create_or_evolve(df, t, "p")
    tables.insert_rows(df, t)
    tables.delete_where(spark, t, "p IS NULL OR id = 3")
    assert rows(spark.table(t), "id") == [(2,)]


def test_default_versions_do_not_live_in_the_scratch_folder(spark, name):
    t = name("dim")
    tables.replace_all(frame(spark, [(1, "a")]), t)
    assert "/warehouse/" in tables.describe(spark, t)["Location"]


def test_retention_keeps_the_newest_and_the_recent(spark, name):
    t = name("bronze")
    for i in range(6):
        tables.append_partitioned(frame(spark, [(i, f"s{i}", T + timedelta(days=i))],
                                        "id int, snapshot_id string, ingested_at timestamp"), t)
    now = F.lit(T + timedelta(days=12)).cast("timestamp")
    assert tables.retention_purge(spark, t, 7, 3, now) == ["s0", "s1", "s2"]
    assert rows(spark.table(t), "snapshot_id") == [("s3",), ("s4",), ("s5",)]
    assert tables.retention_purge(spark, t, 100, 0, now) == []


def test_read_optional(spark, name):
    assert readers.read_optional(spark, name("absent")) is None


def test_contracts(spark):
    assert set(CONTRACTS) >= {"gold.fact_ton_dong_ho_so", "realtime.fact_xu_ly_ho_so_stream"}
    assert len(CONTRACTS["realtime.fact_xu_ly_ho_so_stream"]) == 27
    empty = spark.createDataFrame([], FACT_BACKLOG)
    assert_schema(empty, FACT_BACKLOG)
    with pytest.raises(ValueError, match="so_luong"):
        assert_schema(empty.drop("so_luong"), FACT_BACKLOG)
    with pytest.raises(ValueError, match="id: expected bigint"):
        assert_schema(empty.withColumn("id", F.lit(1)), FACT_BACKLOG)
    assert conform(empty.withColumn("id", F.lit(1)), FACT_BACKLOG).schema["id"].dataType.simpleString() == "bigint"


def test_calendar_table_grows_and_is_trimmed(spark, name):
    t = name("dim_thoi_gian")
    dims.build_calendar(spark, t, date(2023, 2, 1))
    dims.build_calendar(spark, t, date(2023, 3, 1))
    assert spark.table(t).count() == 31 + 28 + 8
    dims.build_calendar(spark, t, date(2023, 2, 1))
    assert spark.table(t).agg(F.max("ngay_date")).first()[0] == date(2023, 2, 8)


URL = "jdbc:derby:memory:cases;create=true"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_jdbc_snapshot_and_mirror(spark):
    masters = frame(spark, [(1, "a"), (1, "a"), (2, "b")])
    assert tables.mirror_jdbc(masters, URL, '"Agency"', DRIVER)
    assert tables.mirror_jdbc(masters, URL, '"Agency"', DRIVER)          # a repeated run refills
    read = readers.scan_jdbc(spark, URL, "Agency", DRIVER, ("id", 1, 3, 2))
    assert read.rdd.getNumPartitions() == 2 and read.count() == 3
    got = readers.jdbc_snapshot(spark, URL, ["Agency"], "S1", driver=DRIVER)["Agency"]
    assert rows(got, "id", "v", "snapshot_id") == [(1, "a", "S1"), (2, "b", "S1")]
    with pytest.raises(readers.SnapshotErrors) as caught:
        readers.jdbc_snapshot(spark, URL, ["Missing", "Agency"], "S1", driver=DRIVER)
    assert list(caught.value.errors) == ["Missing"] and list(caught.value.frames) == ["Agency"]
    said = []
    assert not tables.mirror_jdbc(masters, "jdbc:derby:memory:absent", "x", DRIVER, on_error=said.append)
    assert len(said) == 1


def test_master_snapshot_appends_each_run(spark, name):
    from caseledger.plans import bronze
    tables.mirror_jdbc(frame(spark, [(1, "a")]), URL, '"Role"', DRIVER)
    prefix = name("m")
    for run in ("S1", "S2"):
        bronze.master_snapshot(spark, URL, run, ["Role"], lambda t: f"{prefix}_{t.lower()}", driver=DRIVER)
    assert rows(spark.table(f"{prefix}_role"), "id", "snapshot_id") == [(1, "S1"), (1, "S2")]


def test_dimension_versions_are_published_and_mirrored(spark, name):
    prefix = name("gold")
    def status(text, day):
        return spark.createDataFrame([(1, "R", text, T + timedelta(days=day), f"s{day}")],
            "trang_thai_id int, ma_trang_thai string, ten_trang_thai string, source_snapshot_at timestamp, source_snapshot_id string")
    for text, day in (("Received", 0), ("Đã nhận", 1)):
        dim = dims.build_dimension(spark, dims.STATUS, status(text, day), lambda t: f"{prefix}_{t}", URL, driver=DRIVER)
    assert rows(dim, "ten_trang_thai", "is_current") == [("Received", False), ("Đã nhận", True)]
    assert_schema(dim, CONTRACTS["gold.dim_trang_thai"])
    mirrored = spark.read.format("jdbc").option("url", URL).option("dbtable", "dim_trang_thai").option("driver", DRIVER).load()
    assert rows(mirrored, "ten_trang_thai") == [("Đã nhận",)]


def test_a_bucketed_log_reads_only_the_buckets_of_a_batch(spark, name, monkeypatch):
    t = name("log")
    every = frame(spark, [(i, f"u{i % 50}") for i in range(400)], "id int, user string")
    tables.append_new_only(every.where("id % 3 > 0"), t, "id", bucket_by="user", buckets=16)
    assert tables.partition_columns(spark, t) == ["key_bucket"]
    batch = frame(spark, [(9_000, "u7"), (7, "u7"), (9_000, "u7")], "id int, user string")
    read = tables.in_buckets(batch, t, "user")
    plan = read._jdf.queryExecution().executedPlan().toString()
    bucket = batch.select(tables.key_bucket("user", 16)).first()[0]
    assert "PartitionFilters: [isnotnull(key_bucket" in plan and f"= {bucket})" in plan
    assert {f.split("key_bucket=")[1].split("/")[0] for f in read.inputFiles()} == {str(bucket)}
    # The append asks that bucket, and no other, which keys it has.
    asked, fresh, anti = [], tables.fresh, tables.anti_join

    def watched(left, known, names):
        asked.extend(known.inputFiles())
        return anti(left, known, names)
    monkeypatch.setattr(tables, "anti_join", watched)
    tables.append_new_only(batch, t, "id", bucket_by="user")
    assert {f.split("key_bucket=")[1].split("/")[0] for f in asked if "key_bucket=" in f and "append-" not in f} == {str(bucket)}
    assert fresh(spark, t).count() == every.where("id % 3 > 0").count() + 1
    tables.append_new_only(every, t, "id", bucket_by="user")
    tables.append_new_only(every.selectExpr("CAST(id AS BIGINT) AS id", "user"), t, "id", bucket_by="user")
    assert fresh(spark, t).count() == 401


def test_a_log_without_buckets_stays_without(spark, name):
    t = name("log")
    tables.append_new_only(frame(spark, [(1, "a")]), t, "id")
    tables.append_new_only(frame(spark, [(1, "a"), (2, "b")]), t, "id", bucket_by="v")
    assert rows(tables.fresh(spark, t)) == [(1, "a"), (2, "b")]
    assert tables.in_buckets(frame(spark, [(1, "a")]), t, "v").count() == 2


def test_latest_snapshot_reads_one_day(spark, name):
    t = name("bronze")
    for n, keys in enumerate(([1, 2, 3], [1, 2], [2, 3, 3])):
        for hour in (9, 10):
            rows_ = [(k, f"{n}-{hour}", T + timedelta(days=n, hours=hour)) for k in (keys if hour == 10 else [8, 9])]
            tables.append_partitioned(frame(spark, rows_, "id int, v string, ingested_at timestamp"), t)
    tables.append_partitioned(frame(spark, [(7, "no time", None)], "id int, v string, ingested_at timestamp"), t)
    got = readers.scan_latest_snapshot(spark, t)
    assert rows(got, "id", "v") == [(2, "2-10"), (3, "2-10"), (3, "2-10")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(ingest_date" in plan and "PushedFilters: [IsNotNull(ingested_at), EqualTo(ingested_at" in plan
    assert readers.newest_partition(spark, t, "ingest_date") == "2024-01-03"
    from caseledger.plans import silver
    assert rows(silver.master_latest_of(spark, t), "id") == [(2,), (3,)]
    only = name("bronze")
    tables.append_partitioned(frame(spark, [(7, "no time", None)], "id int, v string, ingested_at timestamp"), only)
    assert rows(readers.scan_latest_snapshot(spark, only), "id") == [(7,)]


DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_staged_mirror_keeps_the_old_rows_when_a_load_fails(spark, name):
    url = f"jdbc:derby:memory:{name('m')};create=true"
    first = frame(spark, [(i, f"v{i}") for i in range(50)])
    assert tables.mirror_jdbc_staged(first, url, '"dim"', DERBY)
    said = []
    broken = first.withColumn("v", F.when(F.col("id") < 40, F.col("v")).otherwise(F.raise_error(F.lit("bad")).cast("string")))
    assert not tables.mirror_jdbc_staged(broken, url, '"dim"', DERBY, on_error=said.append) and said
    read = lambda: readers.scan_jdbc(spark, url, "dim", DERBY, ("id", 3))
    assert rows(read()) == rows(first)
    # A load that the served table refuses is rolled back as a whole.
    wider = first.withColumnRenamed("v", "w")
    assert not tables.mirror_jdbc_staged(wider, url, '"dim"', DERBY, on_error=said.append)
    assert rows(read()) == rows(first)
    second = frame(spark, [(1, "new"), (70, "more")])
    assert tables.mirror_jdbc_staged(second, url, '"dim"', DERBY) and rows(read()) == rows(second)
    assert readers.jdbc_bounds(spark, url, "dim", "id", DERBY) == (1, 70)
    assert read().rdd.getNumPartitions() == 3
    assert tables.mirror_jdbc_staged(second.where("false"), url, '"dim"', DERBY) and read().count() == 0
