"""Sources, sinks, joins, windows, aggregates and set operations."""

from __future__ import annotations

import math
import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from caseledger.functions import columns as C
from caseledger.operators import calendar as cal_ops
from caseledger.operators import joins, keys, quality, ranking
from caseledger.operators.skew import hot_keys
from caseledger.plans import bronze
from caseledger.plans import dims as dim_plans
from caseledger.schemas import FACT_AGENCY_DAY, assert_schema, conform
from caseledger.sources import readers, tables
from workloads import bindings as B
from workloads.registry import query

EVENT_COLUMNS = "event_id, user_id, event_type, value, ts"


def events(spark, sf):
    return B.table(spark, sf, "events")


def sparse_events(spark, sf):
    """Events whose value is known only now and then."""
    return events(spark, sf).select(
        "event_id", "user_id", "ts", "event_type",
        F.when(F.col("event_id") % 5 == 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("label"))


SPARSE = """sparse AS (
  SELECT event_id, user_id, ts, event_type, CASE WHEN event_id % 5 = 0 THEN value END AS value,
         CASE WHEN event_id % 3 = 0 THEN event_type END AS label FROM events)"""


def priced(spark, sf):
    """Two overlapping sources of the same events: the second repeats every tenth key."""
    base = events(spark, sf)
    first = base.where(F.col("event_id") % 2 == 0).select(
        "event_id", "user_id", "ts", F.col("value").alias("amount"), F.lit(1).alias("source_priority"))
    second = base.where((F.col("event_id") % 2 == 1) | (F.col("event_id") % 10 == 0)).select(
        "event_id", "user_id", "ts", F.col("event_type").alias("kind"),
        F.lit(2).alias("source_priority"))
    return first, second


PRICED = """both_sources AS (
  SELECT event_id, user_id, ts, value AS amount, CAST(NULL AS VARCHAR) AS kind, 1 AS source_priority
  FROM events WHERE event_id % 2 = 0
  UNION ALL
  SELECT event_id, user_id, ts, NULL, event_type, 2
  FROM events WHERE event_id % 2 = 1 OR event_id % 10 = 0)"""


# --- sources ------------------------------------------------------------------------

@query("S5_scan_table_optional", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_optional(spark, sf):
    name, location = B.new_table(spark, "nation")
    tables.create_or_evolve(B.table(spark, sf, "nation"), name, location=location)
    tables.insert_rows(B.table(spark, sf, "nation"), name)
    return keys.union_available(readers.read_optional(spark, name),
                                readers.read_optional(spark, f"{name}_absent"))


@query("S6_date_spine", f"""
SELECT strftime(d, '%Y-%m-%d') AS ngay_date,
       (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = CAST(d AS DATE)) AS cases
FROM generate_series(TIMESTAMP '{B.FIRST}', TIMESTAMP '{B.LAST}', INTERVAL 1 DAY) t(d)""")
def spine(spark, sf):
    per_day = (B.table(spark, sf, "orders").where(C.on_day("o_orderdate", B.FIRST, B.LAST))
               .groupBy(F.to_date("o_orderdate").alias("ngay_date"))
               .agg(F.count(F.lit(1)).alias("cases")))
    return joins.assemble_dense(cal_ops.date_spine(spark, B.FIRST, B.LAST), per_day, key="ngay_date")


@query("S7_literal_rows", f"""WITH {B.DIM_STATUS}
SELECT ma_trang_thai, count(*) AS lines FROM lineitem
JOIN dim_trang_thai ON trang_thai_id = l_linenumber + 1 GROUP BY ma_trang_thai""")
def literal(spark, sf):
    names = keys.literal_rows(spark, B.STATUS_ROWS, "trang_thai_id int, ma_trang_thai string")
    per_status = (B.history(spark, sf).groupBy("trang_thai_id")
                  .agg(F.count(F.lit(1)).alias("lines")))
    return joins.lookup(per_status, names, "trang_thai_id", {"ma_trang_thai": "ma_trang_thai"},
                        "inner").select("ma_trang_thai", "lines")


@query("S8_empty_relation", "SELECT n_nationkey AS co_quan_id, n_name AS ten FROM nation")
def empty(spark, sf):
    first = B.table(spark, sf, "nation").select(F.col("n_nationkey").alias("co_quan_id"),
                                                F.col("n_name").alias("ten"))
    return keys.literal_rows(spark, [], first.schema).unionByName(first)


@query("S9_partition_range_scan", """
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS thoi_gian_id, count(*) AS cases
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'
GROUP BY 1""")
def range_scan(spark, sf):
    name, location = B.new_table(spark, "cases_by_day")
    dated = B.table(spark, sf, "orders").select("o_orderkey", C.day_key("o_orderdate").alias("thoi_gian_id"))
    tables.create_or_evolve(dated, name, "thoi_gian_id", location)
    tables.insert_rows(dated, name)
    return (readers.scan_days(spark, name, 19980101, 19980131).groupBy("thoi_gian_id")
            .agg(F.count(F.lit(1)).alias("cases")))


# An embedded in-memory database stands for the operational one; it lives in a local driver.
DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _database(spark, **frames) -> str:
    url = f"jdbc:derby:memory:m{uuid.uuid4().hex};create=true"
    for table, df in frames.items():
        if not tables.mirror_jdbc(df, url, f'"{table}"', DERBY):
            raise RuntimeError(f"{table} could not be written")
    return url


def _agencies(spark, sf):
    return B.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")


@query("S1_scan_jdbc", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def jdbc(spark, sf):
    url = _database(spark, Agency=_agencies(spark, sf))
    return readers.scan_jdbc(spark, url, "Agency", DERBY, ("s_suppkey", 1, 1000, 4))


@query("K10_mirror_jdbc", "SELECT n_nationkey, upper(n_name) AS n_name FROM nation")
def mirror(spark, sf):
    """A dimension mirrored twice: the second run refills what the first wrote."""
    nations = B.table(spark, sf, "nation").select("n_nationkey", "n_name")
    url = _database(spark, Nation=nations)
    tables.mirror_jdbc(nations.withColumn("n_name", F.upper("n_name")), url, '"Nation"', DERBY)
    return readers.scan_jdbc(spark, url, "Nation", DERBY)


@query("C1_bronze_masters", """
SELECT s_suppkey, s_name, s_acctbal, snapshot_id FROM supplier, (VALUES ('S1'), ('S2')) t(snapshot_id)""")
def bronze_masters(spark, sf):
    """Two snapshots of a master with a repeated row; each run appends its own."""
    masters = _agencies(spark, sf)
    url = _database(spark, Agency=masters.unionByName(masters.where("s_suppkey % 3 = 0")))
    name, _ = B.new_table(spark, "bronze_agency")
    for run in ("S1", "S2"):
        bronze.master_snapshot(spark, url, run, ["Agency"], lambda table: name, driver=DERBY)
    return spark.table(name).select("s_suppkey", "s_name", "s_acctbal", "snapshot_id")


# --- sinks and maintenance ------------------------------------------------------------

@query("K1_append_partitioned", f"""
SELECT {EVENT_COLUMNS}, strftime(ts, '%Y-%m-%d') AS ingest_date FROM events""")
def append(spark, sf):
    name, location = B.new_table(spark, "bronze_events")
    tables.append_partitioned(events(spark, sf).select(*EVENT_COLUMNS.split(", ")), name, "ts",
                              location=location)
    return spark.table(name)


@query("K3_upsert_current_state", """
SELECT c_custkey, c_name,
       CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer
UNION ALL SELECT c_custkey + 1000000000, c_name, c_acctbal FROM customer WHERE c_custkey % 50 = 0""")
def upsert(spark, sf):
    name, location = B.new_table(spark, "customer_state")
    base = B.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = base.where("c_custkey % 5 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    added = base.where("c_custkey % 50 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000000)
    tables.upsert_current_state(base, name, "c_custkey", buckets=8, location=location)
    batch = changed.unionByName(added)
    tables.upsert_current_state(batch, name, "c_custkey")
    tables.upsert_current_state(batch, name, "c_custkey")
    return spark.table(name).drop(tables.BUCKET)


@query("K8_K3_upsert_after_drop_column", "SELECT c_custkey, c_name FROM customer")
def upsert_after_drop(spark, sf):
    """Retiring a column keeps the buckets, and keys of a narrower type find theirs."""
    name, location = B.new_table(spark, "customer_narrow")
    base = B.table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal")
    tables.upsert_current_state(base.withColumn("c_name", F.lit("old")), name, "c_custkey", buckets=8, location=location)
    tables.drop_column(spark.table(name), name, "c_acctbal")
    tables.upsert_current_state(base.select(F.col("c_custkey").cast("int").alias("c_custkey"), "c_name"), name, "c_custkey")
    return spark.table(name).drop(tables.BUCKET)


@query("K9_delete_null_partition", """
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS p
FROM orders WHERE o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '2%'""")
def delete_null_partition(spark, sf):
    name, location = B.new_table(spark, "orders_by_priority")
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    rows = B.table(spark, sf, "orders").select("o_orderkey", F.when(number > 1, number).alias("p"))
    tables.create_or_evolve(rows, name, "p", location)
    tables.insert_rows(rows, name)
    tables.delete_where(spark, name, "p IS NULL OR p = 2")
    return spark.table(name)


@query("K4_append_new_only", f"SELECT {EVENT_COLUMNS} FROM events")
def append_new(spark, sf):
    name, location = B.new_table(spark, "event_log")
    every = events(spark, sf).select(*EVENT_COLUMNS.split(", "))
    tables.append_new_only(every.where("event_id % 3 <> 1"), name, "event_id", ("ts", "event_date"),
                           location)
    tables.append_new_only(every.unionByName(every.where("event_id % 7 = 0")), name, "event_id",
                           ("ts", "event_date"))
    return spark.table(name).drop("event_date")


@query("K4_bucketed_log", f"SELECT {EVENT_COLUMNS} FROM events")
def append_new_bucketed(spark, sf):
    """The same log in buckets of the user: a batch asks only the buckets of its users."""
    name, location = B.new_table(spark, "event_log_buckets")
    every = events(spark, sf).select(*EVENT_COLUMNS.split(", "))
    tables.append_new_only(every.where("event_id % 3 <> 1"), name, "event_id", location=location, bucket_by="user_id", buckets=16)
    tables.append_new_only(every.unionByName(every.where("event_id % 7 = 0")), name, "event_id", bucket_by="user_id")
    return spark.table(name).drop(tables.BUCKET)


@query("K3_versioned_upsert", """
SELECT event_type, user_id, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1""")
def versioned_upsert(spark, sf):
    """Batches in a wrong order and one of them twice: the stored version decides."""
    name, location = B.new_table(spark, "newest_event")
    every = events(spark, sf).select("event_type", "user_id", "event_id", F.struct("ts", "event_id").alias("version"))
    for batch in ("event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 0"):
        tables.upsert_current_state(every.where(batch), name, ["event_type", "user_id"], "version", buckets=8, location=location)
    return tables.fresh(spark, name).drop(tables.BUCKET, "version")


@query("W3_latest_snapshot_pruned", """
SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name FROM customer WHERE c_custkey % 7 <> 3""")
def latest_snapshot_pruned(spark, sf):
    """Three daily snapshots in a table laid out by day; the newest one has lost some keys."""
    name, location = B.new_table(spark, "bronze_customer")
    customer = B.table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"))
    for n in (1, 2, 3):
        at = (F.lit(datetime(2024, 1, 1, 9)).cast("timestamp") + B.days(F.lit(n)))
        rows = customer.where("id % 7 <> 3") if n == 3 else customer.withColumn("name", F.lit("old"))
        tables.append_partitioned(rows.withColumn("ingested_at", at), name, location=location)
    return readers.scan_latest_snapshot(spark, name).select("id", "name")


@query("K10_staged_mirror", "SELECT n_nationkey, upper(n_name) AS n_name FROM nation")
def staged_mirror(spark, sf):
    """A load, one that fails and leaves the old rows, and one that replaces them."""
    nations = B.table(spark, sf, "nation").select("n_nationkey", "n_name")
    url = _database(spark, Nation=nations)
    broken = nations.withColumn("n_name", F.when(F.col("n_nationkey") < 20, F.col("n_name")).otherwise(
        F.raise_error(F.lit("a bad row")).cast("string")))
    if tables.mirror_jdbc_staged(broken, url, '"Nation"', DERBY, on_error=lambda _: None):
        raise RuntimeError("the broken load was taken")
    kept = readers.scan_jdbc(spark, url, "Nation", DERBY)
    if kept.count() != nations.count():
        raise RuntimeError("the old rows are gone")
    tables.mirror_jdbc_staged(nations.withColumn("n_name", F.upper("n_name")), url, '"Nation"', DERBY)
    return readers.scan_jdbc(spark, url, "Nation", DERBY, ("n_nationkey", 4))


@query("K5_replace_all", "SELECT s_suppkey, s_acctbal * 2 AS s_acctbal FROM supplier")
def replace_all(spark, sf):
    name, location = B.new_table(spark, "supplier_version")
    first = B.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    tables.replace_all(first, name, location)
    # The new version is computed from the stored one.
    tables.replace_all(spark.table(name).withColumn("s_acctbal", F.col("s_acctbal") * 2), name)
    return spark.table(name)


@query("K6_replace_partition", """
SELECT l_linenumber AS part_id, l_orderkey, l_quantity FROM lineitem WHERE l_linenumber NOT IN (2, 3)
UNION ALL SELECT l_linenumber, l_orderkey, l_quantity + 1 FROM lineitem WHERE l_linenumber = 2""")
def replace_partition(spark, sf):
    name, location = B.new_table(spark, "lines_by_part")
    lines = B.table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("part_id"),
                                                  "l_orderkey", "l_quantity")
    tables.create_or_evolve(lines, name, "part_id", location)
    tables.insert_rows(lines, name)
    second = lines.where("part_id = 2").withColumn("l_quantity", F.col("l_quantity") + 1)
    tables.replace_partition(second, name, "part_id", 2)
    tables.replace_partition(lines.where(F.lit(False)), name, "part_id", 3)
    return spark.table(name)


@query("K7_create_or_evolve", """
SELECT r_regionkey, r_name, CAST(NULL AS INTEGER) AS nations FROM region
UNION ALL SELECT n_regionkey, NULL, CAST(count(*) AS INTEGER) FROM nation GROUP BY n_regionkey""")
def evolve(spark, sf):
    name, location = B.new_table(spark, "region_evolved")
    old = B.table(spark, sf, "region")
    tables.create_or_evolve(old, name, location=location)
    tables.insert_rows(old, name)
    wider = (B.table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("R_REGIONKEY"))
             .agg(F.count(F.lit(1)).cast("int").alias("nations")))
    tables.create_or_evolve(wider, name)
    tables.insert_rows(wider, name)
    return spark.table(name)


@query("K8_drop_column", "SELECT p_partkey, p_brand FROM part")
def drop_column(spark, sf):
    name, location = B.new_table(spark, "part_narrow")
    wide = B.table(spark, sf, "part").select("p_partkey", "p_brand", F.lit("x").alias("record_hash"))
    tables.create_or_evolve(wide, name, location=location)
    tables.insert_rows(wide, name)
    tables.drop_column(spark.table(name), name, "record_hash")
    return spark.table(name)


@query("K9_delete_where", """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE NOT (l_suppkey % 4 = 0 OR l_linenumber = 7)""")
def delete_where(spark, sf):
    name, location = B.new_table(spark, "lines_trimmed")
    lines = B.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    tables.create_or_evolve(lines, name, "l_linenumber", location)
    tables.insert_rows(lines, name)
    tables.delete_where(spark, name, "l_suppkey % 4 = 0 OR l_linenumber = 7")
    return spark.table(name)


def bronze_snapshots(spark, sf):
    """Fourteen daily snapshots of the customers, one day apart."""
    numbers = F.explode(F.sequence(F.lit(1), F.lit(14))).alias("n")
    return (B.table(spark, sf, "customer").select("c_custkey", "c_acctbal", numbers)
            .select("c_custkey", "c_acctbal", F.format_string("S%02d", "n").alias("snapshot_id"),
                    (F.lit(datetime(2024, 1, 1)).cast("timestamp") + B.days(F.col("n")))
                    .alias("ingested_at")))


@query("K14_retention_purge", """
SELECT snapshot_id, count(*) AS row_count FROM customer,
  (SELECT printf('S%02d', n) AS snapshot_id FROM generate_series(8, 14) t(n)) GROUP BY snapshot_id""")
def retention(spark, sf):
    name, location = B.new_table(spark, "customer_snapshots")
    tables.append_partitioned(bronze_snapshots(spark, sf), name, location=location)
    tables.retention_purge(spark, name, retain_days=7, retain_last=5,
                           now=F.lit(datetime(2024, 1, 16)).cast("timestamp"))
    return (spark.table(name).groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("row_count")))


@query("K15_repartition_table", """
SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS action_date FROM events""")
def relayout(spark, sf):
    name, location = B.new_table(spark, "events_flat")
    flat = events(spark, sf).select("event_id", "ts")
    tables.create_or_evolve(flat, name, location=location)
    tables.insert_rows(flat, name)
    tables.repartition_table(spark, name, "ts", "action_date")
    return spark.table(name)


@query("K16_table_contract", """
SELECT CAST(c_nationkey AS INTEGER) AS co_quan_id, CAST(count(*) AS INTEGER) AS so_luong_tiep_nhan,
       CAST(19980115 AS INTEGER) AS thoi_gian_id
FROM customer GROUP BY c_nationkey""")
def contract(spark, sf):
    counted = B.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("co_quan_id")).agg(
        F.count(F.lit(1)).alias("so_luong_tiep_nhan"))
    padded = counted.withColumns({f.name: F.lit(None).cast(f.dataType) for f in FACT_AGENCY_DAY
                                  if f.name not in counted.columns})
    fact = conform(padded.withColumn("thoi_gian_id", F.lit(19980115)), FACT_AGENCY_DAY)
    return assert_schema(fact, FACT_AGENCY_DAY).select("co_quan_id", "so_luong_tiep_nhan",
                                                      "thoi_gian_id")


# --- projections, keys and predicates -------------------------------------------------

@query("F1_audit_columns", """
SELECT n_nationkey, 'jdbc:source/nation' AS file_name, 'S1' AS snapshot_id, TRUE AS stamped FROM nation""")
def audit(spark, sf):
    return keys.with_audit(B.table(spark, sf, "nation"), "jdbc:source/nation", "S1").select(
        "n_nationkey", "file_name", "snapshot_id", F.col("ingested_at").isNotNull().alias("stamped"))


@query("F2_trim_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trimmed(spark, sf):
    padded = B.table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name").alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"))
    return keys.trim_strings(padded)


@query("F3_source_snapshot_columns", """
SELECT s_suppkey, TIMESTAMP '2024-01-02' AS source_snapshot_at, 'S7' AS source_snapshot_id FROM supplier""")
def snapshot_columns(spark, sf):
    bronze = keys.with_audit(B.table(spark, sf, "supplier").select("s_suppkey"), "f", "S7",
                             F.lit(datetime(2024, 1, 2)).cast("timestamp"))
    return keys.as_source_snapshot(bronze)


@query("F5_composite_event_key", """
SELECT l_orderkey, concat_ws(chr(31), 'CDC', CAST(l_orderkey AS VARCHAR),
         coalesce(CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_linenumber AS VARCHAR) END, '<NULL>'))
       AS event_id FROM lineitem""")
def composite(spark, sf):
    return B.table(spark, sf, "lineitem").select("l_orderkey", C.event_key(
        "CDC", "l_orderkey", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber")))
        .alias("event_id"))


@query("F6_prefixed_key", "SELECT 'XML_' || o_orderkey AS event_id, o_orderkey FROM orders")
def prefixed(spark, sf):
    return B.table(spark, sf, "orders").select(
        C.prefixed_key("XML_", "o_orderkey").alias("event_id"), "o_orderkey")


@query("F7_default_member", """
SELECT CASE WHEN l_suppkey % 10 = 0 THEN -1 ELSE l_suppkey END AS can_bo_id, count(*) AS lines
FROM lineitem GROUP BY 1""")
def default_member(spark, sf):
    officer = F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey"))
    return (B.table(spark, sf, "lineitem").groupBy(C.or_unknown(officer).alias("can_bo_id"))
            .agg(F.count(F.lit(1)).alias("lines")))


@query("F8_event_time_fallback", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN TIMESTAMP '2024-02-01' ELSE ts END AS event_time FROM events""")
def time_fallback(spark, sf):
    business = F.when(F.col("event_id") % 4 != 0, F.col("ts"))
    return events(spark, sf).select("event_id", C.event_time(
        business, F.lit(datetime(2024, 2, 1)).cast("timestamp")).alias("event_time"))


@query("F9_delete_flag", """
SELECT event_id, event_type = 'error' AS da_bi_xoa FROM events""")
def delete_flag(spark, sf):
    kind = F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    return events(spark, sf).select("event_id", C.is_delete(kind).alias("da_bi_xoa"))


@query("F10_cutoff_predicate", B.with_ctes(B.CASES, body="""
SELECT ho_so_id FROM cases WHERE created_at < TIMESTAMP '1998-01-16'
  AND (NOT da_bi_xoa OR event_time >= TIMESTAMP '1998-01-16')"""))
def cutoff(spark, sf):
    return B.cases(spark, sf).where(
        C.created_and_alive("created_at", "da_bi_xoa", "event_time", B.DAY)).select("ho_so_id")


@query("F11_open_predicate", B.with_ctes(B.HISTORY, body="""
SELECT trang_thai_id, count(*) AS n FROM history WHERE trang_thai_id NOT IN (7, 8) GROUP BY 1"""))
def open_predicate(spark, sf):
    return (B.history(spark, sf).where(C.is_open("trang_thai_id")).groupBy("trang_thai_id")
            .agg(F.count(F.lit(1)).alias("n")))


@query("F12_same_day", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE CAST(l_shipdate AS DATE) = DATE '1998-01-15'""")
def same_day(spark, sf):
    return (B.table(spark, sf, "lineitem").where(C.on_day("l_shipdate", B.DAY))
            .select("l_orderkey", "l_linenumber", "l_shipdate"))


@query("F13_status_match", B.with_ctes(B.PAYMENTS, body="""
SELECT ma_giao_dich, so_tien FROM payments WHERE upper(trang_thai_tt) = 'SUCCESS'"""))
def status_match(spark, sf):
    return B.payments(spark, sf).where(C.is_success("trang_thai_tt")).select("ma_giao_dich", "so_tien")


@query("F15_hot_key_sketch_small_share", "SELECT DISTINCT l_orderkey FROM lineitem")
def many_hot(spark, sf):
    """A share that every key reaches: none is missing."""
    lines = B.table(spark, sf, "lineitem").select("l_orderkey")
    rows = max(1, lines.count())
    # So many sketches that each can track every key that falls to it.
    found = hot_keys(lines, "l_orderkey", share=1.0 / rows, min_rows=1, sketches=math.ceil(rows / 100_000))
    return (lines.dropDuplicates().withColumn("_hash", F.xxhash64("l_orderkey"))
            .join(found, "_hash", "left_semi").select("l_orderkey"))


@query("F15_hot_key_sketch", """
SELECT l_linestatus FROM lineitem GROUP BY 1
HAVING count(*) >= 0.2 * (SELECT count(*) FROM lineitem)""")
def hot(spark, sf):
    """Keys with at least a fifth of the rows: what would be split before a window."""
    lines = B.table(spark, sf, "lineitem").select("l_linestatus")
    found = hot_keys(lines, "l_linestatus", share=0.2, min_rows=1)
    return (lines.dropDuplicates().withColumn("_hash", F.xxhash64("l_linestatus"))
            .join(found, "_hash", "left_semi").select("l_linestatus"))


# --- joins ----------------------------------------------------------------------------

@query("J1_lookup_chain", """
SELECT c_custkey, n_name AS co_quan, r_name AS tinh FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0
LEFT JOIN region ON n_regionkey = r_regionkey""")
def chain(spark, sf):
    nation = B.table(spark, sf, "nation").where("n_nationkey % 5 <> 0")
    found = joins.lookup(B.table(spark, sf, "customer"), nation, {"c_nationkey": "n_nationkey"},
                         {"n_name": "co_quan", "n_regionkey": "_region"})
    return joins.lookup(found, B.table(spark, sf, "region"), {"_region": "r_regionkey"},
                        {"r_name": "tinh"}).select("c_custkey", "co_quan", "tinh")


@query("J2_lookup_other_key", """
SELECT s_suppkey, first_part FROM supplier LEFT JOIN (
  SELECT l_suppkey, min(l_partkey) AS first_part FROM lineitem WHERE l_suppkey % 3 = 0 GROUP BY 1)
  ON s_suppkey = l_suppkey""")
def other_key(spark, sf):
    firsts = (B.table(spark, sf, "lineitem").where("l_suppkey % 3 = 0").groupBy("l_suppkey")
              .agg(F.min("l_partkey").alias("first_part")))
    return joins.lookup(B.table(spark, sf, "supplier"), firsts, {"s_suppkey": "l_suppkey"},
                        {"first_part": "first_part"}).select("s_suppkey", "first_part")


# Suppliers as versions of their nation, with ranges that overlap; orders as facts.
_OVERLAP_SQL = """
WITH v AS (SELECT s_nationkey AS k, s_suppkey AS sk, TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey * 37 % 2000 AS INTEGER)) AS f,
  CASE WHEN s_suppkey % 7 <> 0 THEN TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey * 37 % 2000 + s_suppkey * 11 % 900 AS INTEGER)) END AS t FROM supplier)
SELECT o_orderkey, sk FROM (
  SELECT o_orderkey, v.sk, row_number() OVER (PARTITION BY o_orderkey ORDER BY v.f DESC NULLS LAST, v.sk DESC) AS r
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN v ON v.k = c_nationkey AND v.f <= o_orderdate AND (v.t IS NULL OR o_orderdate < v.t)) WHERE r = 1"""


def _overlapping(spark, sf, strategy):
    start = F.col("s_suppkey") * 37 % 2000
    at = lambda days: F.lit(datetime(1992, 1, 1)).cast("timestamp") + B.days(days)
    versions = B.table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("sk"), at(start).alias("effective_from_ts"),
        F.when(F.col("s_suppkey") % 7 != 0, at(start + F.col("s_suppkey") * 11 % 900)).alias("effective_to_ts"))
    facts = B.table(spark, sf, "orders").join(B.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joins.join_scd2_as_of(facts.select("o_orderkey", "c_nationkey", "o_orderdate"), versions, "k", "c_nationkey",
                                 F.col("o_orderdate"), "sk", strategy=strategy).select("o_orderkey", "sk")


@query("J3_overlapping_versions_join", _OVERLAP_SQL)
def overlap_hash(spark, sf):
    return _overlapping(spark, sf, "hash")


@query("J3_overlapping_versions_sweep", _OVERLAP_SQL)
def overlap_sweep(spark, sf):
    return _overlapping(spark, sf, "sweep")


_AS_OF_SQL = B.with_ctes(B.CASES, B.DIM_SERVICE, body=f"""
SELECT ho_so_id, d.thoi_han_tra_kq AS sla FROM cases c LEFT JOIN dim_dich_vu_cong d
  ON c.dv_cong_id = d.dv_cong_id AND {B.as_of('d', 'c.created_at')}""")


@query("J3_scd2_as_of_join", _AS_OF_SQL)
def as_of_hash(spark, sf):
    return joins.join_scd2_as_of(
        B.cases(spark, sf), B.dim_service(spark, sf), "dv_cong_id", "dv_cong_id",
        F.col("created_at"), "dim_dich_vu_cong_sk", [("thoi_han_tra_kq", "sla")]
    ).select("ho_so_id", "sla")


@query("J3_scd2_as_of_sweep", _AS_OF_SQL)
def as_of_sweep(spark, sf):
    """The way a dimension beyond the broadcast bound is joined."""
    return joins.join_scd2_as_of(
        B.cases(spark, sf), B.dim_service(spark, sf), "dv_cong_id", "dv_cong_id",
        F.col("created_at"), "dim_dich_vu_cong_sk", [("thoi_han_tra_kq", "sla")],
        strategy="sweep").select("ho_so_id", "sla")


@query("J4_calendar_lookup", B.with_ctes(B.CALENDAR, body="""
SELECT o_orderkey, stt_ngay_lam_viec AS created_seq FROM orders
LEFT JOIN cal ON ngay_date = CAST(o_orderdate AS DATE)"""))
def calendar_lookup(spark, sf):
    return cal_ops.with_workday(B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
                                B.case_calendar(spark), "o_orderdate", "created_seq"
                                ).select("o_orderkey", "created_seq")


@query("J5_cutoff_number", B.with_ctes(B.CALENDAR, body=f"""
SELECT o_orderkey, (SELECT stt_ngay_lam_viec FROM cal WHERE ngay_date = DATE '{B.DAY}') AS day_seq
FROM orders"""))
def cutoff_number(spark, sf):
    """The number of the snapshot day, as a literal instead of a one-row join."""
    number = cal_ops.workday_number(B.case_calendar(spark), B.DAY)
    return B.table(spark, sf, "orders").select("o_orderkey", F.lit(number).alias("day_seq"))


@query("J6_left_join_latest_state", B.with_ctes(B.CASES, B.HISTORY, body="""
SELECT c.ho_so_id, h.trang_thai_id AS state FROM cases c LEFT JOIN (
  SELECT ho_so_id, trang_thai_id FROM history
  QUALIFY row_number() OVER (PARTITION BY ho_so_id ORDER BY action_time DESC, history_id DESC) = 1) h
  ON c.ho_so_id = h.ho_so_id"""))
def latest_state(spark, sf):
    state = ranking.latest(B.history(spark, sf), "ho_so_id", ["action_time", "history_id"]).select(
        "ho_so_id", F.col("trang_thai_id").alias("state"))
    return B.cases(spark, sf).select("ho_so_id").join(state, "ho_so_id", "left")


@query("J7_events_to_cases", B.with_ctes(B.CASES, B.HISTORY, body="""
SELECT co_quan_id, count(*) AS events FROM history h JOIN cases c ON h.ho_so_id = c.ho_so_id
GROUP BY co_quan_id"""))
def events_to_cases(spark, sf):
    """Events are counted per case before the join, so a busy case is one row in it."""
    counted = B.history(spark, sf).groupBy("ho_so_id").agg(F.count(F.lit(1)).alias("n"))
    return (counted.join(B.cases(spark, sf).select("ho_so_id", "co_quan_id"), "ho_so_id")
            .groupBy("co_quan_id").agg(F.sum("n").alias("events")))


@query("J8_dense_assembly", """
SELECT n_nationkey AS co_quan_id, CAST(coalesce(customers, 0) AS BIGINT) AS customers,
       CAST(coalesce(suppliers, 0) AS BIGINT) AS suppliers
FROM nation
LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer WHERE c_nationkey < 20 GROUP BY 1)
  ON n_nationkey = c_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1)
  ON n_nationkey = s_nationkey""")
def dense(spark, sf):
    def per_nation(name, column, alias):
        return (B.table(spark, sf, name).groupBy(F.col(column).alias("co_quan_id"))
                .agg(F.count(F.lit(1)).alias(alias)))
    return joins.assemble_dense(
        B.agencies(spark, sf), per_nation("customer", "c_nationkey", "customers")
        .where("co_quan_id < 20"), per_nation("supplier", "s_nationkey", "suppliers"),
        key="co_quan_id")


@query("J9_null_safe_anti_join", """
WITH a AS (SELECT event_id, CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id END AS k FROM events),
     b AS (SELECT DISTINCT CASE WHEN user_id % 8 = 0 THEN NULL ELSE user_id END AS k FROM events
           WHERE user_id % 3 <> 1)
SELECT event_id FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.k IS NOT DISTINCT FROM b.k)""")
def null_safe(spark, sf):
    base = events(spark, sf)
    left = base.select("event_id", F.when(F.col("user_id") % 4 != 0, F.col("user_id")).alias("k"))
    right = base.where("user_id % 3 <> 1").select(
        F.when(F.col("user_id") % 8 != 0, F.col("user_id")).alias("k")).dropDuplicates()
    return keys.anti_join(left, right, "k").select("event_id")


@query("J15_join_on_version_key", B.with_ctes(B.CASES, B.DIM_SERVICE, body=f"""
SELECT d.thoi_han_tra_kq AS sla, d.is_current, count(*) AS cases FROM cases c JOIN dim_dich_vu_cong d
  ON c.dv_cong_id = d.dv_cong_id AND {B.as_of('d', 'c.created_at')} GROUP BY 1, 2"""))
def version_key(spark, sf):
    service = B.dim_service(spark, sf)
    keyed = joins.join_scd2_as_of(B.cases(spark, sf), service, "dv_cong_id", "dv_cong_id",
                                  F.col("created_at"), "dim_dich_vu_cong_sk")
    counted = keyed.groupBy("dim_dich_vu_cong_sk").agg(F.count(F.lit(1)).alias("n"))
    return (joins.lookup(counted, service, "dim_dich_vu_cong_sk",
                         {"thoi_han_tra_kq": "sla", "is_current": "is_current"}, "inner")
            .groupBy("sla", "is_current").agg(F.sum("n").alias("cases")))


# --- aggregates -----------------------------------------------------------------------

@query("A7_distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct(spark, sf):
    return keys.distinct_rows(events(spark, sf).select("user_id", "event_type"))


@query("A8_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicates(spark, sf):
    return keys.duplicate_keys(B.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("A9_high_water_mark", B.with_ctes(B.CALENDAR, body="""
SELECT CAST(max(ngay_date) AS VARCHAR) AS max_day, max(stt_ngay_lam_viec) AS max_index
FROM cal WHERE ngay_date <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"""))
def high_water(spark, sf):
    last = B.table(spark, sf, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]
    return B.case_calendar(spark).where(F.col("ngay_date") <= F.lit(last)).agg(
        F.max("ngay_date").alias("max_day"), F.max("stt_ngay_lam_viec").alias("max_index"))


@query("A10_existence", """
SELECT (SELECT count(*) FROM events) = 0 AS events_empty,
       (SELECT count(*) FROM events WHERE value < -1) = 0 AS negative_empty""")
def existence(spark, sf):
    source = events(spark, sf)
    return keys.literal_rows(spark, [(source.isEmpty(), source.where("value < -1").isEmpty())],
                             "events_empty boolean, negative_empty boolean")


@query("A13_mean_by_dimension", """
SELECT event_type, avg(event_id % 100) AS mean_value FROM events GROUP BY event_type""")
def mean_by(spark, sf):
    return events(spark, sf).groupBy("event_type").agg(
        F.avg(F.col("event_id") % 100).alias("mean_value"))


# --- windows, sort and limit ----------------------------------------------------------

@query("W1_latest_per_key", f"""
SELECT {EVENT_COLUMNS} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""")
def latest(spark, sf):
    return ranking.latest(events(spark, sf).select(*EVENT_COLUMNS.split(", ")), "user_id",
                          ["ts", "event_id"])


@query("W2_latest_as_of", B.with_ctes(B.HISTORY, body="""
SELECT ho_so_id, trang_thai_id, can_bo_id, action_time FROM history
WHERE action_time < TIMESTAMP '1998-01-16'
QUALIFY row_number() OVER (PARTITION BY ho_so_id ORDER BY action_time DESC, history_id DESC) = 1"""))
def latest_as_of(spark, sf):
    return ranking.latest_as_of(B.history(spark, sf), "ho_so_id", "action_time", B.DAY,
                                "history_id").select("ho_so_id", "trang_thai_id", "can_bo_id",
                                                     "action_time")


@query("W3_latest_snapshot", """
SELECT c_custkey, c_acctbal, 'S14' AS snapshot_id, TIMESTAMP '2024-01-15' AS ingested_at FROM customer""")
def latest_snapshot(spark, sf):
    return ranking.latest_snapshot(bronze_snapshots(spark, sf), "ingested_at")


_FILL_SQL = f"""WITH {SPARSE}
SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER w AS value,
       last_value(label IGNORE NULLS) OVER w AS label FROM sparse
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


@query("W4_forward_fill", _FILL_SQL)
def forward_fill(spark, sf):
    return ranking.forward_fill(sparse_events(spark, sf), "user_id", ["ts", "event_id"],
                                ["value", "label"]).select("event_id", "user_id", "value", "label")


@query("W4_forward_fill_one_hot_key", f"""WITH {SPARSE}
SELECT event_id, last_value(value IGNORE NULLS) OVER w AS value FROM sparse
WINDOW w AS (PARTITION BY user_id % 2 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def forward_fill_hot(spark, sf):
    """Two keys share all rows; both are cut into chunks that are filled in parallel."""
    coarse = sparse_events(spark, sf).withColumn("half", F.col("user_id") % 2)
    return ranking.forward_fill(coarse, "half", ["ts", "event_id"], ["value"], min_rows=1000,
                                splits=32).select("event_id", "value")


@query("W4_latest_filled", f"""WITH {SPARSE}, filled AS (
  SELECT user_id, event_type, last_value(value IGNORE NULLS) OVER w AS value,
         last_value(label IGNORE NULLS) OVER w AS label,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM sparse
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id, event_type, value, label FROM filled WHERE rn = 1""")
def latest_filled(spark, sf):
    return ranking.latest_filled(sparse_events(spark, sf), "user_id", ["ts", "event_id"],
                                 ["value", "label"], ["event_type"])


@query("W5_running_workdays", B.with_ctes(B.CALENDAR, body="""
SELECT nam, thang, max(stt_ngay_lam_viec) - min(stt_ngay_lam_viec) AS span,
       count(*) FILTER (WHERE NOT co_phai_la_ngay_nghi) AS working_days,
       (SELECT count(*) FROM orders WHERE year(o_orderdate) = nam AND month(o_orderdate) = thang) AS cases
FROM cal GROUP BY nam, thang"""))
def running(spark, sf):
    months = B.case_calendar(spark).groupBy("nam", "thang").agg(
        (F.max("stt_ngay_lam_viec") - F.min("stt_ngay_lam_viec")).alias("span"),
        F.count_if(~F.col("co_phai_la_ngay_nghi")).alias("working_days"))
    cases = (B.table(spark, sf, "orders")
             .groupBy(F.year("o_orderdate").alias("nam"), F.month("o_orderdate").alias("thang"))
             .agg(F.count(F.lit(1)).alias("cases")))
    return months.join(cases, ["nam", "thang"], "left").fillna(0, ["cases"])


@query("W6_primary_role", """
SELECT l_suppkey AS Officerid, min(l_linenumber) AS Roleid FROM lineitem GROUP BY l_suppkey""")
def primary_role(spark, sf):
    links = B.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("Officerid"),
                                                  F.col("l_linenumber").alias("Roleid"))
    return dim_plans.primary_role(links)


@query("O2_limit_sample", "SELECT CAST(least(10, count(*)) AS BIGINT) AS rows_shown FROM events")
def sample(spark, sf):
    return quality.sample_rows(events(spark, sf)).agg(F.count(F.lit(1)).alias("rows_shown"))


# --- set operations -------------------------------------------------------------------

@query("U1_union_available", f"""WITH {PRICED}
SELECT event_id, amount, kind, source_priority FROM both_sources""")
def union(spark, sf):
    first, second = priced(spark, sf)
    return keys.union_available(first, None, second).select("event_id", "amount", "kind",
                                                            "source_priority")


@query("U1_union_then_latest", f"""WITH {PRICED}
SELECT event_id, amount, kind, source_priority FROM both_sources
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, source_priority DESC) = 1""")
def union_latest(spark, sf):
    merged = keys.union_available(*priced(spark, sf))
    return ranking.latest(merged, "event_id", ["ts", "source_priority"]).select(
        "event_id", "amount", "kind", "source_priority")


@query("U3_unknown_member", """
SELECT CAST(s_suppkey AS INTEGER) AS can_bo_id, s_name AS ten FROM supplier
UNION ALL SELECT -1, 'Khong xac dinh'""")
def unknown(spark, sf):
    real = B.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("can_bo_id"),
                                                 F.col("s_name").alias("ten"))
    return keys.with_unknown_member(real, can_bo_id=-1, ten="Khong xac dinh")


@query("A12_U4_recon_counts", """
SELECT 'cases' AS dataset, count(*) AS row_count FROM orders
UNION ALL SELECT 'history', count(*) FROM lineitem UNION ALL SELECT 'payment', count(*) FROM events""")
def counts(spark, sf):
    return quality.recon_counts({"cases": B.table(spark, sf, "orders"),
                                 "history": B.table(spark, sf, "lineitem"),
                                 "payment": events(spark, sf)})


# --- scalar functions -----------------------------------------------------------------

@query("scalar_functions", """
SELECT event_id, upper(event_type) AS up, trim('  ' || event_type || ' ') AS trimmed,
       CAST(NULLIF(event_id % 3, 0) AS BIGINT) AS nullif_zero,
       greatest(event_id % 5, CASE WHEN event_id % 2 = 0 THEN 3 END) AS greatest_skips_null,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(CASE WHEN event_id % 2 = 0 THEN event_type ELSE '7' END AS INTEGER) AS tolerant_int,
       CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS thoi_gian_id,
       make_timestamp(event_id * 1000003) AS micros,
       make_timestamp(event_id * 1003 * 1000) AS millis,
       CASE WHEN event_id % 4 <> 0 THEN (event_id * 1000003) // 1000000 END AS elapsed
FROM events""")
def scalars(spark, sf):
    even = F.col("event_id") % 2 == 0
    start = F.when(F.col("event_id") % 4 != 0, F.timestamp_micros(F.lit(0)))
    return events(spark, sf).select(
        "event_id", F.upper("event_type").alias("up"),
        F.trim(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("trimmed"),
        F.nullif(F.col("event_id") % 3, F.lit(0)).alias("nullif_zero"),
        F.greatest(F.col("event_id") % 5, F.when(even, F.lit(3).cast("long")))
        .alias("greatest_skips_null"),
        C.to_int(F.get_json_object("props", "$.k")).alias("k"),
        C.to_int(F.when(even, F.col("event_type")).otherwise("7")).alias("tolerant_int"),
        C.day_key("ts").alias("thoi_gian_id"),
        C.from_micros(F.col("event_id") * 1000003).alias("micros"),
        C.from_millis(F.col("event_id") * 1003).alias("millis"),
        C.elapsed_seconds(start, C.from_micros(F.col("event_id") * 1000003)).alias("elapsed"))
