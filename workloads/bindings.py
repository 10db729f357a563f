"""The given tables in the roles the operators need, once for Spark and once in SQL.

Orders are cases, line items their status history, nations the agencies, suppliers the
officers, order priorities the services with their SLA, events the change and payment
streams.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caseledger.operators.calendar import calendar
from caseledger.operators.keys import literal_rows, with_unknown_member
from caseledger.operators.scd2 import scd2_apply
from caseledger.plans.dims import AGENCY, OFFICER, SERVICE, STATUS, UNKNOWN_OFFICER
from caseledger.session import scratch_path

DAY = date(1998, 1, 15)
FIRST, LAST = date(1998, 1, 10), date(1998, 1, 16)
CALENDAR_FROM, CALENDAR_TO = date(1995, 1, 1), date(2001, 12, 31)
BASELINE = "1990-01-01 00:00:00"
CHANGE_AT = datetime(1998, 1, 12, 9, 30)
SLA_CHANGE_AT = datetime(1997, 7, 1)
# Moves the events of January 2024 to January 1998.
EVENT_SHIFT_DAYS = 9496
MATCH_SECONDS = 60


_SCHEMAS: dict[str, StructType] = {}
_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[path]).parquet(path)
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name)
                       if f.dataType.typeName().startswith("timestamp") else f.name
                       for f in df.schema.fields])


def stored(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A dimension as the stored table it is in production: written once per application
    under the shared folder, then scanned."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        df = build(spark, sf)
        path = scratch_path(spark, name)
        df.write.parquet(path)
        _STORED[key] = (path, df.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def days(column):
    return F.make_dt_interval(column.cast("int"))


def seconds(column):
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), column.cast("decimal(18,6)"))


def new_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A fresh table name and a location in the shared folder."""
    location = scratch_path(spark, name)
    return f"{name}_{location.rsplit('-', 1)[-1]}", location


# --- cases and their events -------------------------------------------------------

def cases(spark, sf) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    status = (F.when(F.col("o_orderstatus") == "O", 3).when(F.col("o_orderstatus") == "P", 5)
              .otherwise(7))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("ho_so_id"),
        F.concat(F.lit("Case "), F.col("o_orderkey")).alias("ten_ho_so"),
        F.col("o_custkey").cast("string").alias("applicant_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("dv_cong_id"),
        F.col("c_nationkey").alias("co_quan_id"), F.col("o_orderdate").alias("created_at"),
        status.alias("trang_thai_id"),
        (F.col("o_orderdate") + days(F.col("o_orderkey") % 97)).alias("event_time"),
        (F.col("o_orderkey") % 13 == 0).alias("da_bi_xoa"))


CASES = """cases AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ho_so_id, 'Case ' || o_orderkey AS ten_ho_so,
         CAST(o_custkey AS VARCHAR) AS applicant_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS dv_cong_id,
         c_nationkey AS co_quan_id, o_orderdate AS created_at,
         CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'P' THEN 5 ELSE 7 END AS trang_thai_id,
         o_orderdate + to_days(CAST(o_orderkey % 97 AS INTEGER)) AS event_time,
         o_orderkey % 13 = 0 AS da_bi_xoa
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


def history(spark, sf) -> DataFrame:
    line = table(spark, sf, "lineitem")
    return line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .alias("history_id"),
        F.col("l_orderkey").cast("string").alias("ho_so_id"),
        F.col("l_linenumber").alias("trang_thai_truoc_id"),
        (F.col("l_linenumber") + 1).alias("trang_thai_id"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(-1)).otherwise(F.col("l_suppkey").cast("int"))
        .alias("can_bo_id"),
        (F.col("l_shipdate") + seconds(F.col("l_partkey") * 977 % 86400)).alias("action_time"))


HISTORY = """history AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS history_id,
         CAST(l_orderkey AS VARCHAR) AS ho_so_id, l_linenumber AS trang_thai_truoc_id,
         l_linenumber + 1 AS trang_thai_id,
         CASE WHEN l_suppkey % 10 = 0 THEN -1 ELSE CAST(l_suppkey AS INTEGER) END AS can_bo_id,
         l_shipdate + to_seconds(l_partkey * 977 % 86400) AS action_time
  FROM lineitem)"""


def payments(spark, sf) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select(
        F.concat(F.lit("TX_"), F.col("event_id")).alias("ma_giao_dich"),
        F.col("event_id").cast("string").alias("ho_so_id"),
        F.floor(F.col("value") * 100).cast("double").alias("so_tien"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success")
        .alias("trang_thai_tt"),
        (F.col("ts") - days(F.lit(EVENT_SHIFT_DAYS))).alias("thoi_gian_tt"))


PAYMENTS = f"""payments AS (
  SELECT 'TX_' || event_id AS ma_giao_dich, CAST(event_id AS VARCHAR) AS ho_so_id,
         CAST(floor(value * 100) AS DOUBLE) AS so_tien,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS trang_thai_tt,
         ts - to_days({EVENT_SHIFT_DAYS}) AS thoi_gian_tt
  FROM events)"""


# --- calendar ---------------------------------------------------------------------

def case_calendar(spark) -> DataFrame:
    return calendar(spark, CALENDAR_FROM, CALENDAR_TO)


CALENDAR = f"""calendar_days AS (
  SELECT CAST(d AS DATE) AS ngay_date,
         dayofweek(d) IN (0, 6) OR strftime(d, '%m-%d') IN ('01-01', '04-30', '05-01', '09-02')
           AS off
  FROM generate_series(TIMESTAMP '{CALENDAR_FROM}', TIMESTAMP '{CALENDAR_TO}', INTERVAL 1 DAY) t(d)),
cal AS (
  SELECT CAST(strftime(ngay_date, '%Y%m%d') AS INTEGER) AS thoi_gian_id, ngay_date,
         CAST(day(ngay_date) AS INTEGER) AS ngay, CAST(month(ngay_date) AS INTEGER) AS thang,
         CAST(quarter(ngay_date) AS INTEGER) AS quy, CAST(year(ngay_date) AS INTEGER) AS nam,
         off AS co_phai_la_ngay_nghi,
         CAST(sum(CASE WHEN off THEN 0 ELSE 1 END) OVER (ORDER BY ngay_date) AS INTEGER)
           AS stt_ngay_lam_viec
  FROM calendar_days)"""


# --- dimensions -------------------------------------------------------------------

def _stamp(df: DataFrame, at: datetime, snapshot: str) -> DataFrame:
    return df.withColumns({"source_snapshot_at": F.lit(at).cast("timestamp"),
                           "source_snapshot_id": F.lit(snapshot)})


def _two_versions(first: DataFrame, second: DataFrame, spec, at: datetime) -> DataFrame:
    """Load one snapshot, then apply a second one with changes taken at ``at``."""
    loaded = scd2_apply(None, _stamp(first, datetime(1990, 1, 1), "s1"), spec.key, spec.tracked,
                        spec.sk, BASELINE, check=False)
    return scd2_apply(loaded, _stamp(second, at, "s2"), spec.key, spec.tracked, spec.sk,
                      closed_at=F.lit(at).cast("timestamp"), check=False)


def agencies(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("co_quan_id"))


def build_agency(spark, sf) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    base = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("co_quan_id"), F.col("n_name").alias("ten"),
        F.col("r_name").alias("tinh"), F.lit(None).cast("string").alias("phuong"))
    renamed = base.withColumn("ten", F.when(F.col("co_quan_id") % 7 == 1,
                                            F.concat("ten", F.lit(" (new)"))).otherwise(F.col("ten")))
    return _two_versions(base, renamed, AGENCY, CHANGE_AT)


def _versions_sql(name, key, columns, changed, rows, at):
    """Two-snapshot history in SQL: unchanged keys keep one version, changed ones get two."""
    keep = ", ".join(c for c, _ in columns)
    new = ", ".join(f"{n} AS {c}" for c, n in columns)
    return f"""{name} AS (
  SELECT {key}, {keep}, TIMESTAMP '{BASELINE}' AS effective_from_ts,
         CASE WHEN {changed} THEN TIMESTAMP '{at}' END AS effective_to_ts,
         NOT ({changed}) AS is_current, 's1' AS source_snapshot_id FROM {rows}
  UNION ALL
  SELECT {key}, {new}, TIMESTAMP '{at}', NULL, TRUE, 's2' FROM {rows} WHERE {changed})"""


DIM_AGENCY = f"""agency_rows AS (
  SELECT n_nationkey AS co_quan_id, n_name AS ten, r_name AS tinh, CAST(NULL AS VARCHAR) AS phuong
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
{_versions_sql('dim_co_quan', 'co_quan_id',
               [('ten', "ten || ' (new)'"), ('tinh', 'tinh'), ('phuong', 'phuong')],
               'co_quan_id % 7 = 1', 'agency_rows', CHANGE_AT)}"""

STATUS_ROWS = [(1, "RECEIVED"), (2, "ASSIGNED"), (3, "PROCESSING"), (4, "PENDING_APPROVAL"),
               (5, "APPROVED"), (6, "READY"), (7, "COMPLETED"), (8, "REJECTED")]


def build_status(spark, sf) -> DataFrame:
    rows = literal_rows(spark, [(i, c, c.title()) for i, c in STATUS_ROWS],
                        "trang_thai_id int, ma_trang_thai string, ten_trang_thai string")
    return scd2_apply(None, _stamp(rows, datetime(1990, 1, 1), "s1"), STATUS.key, STATUS.tracked,
                      STATUS.sk, BASELINE, check=False)


DIM_STATUS = "dim_trang_thai AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{c}')" for i, c in STATUS_ROWS) + ") t(trang_thai_id, ma_trang_thai))"


def build_officer(spark, sf) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    real = supplier.select(F.col("s_suppkey").cast("int").alias("can_bo_id"),
                           F.col("s_name").alias("ten"),
                           F.concat(F.lit("Role "), F.col("s_nationkey") % 3).alias("vi_tri"))
    unknown = {k: v for k, v in UNKNOWN_OFFICER.items() if k != "source_snapshot_id"}
    first = with_unknown_member(real, **unknown)
    moved = first.withColumn("vi_tri", F.when(F.col("can_bo_id") % 7 == 2, F.lit("Role 9"))
                             .otherwise(F.col("vi_tri")))
    return _two_versions(first, moved, OFFICER, CHANGE_AT)


DIM_OFFICER = f"""officer_rows AS (
  SELECT CAST(s_suppkey AS INTEGER) AS can_bo_id, s_name AS ten,
         'Role ' || (s_nationkey % 3) AS vi_tri FROM supplier
  UNION ALL SELECT -1, 'Khong xac dinh', 'N/A'),
{_versions_sql('dim_can_bo', 'can_bo_id', [('ten', 'ten'), ('vi_tri', "'Role 9'")],
               'can_bo_id % 7 = 2', 'officer_rows', CHANGE_AT)}"""


def build_service(spark, sf) -> DataFrame:
    base = (table(spark, sf, "orders")
            .select(F.substring("o_orderpriority", 1, 1).cast("int").alias("dv_cong_id"),
                    F.substring("o_orderpriority", 3, 20).alias("ten"))
            .dropDuplicates()
            .withColumn("thoi_han_tra_kq", F.col("dv_cong_id")))
    longer = base.withColumn("thoi_han_tra_kq", F.when(
        F.col("dv_cong_id") % 2 == 1, F.col("dv_cong_id") + 2).otherwise(F.col("dv_cong_id")))
    return _two_versions(base, longer, SERVICE, SLA_CHANGE_AT)


DIM_SERVICE = f"""service_rows AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS dv_cong_id,
         substr(o_orderpriority, 3) AS ten,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS thoi_han_tra_kq FROM orders),
{_versions_sql('dim_dich_vu_cong', 'dv_cong_id',
               [('ten', 'ten'), ('thoi_han_tra_kq', 'thoi_han_tra_kq + 2')],
               'dv_cong_id % 2 = 1', 'service_rows', SLA_CHANGE_AT)}"""


def dims(spark, sf) -> dict[str, DataFrame]:
    return {AGENCY.table: dim_agency(spark, sf), STATUS.table: dim_status(spark, sf),
            OFFICER.table: dim_officer(spark, sf), SERVICE.table: dim_service(spark, sf)}


def dim_agency(spark, sf) -> DataFrame:
    return stored(spark, sf, AGENCY.table, build_agency)


def dim_status(spark, sf) -> DataFrame:
    return stored(spark, sf, STATUS.table, build_status)


def dim_officer(spark, sf) -> DataFrame:
    return stored(spark, sf, OFFICER.table, build_officer)


def dim_service(spark, sf) -> DataFrame:
    return stored(spark, sf, SERVICE.table, build_service)


def as_of(alias: str, instant: str) -> str:
    return (f"{instant} >= {alias}.effective_from_ts AND "
            f"({alias}.effective_to_ts IS NULL OR {instant} < {alias}.effective_to_ts)")


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body
