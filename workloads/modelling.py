"""Silver entities, versioned dimensions, facts, indicators and checks."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import functions as F

from caseledger.functions import columns as C
from caseledger.operators import calendar as cal_ops
from caseledger.operators import joins, keys, quality, scd2
from caseledger.plans import dims as dim_plans
from caseledger.plans import gold, kpi, silver
from caseledger.session import materialize
from caseledger.sources import tables
from workloads import bindings as B
from workloads.registry import query

DAY_END = "TIMESTAMP '1998-01-16'"
LAST_INSTANT = "TIMESTAMP '1998-01-15 23:59:59.999999'"


# --- calendar and dimensions ------------------------------------------------------------

@query("C11_calendar", B.with_ctes(B.CALENDAR, body="""
SELECT thoi_gian_id, CAST(ngay_date AS VARCHAR) AS ngay_date, ngay, thang, quy, nam,
       co_phai_la_ngay_nghi, stt_ngay_lam_viec FROM cal
WHERE ngay_date BETWEEN (SELECT CAST(min(o_orderdate) AS DATE) FROM orders)
                    AND (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"""))
def calendar(spark, sf):
    """The calendar over the days on which cases were created."""
    span = B.table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"),
                                            F.to_date(F.max("o_orderdate")).alias("b")).first()
    return B.case_calendar(spark).where(F.col("ngay_date").between(F.lit(span["a"]), F.lit(span["b"])))


@query("C11_calendar_extended", B.with_ctes(B.CALENDAR, body="""
SELECT thoi_gian_id, stt_ngay_lam_viec,
       (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = ngay_date) AS cases
FROM cal WHERE ngay_date <= DATE '1999-03-08'"""))
def calendar_extended(spark, sf):
    """A stored calendar up to the end of 1998, extended after its high-water mark."""
    stored = cal_ops.calendar(spark, B.CALENDAR_FROM, date(1998, 12, 31))
    added = cal_ops.extend_calendar(spark, stored, today=date(1999, 3, 1))
    per_day = (B.table(spark, sf, "orders").groupBy(C.day_key("o_orderdate").alias("thoi_gian_id"))
               .agg(F.count(F.lit(1)).alias("cases")))
    return (stored.unionByName(added).select("thoi_gian_id", "stt_ngay_lam_viec")
            .join(per_day, "thoi_gian_id", "left").fillna(0, ["cases"]))


@query("C12_workdays_between", B.with_ctes(B.CALENDAR, body="""
SELECT l_orderkey, l_linenumber, l_shipdate, CAST(greatest(b.stt_ngay_lam_viec - a.stt_ngay_lam_viec, 0) AS INTEGER)
         AS working_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN cal a ON a.ngay_date = CAST(o_orderdate AS DATE)
LEFT JOIN cal b ON b.ngay_date = CAST(l_shipdate AS DATE)"""))
def workdays(spark, sf):
    pairs = B.table(spark, sf, "lineitem").join(
        B.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return cal_ops.workdays_between(
        pairs.select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate"),
        B.case_calendar(spark), "o_orderdate", "l_shipdate").drop("o_orderdate")


@query("C14_dim_agency", """
SELECT CAST(c_custkey AS INTEGER) AS co_quan_id, c_name AS ten, r_name AS tinh, n_name AS phuong
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = c_custkey % 7""")
def dim_agency(spark, sf):
    def master(name, columns, at):
        return B._stamp(B.table(spark, sf, name).select(*columns), at, "s1")
    agency = master("customer", [F.col("c_custkey").cast("int").alias("id"),
                                 F.col("c_name").alias("name"),
                                 (F.col("c_custkey") % 7).cast("int").alias("Provinceid"),
                                 F.col("c_nationkey").alias("Wardid")], datetime(2024, 1, 1))
    province = master("region", [F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")],
                      datetime(2024, 1, 3))
    ward = master("nation", [F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")],
                  datetime(2024, 1, 2))
    return dim_plans.agency_snapshot(agency, province, ward).select("co_quan_id", "ten", "tinh",
                                                                    "phuong")


@query("C14_dim_officer", """
SELECT CAST(s_suppkey AS INTEGER) AS can_bo_id, s_name AS ten,
       coalesce(n_name, 'Chua xac dinh vai tro') AS vi_tri
FROM supplier LEFT JOIN (SELECT l_suppkey, min(l_linenumber) AS r FROM lineitem
                         WHERE l_suppkey % 4 <> 0 GROUP BY 1) ON l_suppkey = s_suppkey
LEFT JOIN nation ON n_nationkey = r
UNION ALL SELECT -1, 'Khong xac dinh', 'N/A'""")
def dim_officer(spark, sf):
    at = datetime(2024, 1, 1)
    officer = B._stamp(B.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name")), at, "s1")
    links = B._stamp(B.table(spark, sf, "lineitem").where("l_suppkey % 4 <> 0").select(
        F.col("l_suppkey").cast("int").alias("Officerid"), F.col("l_linenumber").alias("Roleid")),
        at, "s1")
    role = B._stamp(B.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), at, "s1")
    return dim_plans.officer_snapshot(officer, links, role).select("can_bo_id", "ten", "vi_tri")


@query("C14_dim_status_service", f"""
WITH {B.DIM_STATUS}
SELECT 'status' AS dim, trang_thai_id AS id, ma_trang_thai AS label FROM dim_trang_thai
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_linenumber + 1 = trang_thai_id)
UNION ALL SELECT DISTINCT 'service', CAST(substr(o_orderpriority, 1, 1) AS INTEGER),
       substr(o_orderpriority, 3) FROM orders""")
def dim_status_service(spark, sf):
    used = B.history(spark, sf).select(F.col("trang_thai_id").alias("id")).dropDuplicates()
    at = datetime(2024, 1, 1)
    status = B._stamp(keys.literal_rows(spark, [(i, c, c.title()) for i, c in B.STATUS_ROWS],
                                        "id int, code string, name string")
                      .join(used, "id", "left_semi"), at, "s1")
    service = B._stamp(B.table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("id"),
        F.substring("o_orderpriority", 3, 20).alias("name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("processing_time"))
        .dropDuplicates(), at, "s1")
    return dim_plans.status_snapshot(status).select(
        F.lit("status").alias("dim"), F.col("trang_thai_id").alias("id"),
        F.col("ma_trang_thai").alias("label")).unionByName(
        dim_plans.service_snapshot(service).select(
            F.lit("service").alias("dim"), F.col("dv_cong_id").alias("id"),
            F.col("ten").alias("label")))


def customer_snapshot(spark, sf, n):
    """Snapshot n: a part of the keys is missing, a part has another segment."""
    base = B.table(spark, sf, "customer").where(F.col("c_custkey") % 11 != n)
    segment = F.when(F.col("c_custkey") % 7 == n, F.concat("c_mktsegment", F.lit(f" {n}"))
                     ).when(F.col("c_custkey") % 13 == n, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return B._stamp(base.select(F.col("c_custkey").alias("key"), segment.alias("segment")),
                    datetime(2024, 1, n), f"s{n}")


def customer_versions(spark, sf):
    dim = None
    for n in (1, 2, 3):
        dim = scd2.scd2_apply(dim, customer_snapshot(spark, sf, n), "key", ["segment"], "sk",
                              "2023-01-01 00:00:00", closed_at=F.lit(datetime(2024, 1, n))
                              .cast("timestamp"), check=False)
    return dim


# An independent formulation: the value of each key in each snapshot, then runs of equal
# neighbours, instead of applying snapshots one by one.
CUSTOMER_VERSIONS = """grid AS (
  SELECT c_custkey AS key, n, c_custkey % 11 <> n AS present,
         CASE WHEN c_custkey % 7 = n THEN c_mktsegment || ' ' || n
              WHEN c_custkey % 13 = n THEN NULL ELSE c_mktsegment END AS segment
  FROM customer, generate_series(1, 3) t(n)),
shown AS (SELECT * FROM grid WHERE present),
marked AS (
  SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(segment) OVER w IS NOT DISTINCT FROM segment
                 THEN 0 ELSE 1 END AS opens
  FROM shown WINDOW w AS (PARTITION BY key ORDER BY n)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY key ORDER BY n) AS run FROM marked),
runs AS (SELECT key, run, any_value(segment) AS segment, min(n) AS a, max(n) AS b FROM numbered
         GROUP BY key, run),
versions AS (
  SELECT key, segment,
         CASE WHEN a = 1 THEN TIMESTAMP '2023-01-01' ELSE TIMESTAMP '2023-12-31' + to_days(CAST(a AS INTEGER)) END
           AS effective_from_ts,
         CASE WHEN b < 3 THEN TIMESTAMP '2024-01-01' + to_days(CAST(b AS INTEGER)) END AS effective_to_ts,
         b = 3 AS is_current, 's' || a AS source_snapshot_id FROM runs)"""


@query("C13_scd2_apply", f"WITH {CUSTOMER_VERSIONS} SELECT * FROM versions")
def scd2_apply(spark, sf):
    return customer_versions(spark, sf).drop("sk")


@query("Q3_one_current_version", f"""WITH {CUSTOMER_VERSIONS}, copies AS (
  SELECT * FROM versions UNION ALL SELECT * FROM versions WHERE key % 5 = 0)
SELECT key, count(*) AS current_versions FROM copies WHERE is_current GROUP BY key HAVING count(*) <> 1""")
def one_current(spark, sf):
    dim = materialize(customer_versions(spark, sf))
    return scd2.several_current(dim.unionByName(dim.where("key % 5 = 0")), "key")


@query("Q4_inverted_ranges", f"""WITH {CUSTOMER_VERSIONS}
SELECT key, effective_from_ts, TIMESTAMP '2022-01-01' AS effective_to_ts FROM versions
WHERE NOT is_current AND key % 3 = 0""")
def inverted(spark, sf):
    broken = customer_versions(spark, sf).withColumn(
        "effective_to_ts", F.when((F.col("key") % 3 == 0) & ~F.col("is_current"),
                                  F.lit(datetime(2022, 1, 1)).cast("timestamp"))
        .otherwise(F.col("effective_to_ts")))
    return scd2.inverted_ranges(broken, "key")


@query("Q8_overlapping_ranges", f"""WITH {CUSTOMER_VERSIONS}, open_ended AS (
  SELECT key, effective_from_ts, CASE WHEN key % 3 <> 0 THEN effective_to_ts END AS effective_to_ts
  FROM versions)
SELECT key, effective_from_ts, effective_to_ts, previous_to_ts FROM (
  SELECT *, lag(coalesce(effective_to_ts, TIMESTAMP '9999-12-31')) OVER (
    PARTITION BY key ORDER BY effective_from_ts) AS previous_to_ts FROM open_ended)
WHERE previous_to_ts > effective_from_ts""")
def overlapping(spark, sf):
    broken = customer_versions(spark, sf).withColumn(
        "effective_to_ts", F.when(F.col("key") % 3 != 0, F.col("effective_to_ts")))
    return scd2.overlapping_ranges(materialize(broken), "key")


# --- silver entities ------------------------------------------------------------------

@query("C5_master_latest", """
SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, 'S3' AS source_snapshot_id FROM customer""")
def master_latest(spark, sf):
    numbers = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n")
    bronze = (B.table(spark, sf, "customer").select("c_custkey", "c_name", numbers).select(
        F.col("c_custkey").cast("int").alias("id"),
        F.concat(F.lit(" "), "c_name").alias("name"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp") + B.days(F.col("n"))).alias("ingested_at"),
        F.lit("f").alias("file_name"), F.concat(F.lit("S"), "n").alias("snapshot_id")))
    doubled = bronze.unionByName(bronze.where("id % 10 = 0"))
    return silver.master_latest(doubled).select("id", "name", "source_snapshot_id")


def application_log(spark, sf):
    """Change events as two sources that overlap: partial updates, deletes, equal times."""
    events = B.table(spark, sf, "events")
    base = events.select(
        F.concat(F.lit("E"), F.col("event_id")).alias("event_id"),
        F.col("user_id").cast("string").alias("ho_so_id"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("name "), "event_id")).alias("ten_ho_so"),
        F.when(F.col("event_id") % 4 == 0, F.col("event_id").cast("string")).alias("applicant_id"),
        F.when(F.col("event_id") % 5 == 0, (F.col("event_id") % 7).cast("int")).alias("dv_cong_id"),
        F.when(F.col("event_id") % 6 == 0, (F.col("event_id") % 25).cast("int")).alias("co_quan_id"),
        F.when(F.col("event_id") % 7 == 0, F.col("ts")).alias("created_at"),
        F.when(F.col("event_type") != "view", (F.col("event_id") % 8).cast("int")).alias("trang_thai_id"),
        F.date_trunc("HOUR", "ts").alias("event_time"),
        (F.col("event_type") == "error").alias("da_bi_xoa"),
        (F.col("event_id") % 2 + 1).cast("int").alias("source_priority"))
    return base.unionByName(base.where("substring(event_id, -1) = '0'")).dropDuplicates(["event_id"])


APPLICATION_LOG = """log AS (
  SELECT 'E' || event_id AS event_id, CAST(user_id AS VARCHAR) AS ho_so_id,
         CASE WHEN event_id % 3 = 0 THEN 'name ' || event_id END AS ten_ho_so,
         CASE WHEN event_id % 4 = 0 THEN CAST(event_id AS VARCHAR) END AS applicant_id,
         CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 7 AS INTEGER) END AS dv_cong_id,
         CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 25 AS INTEGER) END AS co_quan_id,
         CASE WHEN event_id % 7 = 0 THEN ts END AS created_at,
         CASE WHEN event_type <> 'view' THEN CAST(event_id % 8 AS INTEGER) END AS trang_thai_id,
         date_trunc('hour', ts) AS event_time, event_type = 'error' AS da_bi_xoa,
         CAST(event_id % 2 + 1 AS INTEGER) AS source_priority FROM events),
timeline AS (
  SELECT event_id, ho_so_id, event_time, da_bi_xoa, source_priority,
         last_value(ten_ho_so IGNORE NULLS) OVER w AS ten_ho_so,
         last_value(applicant_id IGNORE NULLS) OVER w AS applicant_id,
         last_value(dv_cong_id IGNORE NULLS) OVER w AS dv_cong_id,
         last_value(co_quan_id IGNORE NULLS) OVER w AS co_quan_id,
         last_value(created_at IGNORE NULLS) OVER w AS created_at,
         last_value(trang_thai_id IGNORE NULLS) OVER w AS trang_thai_id
  FROM log WINDOW w AS (PARTITION BY ho_so_id ORDER BY event_time, source_priority, event_id
                        ROWS UNBOUNDED PRECEDING))"""


@query("C6_application_current", f"""WITH {APPLICATION_LOG}
SELECT ho_so_id, ten_ho_so, applicant_id, dv_cong_id, co_quan_id, created_at, trang_thai_id,
       event_time, da_bi_xoa FROM timeline
QUALIFY row_number() OVER (PARTITION BY ho_so_id
  ORDER BY event_time DESC, source_priority DESC, event_id DESC) = 1""")
def application_current(spark, sf):
    return silver.application_current(application_log(spark, sf))


@query("C6_application_timeline", f"""WITH {APPLICATION_LOG}
SELECT event_id, ho_so_id, ten_ho_so, dv_cong_id, co_quan_id, trang_thai_id, da_bi_xoa FROM timeline""")
def application_timeline(spark, sf):
    return silver.application_timeline(application_log(spark, sf)).select(
        "event_id", "ho_so_id", "ten_ho_so", "dv_cong_id", "co_quan_id", "trang_thai_id", "da_bi_xoa")


@query("C6_incremental_state", f"""WITH {APPLICATION_LOG}
SELECT ho_so_id, ten_ho_so, applicant_id, dv_cong_id, co_quan_id, created_at, trang_thai_id,
       event_time, da_bi_xoa FROM timeline
QUALIFY row_number() OVER (PARTITION BY ho_so_id
  ORDER BY event_time DESC, source_priority DESC, event_id DESC) = 1""")
def application_incremental(spark, sf):
    """The state kept up batch by batch over a log in buckets of the case, one batch twice."""
    log, log_at = B.new_table(spark, "application_event")
    state, state_at = B.new_table(spark, "application")
    events = materialize(application_log(spark, sf))
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for n in (2, 0, 1, 0):
        batch = events.where(part == n)
        tables.append_new_only(batch, log, "event_id", location=log_at, bucket_by="ho_so_id", buckets=16)
        changed = batch.select("ho_so_id").dropDuplicates()
        touched = tables.in_buckets(changed, log, "ho_so_id").join(changed, "ho_so_id", "left_semi")
        tables.upsert_current_state(silver.application_current(touched), state, "ho_so_id", buckets=8, location=state_at)
    return tables.fresh(spark, state).drop(tables.BUCKET)


@query("C10_applicant", """
SELECT CAST(user_id AS VARCHAR) AS id, 'N' || event_id AS name, sha256('m' || event_id) AS email,
       ts AS updated_at FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def applicant(spark, sf):
    rows = B.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("id"), F.concat(F.lit("N"), "event_id").alias("name"),
        F.concat(F.lit("m"), "event_id").alias("email"), F.lit("secret").alias("password"),
        F.col("ts").alias("updated_at"), F.col("ts").alias("ingested_at"))
    return silver.applicant(rows)


# --- facts ----------------------------------------------------------------------------

OPEN_CASES = f"""latest_state AS (
  SELECT ho_so_id, trang_thai_id, can_bo_id, action_time FROM history WHERE action_time < {DAY_END}
  QUALIFY row_number() OVER (PARTITION BY ho_so_id ORDER BY action_time DESC, history_id DESC) = 1),
backlog AS (
  SELECT c.ho_so_id, coalesce(s.trang_thai_id, 1) AS trang_thai_id, c.co_quan_id,
         coalesce(s.can_bo_id, -1) AS can_bo_id, c.dv_cong_id,
         CAST(greatest(k.stt_ngay_lam_viec - coalesce(a.stt_ngay_lam_viec, o.stt_ngay_lam_viec), 0) AS INTEGER)
           AS so_ngay_ton_dong_hien_tai,
         CAST(greatest(k.stt_ngay_lam_viec - o.stt_ngay_lam_viec, 0) AS INTEGER) AS tong_thoi_gian_da_xu_ly,
         1 AS so_luong, 19980115 AS thoi_gian_id, d.thoi_han_tra_kq AS sla
  FROM cases c LEFT JOIN latest_state s ON c.ho_so_id = s.ho_so_id
  LEFT JOIN cal o ON o.ngay_date = CAST(c.created_at AS DATE)
  LEFT JOIN cal a ON a.ngay_date = CAST(s.action_time AS DATE)
  LEFT JOIN dim_dich_vu_cong d ON d.dv_cong_id = c.dv_cong_id AND {B.as_of('d', 'c.created_at')}
  CROSS JOIN (SELECT stt_ngay_lam_viec FROM cal WHERE ngay_date = DATE '{B.DAY}') k
  WHERE c.created_at < {DAY_END} AND (NOT c.da_bi_xoa OR c.event_time >= {DAY_END})
    AND coalesce(s.trang_thai_id, 1) NOT IN (7, 8))"""
BACKLOG_SQL = (B.CASES, B.HISTORY, B.CALENDAR, B.DIM_SERVICE, OPEN_CASES)


def backlog_of_day(spark, sf):
    return gold.backlog(B.cases(spark, sf), B.history(spark, sf), B.dims(spark, sf),
                        B.case_calendar(spark), B.DAY)


@query("C15_backlog_snapshot", B.with_ctes(*BACKLOG_SQL, B.DIM_AGENCY, B.DIM_OFFICER, B.DIM_STATUS, body=f"""
SELECT b.ho_so_id, b.trang_thai_id, b.co_quan_id, b.can_bo_id, b.dv_cong_id,
       b.so_ngay_ton_dong_hien_tai, b.tong_thoi_gian_da_xu_ly, b.so_luong, b.thoi_gian_id, b.sla,
       a.ten AS agency, s.ma_trang_thai AS status, f.vi_tri AS role
FROM backlog b
LEFT JOIN dim_co_quan a ON a.co_quan_id = b.co_quan_id AND {B.as_of('a', LAST_INSTANT)}
LEFT JOIN dim_trang_thai s ON s.trang_thai_id = b.trang_thai_id
LEFT JOIN dim_can_bo f ON f.can_bo_id = b.can_bo_id AND {B.as_of('f', LAST_INSTANT)}"""))
def backlog_snapshot(spark, sf):
    """The fact, with each version key resolved to an attribute of its version."""
    dims = B.dims(spark, sf)
    fact = gold.backlog(B.cases(spark, sf), B.history(spark, sf), dims, B.case_calendar(spark), B.DAY)
    for spec, attribute, alias in ((dim_plans.SERVICE, "thoi_han_tra_kq", "sla"),
                                   (dim_plans.AGENCY, "ten", "agency"),
                                   (dim_plans.STATUS, "ma_trang_thai", "status"),
                                   (dim_plans.OFFICER, "vi_tri", "role")):
        fact = joins.lookup(fact, dims[spec.table], spec.sk, {attribute: alias}).drop(spec.sk)
    return fact.drop("id")


RANGE_SQL = B.with_ctes(B.CASES, B.HISTORY, B.CALENDAR, body=f"""
, wanted AS (SELECT * FROM cal WHERE ngay_date BETWEEN DATE '{B.FIRST}' AND DATE '{B.LAST}'),
states AS (
  SELECT w.ngay_date, h.ho_so_id, h.trang_thai_id, h.can_bo_id, h.action_time
  FROM wanted w JOIN history h ON h.action_time < w.ngay_date + INTERVAL 1 DAY
  QUALIFY row_number() OVER (PARTITION BY w.ngay_date, h.ho_so_id
                             ORDER BY h.action_time DESC, h.history_id DESC) = 1)
""".lstrip("\n"))


def _range_sql(select: str) -> str:
    head, tail = RANGE_SQL.rsplit("\n, wanted", 1)
    return head + ",\nwanted" + tail + select


@query("C17_backlog_range", _range_sql("""
SELECT w.thoi_gian_id, c.ho_so_id, coalesce(s.trang_thai_id, 1) AS trang_thai_id,
       coalesce(s.can_bo_id, -1) AS can_bo_id,
       CAST(greatest(w.stt_ngay_lam_viec - coalesce(a.stt_ngay_lam_viec, o.stt_ngay_lam_viec), 0) AS INTEGER)
         AS so_ngay_ton_dong_hien_tai,
       CAST(greatest(w.stt_ngay_lam_viec - o.stt_ngay_lam_viec, 0) AS INTEGER) AS tong_thoi_gian_da_xu_ly
FROM wanted w JOIN cases c ON c.created_at < w.ngay_date + INTERVAL 1 DAY
  AND (NOT c.da_bi_xoa OR c.event_time >= w.ngay_date + INTERVAL 1 DAY)
LEFT JOIN states s ON s.ho_so_id = c.ho_so_id AND s.ngay_date = w.ngay_date
LEFT JOIN cal o ON o.ngay_date = CAST(c.created_at AS DATE)
LEFT JOIN cal a ON a.ngay_date = CAST(s.action_time AS DATE)
WHERE coalesce(s.trang_thai_id, 1) NOT IN (7, 8)"""))
def backlog_range(spark, sf):
    """A week of snapshots in one job."""
    fact = gold.backlog_range(B.cases(spark, sf), B.history(spark, sf), B.dims(spark, sf),
                              B.case_calendar(spark), B.FIRST, B.LAST)
    return fact.select("thoi_gian_id", "ho_so_id", "trang_thai_id", "can_bo_id",
                       "so_ngay_ton_dong_hien_tai", "tong_thoi_gian_da_xu_ly")


@query("C17_backlog_day_by_day", _range_sql("""
SELECT w.thoi_gian_id, c.ho_so_id, coalesce(s.trang_thai_id, 1) AS trang_thai_id,
       CAST(greatest(w.stt_ngay_lam_viec - o.stt_ngay_lam_viec, 0) AS INTEGER) AS tong_thoi_gian_da_xu_ly
FROM wanted w JOIN cases c ON c.created_at < w.ngay_date + INTERVAL 1 DAY
  AND (NOT c.da_bi_xoa OR c.event_time >= w.ngay_date + INTERVAL 1 DAY)
LEFT JOIN states s ON s.ho_so_id = c.ho_so_id AND s.ngay_date = w.ngay_date
LEFT JOIN cal o ON o.ngay_date = CAST(c.created_at AS DATE)
WHERE coalesce(s.trang_thai_id, 1) NOT IN (7, 8)"""))
def backlog_loop(spark, sf):
    """The same week one day at a time: loop and range give the same rows."""
    days = [gold.backlog(B.cases(spark, sf), B.history(spark, sf), B.dims(spark, sf), B.case_calendar(spark), day)
            for day in gold.days_between(B.FIRST, B.LAST)]
    return reduce(lambda a, b: a.unionByName(b), days).select(
        "thoi_gian_id", "ho_so_id", "trang_thai_id", "tong_thoi_gian_da_xu_ly")


# Measures of the day, each written the plain way: one aggregate per measure.
AGENCY_PARTS = f"""got AS (
  SELECT co_quan_id, count(*) AS n FROM cases WHERE CAST(created_at AS DATE) = DATE '{B.DAY}' GROUP BY 1),
stock AS (SELECT co_quan_id, sum(so_luong) AS n FROM backlog GROUP BY 1),
done AS (
  SELECT c.co_quan_id, h.ho_so_id,
         coalesce(greatest(a.stt_ngay_lam_viec - o.stt_ngay_lam_viec, 0) > d.thoi_han_tra_kq, FALSE) AS late
  FROM history h JOIN cases c ON h.ho_so_id = c.ho_so_id AND c.created_at < {DAY_END}
  LEFT JOIN cal o ON o.ngay_date = CAST(c.created_at AS DATE)
  LEFT JOIN cal a ON a.ngay_date = CAST(h.action_time AS DATE)
  LEFT JOIN dim_dich_vu_cong d ON d.dv_cong_id = c.dv_cong_id AND {B.as_of('d', 'c.created_at')}
  WHERE h.trang_thai_id = 7 AND CAST(h.action_time AS DATE) = DATE '{B.DAY}'),
closed AS (SELECT co_quan_id, count(*) FILTER (WHERE late) AS late, count(*) FILTER (WHERE NOT late) AS good
           FROM done GROUP BY 1),
overdue AS (SELECT co_quan_id, count(DISTINCT ho_so_id) AS n FROM backlog
            WHERE tong_thoi_gian_da_xu_ly > sla GROUP BY 1),
rework AS (
  SELECT c.co_quan_id, count(*) AS n FROM history h
  JOIN cases c ON h.ho_so_id = c.ho_so_id AND c.created_at < {DAY_END}
  WHERE h.trang_thai_id = 8 AND CAST(h.action_time AS DATE) = DATE '{B.DAY}' GROUP BY 1),
fees AS (
  SELECT c.co_quan_id, sum(p.so_tien) AS n FROM payments p
  JOIN cases c ON p.ho_so_id = c.ho_so_id AND c.created_at < {DAY_END}
  WHERE upper(p.trang_thai_tt) = 'SUCCESS' AND CAST(p.thoi_gian_tt AS DATE) = DATE '{B.DAY}' GROUP BY 1),
agency_day AS (
  SELECT n_nationkey AS co_quan_id, CAST(coalesce(got.n, 0) AS INTEGER) AS so_luong_tiep_nhan,
         CAST(coalesce(closed.good, 0) AS INTEGER) AS so_luong_dung_han,
         CAST(coalesce(closed.late, 0) + coalesce(overdue.n, 0) AS INTEGER) AS so_luong_tre_han,
         CAST(coalesce(rework.n, 0) AS INTEGER) AS so_luong_rework,
         CAST(coalesce(stock.n, 0) AS INTEGER) AS so_luong_ton_dong,
         CAST(coalesce(fees.n, 0) AS BIGINT) AS tong_chi_phi, CAST(19980115 AS INTEGER) AS thoi_gian_id
  FROM nation LEFT JOIN got ON got.co_quan_id = n_nationkey
  LEFT JOIN stock ON stock.co_quan_id = n_nationkey LEFT JOIN closed ON closed.co_quan_id = n_nationkey
  LEFT JOIN overdue ON overdue.co_quan_id = n_nationkey LEFT JOIN rework ON rework.co_quan_id = n_nationkey
  LEFT JOIN fees ON fees.co_quan_id = n_nationkey)"""
AGENCY_SQL = (*BACKLOG_SQL, B.PAYMENTS, AGENCY_PARTS)


def agency_fact(spark, sf, first=B.DAY, last=B.DAY):
    return gold.agency_days_from_silver(
        B.cases(spark, sf), B.history(spark, sf), B.payments(spark, sf), B.dims(spark, sf),
        B.case_calendar(spark), B.agencies(spark, sf), first, last)


@query("C16_agency_day", B.with_ctes(*AGENCY_SQL, B.DIM_AGENCY, body=f"""
SELECT f.*, a.ten AS agency FROM agency_day f LEFT JOIN dim_co_quan a
  ON a.co_quan_id = f.co_quan_id AND {B.as_of('a', LAST_INSTANT)}"""))
def agency_day(spark, sf):
    fact = agency_fact(spark, sf)
    return joins.lookup(fact, B.dim_agency(spark, sf), "dim_co_quan_sk", {"ten": "agency"}
                        ).drop("id", "dim_co_quan_sk")


@query("A1_agency_received", B.with_ctes(B.CASES, body=f"""
SELECT co_quan_id, count(*) AS so_luong_tiep_nhan FROM cases
WHERE CAST(created_at AS DATE) = DATE '{B.DAY}' GROUP BY 1"""))
def agency_received(spark, sf):
    return gold.received(B.cases(spark, sf), B.DAY).drop("snapshot_day")


@query("A2_agency_backlog", B.with_ctes(*BACKLOG_SQL, body="""
SELECT CAST(thoi_gian_id AS INTEGER) AS thoi_gian_id, co_quan_id,
       CAST(sum(so_luong) AS BIGINT) AS so_luong_ton_dong FROM backlog GROUP BY 1, 2"""))
def agency_backlog(spark, sf):
    return gold.backlog_by_agency(backlog_of_day(spark, sf))


def _activity(spark, sf):
    activity = gold.case_activity(B.history(spark, sf), B.payments(spark, sf), B.DAY)
    return gold.activity_by_agency(activity, B.cases(spark, sf), B.dim_service(spark, sf),
                                   B.case_calendar(spark), B.DAY)


@query("A3_agency_on_off_time", B.with_ctes(*AGENCY_SQL, body="""
SELECT co_quan_id, good AS so_luong_dung_han, late AS so_luong_tre_han_da_dong FROM closed"""))
def on_off_time(spark, sf):
    return _activity(spark, sf).select("co_quan_id", "so_luong_dung_han", "so_luong_tre_han_da_dong"
                                       ).where("so_luong_dung_han + so_luong_tre_han_da_dong > 0")


@query("A4_agency_overdue_open", B.with_ctes(*AGENCY_SQL, body="""
SELECT co_quan_id, n AS so_luong_tre_han_dang_mo FROM overdue"""))
def overdue_open(spark, sf):
    return gold.overdue_open(backlog_of_day(spark, sf), B.dim_service(spark, sf)).drop("thoi_gian_id")


@query("A5_agency_rework", B.with_ctes(B.CASES, B.HISTORY, body=f"""
SELECT CAST(CAST(h.action_time AS DATE) AS VARCHAR) AS snapshot_day, c.co_quan_id, count(*) AS so_luong_rework
FROM history h JOIN cases c ON h.ho_so_id = c.ho_so_id AND c.created_at < CAST(h.action_time AS DATE) + INTERVAL 1 DAY
WHERE h.trang_thai_id = 8 AND CAST(h.action_time AS DATE) BETWEEN DATE '{B.FIRST}' AND DATE '{B.LAST}'
GROUP BY 1, 2"""))
def rework(spark, sf):
    activity = gold.case_activity(B.history(spark, sf), B.payments(spark, sf), B.FIRST, B.LAST)
    return gold.activity_by_agency(activity, B.cases(spark, sf), B.dim_service(spark, sf),
                                   B.case_calendar(spark), B.LAST).select(
        "snapshot_day", "co_quan_id", "so_luong_rework").where("so_luong_rework > 0")


@query("A6_agency_fees", B.with_ctes(*AGENCY_SQL, body="""
SELECT co_quan_id, n AS tong_chi_phi FROM fees"""))
def fees(spark, sf):
    return _activity(spark, sf).select("co_quan_id", "tong_chi_phi").where("tong_chi_phi > 0")


@query("C19_transition_archive", B.with_ctes(B.CASES, B.HISTORY, B.CALENDAR, body="""
SELECT h.history_id AS id, h.ho_so_id, c.co_quan_id, h.trang_thai_id, h.can_bo_id, c.dv_cong_id,
       CASE WHEN h.action_time >= since
            THEN (epoch_us(h.action_time) - epoch_us(since)) / 3600000000.0::DOUBLE END AS thoi_gian_xu_ly,
       CASE WHEN h.trang_thai_id = 7 THEN
            CAST(greatest(a.stt_ngay_lam_viec - o.stt_ngay_lam_viec, 0) AS INTEGER) END AS tong_ngay_lam_viec_xu_ly,
       CAST(strftime(h.action_time, '%Y%m%d') AS INTEGER) AS thoi_gian_id
FROM (SELECT *, lag(action_time) OVER (PARTITION BY ho_so_id ORDER BY action_time, history_id) AS prev
      FROM history) h
JOIN (SELECT * FROM cases) c ON h.ho_so_id = c.ho_so_id
LEFT JOIN cal o ON o.ngay_date = CAST(c.created_at AS DATE)
LEFT JOIN cal a ON a.ngay_date = CAST(h.action_time AS DATE),
LATERAL (SELECT coalesce(h.prev, c.created_at) AS since)"""))
def transitions(spark, sf):
    return gold.transitions(B.history(spark, sf), B.cases(spark, sf), B.case_calendar(spark))


# Working time the other way round: what has passed, less what has passed on days off.
WORKED = """gone AS (
  SELECT ngay_date, off, sum(CASE WHEN off THEN 86400 ELSE 0 END) OVER (ORDER BY ngay_date) AS through FROM calendar_days),
steps AS (
  SELECT h.history_id, h.trang_thai_id, h.action_time AS till, coalesce(
    lag(h.action_time) OVER (PARTITION BY h.ho_so_id ORDER BY h.action_time, h.history_id), c.created_at) AS since
  FROM history h JOIN cases c ON h.ho_so_id = c.ho_so_id),
worked AS (
  SELECT history_id, trang_thai_id, since, till, CASE WHEN till >= since THEN epoch(till)::BIGINT - epoch(since)::BIGINT
    - (b.through - CASE WHEN b.off THEN 86400 - (epoch(till)::BIGINT % 86400) ELSE 0 END)
    + (a.through - CASE WHEN a.off THEN 86400 - (epoch(since)::BIGINT % 86400) ELSE 0 END) END AS s
  FROM steps LEFT JOIN gone a ON a.ngay_date = CAST(since AS DATE) LEFT JOIN gone b ON b.ngay_date = CAST(till AS DATE))"""


@query("C19_N11_working_time_of_steps", B.with_ctes(B.CASES, B.HISTORY, B.CALENDAR, WORKED, body="""
SELECT history_id AS id, trang_thai_id, CAST(s AS BIGINT) AS working_seconds FROM worked"""))
def working_time(spark, sf):
    """Each step of the archive without its days off, in whole seconds."""
    facts = gold.transitions(B.history(spark, sf), B.cases(spark, sf), B.case_calendar(spark), working_time=True)
    return facts.select("id", "trang_thai_id", F.round(F.col("thoi_gian_xu_ly") * 3600).cast("long").alias("working_seconds"))


@query("C22b_mean_working_step_time", B.with_ctes(B.CASES, B.HISTORY, B.CALENDAR, WORKED, body="""
SELECT trang_thai_id, avg(CAST(s AS DOUBLE)) AS mean_working_seconds FROM worked GROUP BY 1"""))
def mean_working_step(spark, sf):
    facts = gold.transitions(B.history(spark, sf), B.cases(spark, sf), B.case_calendar(spark), working_time=True)
    seconds = F.round(F.col("thoi_gian_xu_ly") * 3600)
    return kpi.mean_step_time(facts.withColumn("thoi_gian_xu_ly", seconds)).withColumnRenamed(
        "thoi_gian_xu_ly_tb", "mean_working_seconds")


@query("C22b_weekend_steps", B.with_ctes(B.CASES, B.HISTORY, B.CALENDAR, WORKED, body="""
SELECT history_id AS id FROM worked
WHERE till >= since AND dayofweek(since) IN (0, 6) AND dayofweek(till) IN (0, 6)
  AND date_diff('day', CAST(since AS DATE), CAST(till AS DATE)) <= 1"""))
def weekend_steps(spark, sf):
    """Steps that begin and end in one weekend: each takes no working time."""
    history, cases, cal = B.history(spark, sf), B.cases(spark, sf), B.case_calendar(spark)
    wall = gold.transitions(history, cases, cal).select("id", F.col("thoi_gian_xu_ly").alias("wall"))
    worked = gold.transitions(history, cases, cal, working_time=True).select("id", "thoi_gian_xu_ly")
    times = history.select(F.col("history_id").alias("id"), "action_time")
    both = worked.join(wall, "id").join(times, "id").where("thoi_gian_xu_ly = 0 AND wall >= 0")
    since = F.timestamp_seconds(F.unix_seconds("action_time") - F.round(F.col("wall") * 3600))
    return both.where(F.dayofweek("action_time").isin(1, 7) & F.dayofweek(since).isin(1, 7)
                      & (F.datediff(F.to_date("action_time"), F.to_date(since)) <= 1)).select("id")


# --- indicators on the facts of a range of days -----------------------------------------

PERIOD_FIRST, PERIOD_LAST = date(1997, 11, 20), date(1998, 2, 10)


def build_agency_days(spark, sf):
    return agency_fact(spark, sf, PERIOD_FIRST, PERIOD_LAST)


def agency_days_stored(spark, sf):
    """The agency fact of twelve weeks as it is stored: built once, then scanned."""
    return B.stored(spark, sf, "fact_van_hanh_co_quan", build_agency_days)


DAY_OF = "CAST(strftime({}, '%Y%m%d') AS INTEGER)"
AGENCY_DAYS = f"""wanted AS (SELECT * FROM cal WHERE ngay_date BETWEEN DATE '{PERIOD_FIRST}' AND DATE '{PERIOD_LAST}'),
states AS (
  SELECT w.ngay_date, h.ho_so_id, h.trang_thai_id FROM wanted w
  JOIN history h ON h.action_time < w.ngay_date + INTERVAL 1 DAY
  QUALIFY row_number() OVER (PARTITION BY w.ngay_date, h.ho_so_id ORDER BY h.action_time DESC, h.history_id DESC) = 1),
open_days AS (
  SELECT w.thoi_gian_id, c.co_quan_id, c.ho_so_id,
         coalesce(greatest(w.stt_ngay_lam_viec - o.stt_ngay_lam_viec, 0) > d.thoi_han_tra_kq, FALSE) AS late
  FROM wanted w JOIN cases c ON c.created_at < w.ngay_date + INTERVAL 1 DAY
    AND (NOT c.da_bi_xoa OR c.event_time >= w.ngay_date + INTERVAL 1 DAY)
  LEFT JOIN states s ON s.ho_so_id = c.ho_so_id AND s.ngay_date = w.ngay_date
  LEFT JOIN cal o ON o.ngay_date = CAST(c.created_at AS DATE)
  LEFT JOIN dim_dich_vu_cong d ON d.dv_cong_id = c.dv_cong_id AND {B.as_of('d', 'c.created_at')}
  WHERE coalesce(s.trang_thai_id, 1) NOT IN (7, 8)),
stock AS (SELECT thoi_gian_id, co_quan_id, count(*) AS n, count(*) FILTER (WHERE late) AS late FROM open_days GROUP BY 1, 2),
got AS (SELECT {DAY_OF.format('created_at')} AS thoi_gian_id, co_quan_id, count(*) AS n FROM cases GROUP BY 1, 2),
acts AS (
  SELECT {DAY_OF.format('h.action_time')} AS thoi_gian_id, c.co_quan_id, h.trang_thai_id,
         coalesce(greatest(a.stt_ngay_lam_viec - o.stt_ngay_lam_viec, 0) > d.thoi_han_tra_kq, FALSE) AS late
  FROM history h JOIN cases c ON h.ho_so_id = c.ho_so_id AND c.created_at < CAST(h.action_time AS DATE) + INTERVAL 1 DAY
  LEFT JOIN cal o ON o.ngay_date = CAST(c.created_at AS DATE)
  LEFT JOIN cal a ON a.ngay_date = CAST(h.action_time AS DATE)
  LEFT JOIN dim_dich_vu_cong d ON d.dv_cong_id = c.dv_cong_id AND {B.as_of('d', 'c.created_at')}),
acted AS (SELECT thoi_gian_id, co_quan_id, count(*) FILTER (WHERE trang_thai_id = 7 AND late) AS late,
                 count(*) FILTER (WHERE trang_thai_id = 8) AS rework FROM acts GROUP BY 1, 2),
paid AS (
  SELECT {DAY_OF.format('p.thoi_gian_tt')} AS thoi_gian_id, c.co_quan_id, sum(p.so_tien) AS n FROM payments p
  JOIN cases c ON p.ho_so_id = c.ho_so_id AND c.created_at < CAST(p.thoi_gian_tt AS DATE) + INTERVAL 1 DAY
  WHERE upper(p.trang_thai_tt) = 'SUCCESS' GROUP BY 1, 2),
agency_days AS (
  SELECT w.thoi_gian_id, w.nam, w.quy, w.thang, n_nationkey AS co_quan_id, coalesce(got.n, 0) AS so_luong_tiep_nhan,
         coalesce(acted.late, 0) + coalesce(stock.late, 0) AS so_luong_tre_han, coalesce(acted.rework, 0) AS so_luong_rework,
         coalesce(stock.n, 0) AS so_luong_ton_dong, CAST(coalesce(paid.n, 0) AS BIGINT) AS tong_chi_phi
  FROM wanted w CROSS JOIN nation
  LEFT JOIN got ON got.co_quan_id = n_nationkey AND got.thoi_gian_id = w.thoi_gian_id
  LEFT JOIN stock ON stock.co_quan_id = n_nationkey AND stock.thoi_gian_id = w.thoi_gian_id
  LEFT JOIN acted ON acted.co_quan_id = n_nationkey AND acted.thoi_gian_id = w.thoi_gian_id
  LEFT JOIN paid ON paid.co_quan_id = n_nationkey AND paid.thoi_gian_id = w.thoi_gian_id)"""
PERIOD_SQL = (B.CASES, B.HISTORY, B.PAYMENTS, B.CALENDAR, B.DIM_SERVICE, AGENCY_DAYS)


@query("C17_agency_days", B.with_ctes(*PERIOD_SQL, body="""
SELECT thoi_gian_id, co_quan_id, CAST(so_luong_tiep_nhan AS INTEGER) AS so_luong_tiep_nhan,
       CAST(so_luong_tre_han AS INTEGER) AS so_luong_tre_han, CAST(so_luong_rework AS INTEGER) AS so_luong_rework,
       CAST(so_luong_ton_dong AS INTEGER) AS so_luong_ton_dong, tong_chi_phi FROM agency_days"""))
def agency_days(spark, sf):
    """The fact of twelve weeks that the period indicators read."""
    return agency_days_stored(spark, sf).select("thoi_gian_id", "co_quan_id", "so_luong_tiep_nhan", "so_luong_tre_han",
                                                "so_luong_rework", "so_luong_ton_dong", "tong_chi_phi")


def _closing_sql(period: str, by: str = "") -> str:
    keys = ", ".join(filter(None, (period, by)))
    head = B.with_ctes(*PERIOD_SQL, body="")
    return head.rstrip() + f""",
closing AS (SELECT {period}, max(thoi_gian_id) AS last_day FROM agency_days GROUP BY ALL),
flows AS (SELECT {keys}, sum(so_luong_tiep_nhan) AS got, sum(tong_chi_phi) AS fees, sum(so_luong_tre_han) AS late,
                 sum(so_luong_rework) AS rework FROM agency_days GROUP BY ALL),
levels AS (SELECT {keys}, sum(so_luong_ton_dong) AS stock FROM agency_days
           WHERE thoi_gian_id IN (SELECT last_day FROM closing) GROUP BY ALL)
SELECT {keys}, CAST(got AS BIGINT) AS tong_tiep_nhan, CAST(fees AS BIGINT) AS tong_doanh_thu_vnd, CAST(stock AS BIGINT) AS tong_ton_dong,
       100.0::DOUBLE * CAST(late AS DOUBLE) / NULLIF(CAST(got + stock AS DOUBLE), 0) AS ty_le_tre_han_pct,
       100.0::DOUBLE * CAST(rework AS DOUBLE) / NULLIF(CAST(got AS DOUBLE), 0) AS ty_le_rework_pct,
       CAST(got + stock AS BIGINT) AS tai_cong_viec
FROM flows JOIN levels USING ({keys})"""


@query("C21c_closing_backlog_month", _closing_sql("nam, thang", "co_quan_id"))
def closing_month(spark, sf):
    """By month and agency: what came in adds up, what is open is that of the month's last day."""
    return kpi.kpi_periods(agency_days_stored(spark, sf), B.case_calendar(spark), ("nam", "thang"), "co_quan_id")


@query("C21c_closing_backlog_quarter", _closing_sql("nam, quy"))
def closing_quarter(spark, sf):
    return kpi.kpi_periods(agency_days_stored(spark, sf), B.case_calendar(spark), ("nam", "quy"))


@query("C20_kpi_monthly_agency_fact", B.with_ctes(*PERIOD_SQL, body="""
SELECT nam, thang, CAST(sum(so_luong_tiep_nhan) AS BIGINT) AS tong_tiep_nhan, CAST(sum(tong_chi_phi) AS BIGINT) AS tong_doanh_thu_vnd,
       CAST(sum(so_luong_ton_dong) AS BIGINT) AS tong_ton_dong,
       100.0::DOUBLE * CAST(sum(so_luong_tre_han) AS DOUBLE) / NULLIF(CAST(sum(so_luong_tiep_nhan) + sum(so_luong_ton_dong) AS DOUBLE), 0) AS ty_le_tre_han_pct,
       100.0::DOUBLE * CAST(sum(so_luong_rework) AS DOUBLE) / NULLIF(CAST(sum(so_luong_tiep_nhan) AS DOUBLE), 0) AS ty_le_rework_pct
FROM agency_days WHERE thoi_gian_id BETWEEN 19971201 AND 19980131 GROUP BY 1, 2"""))
def kpi_monthly_agency_fact(spark, sf):
    """The leadership figures over the stored agency fact."""
    return kpi.kpi_monthly(agency_days_stored(spark, sf), B.case_calendar(spark), 19971201, 19980131)


# --- indicators -----------------------------------------------------------------------

def stored_facts(spark, sf):
    """A fact for the indicators: one row per agency and day, straight from the tables."""
    orders = B.cases(spark, sf)
    return orders.groupBy("co_quan_id", C.day_key("created_at").alias("thoi_gian_id")).agg(
        F.count(F.lit(1)).cast("int").alias("so_luong_tiep_nhan"),
        F.count_if(F.col("trang_thai_id") == 7).cast("int").alias("so_luong_dung_han"),
        F.count_if(F.col("trang_thai_id") == 5).cast("int").alias("so_luong_tre_han"),
        F.count_if(F.col("da_bi_xoa")).cast("int").alias("so_luong_rework"),
        F.count_if(F.col("trang_thai_id") == 3).cast("int").alias("so_luong_ton_dong"),
        F.sum(F.col("dv_cong_id").cast("long") * 1000).alias("tong_chi_phi"))


FACTS = """facts AS (
  SELECT co_quan_id, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS thoi_gian_id,
         count(*) AS so_luong_tiep_nhan, count(*) FILTER (WHERE trang_thai_id = 5) AS so_luong_tre_han,
         count(*) FILTER (WHERE da_bi_xoa) AS so_luong_rework,
         count(*) FILTER (WHERE trang_thai_id = 3) AS so_luong_ton_dong,
         sum(dv_cong_id * 1000) AS tong_chi_phi
  FROM cases GROUP BY 1, 2)"""
MEASURES = """CAST(sum(so_luong_tiep_nhan) AS BIGINT) AS tong_tiep_nhan,
       CAST(sum(tong_chi_phi) AS BIGINT) AS tong_doanh_thu_vnd,
       CAST(sum(so_luong_ton_dong) AS BIGINT) AS tong_ton_dong,
       100.0::DOUBLE * CAST(sum(so_luong_tre_han) AS DOUBLE)
         / NULLIF(CAST(sum(so_luong_tiep_nhan) + sum(so_luong_ton_dong) AS DOUBLE), 0) AS ty_le_tre_han_pct,
       100.0::DOUBLE * CAST(sum(so_luong_rework) AS DOUBLE)
         / NULLIF(CAST(sum(so_luong_tiep_nhan) AS DOUBLE), 0) AS ty_le_rework_pct"""


@query("C20_kpi_monthly", B.with_ctes(B.CASES, FACTS, B.CALENDAR, body=f"""
SELECT nam, thang, {MEASURES} FROM facts JOIN cal ON facts.thoi_gian_id = cal.thoi_gian_id
WHERE facts.thoi_gian_id BETWEEN 19970101 AND 19981231 GROUP BY 1, 2 ORDER BY 1, 2"""))
def kpi_monthly(spark, sf):
    return kpi.kpi_monthly(stored_facts(spark, sf), B.case_calendar(spark), 19970101, 19981231)


@query("C21_kpi_agency", B.with_ctes(B.CASES, FACTS, body=f"""
SELECT co_quan_id, {MEASURES},
       CAST(sum(so_luong_tiep_nhan) + sum(so_luong_ton_dong) AS BIGINT) AS tai_cong_viec
FROM facts GROUP BY 1"""))
def kpi_agency(spark, sf):
    return kpi.kpi_agency(stored_facts(spark, sf))


def _single_measure(measure):
    """Each indicator of the agency group on its own, by agency."""
    @query(f"C21_{measure}", B.with_ctes(B.CASES, FACTS, body=f"""
SELECT co_quan_id, {measure} FROM (SELECT co_quan_id, {MEASURES},
  CAST(sum(so_luong_tiep_nhan) + sum(so_luong_ton_dong) AS BIGINT) AS tai_cong_viec
  FROM facts GROUP BY 1)"""))
    def run(spark, sf):
        return kpi.kpi_agency(stored_facts(spark, sf), measures=[measure])
    return run


for _name in ("tong_tiep_nhan", "tong_doanh_thu_vnd", "tong_ton_dong", "ty_le_tre_han_pct",
              "ty_le_rework_pct", "tai_cong_viec"):
    _single_measure(_name)


@query("C22a_backlog_by_status", B.with_ctes(*BACKLOG_SQL, body="""
SELECT trang_thai_id, CAST(sum(so_luong) AS BIGINT) AS so_luong_ton_dong FROM backlog
WHERE co_quan_id = 3 GROUP BY 1"""))
def by_status(spark, sf):
    return kpi.backlog_by_status(backlog_of_day(spark, sf), agency=3)


@query("C22b_mean_step_time", B.with_ctes(B.HISTORY, B.CASES, body="""
SELECT trang_thai_id, avg(CASE WHEN s >= 0 THEN CAST(s AS DOUBLE) END) AS mean_seconds FROM (
  SELECT h.trang_thai_id, epoch(action_time)::BIGINT - epoch(coalesce(
    lag(action_time) OVER (PARTITION BY h.ho_so_id ORDER BY action_time, history_id), created_at))::BIGINT AS s
  FROM history h JOIN cases c ON h.ho_so_id = c.ho_so_id) GROUP BY 1"""))
def mean_step(spark, sf):
    """Compared in whole seconds, because the mean of binary fractions depends on the
    order of the additions."""
    facts = gold.transitions(B.history(spark, sf), B.cases(spark, sf), B.case_calendar(spark))
    seconds = F.round(F.col("thoi_gian_xu_ly") * 3600)
    return kpi.mean_step_time(facts.withColumn("thoi_gian_xu_ly", seconds)).withColumnRenamed(
        "thoi_gian_xu_ly_tb", "mean_seconds")


@query("C22c_mean_backlog_age", B.with_ctes(*BACKLOG_SQL, body="""
SELECT co_quan_id, avg(tong_thoi_gian_da_xu_ly) AS tuoi_ton_dong_tb FROM backlog GROUP BY 1"""))
def mean_age(spark, sf):
    return kpi.mean_backlog_age(backlog_of_day(spark, sf))


@query("C22d_mean_days_stuck", B.with_ctes(*BACKLOG_SQL, body="""
SELECT can_bo_id, avg(so_ngay_ton_dong_hien_tai) AS so_ngay_ngam_tb FROM backlog GROUP BY 1"""))
def mean_stuck(spark, sf):
    return kpi.mean_days_stuck(backlog_of_day(spark, sf))


@query("C22_kpi_drilldown", B.with_ctes(*BACKLOG_SQL, body="""
SELECT co_quan_id, trang_thai_id, CAST(sum(so_luong) AS BIGINT) AS so_luong_ton_dong,
       avg(tong_thoi_gian_da_xu_ly) AS tuoi_ton_dong_tb, avg(so_ngay_ton_dong_hien_tai) AS so_ngay_ngam_tb
FROM backlog GROUP BY 1, 2"""))
def drilldown(spark, sf):
    return kpi.kpi_drilldown(backlog_of_day(spark, sf), ["co_quan_id", "trang_thai_id"])


@query("C23_kpi_slice", B.with_ctes(*BACKLOG_SQL, B.DIM_AGENCY, body=f"""
SELECT a.tinh, CAST(sum(so_luong) AS BIGINT) AS so_luong_ton_dong,
       avg(tong_thoi_gian_da_xu_ly) AS tuoi_ton_dong_tb
FROM backlog b JOIN dim_co_quan a ON a.co_quan_id = b.co_quan_id AND {B.as_of('a', LAST_INSTANT)}
GROUP BY 1"""))
def sliced(spark, sf):
    return kpi.kpi_slice(backlog_of_day(spark, sf), B.dim_agency(spark, sf), "dim_co_quan_sk", ["tinh"])


# --- checks ---------------------------------------------------------------------------

@query("J13_Q2_recon_backlog", B.with_ctes(*BACKLOG_SQL, body="""
SELECT CAST(19980115 AS INTEGER) AS thoi_gian_id, co_quan_id, CAST(count(*) + 1 AS BIGINT) AS gold_ton_dong,
       count(*) AS snapshot_ton_dong FROM backlog WHERE co_quan_id % 5 = 0 GROUP BY co_quan_id"""))
def recon_backlog(spark, sf):
    """Every fifth agency total is put off by one; exactly those must be reported."""
    snapshot = materialize(backlog_of_day(spark, sf))
    totals = gold.backlog_by_agency(snapshot).withColumn(
        "so_luong_ton_dong", F.col("so_luong_ton_dong") + F.when(F.col("co_quan_id") % 5 == 0, 1)
        .otherwise(0))
    return quality.recon_backlog(totals, snapshot)


@query("J14_Q5_orphan_keys", B.with_ctes(*BACKLOG_SQL, body="""
SELECT ho_so_id, CAST(thoi_gian_id AS INTEGER) AS thoi_gian_id FROM backlog WHERE dv_cong_id = 2"""))
def orphans(spark, sf):
    service = B.dim_service(spark, sf).where("dv_cong_id <> 2")
    return quality.orphan_keys(backlog_of_day(spark, sf), service, "dim_dich_vu_cong_sk")


@query("Q1_recon_layers", B.with_ctes(*BACKLOG_SQL, body="""
SELECT 'cases' AS dataset, count(*) AS row_count FROM cases
UNION ALL SELECT 'history', count(*) FROM history UNION ALL SELECT 'backlog', count(*) FROM backlog"""))
def layers(spark, sf):
    return quality.recon_counts({"cases": B.cases(spark, sf), "history": B.history(spark, sf),
                                 "backlog": backlog_of_day(spark, sf)})


@query("Q6_conflicting_keys", """
SELECT l_suppkey, l_linenumber, count(DISTINCT l_returnflag) AS row_count FROM lineitem GROUP BY 1, 2
HAVING count(DISTINCT l_returnflag) > 1""")
def conflicts(spark, sf):
    rows = B.table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag")
    return keys.duplicate_keys(rows.dropDuplicates(), ["l_suppkey", "l_linenumber"])


@query("Q7_event_uniqueness", B.with_ctes(B.HISTORY, body="""
SELECT CAST(count(*) AS BIGINT) AS row_count, count(DISTINCT history_id) AS distinct_events FROM history"""))
def uniqueness(spark, sf):
    return quality.event_uniqueness(B.history(spark, sf), "history_id")


@query("C24_not_empty_gate", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def gate(spark, sf):
    return quality.not_empty(B.table(spark, sf, "events"), "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("C17_backfill", B.with_ctes(*AGENCY_SQL, body="""
SELECT co_quan_id, so_luong_tiep_nhan, so_luong_dung_han, so_luong_tre_han, so_luong_rework,
       so_luong_ton_dong, tong_chi_phi FROM agency_day"""))
def backfill(spark, sf):
    """Two days built day by day, one of them twice; the day in question is read back."""
    names = {}

    def name(table):
        if table not in names:
            names[table], location = B.new_table(spark, table)
            locations[names[table]] = location
        return names[table]

    locations: dict[str, str] = {}
    inputs = {"application": materialize(B.cases(spark, sf)),
              "application_history": materialize(B.history(spark, sf)),
              "payment": materialize(B.payments(spark, sf)), "agency": B.agencies(spark, sf)}
    dims = {k: materialize(v) for k, v in B.dims(spark, sf).items()}
    cal = B.case_calendar(spark)
    for table, contract in (("fact_ton_dong_ho_so", gold.FACT_BACKLOG),
                            ("fact_van_hanh_co_quan", gold.FACT_AGENCY_DAY)):
        empty = keys.literal_rows(spark, [], contract)
        tables.create_or_evolve(empty, name(table), "thoi_gian_id", locations[name(table)])
    gold.backfill(inputs, dims, cal, date(1998, 1, 14), B.DAY, name)
    gold.build_day(inputs, dims, cal, B.DAY, name)
    return (spark.table(name("fact_van_hanh_co_quan")).where("thoi_gian_id = 19980115")
            .select("co_quan_id", "so_luong_tiep_nhan", "so_luong_dung_han", "so_luong_tre_han",
                    "so_luong_rework", "so_luong_ton_dong", "tong_chi_phi"))
