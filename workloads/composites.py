"""Whole steps of the pipeline as they are called in production, and what spans several tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.operators import calendar as cal_ops
from caseledger.operators import keys, quality, scd2
from caseledger.plans import bronze, gold, silver
from caseledger.plans import dims as dim_plans
from caseledger.schemas import CONTRACTS, PACKET_DATA, assert_schema, conform
from caseledger.session import materialize, scratch_path
from caseledger.sources import readers, tables
from caseledger.streaming import transitions
from workloads import bindings as B
from workloads import modelling as M
from workloads import parsing as P
from workloads import streams as S
from workloads.registry import query

FOLDERS = 5


def pages_of_files(spark, sf):
    """The pages of fifty files, to be written one after another: no row holds a file's pages."""
    no = F.col("page_id") % 50
    return B.table(spark, sf, "pages").select((no % FOLDERS).alias("folder"), no.alias("no"), "html").repartition("no")


@query("C2_ingest_xml_with_quarantine", f"""
SELECT 'accepted' AS kind, CAST(o_orderkey // {P.PER_FILE} % {FOLDERS} AS BIGINT) AS folder, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'rejected', CAST(page_id % 50 % {FOLDERS} AS BIGINT), count(DISTINCT page_id % 50) FROM pages GROUP BY 2""")
def ingest_xml(spark, sf):
    """Files of packets and files of web pages in one landing zone; where each came from is its real file path."""
    zone, quarantine = scratch_path(spark, "landing"), scratch_path(spark, "quarantine")
    good = P.files_of_packets(spark, sf).select((F.col("no") % FOLDERS).alias("folder"), F.col("body").alias("value"))
    good.write.option("maxRecordsPerFile", 1).option("compression", "gzip").partitionBy("folder").text(zone)
    pages_of_files(spark, sf).write.mode("append").option("compression", "gzip").partitionBy("folder", "no").text(zone)
    name, _ = B.new_table(spark, "application_xml")
    bronze.ingest_xml(spark, zone, name, quarantine, "*.txt.gz")
    folder = F.regexp_extract("file_name", "/folder=([0-9]+)/", 1).cast("bigint").alias("folder")
    accepted = spark.table(name).groupBy(F.lit("accepted").alias("kind"), folder).agg(F.count(F.lit(1)).alias("n"))
    rejected = readers.scan_quarantine(spark, quarantine).where("error_reason IS NOT NULL AND raw_content IS NOT NULL")
    return accepted.unionByName(rejected.groupBy(F.lit("rejected").alias("kind"), folder).agg(F.count(F.lit(1)).alias("n")))


_TIME = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"


def _step_json(n):
    return (f"""'{{"@action": "INSERT", "id": "H{n}_' || o_orderkey || '", "Statusid": "{n}", "Statusid2": "{n + 1}", ' ||
      CASE WHEN o_orderkey % 4 <> 0 THEN '"Officerid": "' || o_custkey || '", ' ELSE '' END ||
      '"action_time": "' || {_TIME} || '"}}'""")


@query("P1_X1_declared_layout", f"""
SELECT 'HS_' || o_orderkey AS id_ban_ghi, CASE WHEN o_orderkey % 9 = 0 THEN 'null' ELSE
  '{{"name": "Case ' || o_orderkey || '", "Applicantid": "' || printf('%06d', o_custkey) ||
  '", "Serviceid": "' || substr(o_orderpriority, 1, 1) || '", "Agencyid": null, "created_at": "' || {_TIME} ||
  '", "Statusid": "1", "document_array": {{"document": {{"@action": "INSERT", "id": "D_' || o_orderkey ||
  '", "name": "Đơn & tờ khai", "file_url": "s3://docs/' || o_orderkey || '", "Document_Typeid": "2"}}}}, ' ||
  '"payment_array": {{"payment": {{"@action": "INSERT", "amount": "' || o_custkey ||
  '", "method": "CARD", "status": "success", "transaction_code": "T_' || o_orderkey || '", "paid_at": "' || {_TIME} ||
  '"}}}}, "application_history_array": {{"application_history": ' ||
  CASE WHEN o_orderkey % 2 = 0 THEN {_step_json(1)} ELSE '[' || {_step_json(1)} || ', ' || {_step_json(2)} || ']' END || '}}}}' END
  AS data_payload FROM orders
UNION ALL SELECT 'page ' || page_id, NULL FROM pages""")
def declared_layout(spark, sf):
    """Packets of the declared layout, parsed in the JVM, and web pages, left to the Python parser, from one landing zone."""
    good = P.files_of_packets(spark, sf).select(F.col("no").cast("string").alias("file_name"), "body")
    pages = B.table(spark, sf, "pages").select(F.concat(F.lit("page "), "page_id").alias("file_name"), F.col("html").alias("body"))
    files = P.raw_rows(good.unionByName(pages), F.col("file_name"), F.col("body"))
    with bronze.validated_files(files, PACKET_DATA) as (accepted, rejected):
        pages = rejected.select(F.col("file_name").alias("id_ban_ghi"), F.lit(None).cast("string").alias("data_payload"))
        return materialize(accepted.select("id_ban_ghi", "data_payload").unionByName(pages), "declared-layout")


@query("C3_ingest_api_payments", """
SELECT 'HS_' || event_id AS id_ban_ghi, floor(value) AS amount, date_trunc('millisecond', ts) AS ingested_at,
       strftime(ts, '%Y-%m-%d') AS ingest_date, TRUE AS from_a_file FROM events""")
def ingest_api(spark, sf):
    zone, (name, _) = scratch_path(spark, "api"), B.new_table(spark, "payment_transactions")
    P.land_payments(spark, sf, zone)
    bronze.ingest_api_payments(spark, zone, name)
    return spark.table(name).select("id_ban_ghi", "amount", "ingested_at", "ingest_date", F.contains("file_name", F.lit("/api-")).alias("from_a_file"))


@query("C4_T1_ingest_cdc", f"""
SELECT 'application' AS topic, CAST(user_id % {S.CASES_SHARE} AS VARCHAR) AS ho_so_id, count(*) AS changes, max(event_id) AS last_offset
FROM events GROUP BY 2
UNION ALL SELECT 'application_history', CAST(user_id % {S.CASES_SHARE} AS VARCHAR), count(*), max(event_id) FROM events GROUP BY 2""")
def ingest_cdc(spark, sf):
    """One query per captured table, side by side, each with its own checkpoint; the place in the topic is kept."""
    streams = dict(zip(("application", "application_history"), S.topics(spark, sf)))
    names = {topic: B.new_table(spark, f"{topic}_cdc")[0] for topic in streams}
    for running in bronze.ingest_cdc(streams, scratch_path(spark, "checkpoints"), names.get, trigger=None).values():
        running.awaitTermination()
    case = {"application": "id", "application_history": "Applicationid"}
    parts = [tables.fresh(spark, names[t]).groupBy(F.lit(t).alias("topic"), F.col(case[t]).alias("ho_so_id")).agg(
        F.count(F.lit(1)).alias("changes"), F.max("kafka_offset").alias("last_offset")) for t in streams]
    return parts[0].unionByName(parts[1])


@query("A9_high_water_of_a_stored_calendar", B.with_ctes(B.CALENDAR, body="""
SELECT CAST(max(ngay_date) AS VARCHAR) AS max_day, max(stt_ngay_lam_viec) AS max_index
FROM cal WHERE ngay_date <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"""))
def stored_high_water(spark, sf):
    name, location = B.new_table(spark, "dim_thoi_gian")
    last = B.table(spark, sf, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]
    tables.upsert_current_state(cal_ops.calendar(spark, B.CALENDAR_FROM, last), name, "thoi_gian_id", buckets=1, location=location)
    day, index = cal_ops.high_water(tables.fresh(spark, name))
    return keys.literal_rows(spark, [(day, index)], "max_day date, max_index int")


@query("hash_keys_are_keys", B.with_ctes(*M.BACKLOG_SQL, B.DIM_AGENCY, B.DIM_OFFICER, body="""
SELECT 'fact_ton_dong_ho_so' AS dataset, count(*) AS row_count, count(DISTINCT ho_so_id) AS distinct_keys, TRUE AS same_again FROM backlog
UNION ALL SELECT 'dim_co_quan', count(*), count(*), TRUE FROM dim_co_quan
UNION ALL SELECT 'dim_can_bo', count(*), count(*), TRUE FROM dim_can_bo"""))
def hash_keys(spark, sf):
    """Hashed keys: as many as there are things to name, and the same when they are computed again from what is stored."""
    backlog = materialize(M.backlog_of_day(spark, sf))

    def counted(name, rows, key, again):
        return rows.groupBy(F.lit(name).alias("dataset")).agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(key).alias("distinct_keys"),
                                                              F.bool_and(F.col(key) == again).alias("same_again"))
    parts = [counted("fact_ton_dong_ho_so", backlog, "id", F.xxhash64("thoi_gian_id", "ho_so_id"))]
    for spec, build in ((dim_plans.AGENCY, B.dim_agency), (dim_plans.OFFICER, B.dim_officer)):
        parts.append(counted(spec.table, build(spark, sf), spec.sk, scd2.version_key(spec.key, "effective_from_ts", spec.tracked)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _contract_frames(spark, sf):
    """What the plans really produce, for every table that has a contract."""
    built = {spec.table: build(spark, sf) for spec, build in (
        (dim_plans.AGENCY, B.dim_agency), (dim_plans.STATUS, B.dim_status), (dim_plans.OFFICER, B.dim_officer), (dim_plans.SERVICE, B.dim_service))}
    specs = (dim_plans.AGENCY, dim_plans.STATUS, dim_plans.OFFICER, dim_plans.SERVICE)
    calendar = B.case_calendar(spark)
    application, history = (readers.as_records(r) for r in S.change_records(spark, sf))
    packets = P.bronze_packets(spark, sf)
    return {
        "bronze.application_xml": packets, "bronze.payment_transactions": P.api_payments(spark, sf),
        "gold.dim_thoi_gian": calendar, "realtime.dim_thoi_gian": calendar,
        **{f"gold.{t}": d for t, d in built.items()},
        **{f"realtime.{s.table}": scd2.current_attributes(built[s.table], [s.key, *s.tracked]) for s in specs},
        "gold.fact_xu_ly_ho_so": gold.transitions(B.history(spark, sf), B.cases(spark, sf), calendar),
        "gold.fact_ton_dong_ho_so": M.backlog_of_day(spark, sf),
        "gold.fact_van_hanh_co_quan": M.agency_days_stored(spark, sf),
        "realtime.fact_xu_ly_ho_so_stream": transitions.realtime_transitions(application, history, loaded_at=S.loaded_at()),
    }


_VERSIONED_SQL = {"dim_co_quan": "dim_co_quan", "dim_can_bo": "dim_can_bo", "dim_dich_vu_cong": "dim_dich_vu_cong"}
_COUNTS_SQL = {
    "bronze.application_xml": "SELECT count(*) FROM orders", "bronze.payment_transactions": "SELECT count(*) FROM events",
    "gold.dim_thoi_gian": "SELECT count(*) FROM cal", "realtime.dim_thoi_gian": "SELECT count(*) FROM cal",
    **{f"gold.{t}": f"SELECT count(*) FROM {t}" for t in _VERSIONED_SQL},
    **{f"realtime.{t}": f"SELECT count(*) FROM {t} WHERE is_current" for t in _VERSIONED_SQL},
    "gold.dim_trang_thai": "SELECT count(*) FROM dim_trang_thai", "realtime.dim_trang_thai": "SELECT count(*) FROM dim_trang_thai",
    "gold.fact_xu_ly_ho_so": "SELECT count(*) FROM history h JOIN cases c ON h.ho_so_id = c.ho_so_id",
    "gold.fact_ton_dong_ho_so": "SELECT count(*) FROM backlog", "gold.fact_van_hanh_co_quan": "SELECT count(*) FROM agency_days",
    "realtime.fact_xu_ly_ho_so_stream": "SELECT count(*) FROM matched",
}


@query("K16_all_contracts", B.with_ctes(*M.BACKLOG_SQL, B.PAYMENTS, M.AGENCY_DAYS, B.DIM_AGENCY, B.DIM_OFFICER, B.DIM_STATUS, S.CHANGES, body="""
""" + " UNION ALL ".join(f"""SELECT '{name}' AS contract, CAST({len(contract.names)} AS INTEGER) AS n_columns, ({_COUNTS_SQL[name]}) AS row_count,
  ({_COUNTS_SQL[name]}) AS keyed_rows""" for name, contract in CONTRACTS.items())))
def all_contracts(spark, sf):
    """Every table contract against what its plan makes: columns, types, rows, and a first column that is never null."""
    parts = []
    for name, frame in _contract_frames(spark, sf).items():
        kept = conform(assert_schema(frame, CONTRACTS[name]), CONTRACTS[name])
        parts.append(kept.groupBy(F.lit(name).alias("contract"), F.lit(len(kept.columns)).alias("n_columns")).agg(
            F.count(F.lit(1)).alias("row_count"), F.count(kept.columns[0]).alias("keyed_rows")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("Q1_recon_stored_layers", B.with_ctes(M.APPLICATION_LOG, body="""
SELECT 'bronze.document_cdc' AS dataset, count(*) AS row_count FROM orders
UNION ALL SELECT 'silver.document', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'silver.application_event', count(*) FROM log
UNION ALL SELECT 'silver.application', count(DISTINCT ho_so_id) FROM log"""))
def stored_layers(spark, sf):
    """Rows of the stored tables of two layers, after Silver was built from Bronze."""
    (bronze_name, at), prefix = B.new_table(spark, "document_cdc"), B.new_table(spark, "silver")[0]
    change = B.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("D "), "o_orderkey").alias("name"), F.lit("HS_1").alias("Applicationid"),
        F.lit("u").alias("file_url"), F.lit(2).alias("Document_Typeid"), F.lit("c").alias("op"),
        F.lit(P.INGESTED).cast("timestamp").alias("ingested_at"), F.col("o_orderkey").cast("bigint").alias("kafka_offset"))
    tables.append_partitioned(change, bronze_name, location=at)
    silver.build_silver({"document_cdc": spark.table(bronze_name)}, {}, lambda t: f"{prefix}_{t}")
    log = f"{prefix}_application_event"
    tables.append_new_only(M.application_log(spark, sf), log, "event_id", bucket_by="ho_so_id", buckets=8)
    tables.upsert_current_state(silver.application_current(tables.fresh(spark, log)), f"{prefix}_application", "ho_so_id", buckets=8)
    return quality.recon_counts({
        "bronze.document_cdc": tables.fresh(spark, bronze_name),
        **{f"silver.{t}": tables.fresh(spark, f"{prefix}_{t}") for t in ("document", "application_event", "application")}})
