"""XML packets, landed payments, change envelopes and the silver entities built on them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from caseledger.functions import columns as C
from caseledger.functions.packets import REASONS

from caseledger.plans import bronze, silver
from caseledger.schemas import CDC_ROWS, DOCUMENT_ITEM, PAYMENT_TRANSACTIONS, conform
from caseledger.session import materialize, scratch_path
from caseledger.sources import readers, tables
from caseledger.streaming import cdc
from workloads import bindings as B
from workloads.registry import query

INGESTED = datetime(2024, 3, 1, 8, 0)
LONG_AGO = "yyyy-MM-dd HH:mm:ss"
PER_FILE = 250


def tag(name, *content):
    return F.concat(F.lit(f"<{name}>"), *[c if not isinstance(c, str) else F.lit(c) for c in content],
                    F.lit(f"</{name}>"))


def _text(column):
    return F.col(column).cast("string")


def packet_text(col=F.col):
    """One well-formed packet of an order, whose columns ``col`` gives by name.

    Even orders have one status change (an object in the payload), odd ones two (an
    array); every fourth has no officer; every ninth is a delete without data.
    """
    number, key, customer = col("o_orderkey"), col("o_orderkey").cast("string"), col("o_custkey")
    at = F.date_format(col("o_orderdate"), LONG_AGO)
    metadata = tag("metadata", tag("ma_goi_tin", " PKG_", key, "\n"), tag("ma_du_lieu", "DL_HO_SO"),
                   tag("loai_du_lieu", "XML"), tag("ngay_cap_nhat", at),
                   tag("su_kien", F.when(number % 9 == 0, "DELETE").otherwise("INSERT")),
                   tag("id_ban_ghi", "HS_", key))

    def step(n):
        officer = F.when(number % 4 != 0, tag("Officerid", customer.cast("string"))).otherwise("")
        return F.concat(F.lit('<application_history action="INSERT">'),
                        tag("id", f"H{n}_", key), tag("Statusid", str(n)), tag("Statusid2", str(n + 1)),
                        officer, tag("action_time", at), F.lit("</application_history>"))

    steps = F.when(number % 2 == 0, step(1)).otherwise(F.concat(step(1), step(2)))
    document = F.concat(F.lit('<document action="INSERT">'), tag("id", "D_", key),
                        tag("name", "Đơn & tờ khai".replace("&", "&amp;")),
                        tag("file_url", "s3://docs/", key), tag("Document_Typeid", "2"),
                        F.lit("</document>"))
    payment = F.concat(F.lit('<payment action="INSERT">'), tag("amount", customer.cast("string")),
                       tag("method", "CARD"), tag("status", "success"),
                       tag("transaction_code", "T_", key), tag("paid_at", at), F.lit("</payment>"))
    data = F.when(number % 9 == 0, "<du_lieu/>").otherwise(tag(
        "du_lieu", tag("name", "Case ", key), tag("Applicantid", F.format_string("%06d", customer)),
        tag("Serviceid", F.substring(col("o_orderpriority"), 1, 1)), tag("Agencyid", ""),
        tag("created_at", at), tag("Statusid", "1"),
        tag("document_array", document), tag("payment_array", payment),
        tag("application_history_array", steps)))
    return F.concat(F.lit("<packet>"), metadata, data, F.lit("</packet>"))


def packets_of_orders(spark, sf):
    """One packet per order: ``o_orderkey`` and ``packet`` text."""
    return B.table(spark, sf, "orders").select("o_orderkey", packet_text().alias("packet"))


def files_of_packets(spark, sf):
    """Files of up to ``PER_FILE`` packets: ``no`` and ``body``. Orders are exchanged, not the texts made of them."""
    row = F.struct("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    grouped = B.table(spark, sf, "orders").groupBy(F.floor(F.col("o_orderkey") / PER_FILE).alias("no")).agg(F.collect_list(row).alias("orders"))
    packets = F.transform("orders", lambda order: packet_text(lambda name: order[name]))
    return grouped.select("no", F.concat(F.lit("<packets>"), F.array_join(packets, ""), F.lit("</packets>")).alias("body"))


def raw_rows(df, name, content):
    return df.select(content.alias("value"), name.alias("file_name"),
                     F.lit(INGESTED).cast("timestamp").alias("ingested_at"))


def cores(spark):
    return spark.sparkContext.defaultParallelism


def bronze_packets(spark, sf):
    """Accepted packets of one file per order."""
    files = raw_rows(packets_of_orders(spark, sf), _text("o_orderkey"), F.concat(
        F.lit("<?xml version='1.0' encoding='UTF-8'?>\n"), "packet"))
    return bronze.validate_packets(files, spread=cores(spark))[0]


def broken_files(spark, sf):
    """The same packets with one defect each, by the last digits of the key."""
    k = F.col("o_orderkey") % 11
    p = F.col("packet")
    value = (F.when(k == 1, F.regexp_replace(p, "(?s)<metadata>.*</metadata>", ""))
             .when(k == 2, F.regexp_replace(p, "(?s)<ma_goi_tin>.*</ma_goi_tin>", "<ma_goi_tin> </ma_goi_tin>"))
             .when(k == 3, F.regexp_replace(p, "<su_kien>.*</su_kien>", "<su_kien> PATCH </su_kien>"))
             .when(k == 4, F.regexp_replace(p, "<id_ban_ghi>.*</id_ban_ghi>", ""))
             .when(k == 5, F.regexp_replace(p, "(?s)<du_lieu.*</du_lieu>|<du_lieu/>", ""))
             .when(k == 6, F.regexp_replace(p, "</packet>", ""))
             .when(k == 7, F.lit("  \n"))
             .when(k == 8, F.lit("<root><item/></root>"))
             # a good packet followed by a bad one: the file is rejected whole
             .when(k == 9, F.concat(F.lit("<a><b>"), p, F.lit("</b>"), F.lit("<packet/></a>")))
             .otherwise(F.concat(F.lit("<a>"), p, F.lit("</a>"))))
    return raw_rows(packets_of_orders(spark, sf), _text("o_orderkey"), value)


def _reason(name):
    return "'" + REASONS[name].replace("'", "''") + "'"


@query("P1_P3_rejected_files", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS file_name, CASE o_orderkey % 11
  WHEN 1 THEN {_reason('no_metadata')} WHEN 2 THEN {_reason('no_packet_id')}
  WHEN 3 THEN {_reason('bad_event').replace('{event}', 'PATCH')} WHEN 4 THEN {_reason('no_record_id')}
  WHEN 5 THEN {_reason('no_data')} WHEN 6 THEN {_reason('malformed').replace('{detail}', '')}
  WHEN 7 THEN {_reason('empty')} WHEN 8 THEN {_reason('no_packet')} WHEN 9 THEN {_reason('no_metadata')} END
  AS error_reason FROM orders WHERE o_orderkey % 11 BETWEEN 1 AND 9""")
def rejected(spark, sf):
    """The position the parser adds to the text of malformed files is cut off here."""
    prefix = REASONS["malformed"].replace("{detail}", "")
    reason = F.when(F.col("error_reason").startswith(prefix), prefix).otherwise(F.col("error_reason"))
    return bronze.validate_packets(broken_files(spark, sf), spread=cores(spark))[1].select(
        "file_name", reason.alias("error_reason"))


@query("P1_P4_accepted_packets", """
SELECT 'PKG_' || o_orderkey AS ma_goi_tin, 'DL_HO_SO' AS ma_du_lieu, 'XML' AS loai_du_lieu,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ngay_cap_nhat,
       CASE WHEN o_orderkey % 9 = 0 THEN 'DELETE' ELSE 'INSERT' END AS su_kien,
       'HS_' || o_orderkey AS id_ban_ghi, CAST(o_orderkey AS VARCHAR) AS file_name
FROM orders WHERE o_orderkey % 11 IN (0, 10)""")
def accepted(spark, sf):
    return bronze.validate_packets(broken_files(spark, sf), spread=cores(spark))[0].drop("data_payload", "ingested_at")


@query("P2_xml_to_json", """
SELECT CAST(c_custkey AS VARCHAR) AS file_name,
  CASE WHEN c_custkey % 3 = 0 THEN '{"name": "' || c_name || '", "empty": null}'
       WHEN c_custkey % 3 = 1 THEN '{"tag": ["' || c_mktsegment || '", "b"], "nested": {"x": "007"}}'
       ELSE '{"item": {"@action": "INSERT", "#text": "' || c_name || '"}, "leer": {"@k": "1", "#text": null}}' END
  AS data_payload FROM customer""")
def xml_to_json(spark, sf):
    """Arrays, objects, attributes, empty leaves; numbers stay text."""
    customer = B.table(spark, sf, "customer")
    kind = F.col("c_custkey") % 3
    data = (F.when(kind == 0, F.concat(tag("name", F.col("c_name")), F.lit("<empty/>")))
            .when(kind == 1, F.concat(tag("tag", F.col("c_mktsegment")), F.lit("<tag>b</tag><nested><x>007</x></nested>")))
            .otherwise(F.concat(F.lit('<item action="INSERT">'), "c_name", F.lit('</item><leer k="1"/>'))))
    head = "<packet><metadata><ma_goi_tin>P</ma_goi_tin><su_kien>UPDATE</su_kien><id_ban_ghi>R</id_ban_ghi></metadata>"
    files = raw_rows(customer, _text("c_custkey"), F.concat(F.lit(head), tag("du_lieu", data), F.lit("</packet>")))
    return bronze.validate_packets(files)[0].select("file_name", "data_payload")


@query("K2_quarantine_pages", """
SELECT CAST(page_id AS VARCHAR) AS file_name, CAST(length(html) AS INTEGER) AS kept_chars FROM pages""")
def quarantine(spark, sf):
    """Web pages are no packets: each is kept whole, with a reason, as JSON."""
    path = scratch_path(spark, "quarantine")
    files = raw_rows(B.table(spark, sf, "pages"), _text("page_id"), F.col("html"))
    rejected_rows = bronze.validate_packets(files)[1]
    tables.write_quarantine(rejected_rows, path)
    back = readers.scan_quarantine(spark, path)
    return back.where(F.col("error_reason").isNotNull()).select(
        "file_name", F.char_length("raw_content").alias("kept_chars"))


@query("S2_C2_xml_landing_zone", """
SELECT CAST(o_orderkey // 250 AS BIGINT) AS file_no, count(*) AS packets,
       count(*) FILTER (WHERE o_orderkey % 9 = 0) AS deletes
FROM orders GROUP BY 1""")
def landing(spark, sf):
    """Files of up to 250 packets, three folders deep, through ingestion to Bronze."""
    zone = scratch_path(spark, "landing")
    files = files_of_packets(spark, sf).select(F.col("body").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(f"{zone}/2024/03/01")
    # The landing zone holds *.xml; Spark names compressed text files *.txt.gz, hence the pattern.
    files = readers.scan_raw_documents(spark, zone, "*.txt.gz")
    name, location = B.new_table(spark, "application_xml")
    tables.append_partitioned(bronze.validate_packets(files, stage=True)[0], name, location=location)
    number = F.floor(F.substring("id_ban_ghi", 4, 20).cast("long") / PER_FILE)
    return spark.table(name).groupBy(number.alias("file_no")).agg(
        F.count(F.lit(1)).alias("packets"), F.count_if(F.col("su_kien") == "DELETE").alias("deletes"))


@query("P5_parse_collection", """
SELECT 'HS_' || o_orderkey AS id_ban_ghi, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS items
FROM orders WHERE o_orderkey % 9 <> 0""")
def collection(spark, sf):
    parsed = silver.parse_collection(bronze_packets(spark, sf),
                                     "$.application_history_array.application_history",
                                     silver.HISTORY_ITEM)
    return parsed.select("id_ban_ghi", F.size("items").alias("items"))


@query("P6_explode_documents", """
SELECT 'HS_' || o_orderkey AS ho_so_id, 'D_' || o_orderkey AS id, 'Đơn & tờ khai' AS name
FROM orders WHERE o_orderkey % 9 <> 0""")
def documents_exploded(spark, sf):
    return silver.explode_items(bronze_packets(spark, sf), "$.document_array.document", DOCUMENT_ITEM,
                                [F.col("id_ban_ghi").alias("ho_so_id")]).select(
        "ho_so_id", "item.id", "item.name")


@query("F4_canonical_projection", """
SELECT 'XML_PKG_' || o_orderkey AS event_id, 'HS_' || o_orderkey AS ho_so_id,
  CASE WHEN o_orderkey % 9 <> 0 THEN 'Case ' || o_orderkey END AS ten_ho_so,
  CASE WHEN o_orderkey % 9 <> 0 THEN printf('%06d', o_custkey) END AS applicant_id,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS dv_cong_id,
  CAST(NULL AS INTEGER) AS co_quan_id, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS created_at,
  CAST(CASE WHEN o_orderkey % 9 <> 0 THEN 1 END AS INTEGER) AS trang_thai_id, o_orderdate AS event_time,
  o_orderkey % 9 = 0 AS da_bi_xoa, CAST(1 AS INTEGER) AS source_priority FROM orders""")
def canonical(spark, sf):
    return silver.application_from_xml(bronze_packets(spark, sf))


# --- change envelopes -------------------------------------------------------------------

def order_changes(spark, sf):
    """Orders as change records of applications: creates, updates, reads and deletes."""
    key = F.col("o_orderkey")
    micros = F.unix_micros("o_orderdate") + 123456
    after = F.struct(_text("o_orderkey").alias("id"), F.concat(F.lit("Case "), key).alias("name"),
                     micros.alias("created_at"), _text("o_custkey").alias("Applicantid"),
                     F.lit(3).alias("Statusid"),
                     F.substring("o_orderpriority", 1, 1).cast("int").alias("Serviceid"),
                     (key % 25).cast("int").alias("Agencyid"),
                     (micros + 3_600_000_000).alias("updated_at"))
    op = F.element_at(F.array(*[F.lit(o) for o in "curd"]), (key % 4 + 1).cast("int"))
    before = F.when(op.isin("u", "d"), after.withField("Statusid", F.lit(2))
                    .withField("updated_at", micros))
    payload = F.struct(before.alias("before"), F.when(op != "d", after).alias("after"),
                       F.struct((F.unix_millis("o_orderdate") + 5).alias("ts_ms"),
                                key.alias("txId")).alias("source"),
                       op.alias("op"))
    return B.table(spark, sf, "orders").select(
        F.to_json(F.struct(payload.alias("payload"))).alias("json_value"),
        (F.col("o_orderdate") + B.seconds(F.lit(60))).alias("kafka_timestamp"),
        (key % 3).cast("int").alias("kafka_partition"), key.alias("kafka_offset"))


@query("P7_parse_cdc", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Case ' || o_orderkey AS name,
       o_orderdate + INTERVAL 123456 MICROSECOND AS created_at, CAST(o_custkey AS VARCHAR) AS Applicantid,
       CAST(3 AS INTEGER) AS Statusid, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS Serviceid,
       CAST(o_orderkey % 25 AS INTEGER) AS Agencyid,
       o_orderdate + INTERVAL 3600123456 MICROSECOND AS updated_at,
       CASE o_orderkey % 4 WHEN 0 THEN 'c' ELSE 'u' END AS op
FROM orders WHERE o_orderkey % 4 < 2""")
def parse_cdc(spark, sf):
    return cdc.parse_cdc(order_changes(spark, sf), CDC_ROWS["application"]).drop("ingested_at")


@query("P7_parse_cdc_all_operations", """
SELECT CAST(o_orderkey AS VARCHAR) AS ho_so_id, o_orderkey % 4 = 3 AS da_bi_xoa,
       CAST(CASE WHEN o_orderkey % 4 = 3 THEN 2 ELSE 3 END AS INTEGER) AS trang_thai_id FROM orders""")
def parse_cdc_all(spark, sf):
    """Snapshot reads and deletes too: a delete keeps its before image and sets the flag."""
    rows = cdc.parse_cdc(order_changes(spark, sf), CDC_ROWS["application"], ("c", "u", "r", "d"))
    return silver.application_from_cdc(rows).select("ho_so_id", "da_bi_xoa", "trang_thai_id")


@query("P8_P9_parse_cdc_before_after", """
SELECT CAST(o_orderkey AS VARCHAR) AS ho_so_id,
       CAST(CASE WHEN o_orderkey % 4 = 1 THEN 2 END AS INTEGER) AS app_before_status_id,
       CAST(3 AS INTEGER) AS app_after_status_id,
       CASE WHEN o_orderkey % 4 = 1 THEN o_orderdate + INTERVAL 123456 MICROSECOND END AS app_before_updated_at,
       o_orderdate + INTERVAL 5 MILLISECOND AS app_event_time, o_orderkey AS application_kafka_offset
FROM orders WHERE o_orderkey % 4 < 2""")
def parse_before_after(spark, sf):
    return cdc.application_changes(order_changes(spark, sf), CDC_ROWS["application"]).select(
        "ho_so_id", "app_before_status_id", "app_after_status_id", "app_before_updated_at",
        "app_event_time", "application_kafka_offset")


@query("F14_not_null_stream_keys", """
SELECT 'H' || event_id AS id, CAST(user_id AS VARCHAR) AS ho_so_id FROM events
WHERE event_id % 6 <> 0 AND event_id % 10 <> 0""")
def not_null_keys(spark, sf):
    """History inserts without an id or a case are left out."""
    e = F.col("event_id")
    row = F.struct(F.when(e % 6 != 0, F.concat(F.lit("H"), e)).alias("id"),
                   F.when(e % 10 != 0, _text("user_id")).alias("Applicationid"))
    records = B.table(spark, sf, "events").select(
        F.to_json(F.struct(F.struct(row.alias("after"), F.lit("c").alias("op")).alias("payload")))
        .alias("json_value"), F.col("ts").alias("kafka_timestamp"),
        F.lit(0).alias("kafka_partition"), e.alias("kafka_offset"))
    return cdc.history_changes(records, CDC_ROWS["application_history"]).select(
        "id", F.col("h_ho_so_id").alias("ho_so_id"))


# --- silver entities on parsed input ------------------------------------------------------

def land_payments(spark, sf, zone):
    """Events as JSON arrays of up to 500 payments per file."""
    row = F.struct(F.concat(F.lit("HS_"), "event_id").alias("id_ban_ghi"),
                   F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS")
                   .alias("payment_status"), F.concat(F.lit("TAX"), "event_id").alias("tax_code"),
                   F.floor("value").cast("double").alias("amount"), F.lit("QR").alias("method"),
                   F.date_format("ts", LONG_AGO).alias("timestamp"),
                   F.unix_millis("ts").alias("ingested_at"))
    (B.table(spark, sf, "events").groupBy(F.floor(F.col("event_id") / 500).alias("file_no"))
     .agg(F.to_json(F.collect_list(row)).alias("value")).select("value")
     .write.option("maxRecordsPerFile", 1).text(zone))


def api_payments(spark, sf):
    """The landed payments, read back."""
    zone = scratch_path(spark, "api")
    land_payments(spark, sf, zone)
    return conform(readers.scan_api_payments(spark, zone), PAYMENT_TRANSACTIONS)


@query("S3_C3_api_payments", """
SELECT 'HS_' || event_id AS id_ban_ghi, 'TAX' || event_id AS tax_code, floor(value) AS amount,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
       date_trunc('millisecond', ts) AS ingested_at FROM events""")
def api(spark, sf):
    name, location = B.new_table(spark, "payment_transactions")
    tables.append_partitioned(api_payments(spark, sf), name, location=location)
    return spark.table(name).select("id_ban_ghi", "tax_code", "amount", "timestamp", "ingested_at")


@query("C7_silver_history", """
SELECT 'H' || n || '_' || o_orderkey AS history_id, 'HS_' || o_orderkey AS ho_so_id,
       CAST(n AS INTEGER) AS trang_thai_truoc_id, CAST(n + 1 AS INTEGER) AS trang_thai_id,
       CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE CAST(o_custkey AS INTEGER) END AS can_bo_id,
       o_orderdate AS action_time FROM orders, generate_series(1, 2) t(n)
WHERE o_orderkey % 9 <> 0 AND (n = 1 OR o_orderkey % 2 = 1)
UNION ALL
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey), CAST(l_orderkey AS VARCHAR),
       l_linenumber, l_linenumber + 1,
       CASE WHEN l_suppkey % 10 = 0 THEN -1 ELSE CAST(l_suppkey AS INTEGER) END,
       l_shipdate + to_seconds(l_partkey * 977 % 86400) FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                           ORDER BY l_shipdate DESC) = 1""")
def silver_history(spark, sf):
    change = B.history(spark, sf).select(
        F.col("history_id").alias("id"), F.col("ho_so_id").alias("Applicationid"),
        F.col("trang_thai_truoc_id").alias("Statusid"), F.col("trang_thai_id").alias("Statusid2"),
        F.when(F.col("can_bo_id") != -1, F.col("can_bo_id")).alias("Officerid"), "action_time",
        F.lit(None).cast("string").alias("note"), F.col("action_time").alias("ingested_at"))
    return silver.history(bronze_packets(spark, sf), change).drop("note", "source_ingested_at")


@query("C8_silver_document", """
SELECT 'D_' || o_orderkey AS document_id, 'HS_' || o_orderkey AS ho_so_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'new' ELSE 'Đơn & tờ khai' END AS ten_tai_lieu,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN 4 ELSE 2 END AS INTEGER) AS loai_tai_lieu_id
FROM orders WHERE o_orderkey % 9 <> 0""")
def silver_document(spark, sf):
    """A later change record replaces the document of the packet."""
    newer = (B.table(spark, sf, "orders").where("o_orderkey % 5 = 0 AND o_orderkey % 9 <> 0").select(
        F.concat(F.lit("D_"), "o_orderkey").alias("id"),
        F.concat(F.lit("HS_"), "o_orderkey").alias("Applicationid"), F.lit("new").alias("name"),
        F.lit("u").alias("file_url"), F.lit(4).alias("Document_Typeid"),
        F.lit(INGESTED).cast("timestamp").alias("ingested_at")))
    return silver.document(bronze_packets(spark, sf), newer).select(
        "document_id", "ho_so_id", "ten_tai_lieu", "loai_tai_lieu_id")


@query("C8_document_tombstones", """
SELECT 'D_' || o_orderkey AS document_id, 'HS_' || o_orderkey AS ho_so_id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'back' ELSE 'Đơn & tờ khai' END AS ten_tai_lieu
FROM orders WHERE o_orderkey % 9 <> 0 AND (o_orderkey % 4 <> 0 OR o_orderkey % 7 = 0)""")
def document_tombstones(spark, sf):
    """Deleted documents stay away although their inserts arrive again, unless a newer one comes."""
    packets = materialize(bronze_packets(spark, sf))
    number = F.substring("id_ban_ghi", 4, 20).cast("long")

    def later(rows, days, action, name):
        at = F.date_format(F.col("ngay_cap_nhat").cast("timestamp") + B.days(F.lit(days)), LONG_AGO)
        item = F.struct(F.lit(action).alias("@action"), F.concat(F.lit("D_"), number.cast("string")).alias("id"), name.alias("name"))
        payload = F.to_json(F.struct(F.struct(item.alias("document")).alias("document_array")))
        return rows.withColumns({"ngay_cap_nhat": at, "data_payload": payload, "ma_goi_tin": F.concat("ma_goi_tin", F.lit(action))})
    living = packets.where(number % 9 != 0)
    gone = later(living.where(number % 4 == 0), 2, "DELETE", F.lit(None).cast("string"))
    back = later(living.where(number % 7 == 0), 3, "INSERT", F.lit("back"))
    name, location = B.new_table(spark, "document")
    # Two batches arrive twice: their changes are taken out of the payloads once.
    first, second, third = (materialize(silver.document_versions(batch, None), "versions") for batch in (packets, gone, back))
    for batch in (first, second, third, first, second):
        tables.upsert_current_state(batch, name, "document_id", silver.VERSION, buckets=8, location=location)
    return silver.live(tables.fresh(spark, name)).select("document_id", "ho_so_id", "ten_tai_lieu")


@query("C9_silver_payment", """
SELECT 'T_' || o_orderkey AS ma_giao_dich, 'HS_' || o_orderkey AS ho_so_id,
       CAST(o_custkey AS DOUBLE) AS so_tien, 'success' AS trang_thai_tt, o_orderdate AS thoi_gian_tt,
       'XML_MOT_CUA' AS nguon_du_lieu FROM orders WHERE o_orderkey % 9 <> 0
UNION ALL
SELECT 'API_TAX' || event_id, 'HS_' || event_id, floor(value),
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END, date_trunc('second', ts),
       'API_THANH_TOAN' FROM events""")
def silver_payment(spark, sf):
    return silver.payment(bronze_packets(spark, sf), api_payments(spark, sf)).drop("phuong_thuc")


@query("C6_application_from_sources", """
SELECT 'HS_' || o_orderkey AS ho_so_id, CASE WHEN o_orderkey % 9 <> 0 THEN 'Case ' || o_orderkey END AS ten_ho_so,
       CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderkey % 25 AS INTEGER) END AS co_quan_id,
       CAST(CASE WHEN o_orderkey % 4 < 2 THEN 3 WHEN o_orderkey % 9 <> 0 THEN 1 END AS INTEGER) AS trang_thai_id,
       o_orderkey % 4 >= 2 AND o_orderkey % 9 = 0 AS da_bi_xoa
FROM orders WHERE NOT (o_orderkey % 9 = 0 AND o_orderkey % 4 < 2)
UNION ALL
SELECT 'HS_' || o_orderkey, 'Case ' || o_orderkey, CAST(o_orderkey % 25 AS INTEGER), 3, FALSE
FROM orders WHERE o_orderkey % 9 = 0 AND o_orderkey % 4 < 2""")
def application_from_sources(spark, sf):
    """Packets first, change records of the same cases an hour later, everything twice."""
    rows = cdc.parse_cdc(order_changes(spark, sf), CDC_ROWS["application"])
    rows = rows.withColumn("id", C.prefixed_key("HS_", "id"))
    packets = materialize(bronze_packets(spark, sf))  # read four times: twice in each of two batches
    events = silver.application_events(packets.unionByName(packets), rows.unionByName(rows))
    name, location = B.new_table(spark, "application_event")
    tables.append_new_only(events, name, "event_id", location=location)
    tables.append_new_only(events, name, "event_id")
    return silver.application_current(spark.table(name)).select(
        "ho_so_id", "ten_ho_so", "co_quan_id", "trang_thai_id", "da_bi_xoa")
