import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caseledger.functions.packets import REASONS
from caseledger.plans import bronze, silver
from caseledger.schemas import APPLICATION_XML, CDC_ROWS, QUARANTINE
from caseledger.sources import readers, tables
from caseledger.streaming import cdc
from tests.conftest import rows

T = datetime(2024, 1, 1)
META = "<metadata><ma_goi_tin> {p} </ma_goi_tin><su_kien>{e}</su_kien><id_ban_ghi>{r}</id_ban_ghi>{more}</metadata>"


def packet(p="P1", e="INSERT", r="HS_1", data="<du_lieu/>", more=""):
    return f"<packet>{META.format(p=p, e=e, r=r, more=more)}{data}</packet>"


def validate(spark, *texts):
    raw = spark.createDataFrame([(t, f"f{i}", T) for i, t in enumerate(texts)],
                                "value string, file_name string, ingested_at timestamp")
    return bronze.validate_packets(raw)


GOOD = packet()
REJECTED = [
    ("", REASONS["empty"]), (None, REASONS["empty"]), ("  \n\t ", REASONS["empty"]),
    ("<packet><metadata>", REASONS["malformed"].split("{")[0]),
    (GOOD + "trailing", REASONS["malformed"].split("{")[0]),
    ("<root><item/></root>", REASONS["no_packet"]),
    ("<packet><du_lieu/></packet>", REASONS["no_metadata"]),
    (packet(p="  "), REASONS["no_packet_id"]),
    (packet(e="PATCH"), REASONS["bad_event"].format(event="PATCH")),
    (packet(e=""), REASONS["bad_event"].format(event="")),
    (packet(r=" "), REASONS["no_record_id"]),
    (packet(data=""), REASONS["no_data"]),
    (f"<a>{GOOD}{packet(r='')}</a>", REASONS["no_record_id"]),
    # The first broken rule of the first broken packet is reported.
    (packet(p="", e="PATCH"), REASONS["no_packet_id"]),
]


@pytest.mark.parametrize("chunk", [REJECTED])
def test_every_rejection_rule(spark, chunk):
    good, bad = validate(spark, *[text for text, _ in chunk])
    assert good.count() == 0 and bad.schema == QUARANTINE
    reasons = {r["file_name"]: r for r in bad.collect()}
    for i, (text, reason) in enumerate(chunk):
        assert reasons[f"f{i}"]["error_reason"].startswith(reason), text
        assert reasons[f"f{i}"]["raw_content"] == text


def test_accepted_layouts(spark):
    good, bad = validate(
        spark, GOOD, "<?xml version='1.0' encoding='UTF-8'?>\n" + packet(p="P2"),
        f"<a><b>{packet(p='P3')}</b><c><d>{packet(p='P4')}</d></c></a>")
    assert bad.count() == 0 and good.schema == APPLICATION_XML
    assert rows(good, "ma_goi_tin", "file_name") == [("P1", "f0"), ("P2", "f1"), ("P3", "f2"), ("P4", "f2")]


def test_payload_shapes(spark):
    data = ("<du_lieu><a>007</a><b k='1'>t</b><c/><d>1</d><d>2</d><e><f>x</f></e><g k='2'/>"
            "<n>Nguyễn &amp; Trần</n></du_lieu>")
    good, _ = validate(spark, packet(data=data), packet(p="D", e="DELETE"))
    found = {r["ma_goi_tin"]: json.loads(r["data_payload"]) for r in good.collect()}
    assert found["P1"] == {"a": "007", "b": {"@k": "1", "#text": "t"}, "c": None, "d": ["1", "2"],
                           "e": {"f": "x"}, "g": {"@k": "2", "#text": None}, "n": "Nguyễn & Trần"}
    assert found["D"] is None
    assert good.where("ma_goi_tin = 'P1' AND data_payload LIKE '%Nguyễn%'").count() == 1


def test_files_are_parsed_once(spark):
    good, _ = validate(spark, GOOD)
    assert good._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_landing_zone_to_tables(spark, name, folder):
    import pathlib
    deep = pathlib.Path(folder, "raw", "2024", "01", "02")
    deep.mkdir(parents=True)
    (deep / "a.xml").write_text(GOOD, encoding="utf-8")
    (deep / "b.xml").write_text("<oops>", encoding="utf-8")
    (deep / "c.txt").write_text("not xml", encoding="utf-8")
    t = name("application_xml")
    bronze.ingest_xml(spark, f"{folder}/raw", t, f"{folder}/quarantine")
    assert rows(spark.table(t), "ma_goi_tin") == [("P1",)]
    assert spark.table(t).first()["file_name"].endswith("a.xml")
    kept = spark.read.json(f"{folder}/quarantine")
    assert rows(kept, "raw_content") == [("<oops>",)]
    assert set(kept.columns) == {"file_name", "raw_content", "error_reason", "ingested_at"}


def test_api_payments(spark, name, folder):
    import pathlib
    pathlib.Path(folder, "api").mkdir()
    pathlib.Path(folder, "api", "call.json").write_text(json.dumps([
        {"id_ban_ghi": "HS_1", "payment_status": "SUCCESS", "tax_code": "9", "amount": 50000, "method": "QR",
         "timestamp": "2024-01-01 10:00:00", "ingested_at": 1704103200123}] * 2), encoding="utf-8")
    t = name("payments")
    bronze.ingest_api_payments(spark, f"{folder}/api", t)
    assert spark.table(t).count() == 2
    row = spark.table(t).first()
    assert row["ingested_at"] == datetime(2024, 1, 1, 10, 0, 0, 123000) and row["file_name"].endswith("call.json")
    paid = silver.payment(None, spark.table(t))
    assert rows(paid, "ma_giao_dich", "so_tien") == [("API_9", 50000.0)]


def bronze_row(p, event, data, at="2024-01-01 00:00:00", r="HS_1"):
    return (p, "", "", at, event, r, json.dumps(data) if data is not None else "null", "f", T + timedelta(days=9))


def xml_frame(spark, *packets):
    return spark.createDataFrame(list(packets), APPLICATION_XML)


FULL = {"name": "A", "Applicantid": "007", "Serviceid": "1", "Agencyid": "2", "created_at": "2024-01-01 00:00:00",
        "Statusid": "1"}


def test_partial_update_keeps_attributes_and_delete_is_revived(spark):
    events = silver.application_events(xml_frame(
        spark, bronze_row("P1", "INSERT", FULL), bronze_row("P2", "UPDATE", {"Statusid": "3"}, "2024-01-02 00:00:00"),
        bronze_row("P3", "DELETE", None, "2024-01-03 00:00:00")), None)
    row = silver.application_current(events).first()
    assert (row["ten_ho_so"], row["trang_thai_id"], row["applicant_id"], row["da_bi_xoa"]) == ("A", 3, "007", True)
    later = events.unionByName(silver.application_from_xml(xml_frame(
        spark, bronze_row("P4", "UPDATE", {"Statusid": "4"}, "2024-01-04 00:00:00"))))
    row = silver.application_current(later).first()
    assert (row["ten_ho_so"], row["trang_thai_id"], row["da_bi_xoa"]) == ("A", 4, False)


def test_equal_times_prefer_the_change_stream_and_packets_enter_once(spark):
    rows_cdc = spark.createDataFrame([("HS_1", "B", None, None, 5, None, None, T)],
        "id string, name string, created_at timestamp, Applicantid string, Statusid int, Serviceid int, Agencyid int, updated_at timestamp"
        ).withColumn("ingested_at", F.col("updated_at"))
    packets = xml_frame(spark, bronze_row("P1", "INSERT", FULL))
    events = silver.application_events(packets.unionByName(packets), rows_cdc)
    assert events.count() == 2
    row = silver.application_current(events).first()
    assert (row["ten_ho_so"], row["trang_thai_id"], row["dv_cong_id"]) == ("B", 5, 1)


def test_missing_business_time_falls_back_to_ingest_time(spark):
    events = silver.application_events(xml_frame(spark, bronze_row("P1", "INSERT", FULL, at="")), None)
    assert events.first()["event_time"] == T + timedelta(days=9)


def test_one_item_and_many_items(spark):
    one = {"application_history_array": {"application_history": {"id": "H1", "Statusid": "1", "Statusid2": "2",
           "Officerid": "x", "action_time": "2024-01-01 08:00:00"}}}
    many = {"application_history_array": {"application_history": [
        {"id": "H2", "Statusid2": "3", "Officerid": "7", "action_time": "bad"}, {"id": "H3"}]}}
    got = silver.history(xml_frame(spark, bronze_row("P1", "INSERT", one), bronze_row("P2", "INSERT", many),
                                   bronze_row("P3", "INSERT", {"application_history_array": None}),
                                   bronze_row("P4", "DELETE", None)), None)
    assert rows(got, "history_id", "trang_thai_id", "can_bo_id", "action_time") == [
        ("H1", 2, -1, datetime(2024, 1, 1, 8)), ("H2", 3, 7, None), ("H3", None, -1, None)]


def test_applicant_drops_secrets(spark):
    df = spark.createDataFrame([("1", "a", "m", "p", "pw", T, T), ("1", "b", "m", None, "pw", T + timedelta(1), T)],
                               "id string, name string, email string, phone string, password string, updated_at timestamp, ingested_at timestamp")
    safe = silver.applicant(df).first()
    assert "password" not in safe and safe["name"] == "b" and len(safe["email"]) == 64 and safe["phone"] is None
    assert silver.applicant(df, (), ()).first()["password"] == "pw"


def test_master_conflict_stops(spark):
    df = spark.createDataFrame([(1, " a ", T, "f", "S1"), (1, "b", T + timedelta(1), "f", "S2"), (1, "c", T + timedelta(1), "f", "S2")],
                               "id int, name string, ingested_at timestamp, file_name string, snapshot_id string")
    with pytest.raises(ValueError):
        silver.master_latest(df)
    ok = silver.master_latest(df.where("name <> 'c'"))
    assert rows(ok) == [(1, "b", T + timedelta(1), "S2")]


def envelope(spark, *payloads):
    return spark.createDataFrame([(json.dumps({"payload": p}), T, 0, i) for i, p in enumerate(payloads)],
                                 "json_value string, kafka_timestamp timestamp, kafka_partition int, kafka_offset long")


def test_operations_of_the_change_stream(spark):
    row = {"id": "1", "updated_at": 1704067200123456}
    records = envelope(spark, {"after": row, "op": "c"}, {"after": row, "op": "r"}, {"before": row, "after": None, "op": "d"},
                       {"after": row, "op": "u"})
    flat = cdc.parse_cdc(records, CDC_ROWS["application"])
    assert rows(flat, "op") == [("c",), ("u",)]
    assert flat.first()["updated_at"] == datetime(2024, 1, 1, 0, 0, 0, 123456)
    everything = cdc.parse_cdc(records, CDC_ROWS["application"], ("c", "u", "r", "d"))
    assert rows(everything, "id", "op") == [("1", "c"), ("1", "d"), ("1", "r"), ("1", "u")]


def test_build_silver_twice_gives_the_same_tables(spark, name):
    prefix = name("silver")
    items = {**FULL, "document_array": {"document": {"id": "D1", "name": "d", "Document_Typeid": "2"}},
             "payment_array": {"payment": {"transaction_code": "T1", "amount": "5", "status": "success",
                                           "paid_at": "2024-01-01 09:00:00"}},
             "application_history_array": {"application_history": {"id": "H1", "Statusid2": "2",
                                                                   "action_time": "2024-01-01 08:00:00"}}}
    inputs = {"application_xml": xml_frame(spark, bronze_row("P1", "INSERT", items),
                                           bronze_row("P2", "UPDATE", {"Statusid": "2"}, "2024-01-02 00:00:00"))}
    states = []
    for _ in range(2):
        silver.build_silver(inputs, {}, lambda t: f"{prefix}_{t}")
        states.append([rows(spark.table(f"{prefix}_{t}")) for t in
                       ("application_event", "application", "application_history", "document", "payment")])
    assert states[0] == states[1]
    assert [len(s) for s in states[0]] == [2, 1, 1, 1, 1]
    assert tables.partition_columns(spark, f"{prefix}_application_history") == ["action_date"]
    assert readers.read_optional(spark, f"{prefix}_applicant") is None


def _document(action, name_, **more):
    return {"document_array": {"document": {"@action": action, "id": "D1", **({"name": name_} if name_ else {}), **more}}}


def test_a_deleted_document_stays_away_and_a_newer_one_comes_back(spark, name):
    prefix = name("silver")
    insert = xml_frame(spark, bronze_row("P1", "INSERT", {**FULL, **_document("INSERT", "first")}, "2024-01-01 08:00:00"))
    delete = xml_frame(spark, bronze_row("P2", "UPDATE", _document("DELETE", None), "2024-01-02 08:00:00"))
    again = xml_frame(spark, bronze_row("P3", "UPDATE", _document("INSERT", "second"), "2024-01-03 08:00:00"))

    def after(*batches):
        for batch in batches:
            silver.build_silver({"application_xml": batch}, {}, lambda t: f"{prefix}_{t}")
        return rows(silver.live(tables.fresh(spark, f"{prefix}_document")), "document_id", "ten_tai_lieu")
    assert after(insert) == [("D1", "first")]
    assert after(delete) == [] and after(insert, delete) == []      # an older insert does not revive it
    assert after(again) == [("D1", "second")] and after(delete, insert) == [("D1", "second")]
    assert rows(silver.document(insert.union(delete), None)) == [] and silver.document(insert.union(delete).union(again), None).count() == 1


def test_replayed_batches_of_documents_and_applicants_change_nothing(spark, name):
    prefix = name("silver")
    doc = "id string, name string, Applicationid string, file_url string, Document_Typeid int, op string, ingested_at timestamp, kafka_offset long"
    person = "id string, name string, email string, phone string, password string, updated_at timestamp, ingested_at timestamp, kafka_offset long"
    at = lambda d: datetime(2024, 1, d)
    old = {"document_cdc": spark.createDataFrame([("D1", "old", "HS_1", "u", 1, "c", at(1), 5)], doc),
           "applicant_cdc": spark.createDataFrame([("A1", "old", "e", "p", "s", at(1), at(1), 5)], person)}
    # The newer rows of one micro-batch share its time; their place in the topic orders them.
    new = {"document_cdc": spark.createDataFrame([("D1", "newer", "HS_1", "u", 1, "u", at(2), 7), ("D1", "new", "HS_1", "u", 1, "u", at(2), 6)], doc),
           "applicant_cdc": spark.createDataFrame([("A1", "new", "e", "p", "s", at(2), at(2), 6), ("A1", "newer", "e", "p", "s", at(2), at(2), 7)], person)}
    for batch in (old, new, old, new, old):
        silver.build_silver(batch, {}, lambda t: f"{prefix}_{t}")
    assert rows(silver.live(tables.fresh(spark, f"{prefix}_document")), "document_id", "ten_tai_lieu") == [("D1", "newer")]
    stored = tables.fresh(spark, f"{prefix}_applicant")
    assert rows(stored, "id", "name") == [("A1", "newer")] and "password" not in stored.columns
    gone = {"document_cdc": spark.createDataFrame([("D1", "newer", "HS_1", "u", 1, "d", at(3), 9)], doc)}
    for batch in (gone, new):
        silver.build_silver(batch, {}, lambda t: f"{prefix}_{t}")
    assert silver.live(tables.fresh(spark, f"{prefix}_document")).count() == 0


def test_history_of_one_instant_is_ordered_by_its_place_in_the_topic(spark):
    schema = "id string, Applicationid string, Statusid int, Statusid2 int, Officerid int, action_time timestamp, note string, ingested_at timestamp, kafka_offset long"
    moved = spark.createDataFrame([("H1", "HS_1", 1, n, 1, T, f"n{n}", T, n) for n in (3, 9, 4)], schema)
    assert rows(silver.history(None, moved), "history_id", "trang_thai_id") == [("H1", 9)]
    assert rows(silver.history(None, moved.drop("kafka_offset")), "history_id") == [("H1",)]


def test_python_workers_take_few_files_at_once(spark):
    from pyspark.sql import functions as F
    raw = spark.range(0, 3 * bronze.FILES_AT_ONCE, 1, 1).select(
        F.lit("<packet/>").alias("value"), F.col("id").cast("string").alias("file_name"), F.current_timestamp().alias("ingested_at"))
    assert bronze.validate_packets(raw)[1].count() == 3 * bronze.FILES_AT_ONCE
    sizes = F.pandas_udf(lambda ids: ids * 0 + len(ids), "long")
    assert raw.select(F.max(sizes(F.col("file_name").cast("long")))).first()[0] <= bronze.FILES_AT_ONCE
