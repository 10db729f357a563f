"""Table contracts. Names and types are fixed values shared with existing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructType, TimestampType)

_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(),
          "double": DoubleType(), "boolean": BooleanType(), "date": DateType(),
          "timestamp": TimestampType()}


def _schema(fields: str) -> StructType:
    """``name type, ...`` without needing a running session at import time."""
    schema = StructType()
    for field in fields.split(", "):
        name, kind = field.split()
        schema = schema.add(name, _TYPES[kind])
    return schema


_VERSION_COLUMNS = ("effective_from_ts timestamp, effective_to_ts timestamp, "
                    "is_current boolean, source_snapshot_id string")

# --- rows that arrive -----------------------------------------------------------

MASTER_TABLES = ("Province", "Ward", "Status", "Service", "Agency", "Role", "Permission",
                 "Document_Type", "Officer", "Officer_Role")

API_PAYMENT_RAW = _schema(
    "id_ban_ghi string, payment_status string, tax_code string, amount double, "
    "method string, timestamp string, ingested_at bigint")

CDC_ROWS = {
    "application": _schema(
        "id string, name string, created_at bigint, Applicantid string, Statusid int, "
        "Serviceid int, Agencyid int, updated_at bigint"),
    "application_history": _schema(
        "id string, Applicationid string, Statusid int, Statusid2 int, Officerid int, "
        "action_time bigint, note string"),
    "document": _schema(
        "id string, name string, Applicationid string, file_url string, Document_Typeid int"),
    "applicant": _schema(
        "id string, identity_num string, name string, email string, phone string, "
        "password string, Provinceid int, Wardid int, updated_at bigint"),
}

HISTORY_ITEM = _schema("id string, Statusid string, Statusid2 string, Officerid string, "
                       "action_time string, note string")
DOCUMENT_ITEM = _schema("id string, name string, file_url string, Document_Typeid string, @action string")
PAYMENT_ITEM = _schema("amount string, method string, status string, "
                       "transaction_code string, paid_at string")



def _items(tag: str, schema: StructType) -> StructType:
    return StructType().add(tag, ArrayType(schema))


# The content of <du_lieu> as the sources declare it, in the order they write it.
PACKET_DATA = (
    _schema("name string, Applicantid string, Serviceid string, Agencyid string, "
            "created_at string, Statusid string")
    .add("document_array", _items("document", DOCUMENT_ITEM))
    .add("payment_array", _items("payment", StructType(
        _schema("@action string, id string").fields + PAYMENT_ITEM.fields)))
    .add("application_history_array", _items("application_history", StructType(
        _schema("@action string").fields + HISTORY_ITEM.fields))))

# --- Bronze -----------------------------------------------------------------------

PACKET = _schema("ma_goi_tin string, ma_du_lieu string, loai_du_lieu string, "
                 "ngay_cap_nhat string, su_kien string, id_ban_ghi string, data_payload string")
APPLICATION_XML = _schema(
    "ma_goi_tin string, ma_du_lieu string, loai_du_lieu string, ngay_cap_nhat string, "
    "su_kien string, id_ban_ghi string, data_payload string, file_name string, "
    "ingested_at timestamp")
QUARANTINE = _schema("file_name string, raw_content string, error_reason string, "
                     "ingested_at timestamp")
PAYMENT_TRANSACTIONS = _schema(
    "id_ban_ghi string, payment_status string, tax_code string, amount double, "
    "method string, timestamp string, file_name string, ingested_at timestamp")

# --- Gold and serving ---------------------------------------------------------------

DIM_CALENDAR = _schema(
    "thoi_gian_id int, ngay_date date, ngay int, thang int, quy int, nam int, "
    "co_phai_la_ngay_nghi boolean, stt_ngay_lam_viec int")
DIM_AGENCY = _schema("dim_co_quan_sk bigint, co_quan_id int, ten string, tinh string, "
                     "phuong string, " + _VERSION_COLUMNS)
DIM_STATUS = _schema("dim_trang_thai_sk bigint, trang_thai_id int, ma_trang_thai string, "
                     "ten_trang_thai string, " + _VERSION_COLUMNS)
DIM_OFFICER = _schema("dim_can_bo_sk bigint, can_bo_id int, ten string, vi_tri string, "
                      + _VERSION_COLUMNS)
DIM_SERVICE = _schema("dim_dich_vu_cong_sk bigint, dv_cong_id int, ten string, "
                      "thoi_han_tra_kq int, " + _VERSION_COLUMNS)
FACT_TRANSITIONS = _schema(
    "id string, ho_so_id string, co_quan_id int, trang_thai_id int, can_bo_id int, "
    "dv_cong_id int, thoi_gian_xu_ly double, tong_ngay_lam_viec_xu_ly int, thoi_gian_id int")
FACT_BACKLOG = _schema(
    "id bigint, ho_so_id string, trang_thai_id int, dim_trang_thai_sk bigint, co_quan_id int, "
    "dim_co_quan_sk bigint, can_bo_id int, dim_can_bo_sk bigint, dv_cong_id int, "
    "dim_dich_vu_cong_sk bigint, so_ngay_ton_dong_hien_tai int, tong_thoi_gian_da_xu_ly int, "
    "so_luong int, thoi_gian_id int")
FACT_AGENCY_DAY = _schema(
    "id bigint, co_quan_id int, dim_co_quan_sk bigint, so_luong_tiep_nhan int, "
    "so_luong_dung_han int, so_luong_tre_han int, so_luong_rework int, so_luong_ton_dong int, "
    "tong_chi_phi bigint, thoi_gian_id int")
SERVING_AGENCY = _schema("co_quan_id int, ten string, tinh string, phuong string")
SERVING_STATUS = _schema("trang_thai_id int, ma_trang_thai string, ten_trang_thai string")
SERVING_OFFICER = _schema("can_bo_id int, ten string, vi_tri string")
SERVING_SERVICE = _schema("dv_cong_id int, ten string, thoi_han_tra_kq int")
FACT_TRANSITION_STREAM = _schema(
    "ho_so_id string, id string, ten_ho_so string, applicant_id string, co_quan_id int, "
    "dv_cong_id int, trang_thai_truoc_id int, trang_thai_id int, can_bo_id int, "
    "created_at timestamp, previous_action_time timestamp, action_time timestamp, "
    "thoi_gian_xu_ly_seconds bigint, thoi_gian_xu_ly double, thoi_gian_id int, "
    "transaction_id string, application_event_time timestamp, history_event_time timestamp, "
    "kafka_event_time timestamp, fact_loaded_at timestamp, join_skew_ms bigint, "
    "kafka_to_fact_latency_ms bigint, source_to_fact_latency_ms bigint, "
    "application_kafka_partition int, application_kafka_offset bigint, "
    "history_kafka_partition int, history_kafka_offset bigint")

CONTRACTS = {
    "bronze.application_xml": APPLICATION_XML,
    "bronze.payment_transactions": PAYMENT_TRANSACTIONS,
    "gold.dim_thoi_gian": DIM_CALENDAR,
    "gold.dim_co_quan": DIM_AGENCY,
    "gold.dim_trang_thai": DIM_STATUS,
    "gold.dim_can_bo": DIM_OFFICER,
    "gold.dim_dich_vu_cong": DIM_SERVICE,
    "gold.fact_xu_ly_ho_so": FACT_TRANSITIONS,
    "gold.fact_ton_dong_ho_so": FACT_BACKLOG,
    "gold.fact_van_hanh_co_quan": FACT_AGENCY_DAY,
    "realtime.dim_thoi_gian": DIM_CALENDAR,
    "realtime.dim_co_quan": SERVING_AGENCY,
    "realtime.dim_trang_thai": SERVING_STATUS,
    "realtime.dim_can_bo": SERVING_OFFICER,
    "realtime.dim_dich_vu_cong": SERVING_SERVICE,
    "realtime.fact_xu_ly_ho_so_stream": FACT_TRANSITION_STREAM,
}

PARTITION_KEYS = {
    "bronze.application_xml": "ingest_date",
    "bronze.payment_transactions": "ingest_date",
    "silver.application_history": "action_date",
    "silver.payment": "paid_date",
    "gold.fact_xu_ly_ho_so": "thoi_gian_id",
    "gold.fact_ton_dong_ho_so": "thoi_gian_id",
    "gold.fact_van_hanh_co_quan": "thoi_gian_id",
}


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Select the contract's columns in its order and types."""
    return df.select(*[df[field.name].cast(field.dataType).alias(field.name)
                       for field in contract])


def assert_schema(df: DataFrame, contract: StructType) -> DataFrame:
    """Fail before a write when a column is missing or has another type."""
    actual = {field.name.lower(): field.dataType for field in df.schema}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"got {actual[field.name.lower()].simpleString() if field.name.lower() in actual else 'nothing'}"
        for field in contract
        if actual.get(field.name.lower()) != field.dataType
    ]
    if problems:
        raise ValueError("schema does not match the contract: " + "; ".join(problems))
    return df
