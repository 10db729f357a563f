"""Change-data-capture envelopes, in batch or streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from caseledger.functions.columns import from_micros, from_millis

TIME_COLUMNS = ("updated_at", "created_at", "action_time")


def _flat_envelope(row: StructType, with_before: bool) -> StructType:
    payload = StructType().add("after", row).add("op", "string")
    return StructType().add("payload", payload.add("before", row) if with_before else payload)


def full_envelope(row: StructType) -> StructType:
    source = StructType().add("ts_ms", "long").add("txId", "long")
    transaction = (StructType().add("id", "string").add("total_order", "long")
                   .add("data_collection_order", "long"))
    return StructType().add("payload", StructType()
                            .add("before", row).add("after", row).add("source", source)
                            .add("op", "string").add("ts_ms", "long")
                            .add("transaction", transaction))


def times_from_micros(df: DataFrame, names: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """Epoch microseconds to timestamps, exactly, for the named long columns present."""
    present = {f.name for f in df.schema.fields if isinstance(f.dataType, LongType)}
    return df.withColumns({name: from_micros(name) for name in names if name in present})


def _payloads(records: DataFrame, envelope: StructType, ops: Sequence[str],
              *keep: str) -> DataFrame:
    """The fields of each payload whose operation is wanted.

    Filtering inside ``inline`` keeps the optimizer from pushing conditions on the parsed
    value below the parse, which would parse every record once per condition.
    """
    payload = F.from_json("json_value", envelope).getField("payload")
    wanted = F.filter(F.array(payload), lambda p: p["op"].isin(*ops))
    return records.select(*keep, F.inline(wanted))


POSITION = ("kafka_partition", "kafka_offset")


def parse_cdc(records: DataFrame, row: StructType, ops: Sequence[str] = ("c", "u"),
              ingested_at: Column | None = None, keep_position: bool = False) -> DataFrame:
    """Flat rows of the wanted operations: row image, ``op``, ``ingested_at``.

    The row is the after image; a delete (``d``), if asked for, has only the before image.
    With ``keep_position`` the place in the topic stays too, which orders rows that one
    micro-batch ingested at the same instant.
    """
    deletes = "d" in ops
    kept = POSITION if keep_position else ()
    opened = _payloads(records, _flat_envelope(row, deletes), ops, *kept)
    if deletes:
        opened = opened.withColumn("after", F.when(F.col("op") == "d", F.col("before"))
                                   .otherwise(F.col("after")))
    return times_from_micros(opened.select("after.*", "op", *kept)).withColumn(
        "ingested_at", F.current_timestamp() if ingested_at is None else ingested_at)


def parse_cdc_with_before(records: DataFrame, row: StructType,
                          ops: Sequence[str] = ("c", "u")) -> DataFrame:
    """Both images with source time, transaction and the position in the topic.

    Columns: ``before``, ``after``, ``op``, ``event_time`` (source time, else the time of
    the record), ``transaction_id``, ``kafka_timestamp``, ``kafka_partition``,
    ``kafka_offset``.
    """
    position = ("kafka_timestamp", "kafka_partition", "kafka_offset")
    return _payloads(records, full_envelope(row), ops, *position).select(
        "before", "after", "op",
        F.coalesce(from_millis("source.ts_ms"), F.col("kafka_timestamp")).alias("event_time"),
        F.col("source.txId").cast("string").alias("transaction_id"), *position)


# Column of the transition join -> where the envelope has it.
APPLICATION_CHANGE = {
    "ho_so_id": "after.id", "ten_ho_so": "after.name", "applicant_id": "after.Applicantid",
    "co_quan_id": "after.Agencyid", "dv_cong_id": "after.Serviceid",
    "app_before_status_id": "before.Statusid", "app_after_status_id": "after.Statusid",
    "created_at": "after.created_at", "app_before_updated_at": "before.updated_at",
    "app_after_updated_at": "after.updated_at", "app_event_time": "event_time",
    "app_kafka_timestamp": "kafka_timestamp",
    "application_kafka_partition": "kafka_partition", "application_kafka_offset": "kafka_offset",
}
HISTORY_CHANGE = {
    "id": "after.id", "h_ho_so_id": "after.Applicationid",
    "trang_thai_truoc_id": "after.Statusid", "trang_thai_id": "after.Statusid2",
    "can_bo_id": "after.Officerid", "action_time": "after.action_time",
    "transaction_id": "transaction_id", "history_event_time": "event_time",
    "history_kafka_timestamp": "kafka_timestamp",
    "history_kafka_partition": "kafka_partition", "history_kafka_offset": "kafka_offset",
}
MICROS = ("after.created_at", "after.updated_at", "before.updated_at", "after.action_time")


def _changes(records: DataFrame, row: StructType, ops: Sequence[str], fields: dict[str, str],
             keys: Sequence[str]) -> DataFrame:
    """The named fields of each change; rows without their keys cannot be matched."""
    opened = parse_cdc_with_before(records, row, ops).select(*[
        (from_micros(path) if path in MICROS else F.col(path)).alias(name)
        for name, path in fields.items()])
    return opened.dropna(subset=list(keys))


def application_changes(records: DataFrame, row: StructType) -> DataFrame:
    """Application changes, the left input of the transition join."""
    return _changes(records, row, ("c", "u"), APPLICATION_CHANGE, ["ho_so_id"])


def history_changes(records: DataFrame, row: StructType) -> DataFrame:
    """Inserted status changes, the right input of the transition join."""
    return _changes(records, row, ("c",), HISTORY_CHANGE, ["id", "h_ho_so_id"])
