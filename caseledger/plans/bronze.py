"""Arrival layer: master snapshots, XML packets with quarantine, payments, change streams."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from caseledger.functions.layouts import declared_column
from caseledger.functions.packets import EVENTS, blank_column, judged_column, parsed_without_text, validate_column
from caseledger.schemas import (APPLICATION_XML, CDC_ROWS, MASTER_TABLES, PACKET_DATA,
                                PAYMENT_TRANSACTIONS, QUARANTINE, conform)
from caseledger.session import materialize, staged
from caseledger.sources.readers import (SnapshotErrors, jdbc_snapshot, large_documents, scan_api_payments,
                                        scan_raw_documents)
from caseledger.sources.tables import append_partitioned, write_quarantine
from caseledger.streaming.cdc import parse_cdc
from caseledger.streaming.sinks import stream_append


# Files that a Python worker takes at once: a row is a whole file, and Spark's ten thousand of them
# are held as text, as parsed rows and as Arrow batches side by side.
# Files may be large, too, so bytes are bounded as well; a larger file goes alone.
FILES_AT_ONCE, BYTES_AT_ONCE = 500, 16 * 2 ** 20
# Rejected files whose texts one job reads again; their paths go through the driver.
REREAD_AT_ONCE = 1_000
# Files of more stored bytes are read by jobs of their own that take a share of the cores: a task holds some ten copies of a text.
LARGE_BYTES, LARGE_SHARE = 8 * 2 ** 20, 4


def _few_files_at_once(spark: SparkSession) -> None:
    """From here on in the session, as the parsed frame may run at any later time."""
    for bound, most in (("maxRecordsPerBatch", FILES_AT_ONCE), ("maxBytesPerBatch", BYTES_AT_ONCE)):
        name = f"spark.sql.execution.arrow.{bound}"
        now = spark.conf.get(name).rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, most)


def master_snapshot(spark: SparkSession, url: str, snapshot_id: str,
                    tables: Sequence[str] = MASTER_TABLES,
                    table_name: Callable[[str], str] = str.lower, **options) -> list[str]:
    """Append one snapshot of every master table; failures are raised after the rest is in."""
    failure = None
    try:
        frames = jdbc_snapshot(spark, url, tables, snapshot_id, **options)
    except SnapshotErrors as error:
        failure, frames = error, error.frames
    for name, frame in frames.items():
        append_partitioned(frame, table_name(name))
    if failure:
        raise failure
    return list(frames)


def _without_accepted(checked: DataFrame) -> DataFrame:
    """The text of accepted files is in their packets; it need not be staged again."""
    return checked.withColumn("value", F.when(~F.coalesce("result.is_valid", F.lit(False)), F.col("value")))


def validate_documents(raw: DataFrame, events: Sequence[str] = EVENTS,
                       spread: int | None = None) -> DataFrame:
    """Add the validation result of files of any layout.

    Landed files already arrive in many small splits. ``spread`` moves the texts over
    that many tasks first, for input that comes from a few large splits.
    """
    _few_files_at_once(raw.sparkSession)
    # By file name: a hash placement needs no sort of the texts to be repeatable.
    rows = raw.repartition(spread, "file_name") if spread else raw
    return _without_accepted(rows.withColumn("result", validate_column(F.col("value"), events)))


def judge_documents(raw: DataFrame, events: Sequence[str] = EVENTS) -> DataFrame:
    """:func:`validate_documents` without the texts, for files that can be read again."""
    _few_files_at_once(raw.sparkSession)
    parsed = parsed_without_text(raw).withColumn("result", judged_column(F.col("blank"), F.col("parsed"), events))
    return parsed.withColumn("value", F.lit(None).cast("string"))


def validate_declared(raw: DataFrame, layout: StructType = PACKET_DATA, events: Sequence[str] = EVENTS,
                      spread: int | None = None) -> DataFrame:
    """Add the validation result of files of one declared layout, without Python; null for others."""
    rows = raw.repartition(spread, "file_name") if spread else raw
    value = F.col("value")
    return _without_accepted(rows.withColumn("result", judged_column(blank_column(value), declared_column(value, layout), events)))


def by_packet(validated: DataFrame) -> DataFrame:
    """One row per packet of an accepted file and one per other file, so that no stored row holds a file's packets.

    A scan takes thousands of rows at once, whose packets would otherwise all be in memory.
    """
    return validated.select("value", "file_name", "ingested_at", "result.is_valid", "result.error_msg",
                            F.explode_outer("result.packets").alias("packet"))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    accepted = rows.where("is_valid").select("packet.*", "file_name", "ingested_at")
    rejected = rows.where("NOT is_valid").select(
        "file_name", F.col("value").alias("raw_content"), F.col("error_msg").alias("error_reason"), "ingested_at")
    return conform(accepted, APPLICATION_XML), conform(rejected, QUARANTINE)


def split_valid_invalid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted packets, one row each, and rejected files with their reason."""
    return _split(by_packet(validated))


def validate_packets(raw: DataFrame, events: Sequence[str] = EVENTS, stage: bool = False,
                     spread: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). ``stage`` writes the result once, so that two sinks do not
    parse every file twice."""
    rows = by_packet(validate_documents(raw, events, spread))
    return _split(materialize(rows, "packets") if stage else rows)


@contextmanager
def validated_files(raw: DataFrame, layout: StructType | None = None,
                    events: Sequence[str] = EVENTS) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(accepted, rejected) for the length of a block, written once under the shared folder.

    With a ``layout`` (``schemas.PACKET_DATA``), files of it are parsed in the JVM and Python
    workers see only the rest. Both ways give the same rows; without a layout is faster.
    """
    if layout is None:
        with staged(by_packet(validate_documents(raw, events)), "packets") as checked:
            yield _split(checked)
        return
    with staged(by_packet(validate_declared(raw, layout, events)), "declared") as first:
        rest = first.where("is_valid IS NULL").select("value", "file_name", "ingested_at")
        with staged(by_packet(validate_documents(rest, events)), "undeclared") as second:
            yield _split(first.where("is_valid IS NOT NULL").unionByName(second))


def _few(spark: SparkSession, names: Sequence[str]) -> Iterator[Sequence[str]]:
    """As many large files as are read at a time."""
    size = max(1, spark.sparkContext.defaultParallelism // LARGE_SHARE)
    return (names[i:i + size] for i in range(0, len(names), size))


def _of_files(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """A condition on the path with literals leaves the other files out of the scan."""
    return raw.where(F.col("file_name").isin(list(names)))


def _quarantine_files(rejected: DataFrame, raw: DataFrame, large: Sequence[str], quarantine: str) -> None:
    """Rejected files with their texts, which are read again: of these files only, a bounded number in a job."""
    apart = set(large)
    with staged(rejected.drop("raw_content"), "rejected") as found:
        groups = max(1, math.ceil(found.count() / REREAD_AT_ONCE))
        for group in range(groups):
            few = found.where(F.pmod(F.xxhash64("file_name"), F.lit(groups)) == group)
            names = sorted(row["file_name"] for row in few.select("file_name").collect())
            for part in ([n for n in names if n not in apart], *_few(raw.sparkSession, [n for n in names if n in apart])):
                texts = _of_files(raw, part).select("file_name", F.col("value").alias("raw_content"))
                write_quarantine(conform(texts.join(F.broadcast(few), "file_name"), QUARANTINE), quarantine)


def ingest_xml(spark: SparkSession, landing: str, table: str, quarantine: str,
               pattern: str = "*.xml", layout: StructType | None = None) -> None:
    """Landed files to Bronze packets and, with their reasons, to the quarantine; parsed once.

    Texts are not staged, as a landed file may be large and stays as it is: the few that are
    rejected are read again. With a ``layout`` they are, for the second parser.
    """
    if layout is None:
        raw = scan_raw_documents(spark, landing, pattern, sizes=True)
        large = large_documents(spark, landing, pattern, LARGE_BYTES)
        others = raw.where(F.col("stored_bytes") <= LARGE_BYTES)
        apart = (by_packet(judge_documents(_of_files(raw, few))) for few in _few(spark, large))
        with staged(by_packet(judge_documents(others)), "packets", more=apart) as checked:
            accepted, rejected = _split(checked)
            append_partitioned(accepted, table)
            _quarantine_files(rejected, raw, large, quarantine)
        return
    with validated_files(scan_raw_documents(spark, landing, pattern), layout) as (accepted, rejected):
        append_partitioned(accepted, table)
        write_quarantine(rejected, quarantine)


def ingest_api_payments(spark: SparkSession, landing: str, table: str) -> None:
    append_partitioned(conform(scan_api_payments(spark, landing), PAYMENT_TRANSACTIONS), table)


def ingest_cdc(records: dict[str, DataFrame], checkpoints: str,
               table_name: Callable[[str], str] = lambda name: f"{name}_cdc",
               trigger: str | None = "5 seconds",
               ops: Sequence[str] = ("c", "u")) -> dict[str, StreamingQuery]:
    """One stream per captured table, each with its own checkpoint; batches are appended once."""
    return {
        name: stream_append(parse_cdc(topic, CDC_ROWS[name], ops, keep_position=True), table_name(name),
                            f"{checkpoints}/{name}", trigger, name=f"cdc_{name}")
        for name, topic in records.items()
    }
