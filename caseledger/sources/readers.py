"""Readers: databases, landed files, topics, catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.functions.columns import from_millis
from caseledger.operators.keys import with_audit
from caseledger.schemas import API_PAYMENT_RAW, QUARANTINE


class SnapshotErrors(RuntimeError):
    """Some tables of a snapshot could not be read; the others were."""

    def __init__(self, errors: dict[str, Exception], frames: dict[str, DataFrame]):
        super().__init__("; ".join(f"{table}: {error}" for table, error in errors.items()))
        self.errors, self.frames = errors, frames


def quoted(table: str) -> str:
    return '"' + table.replace('"', '""') + '"'


def scan_jdbc(spark: SparkSession, url: str, table: str, driver: str | None = None,
              partition: tuple[str, int, int, int] | tuple[str, int] | None = None,
              fetch_size: int = 10_000, **options: str) -> DataFrame:
    """One table, mixed-case name quoted.

    ``partition`` = (column, lower, upper, parts) reads in parallel ranges, and (column, parts)
    asks the source for the bounds; without it the table comes through one connection, which
    only suits small masters.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", quoted(table))
              .option("fetchsize", fetch_size).options(**options))
    if driver:
        reader = reader.option("driver", driver)
    if partition and len(partition) == 2:
        bounds = jdbc_bounds(spark, url, table, partition[0], driver, **options)
        partition = bounds and (partition[0], *bounds, partition[1])
    if partition:
        column, lower, upper, parts = partition
        reader = (reader.option("partitionColumn", quoted(column)).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", parts))
    return reader.load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str, driver: str | None = None,
                **options: str) -> tuple[int, int] | None:
    """Least and greatest value of a numeric column, computed by the source; ``None`` if it has none."""
    name = quoted(column)
    reader = spark.read.format("jdbc").option("url", url).options(**options).option(
        "query", f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {quoted(table)}")
    row = (reader.option("driver", driver) if driver else reader).load().first()
    # Ranges need a lower bound below the upper one; the last range is open anyway.
    return None if row is None or row[0] is None else (int(row[0]), max(int(row[1]), int(row[0]) + 1))


def jdbc_snapshot(spark: SparkSession, url: str, tables: Sequence[str], snapshot_id: str,
                  partitions: dict[str, tuple[str, int, int, int]] | None = None,
                  **options) -> dict[str, DataFrame]:
    """All tables of one snapshot, exact duplicates removed, audit columns added.

    A failing table does not stop the others: the error raised at the end carries both
    the failures and the frames that could be read.
    """
    frames: dict[str, DataFrame] = {}
    errors: dict[str, Exception] = {}
    for table in tables:
        try:
            rows = scan_jdbc(spark, url, table, partition=(partitions or {}).get(table), **options)
            frames[table] = with_audit(rows.dropDuplicates(), f"{url}/{table}", snapshot_id)
        except Exception as error:
            errors[table] = error
    if errors:
        raise SnapshotErrors(errors, frames)
    return frames


def scan_raw_documents(spark: SparkSession, path: str, pattern: str = "*.xml", sizes: bool = False) -> DataFrame:
    """Each file as one row, at any depth below ``path``; with ``sizes`` also its ``stored_bytes``."""
    files = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
             .text(path, wholetext=True))
    size = [F.col("_metadata.file_size").alias("stored_bytes")] if sizes else []
    return with_audit(files.select("value", F.col("_metadata.file_path").alias("_path"), *size),
                      F.col("_path")).drop("_path")


def large_documents(spark: SparkSession, path: str, pattern: str, most: int) -> list[str]:
    """Paths of the files of over ``most`` stored bytes, without reading them."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
             .load(path).where(F.col("_metadata.file_size") > most))  # leaves the others out of the scan
    return sorted(row["file_path"] for row in files.select("_metadata.file_path").collect())


def scan_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected files. Unless told otherwise, the JSON reader makes a row of nulls of one with over 20 million characters."""
    return spark.read.schema(QUARANTINE).option("maxStringLen", 2 ** 31 - 1).json(path)


def scan_api_payments(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON arrays of payments; the fetch time arrives as epoch milliseconds."""
    rows = (spark.read.schema(API_PAYMENT_RAW).option("multiLine", True)
            .option("recursiveFileLookup", True).json(path))
    return rows.select(
        *[c for c in API_PAYMENT_RAW.names if c != "ingested_at"],
        F.col("_metadata.file_path").alias("file_name"),
        from_millis("ingested_at").alias("ingested_at"))


def stream_records(spark: SparkSession, fmt: str, path: str | None = None, schema=None,
                   **options) -> DataFrame:
    """A topic as ``json_value, kafka_timestamp, kafka_partition, kafka_offset``.

    ``fmt`` is ``kafka`` with its own options, or a file format whose rows have the
    columns ``value, timestamp, partition, offset``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return as_records(reader.load(path) if path else reader.load())


def as_records(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("json_value"),
                     F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
                     F.col("partition").cast("int").alias("kafka_partition"),
                     F.col("offset").cast("bigint").alias("kafka_offset"))


def stream_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 fail_on_data_loss: bool = True, max_per_trigger: int | None = None) -> DataFrame:
    """A Kafka topic. ``max_per_trigger`` bounds a batch when a backlog is replayed."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return stream_records(spark, "kafka", **options)


def read_optional(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or ``None`` when it was not ingested yet."""
    return spark.table(table) if spark.catalog.tableExists(table) else None


def scan_days(spark: SparkSession, table: str, first: int, last: int,
              key: str = "thoi_gian_id") -> DataFrame:
    """A day-partitioned fact between two keys; the range prunes partitions."""
    return spark.table(table).where(F.col(key).between(first, last))


def newest_partition(spark: SparkSession, table: str, column: str) -> str | None:
    """The greatest value of a partition column, from the catalog alone."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():  # names, not data
        values = dict(part.split("=", 1) for part in row[0].split("/"))
        if values.get(column) not in (None, "__HIVE_DEFAULT_PARTITION__"):
            found.append(unquote(values[column]))
    return max(found, default=None)


def scan_latest_snapshot(spark: SparkSession, table: str, ts: str = "ingested_at",
                         day: str = "ingest_date") -> DataFrame:
    """All rows of the newest snapshot of a table laid out by the day of ``ts``.

    The newest day comes from the partition names and the newest instant from that day's one
    column; both are then literals, so the scan reads one partition and its matching row groups.
    """
    newest = newest_partition(spark, table, day)
    rows = spark.table(table)
    if newest is None:  # no day at all, or rows without a time only
        return rows.where(F.col(day).isNull())
    rows = rows.where(F.col(day) == F.lit(newest).cast(rows.schema[day].dataType))
    at = rows.agg(F.unix_micros(F.max(ts))).first()[0]
    return rows.where(F.col(ts) == F.timestamp_micros(F.lit(at)))
