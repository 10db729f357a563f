"""Streaming writers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from caseledger.sources.ledger import append_once, stream_identity
from caseledger.sources.tables import append_new_only, upsert_current_state, with_day


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# State on local disk, one store per task of a join instead of four, and no read before each
# write for the sake of a row count.
_STATE = {
    _PROVIDER: _ROCKSDB,
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def _state_settings(spark: SparkSession, idle_batches: bool) -> Iterator[None]:
    """The settings of a query's state, which Spark takes from the session when the query starts.

    A session that names another kind of store keeps it, and a query that has a checkpoint
    keeps the kind and format it began with.
    """
    wanted = dict(_STATE) if spark.conf.get(_PROVIDER, None) in (None, _ROCKSDB) else {}
    if not idle_batches:
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
           trigger: str | None, name: str | None, idle_batches: bool = True) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).outputMode("append").option(
        "checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    # Without an interval the query takes what is there and stops (backfill, tests).
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    with _state_settings(df.sparkSession, idle_batches):
        return writer.start()


def stream_append(df: DataFrame, table: str, checkpoint: str, trigger: str | None = "5 seconds",
                  ts: str = "ingested_at", day: str = "ingest_date",
                  name: str | None = None) -> StreamingQuery:
    """Append every micro-batch to a day-partitioned table, each exactly once.

    A batch that Spark runs again, because the query stopped between the write and its own
    commit, finds its entry in the table's ledger and adds nothing.
    """
    def write(batch: DataFrame, number: int) -> None:
        # The batch's own session: the checkpoint is written before the first batch runs.
        stream = stream_identity(batch.sparkSession, checkpoint)
        append_once(with_day(batch, ts, day), table, stream, number, day)
    return _start(df, write, checkpoint, trigger, name)


def stream_files(df: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds",
                 partition_by: Sequence[str] = (), name: str | None = None,
                 idle_batches: bool = True) -> StreamingQuery:
    """Append to Parquet files with Spark's own exactly-once file log.

    Without ``idle_batches`` no batch runs for the watermark alone. What it would clear from the
    state is then cleared by the next batch with data, and only streams that emit no row by the
    watermark, such as inner joins, lose nothing by it. A replay saves a pass over its state.
    """
    writer = (df.writeStream.format("parquet").option("path", path).outputMode("append")
              .option("checkpointLocation", checkpoint).partitionBy(*partition_by))
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    with _state_settings(df.sparkSession, idle_batches):
        return writer.start()


def stream_upsert(df: DataFrame, table: str, keys: Sequence[str], checkpoint: str,
                  trigger: str | None = "5 seconds", order: Sequence[str] = (),
                  buckets: int = 64, name: str | None = None,
                  idle_batches: bool = True) -> StreamingQuery:
    """Keyed upsert of every micro-batch: a replayed batch changes nothing.

    ``order`` says which row of a key is the newest, of one batch and of what is stored, and must
    be given: without it a replayed older batch could undo a newer one. Each batch
    rewrites the buckets it touches, so for a large table and a fast trigger prefer
    :func:`stream_new_only` (transitions never change) or a catalog with ``MERGE``.
    ``idle_batches`` is that of :func:`stream_files`.
    """
    if not order:
        raise ValueError("name the columns that order the rows of a key")
    return _start(df, lambda batch, _: upsert_current_state(batch, table, keys, list(order), buckets),
                  checkpoint, trigger, name, idle_batches)


def stream_new_only(df: DataFrame, table: str, keys: Sequence[str], checkpoint: str,
                    trigger: str | None = "5 seconds", day: tuple[str, str] | None = None,
                    name: str | None = None) -> StreamingQuery:
    """Append events whose key the table lacks; replay-safe for immutable events."""
    return _start(df, lambda batch, _: append_new_only(batch, table, keys, day),
                  checkpoint, trigger, name)
