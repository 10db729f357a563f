"""Near-real-time fact: one row per status transition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseledger.functions.columns import day_key, elapsed_hours, elapsed_seconds
from caseledger.operators.joins import (interval_join, interval_semi_join, near_in_time,
                                        stream_interval_join)
from caseledger.schemas import CDC_ROWS, FACT_TRANSITION_STREAM
from caseledger.streaming.cdc import application_changes, history_changes

# How far apart the two changes may be, and the watermark of both streams.
BOUND_SECONDS = 60
WATERMARK = "1 minute"
TRIGGER = "5 seconds"

# The two changes describe one transition when the new status is the same and the old
# one, if the application change has it, agrees.
_KEYS = [("ho_so_id", "h_ho_so_id"), ("app_after_status_id", "trang_thai_id")]


def _same_origin() -> Column:
    return (F.col("app_before_status_id").isNull()
            | (F.col("app_before_status_id") == F.col("trang_thai_truoc_id")))


def join_changes(application: DataFrame, history: DataFrame,
                 bound_seconds: int = BOUND_SECONDS, watermark: str = WATERMARK) -> DataFrame:
    """Match application changes with history inserts; static frames need no watermark."""
    if application.isStreaming or history.isStreaming:
        return stream_interval_join(application, history, _KEYS, "app_event_time",
                                    "history_event_time", bound_seconds, watermark,
                                    _same_origin())
    return interval_join(application, history, _KEYS, "app_event_time", "history_event_time",
                         bound_seconds, _same_origin())


def measure(joined: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Step duration, latencies and lineage of the joined changes."""
    loaded = F.current_timestamp() if loaded_at is None else loaded_at
    record_time = F.greatest("app_kafka_timestamp", "history_kafka_timestamp")
    source_time = F.greatest("app_event_time", "history_event_time")
    columns = {
        "previous_action_time": F.col("app_before_updated_at"),
        "thoi_gian_xu_ly_seconds": elapsed_seconds("app_before_updated_at", "app_after_updated_at"),
        "thoi_gian_xu_ly": elapsed_hours("app_before_updated_at", "app_after_updated_at"),
        "thoi_gian_id": day_key("action_time"),
        "application_event_time": F.col("app_event_time"),
        "kafka_event_time": record_time,
        "fact_loaded_at": loaded,
        "join_skew_ms": F.abs(F.unix_millis("app_event_time") - F.unix_millis("history_event_time")),
        "kafka_to_fact_latency_ms": F.unix_millis(loaded) - F.unix_millis(record_time),
        "source_to_fact_latency_ms": F.unix_millis(loaded) - F.unix_millis(source_time),
    }
    return joined.select(*[columns.get(name, F.col(name)).alias(name)
                           for name in FACT_TRANSITION_STREAM.names])


def realtime_transitions(application_records: DataFrame, history_records: DataFrame,
                         bound_seconds: int = BOUND_SECONDS, watermark: str = WATERMARK,
                         loaded_at: Column | None = None) -> DataFrame:
    """Two topics of change records to the transition fact."""
    application = application_changes(application_records, CDC_ROWS["application"])
    history = history_changes(history_records, CDC_ROWS["application_history"])
    return measure(join_changes(application, history, bound_seconds, watermark), loaded_at)


def unmatched_changes(application: DataFrame, history: DataFrame,
                      bound_seconds: int = BOUND_SECONDS) -> DataFrame:
    """Batch view of the history inserts for which no application change was found.

    The stream drops them; this report, run over the stored topics, makes the loss visible.
    """
    matched = interval_semi_join(application, history, _KEYS, "app_event_time", "history_event_time",
                                 bound_seconds, _same_origin()).select("id").dropDuplicates()
    return history.hint("merge").join(matched, "id", "left_anti")


def unmatched_stream(application: DataFrame, history: DataFrame,
                     bound_seconds: int = BOUND_SECONDS, watermark: str = WATERMARK) -> DataFrame:
    """The history inserts for which the stream found no application change, as a side stream.

    A left outer join of the two streams: a history row leaves the state when both watermarks
    say that no partner within the bound can come any more, and is then emitted without one.
    Every history insert therefore ends either in the fact or here; rows behind the watermark
    when they arrive end in neither. A history row stands in one time bucket only, into which
    every change within its bound is copied, so it is known as unmatched in all of its time
    range at once and compared with its neighbours in time instead of with its whole key.
    """
    changes = application.select("ho_so_id", "app_before_status_id", "app_after_status_id", "app_event_time")
    near, placed, condition = near_in_time(
        changes.withWatermark("app_event_time", watermark), history.withWatermark("history_event_time", watermark),
        _KEYS, "app_event_time", "history_event_time", bound_seconds, _same_origin())
    joined = placed.join(near, condition, "left_outer")
    return joined.where(F.col("ho_so_id").isNull()).select(*history.columns)


def cdc_lag_report(fact: DataFrame, window: str = "1 minute",
                   ts: str = "kafka_event_time", lag: str = "kafka_to_fact_latency_ms",
                   watermark: str | None = None) -> DataFrame:
    """Events, events per second and latency per tumbling window.

    Of a stream, with a ``watermark``, a window is emitted once, when the watermark has passed
    its end; rows that arrive after that are dropped. The open windows are the state, so a
    restarted report continues where it was. The percentile is exact: a window holds a count per
    distinct lag.
    """
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    timed = fact.withWatermark(ts, watermark) if watermark else fact
    return (timed.groupBy(F.window(ts, window))
            .agg(F.count(F.lit(1)).alias("events"), F.max(lag).alias("max_lag_ms"),
                 F.avg(lag).alias("mean_lag_ms"),
                 F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY `{lag}`)")  # a double of whatever it is
                 .cast(fact.schema[lag].dataType).alias("p95_lag_ms"))
            .select(F.col("window.start").alias("window_start"), "events",
                    (F.col("events") / seconds).alias("events_per_second"),
                    "max_lag_ms", "mean_lag_ms", "p95_lag_ms"))
