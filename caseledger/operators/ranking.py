"""Latest row per key, latest snapshot, carry-forward."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseledger.functions.columns import in_days
from caseledger.operators.skew import (HOT_ROWS, HOT_SHARE, SPLITS, columns_of, hot_hashes,
                                       split_hot_keys)


def latest(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
           ascending: bool = False) -> DataFrame:
    """One row per key, the greatest by ``order`` with nulls last.

    Give enough order columns to make the order total. Spark plans a group limit
    below the exchange, so every map task sends at most one row per key: a key with
    a third of all rows costs no more than any other.
    """
    ordering = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last()
                for c in columns_of(order)]
    ranked = Window.partitionBy(*columns_of(key)).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def latest_as_of(df: DataFrame, key: str | Sequence[str], ts: str, day: date,
                 tie: str | Sequence[str]) -> DataFrame:
    """State at the end of ``day``: later events are filtered out at the scan."""
    return latest(df.where(in_days(df, ts, None, day)), key, [ts, *columns_of(tie)])


def latest_snapshot(df: DataFrame, order: str) -> DataFrame:
    """All rows of the newest snapshot.

    A one-row maximum and an equality join; ranking the whole table in a window
    without partitions would run in a single task.
    """
    newest = df.agg(F.max(order).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(order).eqNullSafe(F.col("_newest")), "left_semi")


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def latest_filled(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                  fill: Sequence[str], take: Sequence[str] = ()) -> DataFrame:
    """Carry forward and keep the last row, as one aggregation.

    For each ``fill`` column the last value that is not null, for each ``take``
    column the value of the last row. It equals ``latest(forward_fill(df))`` but is
    combined on the map side and needs no sort of each key's whole history.
    """
    position = _order_struct(columns_of(order))
    return df.groupBy(*columns_of(key)).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in fill],
        *[F.max_by(c, position).alias(c) for c in take],
    )


def forward_fill(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                 fill: Sequence[str], *, split_hot: bool = True, splits: int = SPLITS,
                 share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame:
    """Replace nulls by the last earlier value of the same key.

    ``order`` starts with a timestamp. A sketch of the keys is taken first, so pass a
    stored frame rather than a costly plan. Without hot keys the fill is one window. Hot
    keys are cut into consecutive chunks that are filled in parallel; each chunk then
    receives the last values of the chunks before it, from a summary with one row per
    chunk.
    """
    keys, ordering = columns_of(key), columns_of(order)
    hot = hot_hashes(df, keys, share, min_rows) if split_hot else []
    if not hot:
        running = (Window.partitionBy(*keys).orderBy(*ordering)
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in fill})

    chunked = split_hot_keys(df, keys, F.unix_micros(F.col(ordering[0]).cast("timestamp")),
                             splits=splits, hot=hot)
    running = (Window.partitionBy(*keys, "_chunk").orderBy(*ordering)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = chunked.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in fill})

    carried = carry_over(chunked, keys, ordering, fill)
    joined = within.join(carried, _same_chunk(keys, carried), "left")
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"_carry_{c}")).alias(c) if c in fill else F.col(c)
        for c in df.columns
    ])


def carry_over(chunked: DataFrame, keys: Sequence[str], ordering: Sequence[str],
               columns: Sequence[str]) -> DataFrame:
    """Per chunk of a hot key, the last non-null values of all earlier chunks.

    At most (number of hot keys x number of chunks) rows, whatever the data size.
    """
    position = _order_struct(ordering)
    summary = (chunked.where(F.col("_chunk").isNotNull())
               .groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys],
                        F.col("_chunk").alias("_k_chunk"))
               .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"_last_{c}")
                      for c in columns]))
    before = (Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_k_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    return summary.select(
        *[f"_k_{k}" for k in keys], "_k_chunk",
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}")
          for c in columns])


def _same_chunk(keys: Sequence[str], carried: DataFrame) -> Column:
    condition = F.col("_chunk") == F.col("_k_chunk")
    for name in keys:
        condition &= F.col(name).eqNullSafe(F.col(f"_k_{name}"))
    return condition


def previous_value(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                   column: str, alias: str, *, split_hot: bool = True, splits: int = SPLITS,
                   share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame:
    """Value of ``column`` in the row before, per key; ``column`` must not be null.

    Same splitting as :func:`forward_fill`: only the first row of a chunk needs the
    carried value.
    """
    keys, ordering = columns_of(key), columns_of(order)
    hot = hot_hashes(df, keys, share, min_rows) if split_hot else []
    if not hot:
        ordered = Window.partitionBy(*keys).orderBy(*ordering)
        return df.withColumn(alias, F.lag(column).over(ordered))
    chunked = split_hot_keys(df, keys, F.unix_micros(F.col(ordering[0]).cast("timestamp")),
                             splits=splits, hot=hot)
    ordered = Window.partitionBy(*keys, "_chunk").orderBy(*ordering)
    within = chunked.withColumn(alias, F.lag(column).over(ordered))
    carried = carry_over(chunked, keys, ordering, [column])
    joined = within.join(carried, _same_chunk(keys, carried), "left")
    return joined.select(*df.columns,
                         F.coalesce(F.col(alias), F.col(f"_carry_{column}")).alias(alias))
