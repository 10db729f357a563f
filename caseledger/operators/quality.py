"""Reconciliation and integrity checks; each returns the offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.operators.joins import lookup


def recon_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table as one result."""
    counts = [df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"))
              .select("dataset", "row_count") for name, df in tables.items()]
    return reduce(lambda a, b: a.union(b), counts)


def recon_backlog(fact: DataFrame, backlog: DataFrame) -> DataFrame:
    """Agency-day totals that differ from the number of snapshot rows.

    The snapshot is counted per agency and day before the join, so the join only sees
    aggregated rows.
    """
    counted = (backlog.groupBy("thoi_gian_id", "co_quan_id")
               .agg(F.count("ho_so_id").alias("snapshot_ton_dong")))
    return (fact.select("thoi_gian_id", "co_quan_id",
                        F.col("so_luong_ton_dong").alias("gold_ton_dong"))
            .join(counted, ["thoi_gian_id", "co_quan_id"], "left")
            .withColumn("snapshot_ton_dong", F.coalesce("snapshot_ton_dong", F.lit(0)))
            .where(F.col("gold_ton_dong") != F.col("snapshot_ton_dong"))
            .select("thoi_gian_id", "co_quan_id", "gold_ton_dong", "snapshot_ton_dong"))


def orphan_keys(fact: DataFrame, dim: DataFrame, sk: str, columns=("ho_so_id", "thoi_gian_id")
                ) -> DataFrame:
    """Facts whose surrogate key is null or unknown. Distinct keys travel, not versions."""
    known = dim.select(F.col(sk).alias("_known"), F.col(sk).alias("_found")).dropDuplicates()
    return (lookup(fact, known, {sk: "_known"}, {"_found": "_hit"})
            .where(F.col("_hit").isNull()).select(*columns))


def event_uniqueness(fact: DataFrame, event_id: str = "id") -> DataFrame:
    """Rows and distinct events; equal when every event produced one fact."""
    per_event = fact.groupBy(event_id).agg(F.count(F.lit(1)).alias("n"))
    return per_event.agg(F.sum("n").alias("row_count"),
                         F.count(event_id).alias("distinct_events"))


def not_empty(df: DataFrame, what: str = "table") -> DataFrame:
    """Gate before publishing."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """A few rows for an error message."""
    return df.limit(n)
