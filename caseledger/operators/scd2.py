"""Slowly changing dimensions with full version history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseledger.operators.keys import require_unique
from caseledger.operators.ranking import previous_value

# Fixed value: start of the versions found by the first load.
BASELINE = "2023-01-01 00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"
META = ("source_snapshot_at", "source_snapshot_id")


def version_key(key: str, start: str, tracked: Sequence[str]) -> Column:
    """Surrogate key of one version.

    It covers the start and the tracked values, so a change that arrives through a
    joined attribute under an unchanged snapshot id still gets a key of its own.
    """
    return F.xxhash64(F.col(key), F.col(start), *[F.col(c) for c in tracked])


def snapshot_versions(snapshot: DataFrame, key: str, tracked: Sequence[str], sk: str,
                      baseline: str | datetime | None = None, check: bool = True) -> DataFrame:
    """A full snapshot as open versions that start at the snapshot's time."""
    rows = snapshot.dropDuplicates()
    if check:
        require_unique(rows, key, f"snapshot for {sk}")
    start = (F.lit(baseline).cast("timestamp") if baseline is not None
             else F.coalesce(F.col("source_snapshot_at"), F.current_timestamp()))
    attributes = [c for c in rows.columns if c not in META]
    return (rows.withColumn("effective_from_ts", start)
            .withColumn("_id", F.coalesce(
                F.col("source_snapshot_id"),
                F.date_format("effective_from_ts", "yyyyMMddHHmmssSSSSSS")))
            .select(version_key(key, "effective_from_ts", tracked).alias(sk), *attributes,
                    "effective_from_ts", F.lit(None).cast("timestamp").alias("effective_to_ts"),
                    F.lit(True).alias("is_current"), F.col("_id").alias("source_snapshot_id")))


def scd2_apply(target: DataFrame | None, snapshot: DataFrame, key: str,
               tracked: Sequence[str], sk: str, baseline: str | datetime = BASELINE,
               closed_at: Column | None = None, check: bool = True) -> DataFrame:
    """Next state of a dimension: stored versions merged with a full snapshot.

    ``snapshot`` has the key, the attributes and ``source_snapshot_at`` /
    ``source_snapshot_id``. Changed keys close their version and open a new one,
    missing keys close (at ``closed_at``, default now), returning keys open again,
    the rest stays. One full outer join on the key decides every case, and each
    joined row yields the one or two versions it stands for; nothing is collected.
    """
    if target is None:
        return snapshot_versions(snapshot, key, tracked, sk, baseline, check)
    fresh = snapshot_versions(snapshot, key, tracked, sk, None, check)
    columns = fresh.columns
    stored = target.select(*columns)
    history = stored.where(~F.col("is_current"))

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias(f"_{name}_key"),
                         F.struct(*[F.col(c) for c in columns]).alias(name))

    pair = packed(stored.where("is_current"), "old").join(
        packed(fresh, "new"), F.col("_old_key") == F.col("_new_key"), "full_outer")
    differs = reduce(lambda a, b: a | b,
                     [~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in tracked],
                     F.lit(False))
    gone, appeared = F.col("_new_key").isNull(), F.col("_old_key").isNull()
    end = F.coalesce(F.col("new.effective_from_ts"),
                     F.current_timestamp() if closed_at is None else closed_at)
    closed = F.struct(*[
        end.alias(c) if c == "effective_to_ts"
        else F.lit(False).alias(c) if c == "is_current"
        else F.col(f"old.`{c}`").alias(c) for c in columns])
    # Field nullability must agree before the versions can share one array.
    same = F.struct(*[F.col(f"old.`{c}`").alias(c) for c in columns])
    opened = F.struct(*[F.col(f"new.`{c}`").alias(c) for c in columns])
    versions = (F.when(appeared, F.array(opened))
                .when(gone, F.array(closed))
                .when(differs, F.array(closed, opened))
                .otherwise(F.array(same)))
    return history.unionByName(pair.select(F.inline(versions)))


def current_attributes(dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The type-1 view of a versioned dimension, for serving copies."""
    return dim.where("is_current").select(*columns)


# --- integrity ------------------------------------------------------------------

def several_current(dim: DataFrame, key: str) -> DataFrame:
    """Keys whose number of current versions is not one (closed keys have none left)."""
    return (dim.where("is_current").groupBy(key)
            .agg(F.count(F.lit(1)).alias("current_versions"))
            .where(F.col("current_versions") != 1))


def inverted_ranges(dim: DataFrame, key: str) -> DataFrame:
    return dim.where(F.col("effective_to_ts") <= F.col("effective_from_ts")).select(
        key, "effective_from_ts", "effective_to_ts")


def overlapping_ranges(dim: DataFrame, key: str) -> DataFrame:
    """Versions that start before the version ahead of them has ended."""
    ended = dim.select(key, "effective_from_ts", "effective_to_ts",
                       F.coalesce("effective_to_ts", F.lit(END_OF_TIME).cast("timestamp"))
                       .alias("_end"))
    paired = previous_value(ended, key, ["effective_from_ts", "_end"], "_end", "previous_to_ts")
    return (paired.where(F.col("previous_to_ts") > F.col("effective_from_ts"))
            .select(key, "effective_from_ts", "effective_to_ts", "previous_to_ts"))


def scd2_violations(dim: DataFrame, key: str) -> DataFrame:
    """All three checks as one report: kind and key."""
    def tagged(df: DataFrame, kind: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"))
    return (tagged(several_current(dim, key), "several_current")
            .unionByName(tagged(inverted_ranges(dim, key), "inverted_range"))
            .unionByName(tagged(overlapping_ranges(dim, key), "overlapping_range")))
