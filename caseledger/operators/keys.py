"""Row-level clean-up, keys, unions and anti joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from caseledger.operators.skew import columns_of


def with_audit(df: DataFrame, file_name: str | Column, snapshot_id: str | None = None,
               ingested_at: Column | None = None) -> DataFrame:
    """Add ``ingested_at``, ``file_name`` and, for master snapshots, ``snapshot_id``."""
    added = {
        "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        "file_name": F.lit(file_name) if isinstance(file_name, str) else file_name,
    }
    if snapshot_id is not None:
        added["snapshot_id"] = F.lit(snapshot_id)
    return df.withColumns(added)


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column in one projection."""
    return df.select(*[
        F.trim(F.col(f"`{field.name}`")).alias(field.name)
        if isinstance(field.dataType, StringType) else F.col(f"`{field.name}`")
        for field in df.schema.fields
    ])


def as_source_snapshot(df: DataFrame) -> DataFrame:
    """Turn Bronze audit columns into snapshot metadata; drop what only Bronze needs."""
    renamed = df.withColumnRenamed("ingested_at", "source_snapshot_at")
    if "snapshot_id" in df.columns:
        renamed = renamed.withColumnRenamed("snapshot_id", "source_snapshot_id")
    else:
        renamed = renamed.withColumn("source_snapshot_id", F.lit(None).cast("string"))
    return renamed.drop("file_name")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (df.groupBy(*columns_of(key)).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def require_unique(df: DataFrame, key: str | Sequence[str], what: str = "input") -> DataFrame:
    """Raise with at most ten example keys when ``key`` is not unique."""
    examples = duplicate_keys(df, key).limit(10).collect()
    if examples:
        shown = [tuple(row)[:-1] for row in examples]
        raise ValueError(f"{what}: several different rows for the same key, for example {shown}")
    return df


def union_available(*frames: DataFrame | None) -> DataFrame | None:
    """Union by name of the inputs that exist; absent columns become null."""
    present = [frame for frame in frames if frame is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def anti_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose null-safe key is absent from ``right``."""
    names = columns_of(keys)
    other = right.select(*[F.col(name).alias(f"_r_{name}") for name in names])
    condition = reduce(lambda a, b: a & b,
                       [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in names])
    return left.join(other, condition, "left_anti")


def with_unknown_member(dim: DataFrame, **member) -> DataFrame:
    """Append one literal row; columns that are not named stay null."""
    row = dim.sparkSession.range(1).select(*[
        F.lit(member.get(field.name)).cast(field.dataType).alias(field.name)
        for field in dim.schema.fields
    ])
    return dim.unionByName(row)


def literal_rows(spark, rows, schema) -> DataFrame:
    """A small inline relation; no rows gives an empty typed one."""
    return spark.createDataFrame(list(rows), schema)
