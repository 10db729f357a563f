"""Where the example queries register themselves, with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types that mean the same in both engines: local timestamps, days as text."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, TimestampType)
        else F.col(f"`{f.name}`").cast("string").alias(f.name)
        if isinstance(f.dataType, DateType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register
