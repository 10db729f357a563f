"""Helpers that keep one very frequent key from landing in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is split when it holds at least this share of the rows and this many rows.
HOT_SHARE = 0.0005
HOT_ROWS = 1_000_000
# The sketch tracks this many items per key asked for, up to what approx_top_k allows.
SKETCH_FACTOR, SKETCH_MOST = 16, 1_000_000
# Largest side that is broadcast by a hint.
BROADCAST_BYTES = 64 << 20
# Chunks per hot key: a key with a third of all rows gives chunks of about HOT_SHARE.
SPLITS = 512


def columns_of(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def hot_keys(df: DataFrame, key: str | Sequence[str], share: float = HOT_SHARE,
             min_rows: int = HOT_ROWS, sketches: int = 1) -> DataFrame:
    """Hashes of the keys that hold at least ``share`` of the rows.

    One scan of the key columns into a heavy-hitter sketch whose size follows from
    ``share`` alone: at most ``1 / share`` keys can reach it, so that many are tracked
    (for a share too small to be tracked this raises). The sketch only decides what to
    split; results of the operators do not depend on it being exact.

    With several ``sketches`` keys are dealt to them by their hash, in the same scan, so
    that smaller shares can be tracked; ``share`` is of all rows all the same. Each tracks
    twice the keys that fall to it on average.
    """
    tracked = math.ceil(1 / share if sketches == 1 else 2 / (share * sketches))
    if not 0 < share <= 1 or tracked > SKETCH_MOST // 4:
        raise ValueError(f"share must lie between {4 / SKETCH_MOST} and 1")
    items = min(SKETCH_MOST, SKETCH_FACTOR * max(tracked, 2048))
    hashed = df.select(F.xxhash64(*columns_of(key)).alias("_hash"))
    top = F.expr(f"approx_top_k(_hash, {tracked}, {items})").alias("_top")
    total = F.count(F.lit(1)).alias("_total")
    if sketches == 1:
        found = hashed.agg(total, top)
    else:
        dealt = hashed.groupBy(F.pmod("_hash", F.lit(sketches)).alias("_sketch")).agg(top)
        found = dealt.crossJoin(F.broadcast(hashed.agg(total)))
    return (found
            .select("_total", F.inline("_top"))
            .where((F.col("count") >= min_rows) & (F.col("count") >= F.col("_total") * share))
            .select(F.col("item").alias("_hash")))


def hot_hashes(df: DataFrame, key: str | Sequence[str], share: float = HOT_SHARE,
               min_rows: int = HOT_ROWS) -> list[int]:
    """:func:`hot_keys` on the driver: at most ``1 / share`` numbers, usually none.

    Knowing that there are none keeps the plan of the main job to a single exchange.
    """
    return [row["_hash"] for row in hot_keys(df, key, share, min_rows).collect()]


def split_hot_keys(df: DataFrame, key: str | Sequence[str], position: Column,
                   chunk: str = "_chunk", splits: int = SPLITS, share: float = HOT_SHARE,
                   min_rows: int = HOT_ROWS, hot: Sequence[int] | None = None) -> DataFrame:
    """Add ``chunk``: null for ordinary keys, an order-preserving number for hot ones.

    ``position`` is a long that does not decrease along the caller's ordering. The
    range of each hot key is cut at approximate quantiles, so its rows spread over
    about ``splits`` groups of similar size; the cut points are a function of the
    position alone, hence rows keep their order across chunks. The table of cut points
    is bounded by construction (one row per hot key), so it is broadcast.
    """
    keys = columns_of(key)
    chosen = hot_hashes(df, keys, share, min_rows) if hot is None else list(hot)
    placed = df.withColumns({"_hash": F.xxhash64(*keys), "_position": position})
    fractions = [i / splits for i in range(1, splits)]
    bounds = (placed.where(F.col("_hash").isin(chosen)).groupBy("_hash")
              .agg(F.percentile_approx("_position", fractions, 4 * splits).alias("_bounds")))
    marked = placed.join(F.broadcast(bounds), "_hash", "left")
    number = F.size(F.filter("_bounds", lambda b: b < F.col("_position")))
    return (marked
            .withColumn(chunk, F.when(F.col("_bounds").isNotNull(), number))
            .drop("_hash", "_position", "_bounds"))


def broadcast_within(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the size in bytes is proven small.

    Catalyst's own estimate comes first: under the automatic threshold no hint is needed.
    Otherwise the rows' sizes are added up, one number per task. A larger side comes back
    without a hint and joins by shuffle, with adaptive skew handling, and a session that
    has broadcasts disabled keeps them disabled.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if threshold < 0 or estimate <= threshold:
        return df
    size = F.lit(16 + 8 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif field.dataType.typeName() in ("struct", "array", "map", "variant"):
            size = size + F.coalesce(F.octet_length(column.cast("string")), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes else df
