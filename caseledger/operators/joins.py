"""Lookups, version lookups as of an instant, dense assembly, interval join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseledger.operators.ranking import forward_fill
from caseledger.operators.skew import BROADCAST_BYTES, HOT_ROWS, HOT_SHARE, broadcast_within, columns_of


def lookup(df: DataFrame, dim: DataFrame, on: str | dict[str, str],
           columns: dict[str, str], how: str = "left") -> DataFrame:
    """Add ``columns`` (dimension column -> new name) of the matching dimension row.

    ``on`` is a shared column or ``{fact column: dimension column}``. The dimension is
    broadcast only if it is proven small.
    """
    pairs = {on: on} if isinstance(on, str) else on
    right = broadcast_within(dim.select(
        *[F.col(d).alias(f"_d_{d}") for d in pairs.values()],
        *[F.col(c).alias(alias) for c, alias in columns.items()]))
    condition = reduce(lambda a, b: a & b,
                       [F.col(f) == F.col(f"_d_{d}") for f, d in pairs.items()])
    return df.join(right, condition, how).drop(*[f"_d_{d}" for d in pairs.values()])


def versions_at(dim: DataFrame, instant: Column) -> DataFrame:
    """The versions in force at one instant: at most one row per key."""
    return dim.where((F.col("effective_from_ts") <= instant)
                     & (F.col("effective_to_ts").isNull() | (instant < F.col("effective_to_ts"))))


def join_scd2_as_of(df: DataFrame, dim: DataFrame, dim_key: str, fact_key: str, as_of: Column,
                    sk: str, attributes: Sequence[tuple[str, str]] = (),
                    strategy: str = "auto", max_broadcast_bytes: int = BROADCAST_BYTES,
                    disjoint: bool = False) -> DataFrame:
    """Left join to the version in force at ``as_of`` of each row: exactly one row per row.

    Where ranges of a key overlap, the version that started last among those in force
    counts (of equal starts the one with the greater key). A dimension within the
    broadcast bound joins in place. A larger one is swept: its version starts and the fact
    rows are ordered together per key and the last start is carried forward, so a key with
    many versions and many facts costs a sort and not their product, and hot keys are
    split. Both ways read the same disjoint ranges, so they give the same answer.

    ``disjoint`` says that the ranges of a key do not overlap, as in every dimension that
    ``plans.dims`` publishes; the repair of overlaps is then left out of the plan.
    """
    versions = dim.select(
        F.col(dim_key).alias("_v_key"), F.col("effective_from_ts").alias("_v_from"),
        F.col("effective_to_ts").alias("_v_to"), F.col(sk),
        *[F.col(c).alias(alias) for c, alias in attributes])
    added = [sk, *[alias for _, alias in attributes]]
    small = False
    if strategy == "auto":
        hinted = broadcast_within(versions, max_broadcast_bytes)
        estimate = int(str(versions._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        conf = df.sparkSession._jsparkSession.sessionState().conf()
        small = hinted is not versions
        strategy = "hash" if small or estimate <= conf.autoBroadcastJoinThreshold() else "sweep"
    versions = _usable(versions) if disjoint else disjoint_ranges(versions, sk)
    if strategy == "hash":
        held = df.withColumn("_as_of", as_of)
        condition = ((F.col(fact_key) == F.col("_v_key")) & (F.col("_as_of") >= F.col("_v_from"))
                     & (F.col("_v_to").isNull() | (F.col("_as_of") < F.col("_v_to"))))
        versions = F.broadcast(versions) if small else versions
        return held.join(versions, condition, "left").select(*df.columns, *added)
    return _sweep_as_of(df, versions, fact_key, as_of, added)


def _usable(versions: DataFrame) -> DataFrame:
    """Versions that some instant can fall into."""
    return versions.where(F.col("_v_key").isNotNull() & F.col("_v_from").isNotNull()
                          & (F.col("_v_to").isNull() | (F.col("_v_from") < F.col("_v_to"))))


def disjoint_ranges(versions: DataFrame, sk: str) -> DataFrame:
    """Versions (_v_key, _v_from, _v_to, ...) whose ranges do not overlap within a key.

    Keys without overlaps pass through. In the others every instant goes to the version in
    force that started last, of equal starts to the greater ``sk``. One sweep over a key's
    starts and ends finds the parts of each version, so the cost is that of sorting them,
    however many overlap; only row numbers and times enter the sweep.
    """
    usable = _usable(versions)
    by_key = Window.partitionBy("_v_key")
    before = by_key.orderBy("_v_from").rowsBetween(Window.unboundedPreceding, -1)
    far = F.struct(F.col("_v_to").isNull().alias("open"), F.col("_v_to").alias("at"))
    seen = usable.withColumn("_far", F.max(far).over(before))
    seen = seen.withColumn("_clash", F.max(F.coalesce(
        F.col("_far.open") | (F.col("_v_from") < F.col("_far.at")), F.lit(False))).over(by_key))
    clean = seen.where(~F.col("_clash")).select(*versions.columns)
    # The rank by start, and among equal starts by sk: of two versions in force the higher one counts.
    rank = F.row_number().over(by_key.orderBy("_v_from", sk, F.asc_nulls_last("_v_to")))
    messy = seen.where("_clash").select(*versions.columns).withColumn("_rank", rank)
    times = F.struct(F.unix_micros("_v_from").alias("since"), F.unix_micros("_v_to").alias("until"))
    swept = messy.groupBy(F.col("_v_key").alias("_p_key")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", times.alias("t")))), lambda x: x["t"]).alias("spans"))
    parts = swept.select("_p_key", F.explode(_winning_parts("spans")).alias("_part"))
    cut = messy.join(parts, (F.col("_v_key") == F.col("_p_key")) & (F.col("_rank") == F.col("_part.rank")))
    cut = cut.withColumns({"_v_from": F.timestamp_micros("_part.since"), "_v_to": F.timestamp_micros("_part.until")})
    return clean.unionByName(cut.select(*versions.columns))


def _winning_parts(spans: str) -> Column:
    """For spans in the order of their start: (rank, since, until) of the parts in which each is the last started."""
    import heapq

    def of(rows) -> list[tuple[int, int, int | None]]:
        ends = [None if r["until"] is None else int(r["until"]) for r in rows]
        starts = [int(r["since"]) for r in rows]
        out, alive, at = [], [], None

        def run_to(limit: int | None) -> None:
            """Give the time up to ``limit`` to the last started of those still in force."""
            nonlocal at
            while alive and (limit is None or at < limit):
                best = -alive[0]
                if ends[best] is not None and ends[best] <= at:
                    heapq.heappop(alive)  # over; an earlier one may still be in force
                    continue
                stop = limit if ends[best] is None else ends[best] if limit is None else min(limit, ends[best])
                if out and out[-1][0] == best + 1 and out[-1][2] == at:
                    out[-1] = (best + 1, out[-1][1], stop)
                else:
                    out.append((best + 1, at, stop))
                at = stop
                if stop is None:
                    return
        for n, start in enumerate(starts):
            run_to(start)
            at = start
            heapq.heappush(alive, -n)
        run_to(None)
        return out

    @F.pandas_udf("array<struct<rank:int,since:long,until:long>>")
    def sweep(column: pd.Series) -> pd.Series:
        return pd.Series([of(rows) for rows in column])
    return sweep(F.col(spans))


def _sweep_as_of(df: DataFrame, versions: DataFrame, fact_key: str, as_of: Column,
                 added: Sequence[str], share: float = HOT_SHARE,
                 min_rows: int = HOT_ROWS) -> DataFrame:
    """As-of lookup by one ordering of starts and facts (validity ranges must not overlap)."""
    usable = versions.where(F.col("_v_to").isNull() | (F.col("_v_from") < F.col("_v_to")))
    starts = usable.select(
        F.col("_v_key").alias("_key"), F.col("_v_from").alias("_at"), F.lit(0).alias("_kind"),
        F.struct("_v_to", *added).alias("_version"))
    facts = df.select(
        F.col(fact_key).cast(starts.schema["_key"].dataType).alias("_key"),
        as_of.alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*[F.col(c) for c in df.columns]).alias("_fact"))
    both = starts.unionByName(facts, allowMissingColumns=True)
    filled = forward_fill(both, "_key", ["_at", "_kind"], ["_version"],
                          share=share, min_rows=min_rows)
    alive = (F.col("_key").isNotNull() & F.col("_at").isNotNull()
             & (F.col("_version._v_to").isNull() | (F.col("_at") < F.col("_version._v_to"))))
    return (filled.where("_kind = 1")
            .select("_fact.*", *[F.when(alive, F.col(f"_version.`{c}`")).alias(c) for c in added]))


def assemble_dense(spine: DataFrame, *aggregates: DataFrame, key: str | Sequence[str],
                   fill: int = 0) -> DataFrame:
    """One row per spine key with the measures of every aggregate, absent ones ``fill``.

    Each aggregate has one row per key. Stacking them and grouping once costs a single
    exchange of already aggregated rows, where chained left joins cost one per input.
    """
    keys = columns_of(key)
    measures = [c for frame in aggregates for c in frame.columns if c not in keys]
    base = spine.select(*keys, F.lit(True).alias("_in_spine"))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [base, *aggregates])
    return (stacked.groupBy(*keys)
            .agg(F.max("_in_spine").alias("_in_spine"),
                 *[F.coalesce(F.max(m), F.lit(fill)).alias(m) for m in measures])
            .where("_in_spine").drop("_in_spine"))


def near_in_time(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                 left_ts: str, right_ts: str, bound_seconds: int,
                 extra: Column | None = None) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides in time buckets, and the condition under which their rows meet.

    Each right row stands in the one bucket of its time (``_r_bucket``), each left row in the
    one or two buckets (``_l_bucket``) that its bound reaches. Buckets are two bounds wide, so
    a pair meets in exactly one of them and a right row sees all its partners in its own.
    """
    bound = bound_seconds * 1_000_000
    width = max(1, 2 * bound)
    l_micros = F.unix_micros(F.col(left_ts))
    r_bucket = F.floor(F.unix_micros(F.col(right_ts)) / F.lit(width))
    near = left.withColumn("_l_bucket", F.explode(F.array_distinct(F.array(
        F.floor((l_micros - bound) / F.lit(width)), F.floor((l_micros + bound) / F.lit(width))))))
    placed = right.withColumn("_r_bucket", r_bucket)
    span = F.expr(f"INTERVAL {bound_seconds} SECONDS")
    condition = ((F.col("_l_bucket") == F.col("_r_bucket"))
                 & (F.col(right_ts) >= F.col(left_ts) - span)
                 & (F.col(right_ts) <= F.col(left_ts) + span))
    for l_key, r_key in on:
        condition &= F.col(l_key) == F.col(r_key)
    if extra is not None:
        condition &= extra
    if not (left.isStreaming or right.isStreaming):
        # Rows are parsed out of a few file bytes each, so the planner's sizes are far too
        # small: without the hint it sends a whole side through the driver.
        near, placed = near.hint("merge"), placed.hint("merge")
    return near, placed, condition


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                  left_ts: str, right_ts: str, bound_seconds: int,
                  extra: Column | None = None) -> DataFrame:
    """Inner join on equal keys and times at most ``bound_seconds`` apart (inclusive).

    Works on static and on streaming frames. Both sides carry the number of their time
    bucket, two bounds wide, and the left side looks into the one or two buckets that its
    bound reaches. A pair is found in exactly one bucket, so nothing is duplicated; a key
    with very many events only ever compares neighbours in time instead of all pairs.
    """
    near, placed, condition = near_in_time(left, right, on, left_ts, right_ts, bound_seconds, extra)
    return near.join(placed, condition, "inner").drop("_l_bucket", "_r_bucket")


def interval_semi_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                       left_ts: str, right_ts: str, bound_seconds: int,
                       extra: Column | None = None) -> DataFrame:
    """The ``right`` rows that have a partner in :func:`interval_join`, each once, of static frames."""
    near, placed, condition = near_in_time(left, right, on, left_ts, right_ts, bound_seconds, extra)
    return placed.join(near, condition, "left_semi").drop("_r_bucket")


def stream_interval_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                         left_ts: str, right_ts: str, bound_seconds: int = 60,
                         watermark: str = "1 minute", extra: Column | None = None) -> DataFrame:
    """:func:`interval_join` of two streams; the watermarks bound the state."""
    return interval_join(left.withWatermark(left_ts, watermark),
                         right.withWatermark(right_ts, watermark),
                         on, left_ts, right_ts, bound_seconds, extra)
