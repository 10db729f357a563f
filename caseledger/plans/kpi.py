"""Management indicators over the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.functions.columns import percent
from caseledger.operators.joins import lookup
from caseledger.operators.skew import columns_of


def _agency_measures():
    got, stock = F.sum("so_luong_tiep_nhan"), F.sum("so_luong_ton_dong")
    return {
        "tong_tiep_nhan": got,
        "tong_doanh_thu_vnd": F.sum("tong_chi_phi"),
        "tong_ton_dong": stock,
        "ty_le_tre_han_pct": percent(F.sum("so_luong_tre_han"), got + stock),
        "ty_le_rework_pct": percent(F.sum("so_luong_rework"), got),
        "tai_cong_viec": got + stock,
    }


def kpi_monthly(fact: DataFrame, cal: DataFrame, first: int, last: int) -> DataFrame:
    """Leadership figures by month for day keys ``first`` to ``last``.

    The fact is summed per day first, so the calendar joins a few hundred rows; the range
    on the day key prunes partitions.
    """
    daily = (fact.where(F.col("thoi_gian_id").between(first, last)).groupBy("thoi_gian_id")
             .agg(*[F.sum(c).alias(c) for c in (
                 "so_luong_tiep_nhan", "tong_chi_phi", "so_luong_ton_dong", "so_luong_tre_han",
                 "so_luong_rework")]))
    dated = lookup(daily, cal, "thoi_gian_id", {"nam": "nam", "thang": "thang"}, "inner")
    wanted = {k: v for k, v in _agency_measures().items() if k != "tai_cong_viec"}
    return (dated.groupBy("nam", "thang").agg(*[v.alias(k) for k, v in wanted.items()])
            .orderBy("nam", "thang"))


def kpi_agency(fact: DataFrame, by: str | Sequence[str] = "co_quan_id",
               measures: Sequence[str] | None = None) -> DataFrame:
    """Agency indicators by any columns of the fact. The backlog is a stock: group by day
    before reading it as an end-of-day figure."""
    known = _agency_measures()
    return fact.groupBy(*columns_of(by)).agg(
        *[known[name].alias(name) for name in (measures or known)])


# Of the agency fact: what adds up over days, and what is a level at the end of a day.
FLOWS = ("so_luong_tiep_nhan", "tong_chi_phi", "so_luong_tre_han", "so_luong_rework")
STOCKS = ("so_luong_ton_dong",)


def period_totals(fact: DataFrame, cal: DataFrame, period: Sequence[str] = ("nam", "thang"),
                  by: str | Sequence[str] = (), flows: Sequence[str] = FLOWS,
                  stocks: Sequence[str] = STOCKS) -> DataFrame:
    """Flows summed over each period of the calendar, stocks as they were on its last day.

    The last day of a period is the last one for which the fact has rows, of whatever slice;
    a slice without a row on that day holds nothing then. ``by`` are any columns of the fact:
    over them stocks add up, over days they do not. The fact is combined per day and slice
    first, so the calendar and the last days (a row per day at most) meet few rows.
    """
    keys, slices = list(period), columns_of(by)
    daily = fact.groupBy("thoi_gian_id", *slices).agg(*[F.sum(c).alias(c) for c in (*flows, *stocks)])
    daily = lookup(daily, cal, "thoi_gian_id", {p: p for p in keys}, "inner")
    days = lookup(fact.select("thoi_gian_id").distinct(), cal, "thoi_gian_id", {p: p for p in keys}, "inner")
    closing = days.groupBy(*keys).agg(F.max("thoi_gian_id").alias("_closing"))
    joined = daily.join(F.broadcast(closing), keys)  # no more rows than the calendar has periods
    on_last = F.col("thoi_gian_id") == F.col("_closing")
    return joined.groupBy(*keys, *slices).agg(
        *[F.sum(c).alias(c) for c in flows],
        *[F.sum(F.when(on_last, F.col(c)).otherwise(0)).alias(c) for c in stocks])


def kpi_periods(fact: DataFrame, cal: DataFrame, period: Sequence[str] = ("nam", "thang"),
                by: str | Sequence[str] = ()) -> DataFrame:
    """Agency indicators per period, with the backlog as it stood at the period's end."""
    totals = period_totals(fact, cal, period, by)
    got, stock = F.col("so_luong_tiep_nhan"), F.col("so_luong_ton_dong")
    return totals.select(
        *period, *columns_of(by), got.alias("tong_tiep_nhan"), F.col("tong_chi_phi").alias("tong_doanh_thu_vnd"),
        stock.alias("tong_ton_dong"), percent(F.col("so_luong_tre_han"), got + stock).alias("ty_le_tre_han_pct"),
        percent(F.col("so_luong_rework"), got).alias("ty_le_rework_pct"), (got + stock).alias("tai_cong_viec"))


def backlog_by_status(backlog: DataFrame, agency: int | None = None) -> DataFrame:
    kept = backlog if agency is None else backlog.where(F.col("co_quan_id") == agency)
    return kept.groupBy("trang_thai_id").agg(F.sum("so_luong").alias("so_luong_ton_dong"))


def mean_step_time(facts: DataFrame, by: str | Sequence[str] = "trang_thai_id") -> DataFrame:
    return facts.groupBy(*columns_of(by)).agg(
        F.avg("thoi_gian_xu_ly").alias("thoi_gian_xu_ly_tb"))


def mean_backlog_age(backlog: DataFrame, by: str | Sequence[str] = "co_quan_id") -> DataFrame:
    return backlog.groupBy(*columns_of(by)).agg(
        F.avg("tong_thoi_gian_da_xu_ly").alias("tuoi_ton_dong_tb"))


def mean_days_stuck(backlog: DataFrame, by: str | Sequence[str] = "can_bo_id") -> DataFrame:
    return backlog.groupBy(*columns_of(by)).agg(
        F.avg("so_ngay_ton_dong_hien_tai").alias("so_ngay_ngam_tb"))


def kpi_drilldown(backlog: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """All backlog indicators of one slice."""
    return backlog.groupBy(*columns_of(by)).agg(
        F.sum("so_luong").alias("so_luong_ton_dong"),
        F.avg("tong_thoi_gian_da_xu_ly").alias("tuoi_ton_dong_tb"),
        F.avg("so_ngay_ton_dong_hien_tai").alias("so_ngay_ngam_tb"))


def kpi_slice(backlog: DataFrame, dim: DataFrame, sk: str, attributes: Sequence[str]
              ) -> DataFrame:
    """Indicators by attributes of a dimension version, through its surrogate key.

    Sums are taken per surrogate key before the join, so the join and the second
    aggregation work on one row per version, whatever the skew of the fact.
    """
    partial = backlog.groupBy(sk).agg(
        F.sum("so_luong").alias("_n"),
        F.sum("tong_thoi_gian_da_xu_ly").alias("_age"),
        F.count("tong_thoi_gian_da_xu_ly").alias("_age_n"))
    named = lookup(partial, dim, sk, {a: a for a in attributes}, "inner")
    return named.groupBy(*attributes).agg(
        F.sum("_n").alias("so_luong_ton_dong"),
        (F.sum("_age") / F.nullif(F.sum("_age_n"), F.lit(0))).alias("tuoi_ton_dong_tb"))
