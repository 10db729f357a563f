"""Date spine, working-day calendar, working-day differences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseledger.functions.columns import business_today, day_key, non_negative
from caseledger.operators.skew import broadcast_within

# Yearly public holidays (month-day), calendar start and horizon.
FIXED_HOLIDAYS = ("01-01", "04-30", "05-01", "09-02")
CALENDAR_START = date(2023, 1, 1)
DAYS_AHEAD = 7


def date_spine(spark: SparkSession, start: date, end: date, name: str = "ngay_date") -> DataFrame:
    """One row per day, both ends included. ``range`` gives the planner an exact size."""
    days = max((end - start).days + 1, 0)
    return spark.range(0, days, 1, 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def calendar(spark: SparkSession, start: date, end: date,
             holidays: Sequence[str] = FIXED_HOLIDAYS, dated_holidays: DataFrame | None = None,
             prior_index: int = 0) -> DataFrame:
    """Calendar with the running number of working days.

    Saturdays, Sundays, yearly ``holidays`` and the days of ``dated_holidays``
    (column ``ngay_date``) are off. The running sum is one task over one row per day:
    a century is 36,525 rows, so the input of that task is bounded by the calendar.
    """
    days = date_spine(spark, start, end)
    off = (F.dayofweek("ngay_date").isin(1, 7)
           | F.date_format("ngay_date", "MM-dd").isin(*holidays))
    if dated_holidays is not None:
        extra = dated_holidays.select(F.col("ngay_date").alias("_off")).dropDuplicates()
        days = days.join(extra, F.col("ngay_date") == F.col("_off"), "left")
        off = off | F.col("_off").isNotNull()
    running = Window.orderBy("ngay_date").rowsBetween(Window.unboundedPreceding, 0)
    worked = F.sum((~F.col("co_phai_la_ngay_nghi")).cast("int")).over(running)
    return (days.withColumn("co_phai_la_ngay_nghi", off).select(
        day_key("ngay_date").alias("thoi_gian_id"), "ngay_date",
        F.dayofmonth("ngay_date").alias("ngay"), F.month("ngay_date").alias("thang"),
        F.quarter("ngay_date").alias("quy"), F.year("ngay_date").alias("nam"),
        "co_phai_la_ngay_nghi",
        (F.lit(prior_index) + worked).cast("int").alias("stt_ngay_lam_viec")))


def high_water(existing: DataFrame) -> tuple[date | None, int]:
    """Last day and last working-day number of a stored calendar (a one-row action)."""
    row = existing.agg(F.max("ngay_date").alias("day"),
                       F.max("stt_ngay_lam_viec").alias("index")).first()
    return row["day"], int(row["index"] or 0)


def extend_calendar(spark: SparkSession, existing: DataFrame | None, today: date | None = None,
                    start: date = CALENDAR_START, days_ahead: int = DAYS_AHEAD,
                    holidays: Sequence[str] = FIXED_HOLIDAYS,
                    dated_holidays: DataFrame | None = None) -> DataFrame | None:
    """Only the days missing between the stored calendar and the horizon, or ``None``."""
    if days_ahead < 0:
        raise ValueError("days_ahead must not be negative")
    horizon = (today or business_today()) + timedelta(days=days_ahead)
    index = 0
    if existing is not None:
        last, index = high_water(existing)
        start = last + timedelta(days=1) if last else start
    if start > horizon:
        return None
    return calendar(spark, start, horizon, holidays, dated_holidays, index)


def with_workday(df: DataFrame, cal: DataFrame, ts: str | Column, alias: str) -> DataFrame:
    """Add the working-day number of the day of ``ts``; null outside the calendar."""
    day = F.col(ts) if isinstance(ts, str) else ts
    numbered = broadcast_within(cal.select(F.col("ngay_date").alias("_day"),
                                           F.col("stt_ngay_lam_viec").alias(alias)))
    return df.join(numbered, F.to_date(day) == F.col("_day"), "left").drop("_day")


def workdays_between(df: DataFrame, cal: DataFrame, start: str, end: str,
                     alias: str = "working_days") -> DataFrame:
    """Working days after the day of ``start`` up to the day of ``end``, floored at zero."""
    both = with_workday(with_workday(df, cal, start, "_from_seq"), cal, end, "_to_seq")
    return (both.withColumn(alias, non_negative(F.col("_to_seq") - F.col("_from_seq")))
            .drop("_from_seq", "_to_seq"))


def with_worked_seconds(df: DataFrame, cal: DataFrame, ts: str, alias: str,
                        opens: int = 0, closes: int = 24) -> DataFrame:
    """Add the working seconds from the calendar's start to ``ts``; null outside the calendar.

    The calendar's running number of working days is the prefix sum: a working day counts from
    the hour ``opens`` to the hour ``closes``, a day off counts nothing. Half-open hours, so by
    default a working day is all of its 24 hours.
    """
    if not 0 <= opens < closes <= 24:
        raise ValueError("a working day must open before it closes, between 0 and 24")
    length = (closes - opens) * 3600
    days = broadcast_within(cal.select(
        F.col("ngay_date").alias("_day"), F.col("stt_ngay_lam_viec").cast("long").alias("_number"),
        F.col("co_phai_la_ngay_nghi").alias("_off")))
    midnight = F.to_date(ts).cast("timestamp")
    into = F.unix_seconds(ts) - F.unix_seconds(midnight) - F.lit(opens * 3600)
    today = F.least(F.greatest(into, F.lit(0)), F.lit(length))
    done = F.when(F.col("_off"), F.col("_number") * length).otherwise((F.col("_number") - 1) * length + today)
    return df.join(days, F.to_date(ts) == F.col("_day"), "left").withColumn(alias, done).drop("_day", "_number", "_off")


def worked_between(df: DataFrame, cal: DataFrame, start: str, end: str, alias: str = "working_seconds",
                   opens: int = 0, closes: int = 24) -> DataFrame:
    """Working seconds between two times of a row: two lookups, whatever lies between.

    Null when a side is missing or outside the calendar, or when time runs backwards; a step
    that begins and ends on days off takes none.
    """
    both = with_worked_seconds(df, cal, start, "_from_worked", opens, closes)
    both = with_worked_seconds(both, cal, end, "_to_worked", opens, closes)
    return (both.withColumn(alias, F.when(F.col(end) >= F.col(start), F.col("_to_worked") - F.col("_from_worked")))
            .drop("_from_worked", "_to_worked"))


def workday_number(cal: DataFrame, day: date) -> int:
    """Working-day number of one day, a literal for all rows of a snapshot.

    A day outside the calendar is refused: its working-day numbers would be unknown.
    """
    row = cal.where(F.col("ngay_date") == F.lit(day)).select("stt_ngay_lam_viec").first()
    if row is None:
        raise RuntimeError(f"the calendar does not contain {day}; extend it first")
    return row[0]
