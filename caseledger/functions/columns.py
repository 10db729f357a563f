"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They must equal the ones stored in existing tables.
STATUS_RECEIVED = 1
STATUS_COMPLETED = 7
STATUS_REJECTED = 8
TERMINAL_STATUSES = (STATUS_COMPLETED, STATUS_REJECTED)
UNKNOWN_MEMBER = -1
NULL_MARK = "<NULL>"
FIELD_SEPARATOR = "\u001f"
BUSINESS_UTC_OFFSET_HOURS = 7

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- keys -------------------------------------------------------------------

def event_key(source: str, *parts: ColumnOrName) -> Column:
    """Readable composite key: no hash, hence no collisions; nulls are marked."""
    texts = [F.coalesce(_col(part).cast("string"), F.lit(NULL_MARK)) for part in parts]
    return F.concat_ws(FIELD_SEPARATOR, F.lit(source), *texts)


def prefixed_key(prefix: str, part: ColumnOrName) -> Column:
    return F.concat(F.lit(prefix), _col(part))


def or_unknown(key: ColumnOrName) -> Column:
    return F.coalesce(_col(key), F.lit(UNKNOWN_MEMBER))


# --- tolerant casts (the session is ANSI, dirty input must give null) ---------

def to_int(text: ColumnOrName) -> Column:
    return _col(text).try_cast("int")


def to_double(text: ColumnOrName) -> Column:
    return _col(text).try_cast("double")


def to_time(text: ColumnOrName) -> Column:
    return _col(text).try_cast("timestamp")


def from_micros(epoch: ColumnOrName) -> Column:
    return F.timestamp_micros(_col(epoch))


def from_millis(epoch: ColumnOrName) -> Column:
    return F.timestamp_millis(_col(epoch))


# --- times and days -----------------------------------------------------------

def event_time(business: ColumnOrName, fallback: ColumnOrName) -> Column:
    return F.coalesce(_col(business), _col(fallback))


def day_start(day: date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp")


def day_end(day: date) -> Column:
    """First instant after the day; every day range here is half-open."""
    return day_start(day + timedelta(days=1))


def as_of_instant(day: Column) -> Column:
    """Last microsecond of a date column: the instant used for version lookups."""
    return F.date_add(day, 1).cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")


def on_day(ts: ColumnOrName, first: date, last: date | None = None) -> Column:
    """Range on the raw column, so that it prunes partitions and reaches the scan."""
    return (_col(ts) >= day_start(first)) & (_col(ts) < day_end(last or first))


# Day columns by which tables are laid out, next to the timestamps they come from.
DAY_COLUMNS = {"action_time": "action_date", "ingested_at": "ingest_date",
               "thoi_gian_tt": "paid_date"}


def in_days(df: DataFrame, ts: str, first: date | None, last: date) -> Column:
    """Rows between two days (no lower end if ``first`` is ``None``).

    A table laid out by day is also filtered on its day column, so that only the
    partitions of those days are listed and read.
    """
    condition = before_end_of(ts, last) if first is None else on_day(ts, first, last)
    day = DAY_COLUMNS.get(ts)
    if day in df.columns:
        condition &= F.col(day) <= F.lit(last)
        if first is not None:
            condition &= F.col(day) >= F.lit(first)
    return condition


def before_end_of(ts: ColumnOrName, day: date) -> Column:
    return _col(ts) < day_end(day)


def day_key(day: ColumnOrName) -> Column:
    """yyyymmdd as an int."""
    value = _col(day)
    return (F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)).cast("int")


def business_today(now: datetime | None = None) -> date:
    moment = now or datetime.now(timezone.utc)
    return moment.astimezone(timezone(timedelta(hours=BUSINESS_UTC_OFFSET_HOURS))).date()


def resolve_snapshot_date(requested: str | date | None, today: date | None = None) -> date:
    """Default is yesterday; today is allowed; the future is refused."""
    current = today or business_today()
    if requested is None:
        return current - timedelta(days=1)
    day = requested if isinstance(requested, date) else date.fromisoformat(requested)
    if day > current:
        raise ValueError(f"cannot take a snapshot of a future day: {day}")
    return day


def non_negative(value: Column) -> Column:
    """Floor at zero. ``greatest`` skips nulls, so an unknown difference becomes zero."""
    return F.greatest(value, F.lit(0)).cast("int")


def elapsed_seconds(earlier: ColumnOrName, later: ColumnOrName) -> Column:
    """Whole seconds, null when either side is missing or time runs backwards."""
    a, b = _col(earlier), _col(later)
    micros = F.unix_micros(b) - F.unix_micros(a)
    return F.when(b >= a, F.floor(micros / F.lit(1_000_000)).cast("long"))


def elapsed_hours(earlier: ColumnOrName, later: ColumnOrName) -> Column:
    return elapsed_seconds(earlier, later) / F.lit(3600.0)


# --- predicates and ratios ----------------------------------------------------

def is_delete(event: ColumnOrName) -> Column:
    return _col(event) == "DELETE"


def is_open(status: ColumnOrName, terminal=TERMINAL_STATUSES) -> Column:
    return ~F.coalesce(_col(status), F.lit(STATUS_RECEIVED)).isin(*terminal)


def is_success(status: ColumnOrName) -> Column:
    return F.upper(_col(status)) == "SUCCESS"


def created_and_alive(created: ColumnOrName, deleted: ColumnOrName, changed: ColumnOrName,
                      day: date) -> Column:
    """Created by the end of the day, and not deleted or deleted only afterwards.

    A case without a delete flag is not deleted.
    """
    alive = ~F.coalesce(_col(deleted), F.lit(False))
    return before_end_of(created, day) & (alive | (_col(changed) >= day_end(day)))


def percent(numerator: Column, denominator: Column) -> Column:
    return F.lit(100.0) * numerator / F.nullif(denominator, F.lit(0))
