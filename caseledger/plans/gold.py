"""Facts: daily backlog snapshot, agency day, transition archive.

Dimensions are those that ``plans.dims`` publishes: their ranges are disjoint within a key, so
the version lookups here carry no repair of overlaps.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseledger.functions.columns import (STATUS_COMPLETED, STATUS_RECEIVED, STATUS_REJECTED,
                                          TERMINAL_STATUSES, as_of_instant, before_end_of,
                                          created_and_alive, day_end, day_key, in_days, is_open,
                                          is_success, non_negative, on_day, or_unknown,
                                          resolve_snapshot_date)
from caseledger.operators.calendar import with_workday, workday_number, workdays_between, worked_between
from caseledger.operators.joins import assemble_dense, join_scd2_as_of, lookup, versions_at
from caseledger.operators.ranking import latest, latest_as_of, previous_value
from caseledger.operators.skew import broadcast_within
from caseledger.plans.dims import AGENCY, OFFICER, SERVICE, STATUS
from caseledger.schemas import FACT_AGENCY_DAY, FACT_BACKLOG, FACT_TRANSITIONS, conform
from caseledger.session import materialize, staged
from caseledger.sources.tables import replace_partition

_CASE = ("ho_so_id", "co_quan_id", "dv_cong_id", "created_at", "event_time", "da_bi_xoa")
_EVENT = ("ho_so_id", "trang_thai_id", "can_bo_id", "action_time", "history_id")


# --- backlog ----------------------------------------------------------------------

def _with_keys(rows: DataFrame, dims: dict[str, DataFrame], day: date | None) -> DataFrame:
    """Attach version keys: agency, status and officer as of the snapshot day, the service
    as of creation.

    For a single day the dimensions are cut to the versions of that instant first, which
    leaves one row per key and plain equality joins.
    """
    for spec in (AGENCY, STATUS, OFFICER):
        dim = dims[spec.table]
        if day is not None:
            dim = versions_at(dim, day_end(day) - F.expr("INTERVAL 1 MICROSECOND"))
            rows = lookup(rows, dim, spec.key, {spec.sk: spec.sk})
        else:
            rows = join_scd2_as_of(rows, dim, spec.key, spec.key,
                                   as_of_instant(F.col("snapshot_day")), spec.sk, disjoint=True)
    return join_scd2_as_of(rows, dims[SERVICE.table], SERVICE.key, SERVICE.key,
                           F.col("created_at"), SERVICE.sk, disjoint=True)


def _backlog_fact(rows: DataFrame, dims: dict[str, DataFrame], cal: DataFrame,
                  day: date | None) -> DataFrame:
    """Ages in working days, version keys and the surrogate key of each open case-day."""
    rows = rows.withColumn("can_bo_id", or_unknown("can_bo_id"))
    rows = with_workday(rows, cal, "created_at", "_created_seq")
    rows = with_workday(rows, cal, "latest_action_time", "_action_seq")
    if day is not None:
        rows = rows.withColumn("_day_seq", F.lit(workday_number(cal, day)))
    else:
        rows = with_workday(rows, cal, "snapshot_day", "_day_seq")
    keyed = _with_keys(rows, dims, day).withColumn("thoi_gian_id", day_key("snapshot_day"))
    since = F.coalesce("_action_seq", "_created_seq")
    return conform(keyed.select(
        "*", F.xxhash64("thoi_gian_id", "ho_so_id").alias("id"), F.lit(1).alias("so_luong"),
        non_negative(F.col("_day_seq") - since).alias("so_ngay_ton_dong_hien_tai"),
        non_negative(F.col("_day_seq") - F.col("_created_seq")).alias("tong_thoi_gian_da_xu_ly"),
    ), FACT_BACKLOG)


def case_states(history: DataFrame, day: date) -> DataFrame:
    """The last event of each case up to the end of ``day``.

    The history is reduced to one row per case on the map side before it is exchanged.
    """
    return latest_as_of(history, "ho_so_id", "action_time", day, "history_id").select(*_EVENT)


def next_states(states: DataFrame, moved: DataFrame) -> DataFrame:
    """:func:`case_states` of a day from those of the day before and the last events of the day
    itself (:func:`moved_cases`); any of these is later than any state before it."""
    return (states.join(broadcast_within(moved.select("ho_so_id")), "ho_so_id", "left_anti")
            .unionByName(moved))


def moved_cases(history: DataFrame, day: date) -> DataFrame:
    """The last event of each case that has one on ``day``; no other day is read."""
    events = history.where(in_days(history, "action_time", day, day)).select(*_EVENT)
    return latest(events, "ho_so_id", ["action_time", "history_id"])


def open_cases(app: DataFrame, history: DataFrame, day: date,
               terminal: Sequence[int] = TERMINAL_STATUSES) -> DataFrame:
    """Cases open at the end of ``day`` with the state they had then."""
    return _open_cases(app, case_states(history, day), day, terminal)


def _open_cases(app: DataFrame, states: DataFrame, day: date,
                terminal: Sequence[int] = TERMINAL_STATUSES) -> DataFrame:
    """The status comes from the history only; a case without one counts as received."""
    cases = app.select(*_CASE).where(
        created_and_alive("created_at", "da_bi_xoa", "event_time", day))
    state = states.select("ho_so_id", "trang_thai_id", "can_bo_id",
                          F.col("action_time").alias("latest_action_time"))
    return (cases.join(state, "ho_so_id", "left")
            .withColumn("trang_thai_id", F.coalesce("trang_thai_id", F.lit(STATUS_RECEIVED)))
            .where(is_open("trang_thai_id", terminal))
            .withColumn("snapshot_day", F.lit(day)))


def backlog(app: DataFrame, history: DataFrame, dims: dict[str, DataFrame], cal: DataFrame,
            day: date, terminal: Sequence[int] = TERMINAL_STATUSES) -> DataFrame:
    """One row per open case at the end of ``day``."""
    return _backlog_fact(open_cases(app, history, day, terminal), dims, cal, day)


def open_ranges(app: DataFrame, history: DataFrame, first: date, last: date,
                terminal: Sequence[int] = TERMINAL_STATUSES) -> DataFrame:
    """The ranges of days (``_low`` to ``_high``) between ``first`` and ``last`` in which a case
    is open in one state, in one pass.

    Only the last event of a case and day matters, so the history is first combined to
    one row per case and day (everything before ``first`` counts as ``first``). That
    bounds the rows of any case by the number of days, and the window that turns them
    into validity ranges works on this reduced set.
    """
    entered = F.greatest(F.to_date("action_time"), F.lit(first))
    position = F.struct("action_time", "history_id")
    daily = (history.where(in_days(history, "action_time", None, last))
             .groupBy("ho_so_id", entered.alias("from_day"))
             .agg(F.max_by(F.struct("trang_thai_id", "can_bo_id", "action_time"), position)
                  .alias("state"))
             .select("ho_so_id", "from_day", "state"))
    # Per case: its states in order. At most one entry per day of the range.
    states = daily.groupBy("ho_so_id").agg(
        F.array_sort(F.collect_list(F.struct("from_day", "state"))).alias("states"))
    cases = app.select(*_CASE).where(before_end_of("created_at", last))
    begins = F.greatest(F.to_date("created_at"), F.lit(first))
    # A deleted case is there up to the day before the delete.
    ends = F.when(F.col("da_bi_xoa"),
                  F.least(F.date_sub(F.to_date("event_time"), 1), F.lit(last))
                  ).otherwise(F.lit(last))
    nothing = F.struct(F.lit(STATUS_RECEIVED).alias("trang_thai_id"),
                       F.lit(None).cast("int").alias("can_bo_id"),
                       F.lit(None).cast("timestamp").alias("action_time"))
    start = F.array(F.struct(F.lit(None).cast("date").alias("from_day"), nothing.alias("state")))
    timeline = F.concat(start, F.coalesce("states", F.array().cast(
        "array<struct<from_day:date,state:struct<trang_thai_id:int,can_bo_id:int,"
        "action_time:timestamp>>>")))
    ranges = (cases.join(states, "ho_so_id", "left")
              .withColumn("_begins", begins).withColumn("_ends", ends)
              .where(F.col("_begins") <= F.col("_ends"))
              .withColumn("_timeline", timeline)
              .withColumn("_timeline", F.transform("_timeline", lambda entry, n: F.struct(
                  entry["from_day"].alias("from_day"), entry["state"].alias("state"),
                  F.get("_timeline", n + 1)["from_day"].alias("next_day"))))
              .select(*_CASE, "_begins", "_ends", F.explode("_timeline").alias("_entry")))
    low = F.greatest("_begins", "_entry.from_day")
    high = F.least("_ends", F.coalesce(F.date_sub("_entry.next_day", 1), F.col("_ends")))
    return (ranges.where(is_open("_entry.state.trang_thai_id", terminal) & (low <= high))
            .select(*_CASE, F.coalesce("_entry.state.trang_thai_id", F.lit(STATUS_RECEIVED))
                    .alias("trang_thai_id"),
                    F.col("_entry.state.can_bo_id").alias("can_bo_id"),
                    F.col("_entry.state.action_time").alias("latest_action_time"),
                    low.alias("_low"), high.alias("_high")))


def open_case_days(app: DataFrame, history: DataFrame, first: date, last: date,
                   terminal: Sequence[int] = TERMINAL_STATUSES) -> DataFrame:
    """Open cases of every day between ``first`` and ``last``; days are generated only inside
    the ranges in which a case is open."""
    ranges = open_ranges(app, history, first, last, terminal)
    return ranges.withColumn("snapshot_day", F.explode(F.sequence("_low", "_high"))).drop("_low", "_high")


def _within_calendar(cal: DataFrame, first: date, last: date) -> None:
    """Refuse a range whose ends the calendar lacks: ages there would count from nothing."""
    for day in {first, last}:
        workday_number(cal, day)


def backlog_range(app: DataFrame, history: DataFrame, dims: dict[str, DataFrame],
                  cal: DataFrame, first: date, last: date,
                  terminal: Sequence[int] = TERMINAL_STATUSES) -> DataFrame:
    """The union of :func:`backlog` over all days of a range; the calendar must hold them all."""
    _within_calendar(cal, first, last)
    return _backlog_fact(open_case_days(app, history, first, last, terminal), dims, cal, None)


# --- agency day ---------------------------------------------------------------------

def received(app: DataFrame, first: date, last: date | None = None) -> DataFrame:
    """Cases created per agency and day, those deleted later included."""
    return (app.where(on_day("created_at", first, last))
            .groupBy(F.to_date("created_at").alias("snapshot_day"), "co_quan_id")
            .agg(F.count(F.lit(1)).alias("so_luong_tiep_nhan")))


def backlog_by_agency(snapshot: DataFrame) -> DataFrame:
    return (snapshot.groupBy("thoi_gian_id", "co_quan_id")
            .agg(F.sum("so_luong").alias("so_luong_ton_dong")))


def overdue_open(snapshot: DataFrame, service: DataFrame) -> DataFrame:
    """Open cases older than their SLA. The SLA is found through the stored version key,
    because the natural key has one row per version."""
    with_sla = lookup(snapshot, service, SERVICE.sk, {"thoi_han_tra_kq": "_sla"})
    return (with_sla.where(F.col("tong_thoi_gian_da_xu_ly") > F.col("_sla"))
            .groupBy("thoi_gian_id", "co_quan_id")
            .agg(F.count_distinct("ho_so_id").alias("so_luong_tre_han_dang_mo")))


def stock_of_days(app: DataFrame, history: DataFrame, service: DataFrame, cal: DataFrame,
                  first: date, last: date,
                  terminal: Sequence[int] = TERMINAL_STATUSES) -> tuple[DataFrame, DataFrame]:
    """:func:`backlog_by_agency` and :func:`overdue_open` of all days of a range, without the
    backlog of each day (``app`` has one row per case).

    Open ranges are counted by agency, ends and the working day after which they are overdue.
    That leaves no more rows than agencies and days allow, however many cases there are, and
    only these are laid out by day.
    """
    ranges = open_ranges(app, history, first, last, terminal).select(
        "co_quan_id", SERVICE.key, "created_at", "_low", "_high")
    ranges = join_scd2_as_of(ranges, service, SERVICE.key, SERVICE.key, F.col("created_at"),
                             SERVICE.sk, [("thoi_han_tra_kq", "_sla")], disjoint=True)
    ranges = with_workday(ranges, cal, "created_at", "_created_seq")
    # The age of a case is floored at zero, so a negative SLA is always exceeded.
    due = F.col("_created_seq") + F.col("_sla")
    low, high = max(workday_number(cal, first) - 1, 0), workday_number(cal, last)
    limit = F.when(F.col("_sla") < 0, -1).when(due.isNotNull(), F.least(F.greatest(due, F.lit(low)), F.lit(high)))
    counted = ranges.groupBy("co_quan_id", "_low", "_high", limit.alias("_limit")).agg(F.count(F.lit(1)).alias("_n"))
    days = counted.withColumn("snapshot_day", F.explode(F.sequence("_low", "_high")))
    days = with_workday(days, cal, "snapshot_day", "_day_seq").withColumn("thoi_gian_id", day_key("snapshot_day"))
    late = F.coalesce("_day_seq", F.lit(0)) > F.col("_limit")
    totals = days.groupBy("thoi_gian_id", "co_quan_id").agg(
        F.sum("_n").alias("so_luong_ton_dong"),
        F.sum(F.when(late, F.col("_n"))).alias("so_luong_tre_han_dang_mo"))
    totals = materialize(totals, "stock")
    return (totals.drop("so_luong_tre_han_dang_mo"),
            totals.drop("so_luong_ton_dong").where(F.col("so_luong_tre_han_dang_mo").isNotNull()))


def case_activity(history: DataFrame, payment: DataFrame, first: date,
                  last: date | None = None) -> DataFrame:
    """Completions, rejections and fees per case and day.

    Counted per event, before any join: a case with very many events becomes one row per
    day on the map side, and cases are joined to the application once for all measures.
    """
    end = last or first
    events = (history.where(in_days(history, "action_time", first, end)
                            & F.col("trang_thai_id").isin(STATUS_COMPLETED, STATUS_REJECTED))
              .select("ho_so_id", F.to_date("action_time").alias("snapshot_day"),
                      (F.col("trang_thai_id") == STATUS_COMPLETED).cast("int").alias("done"),
                      (F.col("trang_thai_id") == STATUS_REJECTED).cast("int").alias("rework"),
                      F.lit(0.0).alias("fee")))
    fees = (payment.where(in_days(payment, "thoi_gian_tt", first, end) & is_success("trang_thai_tt"))
            .select("ho_so_id", F.to_date("thoi_gian_tt").alias("snapshot_day"),
                    F.lit(0).alias("done"), F.lit(0).alias("rework"),
                    F.col("so_tien").alias("fee")))
    return (events.unionByName(fees).groupBy("ho_so_id", "snapshot_day")
            .agg(F.sum("done").alias("done"), F.sum("rework").alias("rework"),
                 F.sum("fee").alias("fee")))


def activity_by_agency(activity: DataFrame, app: DataFrame, service: DataFrame,
                       cal: DataFrame, last: date) -> DataFrame:
    """Completions on time and late, rejections and fees per agency and day.

    A completion whose case has no SLA version counts as on time; ``missing_sla`` shows
    how many there are.
    """
    cases = (app.where(before_end_of("created_at", last))
             .select("ho_so_id", "co_quan_id", "dv_cong_id", "created_at"))
    # Few cases move on one day, compared with all cases ever: within the bound they are
    # broadcast, and the big table is scanned in place instead of being exchanged.
    joined = (cases.join(broadcast_within(activity), "ho_so_id", "inner")
              .where(F.to_date("created_at") <= F.col("snapshot_day")))
    joined = join_scd2_as_of(joined, service, SERVICE.key, SERVICE.key, F.col("created_at"),
                             SERVICE.sk, [("thoi_han_tra_kq", "_sla")], disjoint=True)
    timed = workdays_between(joined, cal, "created_at", "snapshot_day", "_days")
    late = F.coalesce(F.col("_days") > F.col("_sla"), F.lit(False))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("done")).otherwise(0))

    return (timed.groupBy("snapshot_day", "co_quan_id")
            .agg(total(~late).alias("so_luong_dung_han"),
                 total(late).alias("so_luong_tre_han_da_dong"),
                 total(F.col("_sla").isNull()).alias("missing_sla"),
                 F.sum("rework").alias("so_luong_rework"),
                 F.sum("fee").alias("tong_chi_phi")))


def agency_days(app: DataFrame, history: DataFrame, payment: DataFrame, snapshot: DataFrame,
                dims: dict[str, DataFrame], cal: DataFrame, agencies: DataFrame, first: date,
                last: date, with_missing_sla: bool = False) -> DataFrame:
    """One row per agency and day, also for agencies where nothing happened.

    ``snapshot`` is the backlog of the same days, ``agencies`` has the column
    ``co_quan_id``. Late = completed late + open beyond the SLA.
    """
    stock = backlog_by_agency(snapshot), overdue_open(snapshot, dims[SERVICE.table])
    return _agency_days(app, history, payment, stock, dims, cal, agencies, first, last, with_missing_sla)


def _agency_days(app: DataFrame, history: DataFrame, payment: DataFrame, stock: tuple[DataFrame, DataFrame],
                 dims: dict[str, DataFrame], cal: DataFrame, agencies: DataFrame, first: date,
                 last: date, with_missing_sla: bool = False) -> DataFrame:
    _within_calendar(cal, first, last)
    service = dims[SERVICE.table]

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("thoi_gian_id", day_key("snapshot_day")).drop("snapshot_day")

    # The spine is the product of agencies and days on purpose: it is the result's grain.
    spine = (agencies.select("co_quan_id")
             .withColumn("snapshot_day", F.explode(F.sequence(F.lit(first), F.lit(last))))
             if first != last else agencies.select("co_quan_id", F.lit(first).alias("snapshot_day")))
    activity = case_activity(history, payment, first, last)
    dense = assemble_dense(
        dated(spine),
        dated(received(app, first, last)),
        *stock,
        dated(activity_by_agency(activity, app, service, cal, last)),
        key=["thoi_gian_id", "co_quan_id"])
    late = F.col("so_luong_tre_han_da_dong") + F.col("so_luong_tre_han_dang_mo")
    dense = dense.withColumn("so_luong_tre_han", late).withColumn(
        "id", F.xxhash64("thoi_gian_id", "co_quan_id"))
    keyed = join_scd2_as_of(
        dense, dims[AGENCY.table], AGENCY.key, AGENCY.key,
        as_of_instant(F.to_date(F.col("thoi_gian_id").cast("string"), "yyyyMMdd")), AGENCY.sk,
        disjoint=True)
    fact = conform(keyed, FACT_AGENCY_DAY)
    if with_missing_sla:
        return keyed.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                              for f in FACT_AGENCY_DAY], F.col("missing_sla").cast("int"))
    return fact


def agency_day(app: DataFrame, history: DataFrame, payment: DataFrame, snapshot: DataFrame,
               dims: dict[str, DataFrame], cal: DataFrame, agencies: DataFrame, day: date,
               with_missing_sla: bool = False) -> DataFrame:
    return agency_days(app, history, payment, snapshot, dims, cal, agencies, day, day,
                       with_missing_sla)


# --- transition archive -------------------------------------------------------------

def transitions(history: DataFrame, app: DataFrame, cal: DataFrame,
                min_rows: int | None = None, working_time: bool = False) -> DataFrame:
    """One row per status event: hours since the event before it (or since creation), and
    for completions the working days of the whole case.

    With ``working_time`` the hours leave out the days off of the calendar (null outside it).
    """
    options = {} if min_rows is None else {"min_rows": min_rows}
    ordered = previous_value(
        history.select("history_id", "ho_so_id", "trang_thai_id", "can_bo_id", "action_time")
        .where(F.col("action_time").isNotNull()),
        "ho_so_id", ["action_time", "history_id"], "action_time", "_previous", **options)
    cases = app.select("ho_so_id", "co_quan_id", "dv_cong_id", "created_at")
    joined = workdays_between(ordered.join(cases, "ho_so_id", "inner"), cal,
                              "created_at", "action_time", "_days")
    since = F.coalesce("_previous", "created_at")
    hours = (F.unix_micros("action_time") - F.unix_micros(since)) / F.lit(3_600_000_000.0)
    if working_time:
        joined = worked_between(joined.withColumn("_since", since), cal, "_since", "action_time", "_worked")
        hours = F.col("_worked") / F.lit(3600.0)
    return conform(joined.select(
        "*", F.col("history_id").alias("id"),
        F.when(F.col("action_time") >= since, hours).alias("thoi_gian_xu_ly"),
        F.when(F.col("trang_thai_id") == STATUS_COMPLETED, F.col("_days"))
        .alias("tong_ngay_lam_viec_xu_ly"),
        day_key("action_time").alias("thoi_gian_id")), FACT_TRANSITIONS)


# --- writing ------------------------------------------------------------------------

def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def build_day(silver: dict[str, DataFrame], dims: dict[str, DataFrame], cal: DataFrame,
              day: date | str | None = None, name=lambda table: table,
              today: date | None = None) -> None:
    """Replace both facts of one day; a repeated run gives the same partitions.

    Without a day it is yesterday in business time; a future day is refused.
    """
    day = resolve_snapshot_date(day, today)
    _build_day(silver, case_states(silver["application_history"], day), dims, cal, day, name)


def _build_day(silver: dict[str, DataFrame], states: DataFrame, dims: dict[str, DataFrame],
               cal: DataFrame, day: date, name) -> None:
    key = day.year * 10000 + day.month * 100 + day.day
    spark = cal.sparkSession
    replace_partition(_backlog_fact(_open_cases(silver["application"], states, day), dims, cal, day),
                      name("fact_ton_dong_ho_so"), "thoi_gian_id", key)
    # Read the day back: both facts then agree, and the backlog is not computed twice.
    snapshot = spark.table(name("fact_ton_dong_ho_so")).where(F.col("thoi_gian_id") == key)
    replace_partition(
        agency_day(silver["application"], silver["application_history"], silver["payment"],
                   snapshot, dims, cal, silver["agency"], day),
        name("fact_van_hanh_co_quan"), "thoi_gian_id", key)


def backfill(silver: dict[str, DataFrame], dims: dict[str, DataFrame], cal: DataFrame,
             first: date, last: date, name=lambda table: table,
             today: date | None = None) -> None:
    """Day by day, so an interrupted backfill continues where it was.

    The whole range is checked before the first day is written: it must lie in the calendar
    and not reach into the future. The whole history is read for the first day; each later day
    takes the states of the day before and its own events, both staged and removed after use.
    """
    resolve_snapshot_date(last, today)
    _within_calendar(cal, first, last)
    history = silver["application_history"]
    with ExitStack() as before:
        for day in days_between(first, last):
            if day == first:
                states = case_states(history, day)
            else:
                moved = before.enter_context(staged(moved_cases(history, day), "moved"))
                states = next_states(states, moved)
            with ExitStack() as current:
                if day != last:
                    states = current.enter_context(staged(states, "states"))
                _build_day(silver, states, dims, cal, day, name)
                before.close()
                before.push(current.pop_all())


def agency_days_from_silver(app: DataFrame, history: DataFrame, payment: DataFrame,
                            dims: dict[str, DataFrame], cal: DataFrame, agencies: DataFrame,
                            first: date, last: date) -> DataFrame:
    """Both steps without a stored backlog: that of one day is staged, that of a range only counted."""
    if first == last:
        snapshot = materialize(backlog(app, history, dims, cal, first), "backlog")
        return agency_days(app, history, payment, snapshot, dims, cal, agencies, first, last)
    _within_calendar(cal, first, last)
    stock = stock_of_days(app, history, dims[SERVICE.table], cal, first, last)
    return _agency_days(app, history, payment, stock, dims, cal, agencies, first, last)
