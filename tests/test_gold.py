import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F


from caseledger.operators import quality
from caseledger.operators.calendar import calendar
from caseledger.plans import gold, kpi
from caseledger.plans.dims import AGENCY, OFFICER, SERVICE, STATUS
from caseledger.schemas import FACT_AGENCY_DAY, FACT_BACKLOG, FACT_TRANSITIONS, assert_schema
from caseledger.session import shared_dir
from tests.conftest import rows

DAY = date(2024, 1, 10)
OLD = datetime(2023, 1, 1)


def at(day, hour=9, **more):
    return datetime(2024, 1, day, hour) + timedelta(**more)


@pytest.fixture(scope="module")
def cal(spark):
    return calendar(spark, date(2023, 1, 1), date(2024, 12, 31))


@pytest.fixture(scope="module")
def dims(spark):
    def dim(spec, data, extra):
        return spark.createDataFrame(
            data, f"{spec.sk} long, {spec.key} int, {extra}, effective_from_ts timestamp, effective_to_ts timestamp")
    change = datetime(2024, 1, 9, 12)
    return {
        AGENCY.table: dim(AGENCY, [(1, 1, "A", OLD, change), (2, 1, "A2", change, None), (3, 2, "B", OLD, None)], "ten string"),
        STATUS.table: dim(STATUS, [(10 + i, i, f"S{i}", OLD, None) for i in range(1, 9)], "ma_trang_thai string"),
        OFFICER.table: dim(OFFICER, [(20, 5, "O", OLD, None), (21, -1, "?", OLD, None)], "ten string"),
        SERVICE.table: dim(SERVICE, [(30, 1, 3, OLD, None), (31, 2, 1, datetime(2024, 1, 5), None)], "thoi_han_tra_kq int"),
    }


APP = "ho_so_id string, co_quan_id int, dv_cong_id int, created_at timestamp, event_time timestamp, da_bi_xoa boolean"
HIST = "history_id string, ho_so_id string, trang_thai_id int, can_bo_id int, action_time timestamp"
PAY = "ma_giao_dich string, ho_so_id string, so_tien double, trang_thai_tt string, thoi_gian_tt timestamp"


def test_backlog_rules(spark, cal, dims):
    app = spark.createDataFrame([
        ("plain", 1, 1, at(8), at(8), False), ("none", 1, 1, at(8), at(8), False),
        ("later", 1, 1, at(11), at(11), False), ("gone", 1, 1, at(8), at(10, 8), True),
        ("gone_after", 1, 1, at(8), at(11, 0), True), ("done", 1, 1, at(8), at(8), False),
        ("reopened", 1, 1, at(8), at(8), False), ("tie", 2, 1, at(8), at(8), False),
        ("edge", 2, 1, at(10, 23, minutes=59, seconds=59, milliseconds=500), at(10), False)], APP)
    history = spark.createDataFrame([
        ("h1", "plain", 3, 5, at(9)), ("h2", "plain", 7, 5, at(11)), ("h3", "done", 7, 5, at(9)),
        ("h4", "reopened", 7, 5, at(8)), ("h5", "reopened", 2, None, at(9)),
        ("a", "tie", 7, 5, at(9)), ("b", "tie", 4, 5, at(9)),
        ("h9", "edge", 7, 5, at(11, 0))], HIST)
    fact = gold.backlog(app, history, dims, cal, DAY)
    assert_schema(fact, FACT_BACKLOG)
    got = {r["ho_so_id"]: r for r in fact.collect()}
    assert set(got) == {"plain", "none", "gone_after", "reopened", "tie", "edge"}
    assert (got["plain"]["trang_thai_id"], got["plain"]["so_ngay_ton_dong_hien_tai"], got["plain"]["tong_thoi_gian_da_xu_ly"]) == (3, 1, 2)
    assert (got["none"]["trang_thai_id"], got["none"]["can_bo_id"], got["none"]["so_ngay_ton_dong_hien_tai"]) == (1, -1, 2)
    assert got["none"]["dim_can_bo_sk"] == 21 and got["reopened"]["can_bo_id"] == -1
    assert got["tie"]["trang_thai_id"] == 4 and got["edge"]["tong_thoi_gian_da_xu_ly"] == 0
    assert got["plain"]["dim_co_quan_sk"] == 2          # the version of the snapshot day
    assert gold.backlog(app, history, dims, cal, date(2024, 1, 8)).where("ho_so_id = 'plain'").first()["dim_co_quan_sk"] == 1
    with pytest.raises(RuntimeError):
        gold.backlog(app, history, dims, cal, date(2030, 1, 1))


def test_agency_day_rules(spark, cal, dims):
    app = spark.createDataFrame([
        ("new", 1, 1, at(10), at(10), False), ("new_deleted", 1, 1, at(10), at(10, 10), True),
        ("slow", 1, 2, at(5), at(5), False), ("quick", 1, 1, at(9), at(9), False),
        ("no_sla", 1, 2, at(3), at(3), False), ("overdue", 1, 1, at(2), at(2), False),
        ("rejected", 2, 1, at(9), at(9), False)], APP)
    history = spark.createDataFrame([
        ("1", "slow", 7, 5, at(10)), ("2", "slow", 7, 5, at(10, 11)), ("3", "quick", 7, 5, at(10, 23, minutes=59, seconds=59, milliseconds=900)),
        ("4", "no_sla", 7, 5, at(10)), ("5", "rejected", 8, 5, at(10)), ("6", "rejected", 8, 5, at(10, 12)),
        ("7", "overdue", 3, 5, at(3))], HIST)
    payment = spark.createDataFrame([
        ("p1", "quick", 100.0, "Success", at(10)), ("p2", "quick", 50.0, "SUCCESS", at(10, 23)), ("p3", "quick", 9.0, "failed", at(10)),
        ("p4", "quick", 9.0, "success", at(11)), ("p5", "unknown", 9.0, "success", at(10))], PAY)
    agencies = spark.createDataFrame([(1,), (2,), (3,)], "co_quan_id int")
    snapshot = gold.backlog(app, history, dims, cal, DAY)
    fact = gold.agency_day(app, history, payment, snapshot, dims, cal, agencies, DAY)
    assert_schema(fact, FACT_AGENCY_DAY)
    got = {r["co_quan_id"]: r.asDict() for r in fact.collect()}
    one = got[1]
    # Received includes the case deleted later; completions count events, not cases; a
    # completion without an SLA version counts as on time; late adds the overdue open case.
    assert (one["so_luong_tiep_nhan"], one["so_luong_dung_han"], one["so_luong_tre_han"], one["so_luong_rework"]) == (2, 2, 3, 0)
    assert one["so_luong_ton_dong"] == 2 and one["tong_chi_phi"] == 150 and one["dim_co_quan_sk"] == 2
    assert got[2]["so_luong_rework"] == 2 and got[2]["so_luong_ton_dong"] == 0
    assert got[3]["so_luong_tiep_nhan"] == 0 and got[3]["dim_co_quan_sk"] is None
    visible = gold.agency_day(app, history, payment, snapshot, dims, cal, agencies, DAY, with_missing_sla=True)
    assert visible.where("co_quan_id = 1").first()["missing_sla"] == 1
    assert quality.recon_backlog(fact, snapshot).isEmpty()


def random_world(spark, seed, cases=150):
    rng = random.Random(seed)
    app = [(f"c{i}", rng.choice([1, 2]), rng.choice([1, 2]), at(rng.randint(1, 14), rng.randrange(24)),
            at(rng.randint(8, 20), rng.randrange(24)), rng.random() < 0.2) for i in range(cases)]
    history = [(f"h{i}", f"c{rng.randrange(cases) if rng.random() < 0.7 else 0}", rng.randint(2, 8), rng.choice([5, None]),
                at(rng.randint(1, 18), rng.randrange(24))) for i in range(cases * 4)]
    payment = [(f"p{i}", f"c{rng.randrange(cases)}", float(rng.randrange(1000)), rng.choice(["success", "no"]), at(rng.randint(6, 15)))
               for i in range(cases)]
    return (spark.createDataFrame(app, APP), spark.createDataFrame(history, HIST), spark.createDataFrame(payment, PAY))


@pytest.mark.parametrize("seed", [1, 2])
def test_range_equals_the_daily_loop(spark, cal, dims, seed):
    app, history, payment = random_world(spark, seed)
    first, last = date(2024, 1, 6), date(2024, 1, 12)
    agencies = spark.createDataFrame([(1,), (2,), (9,)], "co_quan_id int")
    ranged = gold.backlog_range(app, history, dims, cal, first, last)
    ranged_days = gold.agency_days(app, history, payment, ranged, dims, cal, agencies, first, last)
    loop, loop_days = [], []
    for day in gold.days_between(first, last):
        snapshot = gold.backlog(app, history, dims, cal, day)
        loop += rows(snapshot)
        loop_days += rows(gold.agency_day(app, history, payment, snapshot, dims, cal, agencies, day))
    def order(found):
        return sorted(found, key=lambda row: tuple((v is not None, str(v)) for v in row))
    assert rows(ranged) == order(loop)
    assert rows(ranged_days) == order(loop_days)
    assert len(loop) > 200


@pytest.mark.parametrize("seed", [4, 5])
def test_a_range_is_counted_without_its_case_days(spark, cal, dims, seed, monkeypatch):
    app, history, payment = random_world(spark, seed)
    # An SLA below zero, none for some days, and a case from before the calendar.
    service = dims["dim_dich_vu_cong"]
    odd = {**dims, "dim_dich_vu_cong": service.withColumn("thoi_han_tra_kq", F.when(F.col("dv_cong_id") == 2, -1).otherwise(F.col("thoi_han_tra_kq")))}
    old = spark.createDataFrame([("old", 1, 1, datetime(1990, 1, 1), datetime(1990, 1, 1), False)], app.schema)
    app, first, last = app.unionByName(old), date(2024, 1, 6), date(2024, 1, 12)
    agencies = spark.createDataFrame([(1,), (2,), (9,)], "co_quan_id int")
    staged, keep = [], gold.materialize
    monkeypatch.setattr(gold, "materialize", lambda df, *a: staged.append(keep(df, *a)) or staged[-1])
    for known in (dims, odd):
        snapshot = gold.backlog_range(app, history, known, cal, first, last)
        want = gold.agency_days(app, history, payment, snapshot, known, cal, agencies, first, last)
        got = gold.agency_days_from_silver(app, history, payment, known, cal, agencies, first, last)
        assert rows(got) == rows(want)
    assert [frame.count() <= 2 * 7 for frame in staged] == [True, True]


def test_backfill_is_idempotent(spark, cal, dims, name):
    app, history, payment = random_world(spark, 3, 40)
    silver = {"application": app, "application_history": history, "payment": payment,
              "agency": spark.createDataFrame([(1,), (2,)], "co_quan_id int")}
    prefix = name("gold")
    states = []
    for _ in range(2):
        gold.backfill(silver, dims, cal, date(2024, 1, 9), DAY, lambda t: f"{prefix}_{t}")
        states.append([rows(spark.table(f"{prefix}_{t}")) for t in ("fact_ton_dong_ho_so", "fact_van_hanh_co_quan")])
    assert states[0] == states[1] and len(states[0][1]) == 4
    assert quality.orphan_keys(spark.table(f"{prefix}_fact_ton_dong_ho_so"), dims[AGENCY.table], AGENCY.sk).isEmpty()


def test_backfill_reads_the_whole_history_once(spark, cal, monkeypatch):
    history = spark.createDataFrame([
        ("x1", "edge", 3, 5, at(8)), ("x2", "edge", 4, None, at(9, 0)), ("x3", "edge", 2, 5, at(9, 0)), ("x4", "edge", 7, 5, None),
        ("x5", "edge", 7, 5, at(9, 23, minutes=59, seconds=59, microseconds=999_999)), ("x6", "edge", 2, 5, at(10, 0)),
        ("y1", "old", 3, 5, at(1)), ("y2", "old", 7, 5, at(11)), ("z1", "new", 2, 5, at(10)), ("n1", None, 2, 5, at(9))], HIST).coalesce(1)
    days = gold.days_between(date(2024, 1, 7), DAY)
    want = {day: rows(gold.case_states(history, day)) for day in days}
    read, got, plain = [], {}, gold.case_states
    monkeypatch.setattr(gold, "case_states", lambda *a: read.append(a[1]) or plain(*a))
    monkeypatch.setattr(gold, "_build_day", lambda silver, states, dims, cal, day, name: got.update({day: rows(states)}))
    gold.backfill({"application_history": history}, {}, cal, days[0], DAY)
    assert read == days[:1] and got == want and want[DAY] != want[days[2]]
    assert not [p for p in Path(shared_dir(spark)).iterdir() if p.name.startswith(("states-", "moved-"))]


def test_transitions(spark, cal):
    app = spark.createDataFrame([("a", 1, 1, at(5), at(5), False)], APP)
    history = spark.createDataFrame([("h1", "a", 2, 5, at(5, 15)), ("h2", "a", 7, 5, at(8, 15)), ("h0", "a", 1, 5, at(4))], HIST)
    fact = gold.transitions(history, app, cal)
    assert_schema(fact, FACT_TRANSITIONS)
    got = {r["id"]: (r["thoi_gian_xu_ly"], r["tong_ngay_lam_viec_xu_ly"], r["thoi_gian_id"]) for r in fact.collect()}
    # The first event lies before creation, so its duration is unknown.
    assert got == {"h0": (None, None, 20240104), "h1": (30.0, None, 20240105), "h2": (72.0, 1, 20240108)}
    split = gold.transitions(random_world(spark, 4)[1], random_world(spark, 4)[0], cal, min_rows=20)
    whole = gold.transitions(random_world(spark, 4)[1], random_world(spark, 4)[0], cal)
    assert rows(split) == rows(whole)


def test_kpis(spark, cal):
    fact = spark.createDataFrame([(1, 20240110, 4, 1, 1, 2, 6, 100), (2, 20240110, 0, 0, 0, 0, 0, 0), (1, 20240111, 6, 1, 1, 0, 4, 50)],
        "co_quan_id int, thoi_gian_id int, so_luong_tiep_nhan int, so_luong_dung_han int, so_luong_tre_han int, so_luong_rework int, so_luong_ton_dong int, tong_chi_phi long")
    assert rows(kpi.kpi_monthly(fact, cal, 20240101, 20240131)) == [(2024, 1, 10, 150, 10, 10.0, 20.0)]
    per = {r["co_quan_id"]: r for r in kpi.kpi_agency(fact).collect()}
    assert per[2]["ty_le_tre_han_pct"] is None and per[1]["tai_cong_viec"] == 20


def test_stocks_are_those_of_the_last_day_of_a_period(spark, cal):
    fact = spark.createDataFrame(
        [(1, 20240130, 4, 1, 1, 6, 100), (2, 20240130, 1, 0, 0, 9, 10), (1, 20240131, 6, 1, 0, 4, 50), (1, 20240201, 2, 0, 0, 5, 0),
         (2, 20240201, 1, 0, 0, 3, 7)],
        "co_quan_id int, thoi_gian_id int, so_luong_tiep_nhan int, so_luong_tre_han int, so_luong_rework int, so_luong_ton_dong int, tong_chi_phi long")
    month = kpi.kpi_periods(fact, cal)
    assert rows(month, "nam", "thang", "tong_tiep_nhan", "tong_ton_dong", "tai_cong_viec") == [(2024, 1, 11, 4, 15), (2024, 2, 3, 8, 11)]
    # An agency without a row on the month's last day has nothing open then.
    per = kpi.kpi_periods(fact, cal, by="co_quan_id")
    assert rows(per, "thang", "co_quan_id", "tong_tiep_nhan", "tong_ton_dong") == [(1, 1, 10, 4), (1, 2, 1, 0), (2, 1, 2, 5), (2, 2, 1, 3)]
    assert rows(kpi.kpi_periods(fact, cal, ("nam", "quy")), "quy", "tong_doanh_thu_vnd", "tong_ton_dong") == [(1, 167, 8)]
    assert month.where("thang = 1").first()["ty_le_tre_han_pct"] == pytest.approx(100 * 2 / 15)
    assert kpi.kpi_periods(fact.where("false"), cal).count() == 0


def test_gate(spark):
    with pytest.raises(ValueError):
        quality.not_empty(spark.range(0))
    assert quality.not_empty(spark.range(1)).count() == 1
    assert rows(quality.recon_counts({"a": spark.range(2), "b": spark.range(0)})) == [("a", 2), ("b", 0)]
    bad = spark.createDataFrame([("x",), ("x",)], "id string")
    assert rows(quality.event_uniqueness(bad)) == [(2, 1)]


def test_stored_history_and_payments_are_pruned_by_day(spark, cal, dims, name):
    from caseledger.sources.tables import append_new_only
    app, history, payment = random_world(spark, 5, 40)
    h, p = name("history"), name("payment")
    append_new_only(history, h, "history_id", ("action_time", "action_date"))
    append_new_only(payment, p, "ma_giao_dich", ("thoi_gian_tt", "paid_date"))
    activity = gold.case_activity(spark.table(h), spark.table(p), DAY)
    plan = activity._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(action_date" in plan and "PartitionFilters: [isnotnull(paid_date" in plan
    assert rows(activity) == rows(gold.case_activity(history, payment, DAY))
    stored = gold.backlog(app, spark.table(h), dims, cal, DAY)
    assert "(action_date" in stored._jdf.queryExecution().executedPlan().toString()
    assert rows(stored) == rows(gold.backlog(app, history, dims, cal, DAY))


def test_days_outside_the_calendar_and_in_the_future_are_refused(spark, cal, dims):
    app = spark.createDataFrame([("a", 1, 1, at(1), at(1), None)], APP)
    hist = spark.createDataFrame([], HIST)
    outside = date(2025, 1, 2)
    with pytest.raises(RuntimeError, match="calendar"):
        gold.backlog_range(app, hist, dims, cal, DAY, outside)
    with pytest.raises(RuntimeError, match="calendar"):
        gold.backlog(app, hist, dims, cal, outside)
    silver = {"application": app, "application_history": hist, "payment": spark.createDataFrame([], PAY)}
    with pytest.raises(ValueError, match="future"):
        gold.build_day(silver, dims, cal, "2024-01-11", today=DAY)
    with pytest.raises(ValueError, match="future"):
        gold.backfill(silver, dims, cal, DAY, date(2024, 1, 11), today=DAY)


def test_a_case_without_a_delete_flag_is_open_in_both_ways(spark, cal, dims):
    app = spark.createDataFrame([("a", 1, 1, at(1), at(1), None), ("b", 1, 1, at(1), at(5), True)], APP)
    hist = spark.createDataFrame([], HIST)
    daily = rows(gold.backlog(app, hist, dims, cal, DAY), "ho_so_id", "thoi_gian_id")
    assert daily == rows(gold.backlog_range(app, hist, dims, cal, DAY, DAY), "ho_so_id", "thoi_gian_id") == [("a", 20240110)]
