from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseledger.operators import calendar as cal
from tests.conftest import rows


def test_weekends_and_fixed_holidays(spark):
    days = {r["ngay_date"]: r for r in cal.calendar(spark, date(2023, 1, 1), date(2023, 5, 2)).collect()}
    assert days[date(2023, 1, 1)]["stt_ngay_lam_viec"] == 0          # starts on a holiday
    assert days[date(2023, 1, 2)]["stt_ngay_lam_viec"] == 1
    assert days[date(2023, 1, 7)]["co_phai_la_ngay_nghi"]            # Saturday
    assert days[date(2023, 1, 7)]["stt_ngay_lam_viec"] == days[date(2023, 1, 6)]["stt_ngay_lam_viec"]
    assert days[date(2023, 5, 1)]["co_phai_la_ngay_nghi"]            # Monday, holiday
    assert days[date(2023, 5, 2)]["quy"] == 2 and days[date(2023, 5, 2)]["thoi_gian_id"] == 20230502


def test_dated_holidays(spark):
    extra = spark.createDataFrame([(date(2023, 1, 3),), (date(2023, 1, 3),)], "ngay_date date")
    days = {r["ngay_date"]: r for r in
            cal.calendar(spark, date(2023, 1, 2), date(2023, 1, 4), dated_holidays=extra).collect()}
    assert [days[date(2023, 1, d)]["stt_ngay_lam_viec"] for d in (2, 3, 4)] == [1, 1, 2]


def test_extension_in_steps_equals_one_build(spark):
    first = cal.extend_calendar(spark, None, date(2023, 3, 1), days_ahead=7)
    more = cal.extend_calendar(spark, first, date(2023, 6, 1), days_ahead=7)
    whole = cal.calendar(spark, cal.CALENDAR_START, date(2023, 6, 8))
    assert rows(first.unionByName(more)) == rows(whole)
    assert cal.extend_calendar(spark, whole, date(2023, 6, 1), days_ahead=7) is None
    with pytest.raises(ValueError):
        cal.extend_calendar(spark, None, date(2023, 6, 1), days_ahead=-1)


def test_working_days(spark):
    calendar = cal.calendar(spark, date(2023, 1, 1), date(2023, 12, 31))
    df = spark.createDataFrame([
        (1, datetime(2023, 1, 6, 9), datetime(2023, 1, 9, 8)),    # Friday to Monday
        (2, datetime(2023, 1, 7), datetime(2023, 1, 9)),          # created on Saturday
        (3, datetime(2023, 1, 9), datetime(2023, 1, 6)),          # backwards
        (4, datetime(2022, 12, 1), datetime(2023, 1, 9)),         # outside the calendar
        (5, datetime(2023, 1, 9, 1), datetime(2023, 1, 9, 23))], "id int, a timestamp, b timestamp")
    got = cal.workdays_between(df, calendar, "a", "b")
    assert rows(got, "id", "working_days") == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0)]
    assert got.columns == ["id", "a", "b", "working_days"]


def test_day_outside_the_calendar_is_refused(spark):
    calendar = cal.calendar(spark, date(2023, 1, 1), date(2023, 1, 31))
    assert cal.workday_number(calendar, date(2023, 1, 3)) == 2
    with pytest.raises(RuntimeError):
        cal.workday_number(calendar, date(2024, 1, 3))


def test_empty_range(spark):
    assert cal.date_spine(spark, date(2023, 1, 2), date(2023, 1, 1)).count() == 0


def test_working_time_between_times_of_day(spark):
    calendar = cal.calendar(spark, date(2023, 1, 1), date(2023, 12, 31))
    df = spark.createDataFrame([
        (1, datetime(2023, 1, 6, 18), datetime(2023, 1, 9, 6)),            # Friday evening to Monday morning
        (2, datetime(2023, 1, 7, 3), datetime(2023, 1, 8, 22)),            # within a weekend
        (3, datetime(2023, 1, 10, 9, 0, 1), datetime(2023, 1, 10, 9, 0, 4)),
        (4, datetime(2023, 4, 28, 23), datetime(2023, 5, 2, 1)),           # a weekend and two holidays
        (5, datetime(2023, 1, 9), datetime(2023, 1, 6)),                   # backwards
        (6, datetime(2022, 12, 1), datetime(2023, 1, 9)),                  # outside the calendar
        (7, None, datetime(2023, 1, 9)), (8, datetime(2023, 1, 9, 5), datetime(2023, 1, 9, 5))],
        "id int, a timestamp, b timestamp")
    got = cal.worked_between(df, calendar, "a", "b")
    assert rows(got, "id", "working_seconds") == [(1, 12 * 3600), (2, 0), (3, 3), (4, 2 * 3600), (5, None), (6, None), (7, None), (8, 0)]
    assert got.columns == ["id", "a", "b", "working_seconds"]
    office = cal.worked_between(df, calendar, "a", "b", opens=8, closes=17)
    assert rows(office.where("id < 5"), "id", "working_seconds") == [(1, 0), (2, 0), (3, 3), (4, 0)]
    with pytest.raises(ValueError):
        cal.worked_between(df, calendar, "a", "b", opens=9, closes=9)


def test_working_time_equals_a_walk_over_the_hours(spark):
    import random
    from datetime import timedelta
    rng, start = random.Random(4), datetime(2023, 4, 1)
    days = cal.calendar(spark, date(2023, 3, 1), date(2023, 6, 30))
    off = {r["ngay_date"] for r in days.collect() if r["co_phai_la_ngay_nghi"]}
    pairs = []
    for i in range(60):
        a = start + timedelta(minutes=rng.randrange(40 * 1440))
        pairs.append((i, a, a + timedelta(minutes=rng.randrange(14 * 1440))))

    def walk(a, b, opens, closes):
        minutes = int((b - a).total_seconds() // 60)
        return 60 * sum((t := a + timedelta(minutes=m)).date() not in off and opens <= t.hour < closes for m in range(minutes))
    df = spark.createDataFrame(pairs, "id int, a timestamp, b timestamp")
    for hours in ((0, 24), (8, 17)):
        got = dict(rows(cal.worked_between(df, days, "a", "b", opens=hours[0], closes=hours[1]), "id", "working_seconds"))
        assert got == {i: walk(a, b, *hours) for i, a, b in pairs}
