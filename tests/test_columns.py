from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseledger.functions import columns as C
from tests.conftest import rows


def test_event_key_marks_nulls_and_cannot_collide(spark):
    df = spark.createDataFrame([("a", None), ("a", "b"), ("a\u001fb", None)], "x string, y string")
    found = [r[0] for r in df.select(C.event_key("CDC", "x", "y")).collect()]
    assert found[0] == "CDC\u001fa\u001f<NULL>"
    assert found[1] == "CDC\u001fa\u001fb"
    assert len(set(found)) == 3


def test_dirty_input_gives_null_under_ansi(spark):
    df = spark.createDataFrame([("",), ("x",), ("7",), (None,)], "t string")
    assert [r[0] for r in df.select(C.to_int("t")).collect()] == [None, None, 7, None]
    assert [r[0] for r in df.select(C.to_double("t")).collect()] == [None, None, 7.0, None]
    assert df.where(C.to_time("t").isNotNull() & (F.col("t") == "x")).count() == 0


def test_epoch_conversion_keeps_microseconds(spark):
    df = spark.range(1).select(C.from_micros(F.lit(1704067200123457)), C.from_millis(F.lit(1704067200123)))
    assert tuple(df.first()) == (datetime(2024, 1, 1, 0, 0, 0, 123457), datetime(2024, 1, 1, 0, 0, 0, 123000))


def test_day_ranges_are_half_open(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23, 59, 59, 500000),), (datetime(2024, 1, 2),)], "t timestamp")
    assert df.where(C.on_day("t", date(2024, 1, 1))).count() == 1
    assert df.where(C.before_end_of("t", date(2024, 1, 1))).count() == 1
    assert df.where(C.on_day("t", date(2024, 1, 1), date(2024, 1, 2))).count() == 2


def test_as_of_instant_is_the_last_microsecond(spark):
    row = spark.range(1).select(C.as_of_instant(F.lit(date(2024, 1, 1)))).first()
    assert row[0] == datetime(2024, 1, 1, 23, 59, 59, 999999)


def test_elapsed_is_null_when_unknown_or_negative(spark):
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 0, 0, 900000)
    df = spark.createDataFrame([(a, b), (b, a), (None, b), (a, a)], "x timestamp, y timestamp")
    assert [r[0] for r in df.select(C.elapsed_seconds("x", "y")).collect()] == [3600, None, None, 0]
    assert [r[0] for r in df.select(C.elapsed_hours("x", "y")).collect()] == [1.0, None, None, 0.0]


def test_unknown_working_day_difference_becomes_zero(spark):
    df = spark.createDataFrame([(None,), (-3,), (2,)], "d int")
    assert [r[0] for r in df.select(C.non_negative(F.col("d"))).collect()] == [0, 0, 2]


def test_missing_status_counts_as_open(spark):
    df = spark.createDataFrame([(None,), (1,), (7,), (8,)], "s int")
    assert rows(df.where(C.is_open("s"))) == [(None,), (1,)]


def test_percent_guards_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(C.percent(F.col("a"), F.col("b"))).collect()] == [None, 25.0]


def test_snapshot_date_rules():
    today = date(2024, 5, 5)
    assert C.resolve_snapshot_date(None, today) == date(2024, 5, 4)
    assert C.resolve_snapshot_date("2024-05-05", today) == today
    with pytest.raises(ValueError):
        C.resolve_snapshot_date("2024-05-06", today)
    with pytest.raises(ValueError):
        C.resolve_snapshot_date("05/05/2024", today)
    # 20:00 UTC is already the next day seven hours east.
    from datetime import timezone
    assert C.business_today(datetime(2024, 5, 5, 20, tzinfo=timezone.utc)) == date(2024, 5, 6)
