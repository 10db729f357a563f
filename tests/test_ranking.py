import random
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseledger.operators import ranking
from caseledger.operators.skew import hot_keys, split_hot_keys
from tests.conftest import rows

BASE = datetime(2024, 1, 1)


def events(n, seed=1, hot=0.6):
    """Most events belong to one key; times repeat and are sometimes missing."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(20)}"
        at = None if rng.random() < 0.02 else BASE + timedelta(seconds=rng.randrange(n // 2))
        made.append((i, key, at, rng.randrange(9) if rng.random() < 0.3 else None,
                     f"v{i}" if rng.random() < 0.1 else None))
    return made


SCHEMA = "id int, key string, at timestamp, a int, b string"


def expected_fill(made):
    out, state = [], {}
    for i, key, at, a, b in sorted(made, key=lambda r: (r[1], r[2] is not None, r[2] or BASE, r[0])):
        last = state.setdefault(key, [None, None])
        last[0] = a if a is not None else last[0]
        last[1] = b if b is not None else last[1]
        out.append((i, last[0], last[1]))
    return sorted(out, key=lambda row: tuple((v is not None, str(v)) for v in row))


def test_latest_is_nulls_last_and_deterministic(spark):
    df = spark.createDataFrame([("x", None, 1), ("x", BASE, 2), ("x", BASE, 3), ("y", None, 4)],
                               "k string, t timestamp, id int")
    assert rows(ranking.latest(df, "k", ["t", "id"]), "k", "id") == [("x", 3), ("y", 4)]


def test_latest_plans_a_group_limit_below_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = ranking.latest(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_as_of_excludes_later_events(spark):
    df = spark.createDataFrame(
        [("x", datetime(2024, 1, 1, 23, 59, 59, 500000), 1), ("x", datetime(2024, 1, 2), 2)],
        "k string, t timestamp, id int")
    assert rows(ranking.latest_as_of(df, "k", "t", date(2024, 1, 1), "id"), "id") == [(1,)]


def test_latest_snapshot_keeps_all_its_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "id int, at int")
    assert rows(ranking.latest_snapshot(df, "at"), "id") == [(2,), (3,)]


def test_forward_fill_equals_a_plain_loop(spark):
    made = events(3000)
    df = spark.createDataFrame(made, SCHEMA)
    want = expected_fill(made)
    for options in ({"split_hot": False}, {}, {"min_rows": 50, "splits": 16, "share": 0.01}):
        assert rows(ranking.forward_fill(df, "key", ["at", "id"], ["a", "b"], **options), "id", "a", "b") == want


def test_hot_keys_are_found_and_split_in_order(spark):
    df = spark.createDataFrame(events(3000), SCHEMA)
    assert hot_keys(df, "key", 0.3, 100).count() == 1
    parts = split_hot_keys(df, "key", F.unix_micros("at"), splits=16, share=0.3, min_rows=100)
    assert parts.where("key <> 'hot' AND _chunk IS NOT NULL").count() == 0
    sizes = [r["count"] for r in parts.where("key = 'hot'").groupBy("_chunk").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * sum(sizes) / len(sizes)
    spans = (parts.where("key = 'hot' AND at IS NOT NULL").groupBy("_chunk")
             .agg(F.min("at").alias("a"), F.max("at").alias("b")).orderBy("_chunk").collect())
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_latest_filled_equals_fill_then_latest(spark):
    df = spark.createDataFrame(events(2000, seed=3), SCHEMA)
    filled = ranking.forward_fill(df, "key", ["at", "id"], ["a", "b"], split_hot=False)
    # The window puts missing times first, so the newest row is the greatest (at, id).
    slow = ranking.latest(filled, "key", ["at", "id"])
    fast = ranking.latest_filled(df, "key", ["at", "id"], ["a", "b"], ["id"])
    assert rows(fast, "key", "a", "b", "id") == rows(slow, "key", "a", "b", "id")


def test_previous_value_with_split_keys(spark):
    df = spark.createDataFrame([r for r in events(2000, seed=5) if r[2] is not None], SCHEMA)
    plain = ranking.previous_value(df, "key", ["at", "id"], "at", "p", split_hot=False)
    split = ranking.previous_value(df, "key", ["at", "id"], "at", "p", min_rows=50, splits=16, share=0.01)
    assert rows(split, "id", "p") == rows(plain, "id", "p")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 30), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=60))
def test_forward_fill_property(spark, data):
    made = [(i, k, BASE + timedelta(seconds=t), a, None) for i, (k, t, a) in enumerate(data)]
    df = spark.createDataFrame(made, SCHEMA)
    got = ranking.forward_fill(df, "key", ["at", "id"], ["a", "b"], min_rows=2, splits=4, share=0.01)
    assert rows(got, "id", "a", "b") == expected_fill(made)
