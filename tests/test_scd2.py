from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseledger.operators import scd2
from caseledger.operators.joins import join_scd2_as_of
from caseledger.session import cut_lineage
from tests.conftest import rows

SCHEMA = "id int, ten string, sla int, source_snapshot_at timestamp, source_snapshot_id string"
DAY0 = datetime(2024, 1, 1)
TRACKED = ["ten", "sla"]


def at(n):
    return DAY0 + timedelta(days=n)


def snapshot(spark, n, values):
    return spark.createDataFrame([(k, t, s, at(n), f"s{n}") for k, (t, s) in values.items()], SCHEMA)


def apply(spark, target, n, values):
    return scd2.scd2_apply(target, snapshot(spark, n, values), "id", TRACKED, "sk",
                           closed_at=F.lit(at(n)).cast("timestamp"))


def shown(dim):
    return rows(dim, "id", "ten", "sla", "effective_from_ts", "effective_to_ts", "is_current", "source_snapshot_id")


BASE = datetime(2023, 1, 1)


def test_first_load_starts_at_the_baseline(spark):
    dim = apply(spark, None, 0, {1: ("a", 3)})
    assert shown(dim) == [(1, "a", 3, BASE, None, True, "s0")]


def test_every_kind_of_change(spark):
    dim = apply(spark, None, 0, {1: ("same", 1), 2: ("old", 1), 3: ("x", None), 4: ("x", 1), 5: ("leaves", 1)})
    dim = apply(spark, dim, 1, {1: ("same", 1), 2: ("new", 1), 3: ("x", 4), 4: ("x", None), 6: ("comes", 1)})
    assert shown(dim) == sorted([
        (1, "same", 1, BASE, None, True, "s0"),
        (2, "new", 1, at(1), None, True, "s1"), (2, "old", 1, BASE, at(1), False, "s0"),
        (3, "x", 4, at(1), None, True, "s1"), (3, "x", None, BASE, at(1), False, "s0"),
        (4, "x", None, at(1), None, True, "s1"), (4, "x", 1, BASE, at(1), False, "s0"),
        (5, "leaves", 1, BASE, at(1), False, "s0"), (6, "comes", 1, at(1), None, True, "s1"),
    ], key=lambda row: tuple((v is not None, str(v)) for v in row))


def test_returning_key_opens_a_new_version(spark):
    dim = apply(spark, None, 0, {1: ("a", 1)})
    dim = apply(spark, dim, 1, {})
    dim = apply(spark, dim, 2, {1: ("a", 1)})
    assert shown(dim) == [(1, "a", 1, BASE, at(1), False, "s0"), (1, "a", 1, at(2), None, True, "s2")]
    assert len({r[0] for r in dim.select("sk").collect()}) == 2


def test_same_snapshot_twice_changes_nothing(spark):
    dim = apply(spark, apply(spark, None, 0, {1: ("a", 1)}), 1, {1: ("b", 1), 2: ("c", 2)})
    again = apply(spark, dim, 1, {1: ("b", 1), 2: ("c", 2)})
    assert rows(again) == rows(dim)


def test_duplicates(spark):
    twice = snapshot(spark, 0, {1: ("a", 1)})
    assert scd2.scd2_apply(None, twice.unionByName(twice), "id", TRACKED, "sk").count() == 1
    clash = twice.unionByName(snapshot(spark, 0, {1: ("b", 1)}))
    with pytest.raises(ValueError):
        scd2.scd2_apply(None, clash, "id", TRACKED, "sk")


def test_joined_attribute_change_under_the_same_snapshot_id(spark):
    """The key of the new version differs although the base row kept its snapshot id."""
    dim = apply(spark, None, 0, {1: ("a", 1)})
    later = snapshot(spark, 1, {1: ("b", 1)}).withColumn("source_snapshot_id", F.lit("s0"))
    dim = scd2.scd2_apply(dim, later, "id", TRACKED, "sk")
    assert dim.select("sk").distinct().count() == 2
    assert scd2.scd2_violations(dim, "id").isEmpty()


def test_violations_are_reported(spark):
    bad = spark.createDataFrame([
        (1, at(0), None, True), (1, at(1), None, True), (2, at(2), at(1), False), (3, at(0), at(5), False),
        (3, at(4), None, True)],
        "id int, effective_from_ts timestamp, effective_to_ts timestamp, is_current boolean")
    assert rows(scd2.scd2_violations(bad, "id")) == sorted([
        ("several_current", "1"), ("overlapping_range", "1"), ("inverted_range", "2"), ("overlapping_range", "3")])


def test_type1_view(spark):
    dim = apply(spark, apply(spark, None, 0, {1: ("a", 1)}), 1, {1: ("b", 1)})
    assert rows(scd2.current_attributes(dim, ["id", "ten"])) == [(1, "b")]


VALUES = st.dictionaries(st.integers(1, 4), st.tuples(st.sampled_from(["a", "b", None]), st.integers(1, 2)), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(VALUES, min_size=1, max_size=4))
def test_random_snapshots_keep_the_invariants_and_answer_as_of(spark, history):
    dim = None
    for n, values in enumerate(history):
        dim = cut_lineage(apply(spark, dim, n, values))
    assert scd2.scd2_violations(dim, "id").isEmpty()
    probes = spark.createDataFrame([(k, n, at(n) + timedelta(hours=1)) for n in range(len(history)) for k in range(1, 5)],
                                   "k int, n int, t timestamp")
    got = join_scd2_as_of(probes, dim, "id", "k", F.col("t"), "sk", [("ten", "ten"), ("sla", "sla")])
    want = [(k, n, *history[n].get(k, (None, None))) for n in range(len(history)) for k in range(1, 5)]
    assert rows(got, "k", "n", "ten", "sla") == sorted(want, key=lambda row: tuple((v is not None, str(v)) for v in row))
