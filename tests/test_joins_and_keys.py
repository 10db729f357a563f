import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caseledger.operators import joins, keys
from caseledger.operators.skew import broadcast_within, hot_keys
from tests.conftest import rows

T = datetime(2024, 1, 1)


def test_trim_touches_only_strings(spark):
    df = spark.createDataFrame([(" a ", 1, None)], "x string, n int, y string")
    assert rows(keys.trim_strings(df)) == [("a", 1, None)]


def test_require_unique_names_examples(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    with pytest.raises(ValueError, match="1"):
        keys.require_unique(df, "id", "agency")
    assert rows(keys.duplicate_keys(df, "id")) == [(1, 2)]
    keys.require_unique(df, ["id", "v"])


def test_union_skips_missing_inputs(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "q")], "x int, y string")
    assert rows(keys.union_available(None, a, b)) == [(1, None), (2, "q")]
    assert keys.union_available(None, None) is None


def test_anti_join_treats_null_as_a_value(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, k string")
    right = spark.createDataFrame([(None,), ("a",)], "k string")
    assert rows(keys.anti_join(left, right, "k"), "id") == [(3,)]
    plan = keys.anti_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_unknown_member_is_appended(spark):
    dim = spark.createDataFrame([(1, "a", T)], "id int, ten string, at timestamp")
    assert rows(keys.with_unknown_member(dim, id=-1, ten="?")) == [(-1, "?", None), (1, "a", T)]


def test_audit_and_snapshot_columns(spark):
    df = keys.with_audit(spark.createDataFrame([(1,)], "id int"), "f", "s1", F.lit(T).cast("timestamp"))
    assert df.columns == ["id", "ingested_at", "file_name", "snapshot_id"]
    assert rows(keys.as_source_snapshot(df)) == [(1, T, "s1")]
    bare = keys.as_source_snapshot(df.drop("snapshot_id"))
    assert rows(bare, "source_snapshot_id") == [(None,)]


def versions(spark):
    return spark.createDataFrame([
        (1, 10, "a", T, T + timedelta(days=1)), (1, 11, "b", T + timedelta(days=1), None),
        (2, 20, "c", T + timedelta(days=2), T + timedelta(days=3)),
        (2, 21, "gone", T + timedelta(days=3), T + timedelta(days=3)),
    ], "k int, sk long, v string, effective_from_ts timestamp, effective_to_ts timestamp")


@pytest.mark.parametrize("strategy", ["hash", "sweep", "auto"])
def test_as_of_boundaries(spark, strategy):
    facts = spark.createDataFrame([
        (1, 1, T - timedelta(seconds=1)), (2, 1, T), (3, 1, T + timedelta(days=1) - timedelta(microseconds=1)),
        (4, 1, T + timedelta(days=1)), (5, 2, T + timedelta(days=3)), (6, 9, T), (7, None, T), (8, 1, None)],
        "id int, fk int, at timestamp")
    got = joins.join_scd2_as_of(facts, versions(spark), "k", "fk", F.col("at"), "sk", [("v", "value")], strategy)
    assert rows(got, "id", "sk", "value") == sorted([
        (1, None, None), (2, 10, "a"), (3, 10, "a"), (4, 11, "b"), (5, None, None), (6, None, None),
        (7, None, None), (8, None, None)])
    assert got.columns == ["id", "fk", "at", "sk", "value"]


def test_sweep_equals_hash_on_many_versions_of_one_key(spark):
    rng = random.Random(2)
    cuts = sorted(rng.sample(range(5000), 300))
    dim = [(7, i, str(i), T + timedelta(seconds=a), T + timedelta(seconds=b) if i % 9 else T + timedelta(seconds=(a + b) // 2))
           for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    dim = spark.createDataFrame(dim, "k int, sk long, v string, effective_from_ts timestamp, effective_to_ts timestamp")
    facts = spark.createDataFrame([(i, 7, T + timedelta(seconds=rng.randrange(5200))) for i in range(2000)],
                                  "id int, fk int, at timestamp")
    hashed = joins.join_scd2_as_of(facts, dim, "k", "fk", F.col("at"), "sk", strategy="hash")
    swept = joins._sweep_as_of(facts, dim.select(F.col("k").alias("_v_key"), F.col("effective_from_ts").alias("_v_from"),
                                                 F.col("effective_to_ts").alias("_v_to"), "sk"),
                               "fk", F.col("at"), ["sk"], share=0.1, min_rows=100)
    assert rows(swept, "id", "sk") == rows(hashed, "id", "sk")


def test_versions_at_gives_one_row_per_key(spark):
    assert rows(joins.versions_at(versions(spark), F.lit(T + timedelta(days=1)).cast("timestamp")), "sk") == [(11,)]


def test_dense_assembly_keeps_only_spine_keys(spark):
    spine = spark.createDataFrame([(1,), (2,)], "k int")
    a = spark.createDataFrame([(1, 5), (3, 6), (None, 7)], "k int, a int")
    b = spark.createDataFrame([(2, 1.5)], "k int, b double")
    assert rows(joins.assemble_dense(spine, a, b, key="k")) == [(1, 5, 0.0), (2, 0, 1.5)]


def test_interval_join_bounds_are_inclusive(spark):
    left = spark.createDataFrame([("x", T)], "k string, lt timestamp")
    right = spark.createDataFrame([("x", i, T + timedelta(milliseconds=m)) for i, m in enumerate(
        (-60_001, -60_000, 0, 60_000, 60_001))] + [("y", 9, T)], "rk string, id int, rt timestamp")
    got = joins.interval_join(left, right, [("k", "rk")], "lt", "rt", 60)
    assert rows(got, "id") == [(1,), (2,), (3,)]


def test_interval_join_equals_the_plain_condition_on_one_busy_key(spark):
    rng = random.Random(4)
    left = spark.createDataFrame([("x", i, T + timedelta(milliseconds=rng.randrange(3_000_000))) for i in range(400)],
                                 "k string, a int, lt timestamp")
    right = spark.createDataFrame([("x", i, T + timedelta(milliseconds=rng.randrange(3_000_000))) for i in range(400)],
                                  "rk string, b int, rt timestamp")
    got = joins.interval_join(left, right, [("k", "rk")], "lt", "rt", 60)
    gap = F.abs(F.unix_micros("lt") - F.unix_micros("rt")) <= 60_000_000
    plain = left.join(right, (F.col("k") == F.col("rk")) & gap)
    assert rows(got, "a", "b") == rows(plain, "a", "b")


def test_broadcast_is_hinted_only_within_the_bound(spark):
    # A join makes Catalyst's estimate a product, so the count decides.
    big = spark.range(60_000).withColumn("x", F.lit("y" * 10))
    wide = big.join(big.withColumnRenamed("x", "z"), "id")
    assert broadcast_within(wide, 1000) is wide
    assert broadcast_within(wide, 100_000_000) is not wide


@pytest.mark.parametrize("strategy", ["hash", "sweep"])
def test_overlapping_versions_give_one_row_per_fact(spark, strategy):
    day = lambda n: datetime(2024, 1, 1) + timedelta(n)
    dim = spark.createDataFrame(
        [(1, "A", day(0), None), (1, "B", day(5), day(10)), (1, "C", day(5), day(7)), (2, "D", day(0), day(3)),
         (2, "E", day(3), None), (3, "F", day(4), day(4)), (None, "G", day(0), None)],
        "k int, sk string, effective_from_ts timestamp, effective_to_ts timestamp")
    facts = spark.createDataFrame([(1, 1, day(12)), (2, 1, day(6)), (3, 1, day(8)), (4, 1, day(-1)), (5, 2, day(3)),
                                   (6, 3, day(4)), (7, None, day(1)), (8, 1, None)], "id int, fk int, at timestamp")
    got = joins.join_scd2_as_of(facts, dim, "k", "fk", F.col("at"), "sk", strategy=strategy)
    assert rows(got, "id", "sk") == [(1, "A"), (2, "C"), (3, "B"), (4, None), (5, "E"), (6, None), (7, None), (8, None)]


def test_hot_keys_of_a_small_share_are_complete(spark):
    df = spark.range(500_000).selectExpr("id % 5000 AS k")
    assert hot_keys(df, "k", share=0.0001, min_rows=1).count() == 5000
    with pytest.raises(ValueError):
        hot_keys(df, "k", share=1e-9)


def test_hot_keys_of_any_share_are_complete_with_more_sketches(spark):
    df = spark.range(600_000).selectExpr("cast(id / 1.5 as long) AS k")  # one or two rows a key
    found = hot_keys(df, "k", share=1 / 600_000, min_rows=1, sketches=6)
    want = df.distinct().selectExpr("xxhash64(k) AS _hash")
    assert found.count() == want.count() == 400_000 and want.join(found, "_hash", "left_anti").isEmpty()
    # The share is of all rows, not of a sketch's.
    df = spark.range(1000).selectExpr("CASE WHEN id < 100 THEN -1 ELSE id END AS k")
    assert [r[0] for r in hot_keys(df, "k", share=0.1, min_rows=1, sketches=5).collect()] == [spark.sql("SELECT xxhash64(-1L)").first()[0]]


def test_small_share_query_returns_every_key(spark):
    from __spark_entry__ import queries
    sf = "/root/testdata/sf0.1"
    keys = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey").distinct()
    got = queries()["F15_hot_key_sketch_small_share"](spark, sf)
    assert got.count() == keys.count() and keys.join(got, "l_orderkey", "left_anti").isEmpty()


def test_the_sweep_over_overlaps_equals_a_look_at_every_instant(spark):
    import random
    rng, day = random.Random(3), lambda n: datetime(2024, 1, 1) + timedelta(n)
    dim = []
    for k in range(25):
        for v in range(rng.randrange(1, 9)):
            start = rng.randrange(40)
            dim.append((k, f"{k}-{v}", day(start), None if rng.random() < 0.3 else day(start + rng.randrange(0, 15))))
    frame = spark.createDataFrame(dim, "k int, sk string, effective_from_ts timestamp, effective_to_ts timestamp")
    facts = spark.createDataFrame([(100 * k + n, k, day(n)) for k in range(25) for n in range(-1, 60)], "id int, fk int, at timestamp")

    def best(k, at):
        alive = [(f, sk, t is None, t or f) for key, sk, f, t in dim if key == k and f <= at and (t is None or at < t)]
        return max(alive)[1] if alive else None
    got = joins.join_scd2_as_of(facts, frame, "k", "fk", F.col("at"), "sk")
    assert rows(got, "id", "sk") == sorted(((100 * k + n, best(k, day(n))) for k in range(25) for n in range(-1, 60)), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_one_key_with_very_many_overlaps_stays_linear(spark):
    """A hundred thousand versions of one key that all overlap: one sweep, not their square."""
    n = 100_000
    micros = F.timestamp_micros(F.col("id") * 1_000_000)
    versions = spark.range(n).select(F.lit(1).alias("_v_key"), micros.alias("_v_from"),
                                     F.when(F.col("id") % 2 == 0, F.timestamp_micros(F.lit(10 * n * 1_000_000))).alias("_v_to"), F.col("id").alias("sk"))
    parts = joins.disjoint_ranges(versions, "sk")
    got = parts.agg(F.count(F.lit(1)), F.countDistinct("sk"), F.sum("sk"), F.count_if(F.col("_v_to").isNull())).first()
    assert tuple(got) == (n, n, n * (n - 1) // 2, 1)


def test_published_dimensions_need_no_repair(spark, name):
    from caseledger.plans import dims
    day = lambda n: datetime(2024, 1, 1) + timedelta(n)
    rows_ = [(10, 1, "a", "t", "p", day(0), None, True, "s"), (11, 1, "b", "t", "p", day(5), day(9), False, "s"),
             (12, 2, "c", "t", "p", day(3), day(3), False, "s"), (13, 2, "d", "t", "p", day(3), None, True, "s")]
    dim = spark.createDataFrame(rows_, "dim_co_quan_sk long, co_quan_id int, ten string, tinh string, phuong string, effective_from_ts timestamp, "
                                       "effective_to_ts timestamp, is_current boolean, source_snapshot_id string")
    table = name("dim")
    dims.publish(dim, dims.AGENCY, table)
    stored = spark.table(table)
    # The open version is cut around the one inside it; one that was never in force stays.
    assert rows(stored, "dim_co_quan_sk", "effective_from_ts", "effective_to_ts", "is_current") == [
        (10, day(0), day(5), False), (10, day(9), None, True), (11, day(5), day(9), False), (12, day(3), day(3), False), (13, day(3), None, True)]
    facts = spark.createDataFrame([(n, n % 2 + 1, day(n)) for n in range(-1, 12)], "id int, fk int, at timestamp")
    look = lambda d, **o: joins.join_scd2_as_of(facts, d, "co_quan_id", "fk", F.col("at"), "dim_co_quan_sk", **o)
    lean = look(stored, disjoint=True)
    assert rows(lean) == rows(look(dim)) and "Window" not in lean._jdf.queryExecution().executedPlan().toString()
