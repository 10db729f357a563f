"""Mixing, packing and exact search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseledger.llm import mixing, packing, topk


def brute_targets(sizes):
    """sizes in source order, null last."""
    total, weights = sum(sizes), [i % 3 + 1 for i in range(len(sizes))]
    capped = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        share = (total - sum(3 * sizes[i] for i in capped)) / sum(weights[i] for i in free) if free else 0
        more = {i for i in free if weights[i] * share > 3 * sizes[i]}
        if not more:
            return [3 * s if i in capped else weights[i] * share for i, s in enumerate(sizes)]
        capped |= more


def test_targets_and_shares(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randrange(1, 9)), rng.choice(["a", "b", "é", "z", None, "z", "z", "z"])) for i in range(600)]
    rows += [(900, None, "only-null"), (901, "", "b"), (902, "x", "tiny"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS mix_size_", "2 AS key", "3 AS target")
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sources = sorted({r[2] for r in rows if r[2] is not None}, key=lambda s: s.encode()) + [None]
    size = lambda t: len((t or "").split())
    sizes = [sum(size(t) for _, t, s in rows if s == x) for x in sources]
    for x, n, want in zip(sources, sizes, brute_targets(sizes)):
        mine = [r for r in out if r["source"] == x]
        assert all(r["mix_target"] == pytest.approx(want) and r["mix_source_size"] == n for r in mine)
        taken = sum(r["mix_size"] * r["mix_copies"] for r in mine)
        assert abs(taken - want) <= max([r["mix_size"] for r in mine], default=0) / 2 + 1e-6
        assert all(math.floor(want / n if n else 0) <= r["mix_copies"] <= 3 for r in mine)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["mix_copies"]) for r in again) == sorted((r["doc_id"], r["mix_copies"]) for r in out)
    assert mixing.mix(docs.where("false")).count() == 0


def test_hot_range_is_ordered_exactly(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGES", 4)
    rows = [(i, "w " * (i % 7 + 1), "s" if i % 3 else "t") for i in range(300)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = out.groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_copies")), F.first("mix_target")).collect()
    assert all(abs(r[1] - r[2]) <= 3.5 for r in got)


def test_best_fit_keeps_every_word_and_shrinks_bins():
    rng = random.Random(3)
    sizes = sorted((rng.randrange(1, 4097) for _ in range(500)), reverse=True)
    where, offset, final = packing.best_fit(sizes)
    bins = {}
    for size, b, o in zip(sizes, where, offset):
        bins.setdefault(b, []).append((o, size))
    for b, parts in bins.items():
        parts.sort()
        assert all(parts[i][0] + parts[i][1] == parts[i + 1][0] for i in range(len(parts) - 1)) and parts[0][0] == 0
        filled = sum(s for _, s in parts)
        assert final[b] == min(x for x in packing.LENGTHS if x >= filled)
    assert sum(final) < 1.1 * sum(sizes)
    # Best fit: a piece never opens a bin while an open one has room for it.
    assert packing.best_fit([300, 200, 12], (512,))[0] == [0, 0, 0]


def test_pack_covers_documents(spark):
    rows = [(1, "w " * 10_000), (2, None), (3, ""), (4, "a b"), (4, "a b"), (None, "c " * 700), (5, " ".join("é" * 600))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS piece", "3 AS shard")
    out = packing.pack(docs).collect()
    per = {}
    for r in out:
        per.setdefault(r["doc_id"], []).append((r["first_word"], r["n_words"]))
    assert sorted(per[1]) == [(0, 4096), (4096, 4096), (8192, 1808)] and per[4] == [(0, 2), (0, 2)]
    assert 2 not in per and 3 not in per and per[None] == [(0, 700)] and per[5] == [(0, 600)]
    fill = {}
    for r in out:
        fill[r["bin_id"], r["bin_length"]] = fill.get((r["bin_id"], r["bin_length"]), 0) + r["n_words"]
    assert len({b for b, _ in fill}) == len(fill) and all(n <= length and length in packing.LENGTHS for (_, length), n in fill.items())
    assert packing.pack(docs.where("false")).count() == 0


def brute_top(rows, k):
    v = {i: [math.floor(64 * x) for x in e] for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q in v:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_top_k_matches_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "PART", 100)
    rng = np.random.default_rng(8)
    rows = [(i, (np.round(rng.normal(size=40) * 4) * scale / 4).tolist()) for i in range(400)]
    rows[33] = (33, rows[20][1])
    rows += [(500, None), (520, [1.0, None] + [0.0] * 38), (540, [float("nan")] * 40), (560, [float("inf")] * 40), (None, [1.0] * 40), (7, rows[7][1])]
    vectors = topk.clean(spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS v"), "vec_id", "embedding")
    got = sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("id % 20 = 0")).collect())
    assert got == brute_top(rows, 20)


def test_top_k_of_few_or_none(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [3.0])], "vec_id long, embedding array<float>")
    vectors = topk.clean(rows, "vec_id", "embedding")
    assert [tuple(r) for r in topk.top_k(vectors, vectors.where("id % 20 = 0")).collect()] == [(0, 1, 1, 64 * 32 + 128 * 32)]
    none = topk.clean(rows.where("false"), "vec_id", "embedding")
    assert topk.top_k(none, none).count() == 0


def test_top_k_of_components_beyond_doubles(spark):
    """64 times a finite component may be no double; scores beyond 64 bits are cut to them."""
    rows = [(0, [1e307, -3.5]), (1, [1.0, 2.0]), (2, [-1e307, 0.25]), (3, [0.0, 1e300]), (20, [1e-300, 1.0])]
    vectors = topk.clean(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("id % 20 = 0")).collect())
    cut = [(q, k, c, max(-2**63, min(2**63 - 1, s))) for q, k, c, s in brute_whole(rows)]
    assert got == cut


def brute_whole(rows):
    from fractions import Fraction
    v = {i: [math.floor(64 * Fraction(x)) for x in e] for i, e in rows}
    out = []
    for q in (i for i in v if i % 20 == 0):
        best = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v[q], v[c])))), c) for c in v if c != q)[:20]
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)
