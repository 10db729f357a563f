"""Packing, FTRL and ridge regression against plain versions, and the registered queries that have no SQL."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseledger.llm import language, packing, toxicity
from caseledger.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain_best_fit(sizes, lengths):
    """Every open bin is looked at for every piece."""
    bins, where, offset, left = [], [], [], sum(sizes)  # bin: [opened length, filled]
    for size in sizes:
        fitting = [(length - filled, b) for b, (length, filled) in enumerate(bins) if length - filled >= size]
        if fitting:
            b = min(fitting)[1]
        else:
            # The least cost for each word that such a bin can still hold.
            prices = [((64.0 + x + x * x / 32768.0) / min(x, left), x) for x in lengths if x >= size]
            bins.append([min(prices)[1], 0])
            b = len(bins) - 1
        where.append(b)
        offset.append(bins[b][1])
        bins[b][1] += size
        left -= size
    return where, offset, [min(x for x in lengths if x >= filled) for _, filled in bins]


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_equals_a_look_at_every_bin(seed):
    rng = random.Random(seed)
    lengths = rng.choice([packing.LENGTHS, (512,), (100, 300), (7, 64, 1000)])
    sizes = sorted((rng.randrange(1, max(lengths) + 1) for _ in range(rng.choice([0, 1, 40, 400]))), reverse=True)
    sizes += [1] * rng.randrange(30)
    assert packing.best_fit(sizes, lengths) == plain_best_fit(sizes, lengths)


def test_ftrl_equals_the_textbook_steps():
    rng = random.Random(2)
    model, z, n = toxicity.Ftrl(0.4), {}, {}
    bias = 1 << toxicity.BITS

    def weight(i):
        l1 = 0.0 if i == bias else 0.4
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((toxicity.SMOOTH + math.sqrt(n[i])) / toxicity.RATE + toxicity.L2)
    for _ in range(400):
        cells = sorted(rng.sample(range(60), rng.randrange(1, 12))) + [bias]
        label, importance = int(sum(cells[:-1]) % 3 == 0), rng.choice([1.0, 2.5])
        model.learn(np.array(cells), label, importance)
        p = 1 / (1 + math.exp(-sum(weight(i) for i in cells)))
        before = {i: weight(i) for i in cells}
        g = (p - label) * importance
        for i in cells:
            old = n.get(i, 0.0)
            z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.RATE * before[i]
            n[i] = old + g * g
    every = np.array([*range(60), bias])
    assert np.allclose(model.weight(every), [weight(i) for i in every]) and (model.weight(every) == 0).any()


def test_scores_are_sums_over_distinct_features(spark):
    texts = ["a b a b", "", None, "b c d", "Z z z"]
    cells, owner = toxicity.features(texts)
    known = np.unique(cells)
    weights, bias = np.linspace(-1, 1, len(known)), -0.25
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["score"] for r in toxicity.score(docs, (known, weights, bias), "text").orderBy("doc_id").collect()]
    value = dict(zip(known.tolist(), weights.tolist()))
    want = [1 / (1 + math.exp(-(bias + sum(value[c] for c in set(cells[owner == i].tolist()))))) for i in range(len(texts))]
    assert got == pytest.approx(want, abs=1e-6)


def test_the_model_is_the_mean_of_its_shards(spark):
    """Trained by hand, shard by shard in the stated order, and averaged."""
    docs = [(i, " ".join(f"w{(i * 5 + k * k) % 31}" for k in range(12)) + (" bad" if i % 3 == 0 else "")) for i in range(90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int")
    cells, weights, bias = toxicity.train(frame, labels, "doc_id", "text", "toxic", rounds=1, shards=2)
    order = frame.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).alias("shard"), F.xxhash64("doc_id", F.lit(2)).alias("at")).collect()
    share = 0.9 * 60 / 30
    l1, total = toxicity.L1 * math.sqrt((60 + 30 * share) / toxicity.L1_ROWS), np.zeros((1 << toxicity.BITS) + 1)
    for shard in (0, 1):
        model = toxicity.Ftrl(l1)
        for row in sorted((r for r in order if r["shard"] == shard), key=lambda r: r["at"]):
            found = np.unique(toxicity.features([row["text"]])[0])
            toxic = int(row["doc_id"] % 3 == 0)
            model.learn(np.append(found, 1 << toxicity.BITS), toxic, share if toxic else 1.0)
        total += model.weight(np.arange((1 << toxicity.BITS) + 1)) / 2
    assert cells.tolist() == np.flatnonzero(total[:-1]).tolist()
    assert weights == pytest.approx(total[cells]) and bias == pytest.approx(total[-1])


def test_ridge_equals_weighted_least_squares():
    rng = np.random.default_rng(4)
    marks, rows, classes, ridge = rng.random((6, 80)) < 0.3, rng.random((40, 80)) < 0.3, rng.integers(0, 3, 40), 1e-2
    base = language.kernel(marks, marks)
    values = language.kernel(rows, marks)
    got = language.fit_ridge(values, base, classes, 3, ridge)
    # The same features by another root of the landmarks' kernel: they differ by a rotation, which ridge does not see.
    own, vectors = np.linalg.eigh(base.astype(float))
    inverse_root = vectors @ np.diag(1 / np.sqrt(own)) @ vectors.T
    x = values @ inverse_root
    for c in range(3):
        y = np.where(classes == c, 1.0, -1.0)
        w = np.array([len(y) / 3 / (classes == k).sum() for k in classes])
        tall = np.vstack([x * np.sqrt(w)[:, None], math.sqrt(ridge * len(y)) * np.eye(6)])
        theta = np.linalg.lstsq(tall, np.concatenate([y * np.sqrt(w), np.zeros(6)]), rcond=None)[0]
        assert np.allclose(values @ got[:, c], x @ theta, atol=1e-4)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_cover_their_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = QUERIES[name](spark, SF)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert set(ids) == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert name.startswith("op6_") or len(ids) == docs.count()
