"""Toxicity: FTRL-proximal logistic regression over hashed words, word n-grams and skip-grams.

A text's features are its distinct words, pairs of neighbours, triples, and pairs with one
word between, hashed to 2**20 cells. Training follows the gradient with one rate per
coordinate and an L1 penalty that leaves most weights exactly zero, so the model is a short
list of (cell, weight) that is small enough to broadcast.

Training uses a bounded sample of the labelled rows: about ``train_rows`` ids of each class,
chosen by a hash of the id, and of each at most ``texts_per_id`` distinct texts; positives
weigh nearly as much as negatives together. ``shards`` streams of that sample are trained side
by side, each whole in one task, and their weights averaged; each further round starts from
the average. Scores cover all rows and whole texts.

Null and empty texts have no feature and get the bias alone. Labels that are null, labels of
unknown documents and rows with a null id are not learned from; contradicting labels of one
id all count. Without labels of both classes every score is the share of positives (0 if
there are no labels). Equal texts get equal scores; repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseledger.llm.words import batches, hash_words, mix, remainder, table
from caseledger.session import materialize

BITS = 20
RATE, SMOOTH, L2 = 1.0, 1.0, 0.1
L1, L1_ROWS = 14.0, 15_000  # the penalty for a sample of so many rows; it goes with their root
THRESHOLD = 0.7
# ASCII letters and digits, and every byte of a character beyond ASCII, belong to words.
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(cells, texts): the cell of each feature, repeats included, and the text it is from."""
    words, offsets = hash_words([t.lower() if t else t for t in texts], True, _LETTERS)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    cells, owners = [mix(words + np.uint64(1))], [text]
    for kind, steps in ((2, (0, 1)), (3, (0, 1, 2)), (4, (0, 2))):
        m = len(words) - steps[-1]
        if m <= 0:
            continue
        value = np.full(m, kind, np.uint64)
        for s in steps:
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + words[s:s + m])
        same = text[:m] == text[steps[-1]:]
        cells.append(value[same])
        owners.append(text[:m][same])
    return (np.concatenate(cells) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


class Ftrl:
    """Per-coordinate state: z (shifted gradients) and n (squared gradients); the last cell is the bias."""

    def __init__(self, l1: float, weights: np.ndarray | None = None):
        self.l1 = l1
        self.n = np.zeros((1 << BITS) + 1)
        self.z = np.zeros((1 << BITS) + 1)
        if weights is not None:  # a start at these weights, as if no gradient had been seen
            rate = SMOOTH / RATE + L2
            self.z = np.where(weights == 0, 0.0, -weights * rate - np.sign(weights) * l1)
            self.z[-1] = -weights[-1] * rate

    def weight(self, cells: np.ndarray) -> np.ndarray:
        z, n = self.z[cells], self.n[cells]
        penalty = np.where(cells == 1 << BITS, 0.0, self.l1)  # the bias is free
        return np.where(np.abs(z) <= penalty, 0.0, -(z - np.sign(z) * penalty) / ((SMOOTH + np.sqrt(n)) / RATE + L2))

    def learn(self, cells: np.ndarray, label: int, importance: float) -> None:
        w = self.weight(cells)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = (p - label) * importance
        n = self.n[cells]
        self.z[cells] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / RATE * w
        self.n[cells] = n + g * g


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
          train_rows: int = 8000, shards: int = 4, rounds: int = 3, texts_per_id: int = 4) -> tuple[np.ndarray, np.ndarray, float]:
    """(cells, weights, bias) of the model."""
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).where("__id IS NOT NULL AND label IN (0, 1)")
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    nothing = np.empty(0, np.int64), np.empty(0)
    if len(counts) < 2:
        share = min(max(float(next(iter(counts), 0)), 1e-6), 1 - 1e-6)
        return *nothing, float(np.log(share / (1 - share)))
    # Positives together weigh nearly as much as negatives.
    sampled = {c: min(n, train_rows) for c, n in counts.items()}
    importance = {0: 1.0, 1: max(1.0, 0.9 * sampled[0] / sampled[1])}
    l1 = L1 * float(np.sqrt(sum(sampled[c] * importance[c] for c in (0, 1)) / L1_ROWS))
    pick = F.xxhash64("__id") / 2.0**64 + 0.5
    share = {c: min(1.0, train_rows / n) for c, n in counts.items()}
    chosen = marked.where(pick < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    # About 2 x train_rows ids of at most a few bytes each, whatever the input.
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "__id")
    # Ranked where the rows are first, so an id with very many texts sends few of them.
    few = Window.partitionBy("__id", "label").orderBy("__text")
    texts = texts.withColumn("__text", F.xxhash64("text")).withColumn("__n", F.dense_rank().over(few)).where(F.col("__n") <= texts_per_id)
    texts = texts.dropDuplicates(["__id", "label", "__text"])
    texts = materialize(texts.withColumn("shard", F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(shards)).cast("int"))
                        .select("__id", "label", "text", "shard"), "train")
    weights = None
    for _ in range(rounds):
        start = spark.sparkContext.broadcast(weights)

        def learn(parts: Iterator[pd.DataFrame], start=start) -> Iterator[pd.DataFrame]:
            models: dict[int, Ftrl] = {}
            for pdf in parts:
                for shard, rows in pdf.groupby("shard"):
                    model = models.setdefault(int(shard), Ftrl(l1, start.value))
                    all_texts, y = rows["text"].tolist(), rows["label"].tolist()
                    for a, b in batches(all_texts, 500_000):
                        cells, owner = features(all_texts[a:b])
                        both = np.unique(owner * (1 << BITS) + cells)
                        cells, edges = both & ((1 << BITS) - 1), np.searchsorted(both >> BITS, np.arange(b - a + 1))
                        for i in range(b - a):
                            model.learn(np.append(cells[edges[i]:edges[i + 1]], 1 << BITS), y[a + i], importance[y[a + i]])
            for shard, model in models.items():
                w = model.weight(np.arange((1 << BITS) + 1))
                at = np.flatnonzero(w)
                yield pd.DataFrame({"shard": shard, "cell": at, "w": w[at]})

        # By key, so that a shard is one model however its rows are stored.
        dealt = texts.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("__id", F.lit(2)), "text", "label")
        trained = dealt.mapInPandas(learn, "shard long, cell long, w double")
        trained = materialize(trained, "shards")
        n = max(1, trained.select("shard").distinct().count())
        # At most 2**20 + 1 rows.
        rows = trained.groupBy("cell").agg((F.sum("w") / n).alias("w")).toPandas()
        weights = np.zeros((1 << BITS) + 1)
        weights[rows["cell"].to_numpy()] = rows["w"].to_numpy()
    cells = np.flatnonzero(weights[:-1])
    return cells, weights[cells], float(weights[-1])


def score(docs: DataFrame, model, text_col: str, output: str = "score") -> DataFrame:
    """``docs`` with the probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        at, w, bias = shared.value
        weights = np.zeros(1 << BITS, np.float32)
        weights[at] = w
        all_texts = texts.tolist()
        out = np.full(len(all_texts), bias)
        for a, b in batches(all_texts):
            cells, owner = features(all_texts[a:b])
            hit = np.flatnonzero(weights[cells])
            both = np.unique(owner[hit] * (1 << BITS) + cells[hit])
            np.add.at(out, a + (both >> BITS), weights[both & ((1 << BITS) - 1)].astype(float))
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return docs.withColumn(output, probability(F.col(text_col).cast("string")))


def op3_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(remainder("doc_id", 3) != 1), "doc_id", "text", "toxic")
    out = score(docs.select("doc_id", "text"), model, "text")
    return out.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
