"""Language identification with string kernels.

The kernel of two texts is a blended spectrum: the number of distinct letter n-grams of 1 to
4 characters that both have, over the root of the product of their own numbers. A few
landmark texts per language span the feature space (Nyström); one ridge regression per
language against the rest is fitted on the kernel values, mapped by the inverse root of the
landmarks' own kernel. Because kernel values are inner products of presence vectors, the
fitted weights fold into one matrix (n-gram cells x languages), and batches of presence
vectors are scored by a matrix product.

The model is fitted on a bounded sample: ``per_language`` distinct texts of each language (all
of them where there are fewer), those with the smallest hashes; ``landmarks`` of them per
language. Copies count once. Every language that occurs is learned; of more than
``most_languages`` each gives so many fewer texts that the sample stays as large. Everything
else covers all rows and whole texts.

Null texts, empty texts and texts without a letter are "und" with score 0, as is every text
when nothing could be learned. Rows with a null id are never learned from. Equal texts get
equal results; repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from caseledger.llm.words import batches, mix, remainder, table

ORDERS, CELLS, BLOCK = 4, 1 << 16, 256
UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def presence(texts: list[str]) -> np.ndarray:
    """A row of n-gram cells per text: True where the text has an n-gram of the cell."""
    out = np.zeros((len(texts), CELLS), bool)
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join(lowered).encode("utf-32-le", "surrogatepass") + b" \0\0\0", np.uint32)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in lowered])
    letter = _letters()[codes]
    # Runs of other characters become one space, which counts as a character of the n-grams.
    keep = letter | np.concatenate(([False], letter[:-1]))
    codes, text = np.where(letter, codes, 32)[keep].astype(np.uint64), text[keep]
    if not len(codes):
        return out
    value = np.zeros(len(codes), np.uint64)
    flat = out.reshape(-1)
    for n in range(1, min(ORDERS, len(codes)) + 1):
        m = len(codes) - n + 1
        value = value[:m] * np.uint64(0x100000001B3) + codes[n - 1:]
        cell = (mix(value + np.uint64(n)) >> np.uint64(48)).astype(np.int64)
        same = text[:m] == text[n - 1:]
        if n == 1:
            same = same & (codes != 32)
        flat[text[:m][same].astype(np.int64) * CELLS + cell[same]] = True
    return out


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalised kernel of presence rows; rows without a letter have the value 0."""
    a = a.astype(np.float32)
    own = np.sqrt(np.outer(np.maximum(a.sum(1), 1), np.maximum(b.sum(1), 1)))
    return np.hstack([a @ b[i:i + BLOCK].astype(np.float32).T for i in range(0, len(b), BLOCK)]) / own


def fit_ridge(values: np.ndarray, marks: np.ndarray, classes: np.ndarray, n: int, ridge: float = 1e-3) -> np.ndarray:
    """Weights (landmarks x classes): one-versus-rest ridge regression on Nyström features."""
    own, base = np.linalg.eigh(marks.astype(float))
    root = base[:, own > 1e-6] / np.sqrt(own[own > 1e-6])
    x = values.astype(float) @ root
    y = np.where(classes[:, None] == np.arange(n), 1.0, -1.0)
    # Each class weighs the same against the rest.
    w = len(y) / n / np.bincount(classes, minlength=n)[classes]
    return root @ np.linalg.solve(x.T @ (x * w[:, None]) + ridge * len(y) * np.eye(x.shape[1]), x.T @ (y * w[:, None]))


def fit(docs: DataFrame, text_col: str, lang_col: str, per_language: int = 250, landmarks: int = 40,
        most_languages: int = 64) -> tuple[list[str], np.ndarray] | None:
    """(languages, weights per n-gram cell and language) from labelled rows; None without any."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "lang IS NOT NULL AND text RLIKE '\\\\p{L}'").withColumn("pick", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in rows.select("lang", "pick").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    names = sorted(counts)
    number = {name: i for i, name in enumerate(names)}
    most, marked = (max(1, min(k, k * most_languages // len(names))) for k in (per_language, landmarks))

    def upto(limits: dict, kind: str) -> DataFrame:
        """The rows of the languages in ``limits`` whose hash is no larger than the limit."""
        known = spark.createDataFrame(list(limits.items()), f"lang string, __limit {kind}")
        place = F.col("pick") / 2.0**64 + 0.5 if kind == "double" else F.col("pick")
        return rows.join(F.broadcast(known), "lang").where(place <= F.col("__limit")).drop("__limit")

    picks: dict[str, list[int]] = {}
    # Ranked are the hashes below a share, about twice as many as wanted; where too few are below it, all.
    for shares in (lambda name: min(1.0, (2.0 * most + 40.0) / counts[name])), (lambda name: 1.0):
        short = {name: shares(name) for name in names if len(picks.get(name, [])) < min(most, counts[name])}
        if short:
            order = Window.partitionBy("lang").orderBy("pick")
            ranks = upto(short, "double").select("lang", "pick").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).collect()
            picks |= {name: [] for name in short}
            for r in ranks:
                picks[r["lang"]].append(r["pick"])
    last = {name: max(found) for name, found in picks.items()}
    first = {name: sorted(found)[:marked][-1] for name, found in picks.items()}

    def grams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            texts = pdf["text"].tolist()
            for a, b in batches(texts):
                bits = np.packbits(presence(texts[a:b]), axis=1)
                yield pd.DataFrame({"lang": pdf["lang"].iloc[a:b].to_numpy(), "bits": [x.tobytes() for x in bits]})

    found = upto(first, "long").dropDuplicates(["lang", "pick"]).mapInPandas(grams, "lang string, bits binary").collect()
    found.sort(key=lambda r: (r["lang"], r["bits"]))
    marks = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in found]), axis=1).astype(bool)
    shared = spark.sparkContext.broadcast(np.packbits(marks, axis=1))

    def values(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = np.unpackbits(shared.value, axis=1)
        for pdf in parts:
            texts = pdf["text"].tolist()
            for a, b in batches(texts):
                for c in range(a, b, 64):
                    k = kernel(presence(texts[c:min(b, c + 64)]), marks)
                    yield pd.DataFrame({"lang": pdf["lang"].iloc[c:min(b, c + 64)].to_numpy(), "k": [x.tobytes() for x in k.astype(np.float32)]})

    sample = upto(last, "long").dropDuplicates(["lang", "pick"]).mapInPandas(values, "lang string, k binary").collect()
    sample.sort(key=lambda r: (r["lang"], r["k"]))
    blocks = [slice(i, i + BLOCK) for i in range(0, len(marks), BLOCK)]
    weights = fit_ridge(np.array([np.frombuffer(r["k"], np.float32) for r in sample]), np.vstack([kernel(marks[x], marks) for x in blocks]),
                        np.array([number[r["lang"]] for r in sample]), len(names))
    weights = (weights / np.sqrt(np.maximum(marks.sum(1), 1))[:, None]).astype(np.float32)
    return names, sum(marks[x].T.astype(np.float32) @ weights[x] for x in blocks)


def classify(docs: DataFrame, model, text_col: str, output: str = "language") -> DataFrame:
    """``docs`` with a struct (lang_pred, score); the score is the softmax of the languages' values."""
    kind = "struct<lang_pred:string,score:double>"
    if model is None:
        return docs.withColumn(output, F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")))
    names, shared = np.array(model[0], object), docs.sparkSession.sparkContext.broadcast(model[1])

    @F.pandas_udf(kind)
    def predict(texts: pd.Series) -> pd.DataFrame:
        all_texts = texts.tolist()
        pred, score = np.full(len(all_texts), UNKNOWN, object), np.zeros(len(all_texts))
        for a, b in batches(all_texts):
            for c in range(a, b, 64):
                d = min(b, c + 64)
                rows = presence([t or "" for t in all_texts[c:d]])
                own = rows.sum(1)
                value = (rows.astype(np.float32) @ shared.value) / np.sqrt(np.maximum(own, 1))[:, None]
                odds = np.exp(4.0 * (value - value.max(1, keepdims=True)))
                top = value.argmax(1)
                has = own > 0
                pred[c:d] = np.where(has, names[top], UNKNOWN)
                score[c:d] = np.where(has, odds.max(1) / odds.sum(1), 0.0)
        return pd.DataFrame({"lang_pred": pred, "score": score})

    return docs.withColumn(output, predict(F.col(text_col).cast("string")))


@F.pandas_udf(BooleanType())
def has_letter(texts: pd.Series) -> pd.Series:
    """Whether a text has a letter, as ``presence`` reads letters."""
    return pd.Series([any(map(str.isalpha, text or "")) for text in texts], dtype=bool)


def learned_from(docs: DataFrame) -> DataFrame:
    """The rows whose language may be learned from."""
    return docs.where(remainder("doc_id", 5) != 0)


def op10_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(learned_from(docs), "text", "lang")
    out = classify(docs.select("doc_id", "text"), model, "text")
    return out.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                      F.col("language.lang_pred").alias("lang_pred"), F.col("language.score").alias("score"))
