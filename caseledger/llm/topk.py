"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors lie in blocks, dimension by dimension (vertical layout). For a query the scores are
accumulated block of dimensions by block; after each, only candidates survive whose score so
far plus the most that the remaining dimensions can add (the product of the remaining norms)
reaches the k-th best score found, and the survivors are compacted. The result is exact.

Query blocks meet parts of the candidates through an equality join on the numbers of block and
part; a task keeps the best k of each query of one block and part at a time, and the parts of a
query are merged by one ranked window. The work is queries times candidates by nature.

Scores are integers: each component x counts as floor(64 x). Vectors that are null, empty or
hold null or non-finite components take no part, nor do rows without an id or whose length
differs from the longest common one (the most frequent length). An id that is repeated counts
once, with its least vector. Ties go to the smaller id. Scores beyond 64 bits are cut to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseledger.llm.words import table
from caseledger.session import materialize

DIMS, QUERY_BLOCK, CANDIDATE_BLOCK, PART = 16, 2048, 8192, 1 << 17
EXACT = float(2**53)


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): usable vectors, one per id; their components are scaled where they are compared."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size("x") > 0))
    rows = rows.groupBy("id").agg(F.min("x").alias("v"))
    rows = materialize(rows, "vectors")
    width = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("v") == (width["n"] if width else 0))


def search(q: np.ndarray, c: np.ndarray, ids: np.ndarray, own: int, k: int, best) -> tuple[np.ndarray, np.ndarray]:
    """The best k (scores, ids) of one query after a block of candidates; ``c`` has a row per dimension."""
    scores0, ids0 = best
    alive = np.flatnonzero(ids != own)
    floor = scores0[k - 1] if len(scores0) >= k else -np.inf
    total = np.zeros(len(alive))
    rest_q = np.sqrt(np.cumsum((q * q)[::-1])[::-1])
    for d in range(0, len(q), DIMS):
        total = total + q[d:d + DIMS] @ c[0][d:d + DIMS][:, alive]
        if d + DIMS < len(q) and floor > -np.inf:
            bound = total + rest_q[d + DIMS] * c[1][d // DIMS + 1][alive] * (1 + 1e-9) + 1e-6
            keep = np.flatnonzero(bound >= floor)
            if len(keep) < len(alive):
                alive, total = alive[keep], total[keep]
    scores, ids = np.concatenate((scores0, total)), np.concatenate((ids0, ids[alive]))
    if len(scores) > 4 * k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _whole(x: float) -> int:
    """floor(64 x) of any finite number: beyond 2**53 the number itself is whole, and 64 times it may be no double."""
    return 64 * int(x) if abs(x) >= EXACT else math.floor(64 * x)


def _large(q: np.ndarray, c: np.ndarray, ids: np.ndarray, own: int, k: int, best):
    """The same with Python integers, from the components as they are, for products that leave the exact range of doubles."""
    whole = [_whole(x) for x in q.tolist()]
    found = [(-sum(a * _whole(b) for a, b in zip(whole, c[:, j].tolist())), int(i)) for j, i in enumerate(ids) if i != own]
    found += [(-s, int(i)) for s, i in zip(*best)]
    found = sorted(found)[:k]
    return [-s for s, _ in found], np.array([i for _, i in found], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``vectors`` and ``queries`` as (id, v); rows (query_id, rank, vec_id, score)."""
    n = queries.count()
    blocks, slices = max(1, math.ceil(n / QUERY_BLOCK)), max(1, math.ceil(vectors.count() / PART))
    asked = queries.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list(F.struct("id", "v")).alias("queries"))

    def packed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"block": pdf["block"], "asked": [np.array([r["id"] for r in q], np.int64).tobytes() for q in pdf["queries"]],
                                "matrix": [np.array([r["v"] for r in q], np.float64).tobytes() for q in pdf["queries"]]})
    # One matrix per block of queries: it goes along with every block of candidates.
    asked = asked.mapInPandas(packed, "block int, asked binary, matrix binary").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def columns(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def emit():
            pdf = pd.concat(held)
            held.clear()
            m = np.stack(pdf["v"].to_numpy())
            return pd.DataFrame({"ids": [pdf["id"].to_numpy(np.int64).tobytes()], "columns": [np.ascontiguousarray(m.T).tobytes()]})
        for pdf in parts:
            for at in range(0, len(pdf), CANDIDATE_BLOCK):
                held.append(pdf.iloc[at:at + CANDIDATE_BLOCK])
                if sum(map(len, held)) >= CANDIDATE_BLOCK:
                    yield emit()
        if held:
            yield emit()

    vertical = vectors.mapInPandas(columns, "ids binary, columns binary").withColumn(
        "part", F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, best, asked_ids, asked_x = None, [], None, None

        def flush():
            rows = [(int(q), int(i), max(-2**63, min(2**63 - 1, int(s)))) for q, (scores, ids) in zip(asked_ids, best) for s, i in zip(scores, ids)]
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")
        for pdf in parts:
            for row in pdf.itertuples():
                if (row.block, row.part) != block:
                    if block is not None:
                        yield flush()
                    block = row.block, row.part
                    asked_ids = np.frombuffer(row.asked, np.int64).tolist()
                    asked_x = np.frombuffer(row.matrix, np.float64).reshape(len(asked_ids), -1)
                    best = [(np.empty(0), np.empty(0, np.int64))] * len(asked_ids)
                ids = np.frombuffer(row.ids, np.int64)
                raw = np.frombuffer(row.columns, np.float64).reshape(-1, len(ids))
                with np.errstate(over="ignore"):
                    asked_v, c = np.floor(64 * asked_x), np.floor(64 * raw)
                    norms = np.sqrt(np.cumsum((c * c)[::-1], axis=0)[::-1])[::DIMS]
                    top = norms[0].max(initial=0)
                    sizes = np.sqrt((asked_v * asked_v).sum(axis=1))
                for j, q in enumerate(asked_v):
                    if sizes[j] * top < EXACT and isinstance(best[j][0], np.ndarray):
                        # A block whose longest vector cannot reach the k-th best score is not looked at.
                        if len(best[j][0]) < k or sizes[j] * top * (1 + 1e-9) + 1e-6 >= best[j][0][k - 1]:
                            best[j] = search(q, (c, norms), ids, asked_ids[j], k, best[j])
                    else:
                        best[j] = _large(asked_x[j], raw, ids, asked_ids[j], k, best[j])
        if block is not None:
            yield flush()

    met = vertical.join(asked, ["block", "part"]).sortWithinPartitions("block", "part")
    parts = met.mapInPandas(scan, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clean(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.where("id % 20 = 0"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""
