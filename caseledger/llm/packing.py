"""Best-fit packing into bins of several permitted lengths.

A document's words are cut into pieces of at most the largest permitted length; pieces are
packed best-fit decreasing. A piece goes to the open bin that it fits most tightly; if there
is none, the length is opened whose cost per word it can still be filled with is least (a
fixed cost per sequence, its words, and a quadratic share for attention). At the end each bin
is cut down to the smallest permitted length that holds its contents.

Pieces are dealt to shards by hash, about ``per_shard`` each, and each shard is packed on its
own, so no source, id or group of copies meets in one task beyond that and a lost task is
repeated with the same result. Only ids and lengths are moved, no texts.

Null and empty texts have no words and no pieces, hence no rows. Repeated rows are packed as
often as they occur. Ties are broken by id, then piece. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.mixing import n_words
from caseledger.llm.words import table
from caseledger.session import materialize

LENGTHS = (512, 1024, 2048, 4096)


def cost(length: int, fixed: float = 64.0, square: float = 32768.0) -> float:
    return fixed + length + length * length / square


def best_fit(sizes, lengths=LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """For sizes in descending order: each one's bin and offset, and each bin's final length."""
    lengths = sorted(lengths)
    left, free, where, offset, filled, opened = sum(sizes), [], [], [], [], []
    for size in sizes:
        at = bisect.bisect_left(free, (size, -1))
        if at < len(free):
            room, which = free.pop(at)
        else:
            room = min((x for x in lengths if x >= size), key=lambda x: (cost(x) / min(x, left), x))
            which = len(filled)
            filled.append(0)
            opened.append(room)
        where.append(which)
        offset.append(filled[which])
        filled[which] += size
        if room > size:
            bisect.insort(free, (room - size, which))
        left -= size
    return where, offset, [next(x for x in lengths if x >= n) for n in filled]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths=LENGTHS, per_shard: int = 2048) -> DataFrame:
    """One row per piece: id, piece, first_word, n_words, bin_id, bin_length, bin_offset (all counted in words)."""
    most = max(lengths)
    sized = docs.select(F.col(id_col).cast("long").alias("id"), n_words(F.col(text_col).cast("string")).alias("n")).where("n > 0")
    sized = materialize(sized, "sizes")
    total = sized.agg(F.sum(F.ceil(F.col("n") / most))).first()[0] or 0
    shards = max(1, math.ceil(total / per_shard))
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / most) - 1).cast("int"))))
    # Repeated rows share their id; the random part keeps even a third of all rows of one id apart.
    pieces = pieces.withColumn("size", F.least(F.col("n") - F.col("piece") * most, F.lit(most))).withColumn(
        "shard", F.pmod(F.xxhash64("id", "piece", F.monotonically_increasing_id()), F.lit(shards)))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "id", "piece"], ascending=[False, True, True], kind="stable", na_position="first")
        where, offset, final = best_fit(pdf["size"].tolist(), lengths)
        shard = int(pdf["shard"].iloc[0])
        return pd.DataFrame({
            "id": pdf["id"].to_numpy(), "piece": pdf["piece"].to_numpy(), "first_word": pdf["piece"].to_numpy() * most,
            "n_words": pdf["size"].to_numpy(), "bin_id": [(shard << 32) + b for b in where],
            "bin_length": [final[b] for b in where], "bin_offset": offset})

    out = pieces.select("id", "piece", "size", "shard").groupBy("shard").applyInPandas(
        packed, "id long, piece long, first_word long, n_words long, bin_id long, bin_length long, bin_offset long")
    return out.withColumnRenamed("id", id_col)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
