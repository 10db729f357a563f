"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words; target / size is the number of copies expected of
its words. The whole part is allocated to every document for certain. The rest is met by order
sampling with unequal probabilities: documents of fewer than ``SHORT`` words have a higher
inclusion probability than longer ones, such that the words expected are the same, because many
short documents say more than one long one. Documents are ranked by random odds over inclusion
odds and taken in that order until the source's remaining words are reached (the document that
crosses the mark is taken if that comes nearer), so the size of each sample is fixed. The random
numbers are hashes of seed, id and text, so reruns agree.

A hot source is never ordered in one place: ranks fall into 4096 ranges or more, with the number
of documents, whose sizes are added up first, and only the range that holds the mark is ordered,
by ranks and sizes without texts. Equal rows are one entry with a number of copies; where the mark
falls among them, they are numbered part by part.

Null and empty texts have size 0 and ride along with copies of their own source. Null sources
are one source, ordered last. Equal rows are interchangeable. A null id counts as the id "null".
Empty tables give empty results. Columns of the input that are named like an added one are
replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseledger.llm.words import table
from caseledger.session import materialize

MOST_COPIES, RANGES, SEED = 3, 4096, "mix-2"
# Documents of fewer words are short; a range of ranks holds about so many documents at most.
SHORT, RANGE_DOCS = 256, 1_000_000
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_inclusion")


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def source_key(source: Column) -> Column:
    """A text that orders as the source does by code point, with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def ordinal(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``nr``, the place of each row in the order of ``column``, without one task for all rows."""
    parts = materialize(df.repartitionByRange(column).sortWithinPartitions(column)
                        .withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    counts = {r["p"]: r["n"] for r in parts.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    offsets = F.create_map(*[F.lit(x) for p, n in before.items() for x in (int(p), n)]) if before else F.create_map(F.lit(0), F.lit(0))
    return parts.withColumn("nr", F.element_at(offsets, part.cast("int")) + place).drop("__at")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """(key, source_size) to the same with ``target``.

    Sources share all words by weight; a target stops at ``most`` times its source, and what
    that frees is shared by weight among the rest until none is above.
    """
    ranked = ordinal(sizes, "key").withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), F.col("nr") % len(weights)))
    ranked = materialize(ranked, "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(share) > most * F.col("source_size")
        n, held, weight = ranked.agg(F.count_if(full), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n == capped or not weight:
            break
        share, capped = (total - most * (held or 0)) / weight, n
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(share), (most * F.col("source_size")).cast("double"))).drop("nr")


def _inclusion(size: Column, prefix: str = "") -> Column:
    """Inclusion probability of a document: above the source's for short ones and below it for long ones, so that
    the expected words of the source stay the same. Half of the room up to one is used."""
    f, own, few = (F.col(f"{prefix}{c}") for c in ("part", "source_size", "short_size"))
    whole = own.cast("double")
    lean = F.lit(0.5) * F.least(F.lit(1.0), (1.0 - f) / f)
    short = f * (1.0 + lean * ((own - few) / whole))
    long = f * (1.0 - lean * (few / whole))
    return F.when(f > 0, F.when(size < SHORT, short).otherwise(long)).otherwise(0.0)


def _rank(u: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds, q, as q / (1 + q): the same order, between 0 and 1."""
    return F.when(inclusion > 0, u * (1.0 - inclusion) / (u * (1.0 - inclusion) + inclusion * (1.0 - u))).otherwise(1.0)


def _numbered(edge: DataFrame) -> DataFrame:
    """``edge`` (with __key) and ``__nr``, a number from 1 within each key, without gathering a key in one task."""
    edge = materialize(edge.withColumn("__at", F.monotonically_increasing_id()), "edge").withColumn("__part", F.shiftright("__at", 33))
    counts = edge.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__part")) - F.col("__n")
    counts = counts.select(F.col("__key").alias("__k"), F.col("__part").alias("__p"), before.alias("__before"))
    place = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__at"))
    edge = edge.withColumn("__nr", place).join(counts, (F.col("__key") == F.col("__k")) & (F.col("__part") == F.col("__p")))
    return edge.withColumn("__nr", F.col("__nr") + F.col("__before")).drop("__at", "__part", "__k", "__p", "__before")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """All columns of ``docs`` with mix_size, mix_source_size, mix_target, mix_copies and mix_inclusion."""
    text = F.col(text_col).cast("string")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    number = F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("long")
    rows = docs.withColumns({"__key": source_key(F.col(source_col)), "__size": n_words(text), "__u": number})
    # One row per distinct document, without its text.
    slim = materialize(rows.groupBy(F.col("__key").alias("key"), F.col("__size").alias("size"), F.col("__u").alias("u"))
                       .agg(F.count(F.lit(1)).alias("c")), "sizes")
    words = F.col("size") * F.col("c")
    goals = targets(slim.groupBy("key").agg(F.sum(words).alias("source_size"), F.sum(F.when(F.col("size") < SHORT, words).otherwise(0)).alias("short_size")), weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.floor(ratio)).withColumn(
        "need", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    goals = materialize(goals.select("key", "source_size", "short_size", "target", "whole", "part", "need"), "goals")
    ranges = max(RANGES, 1 << math.ceil(math.log2(max(1, slim.count() / RANGE_DOCS))))
    ranked = slim.join(goals.select("key", "source_size", "short_size", "part", "need"), "key")
    ranked = ranked.withColumn("rank", _rank(F.col("u") / float(2**48), _inclusion(F.col("size"))))
    ranked = ranked.withColumn("range", F.least(F.floor(F.col("rank") * ranges), F.lit(ranges - 1)).cast("int"))
    parts = ranked.groupBy("key", "need", "range").agg(F.sum(words).alias("words"))
    after = F.sum("words").over(Window.partitionBy("key").orderBy("range"))
    cut = parts.withColumn("before", after - F.col("words")).where("before <= need AND need < before + words").select("key", "before", "range")
    edge = ranked.select("key", "need", "rank", "u", "size", "c", "range").join(cut, ["key", "range"])
    order = Window.partitionBy("key").orderBy("rank", "u", "size")
    edge = edge.withColumn("before", F.col("before") + F.sum(words).over(order) - words)
    # So many copies of each entry lie nearer to the mark than not; the last entry with any holds the mark.
    fit = F.when(F.col("size") > 0, F.floor((F.col("need") - F.col("before")) / F.col("size") + 0.5)).otherwise(F.when(F.col("before") <= F.col("need"), F.col("c")).otherwise(0))
    edge = edge.withColumn("m", F.greatest(F.lit(0), F.least(fit, F.col("c"))))
    mark = edge.groupBy("key").agg(F.max(F.when(F.col("m") > 0, F.struct("rank", "u", "size", "m", "c"))).alias("mark"), F.first("range").alias("cut"))
    goals = goals.join(mark, "key", "left")
    goals = materialize(goals, "marks")
    split = not goals.where("mark.m < mark.c").isEmpty()

    goal = {c: F.col(f"__g_{c}") for c in goals.columns}
    rows = rows.join(goals.select(*[F.col(c).alias(f"__g_{c}") for c in goals.columns]), F.col("__key") == goal["key"])
    rows = rows.withColumn("__inclusion", _inclusion(F.col("__size"), "__g_"))
    rows = rows.withColumn("__rank", _rank(F.col("__u") / float(2**48), F.col("__inclusion")))
    mark, need = goal["mark"], goal["need"]
    here, last = F.struct(F.col("__rank"), F.col("__u"), F.col("__size")), F.struct(mark["rank"], mark["u"], mark["size"])
    # Without a range that holds the mark all ranks lie below it; without an entry in it, all of it lies above.
    below = F.least(F.floor(F.col("__rank") * ranges), F.lit(ranges - 1)) < goal["cut"]
    sure = F.when(need <= 0, False).when(goal["cut"].isNull(), True).when(mark.isNull(), below).otherwise(here <= last)
    among = F.coalesce((here == last) & (mark["m"] < mark["c"]), F.lit(False))

    def result(taken: DataFrame, inside: Column) -> DataFrame:
        kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED]
        return taken.select(*kept, F.col("__size").alias("mix_size"), goal["source_size"].alias("mix_source_size"), goal["target"].alias("mix_target"),
                            (goal["whole"] + inside.cast("long")).alias("mix_copies"), F.col("__inclusion").alias("mix_inclusion"))
    if not split:
        return result(rows, sure)
    return result(rows.where(~among), sure).unionByName(result(_numbered(rows.where(among)), (F.col("__nr") <= mark["m"]) & (need > 0)))


def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return docs.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS n FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, coalesce(sum(size) FILTER (WHERE size < {SHORT}), 0)::BIGINT AS short_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, sum(source_size) OVER () AS total FROM s),
c AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
  sum(weight) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above FROM w),
k AS (SELECT arg_min((total - 3 * below)::DOUBLE / above, 3 * source_size / weight) FILTER (WHERE weight * ((total - 3 * below)::DOUBLE / above) <= 3 * source_size) AS share FROM c),
t AS (SELECT source, source_size, short_size, least(weight * share, (3 * source_size)::DOUBLE) AS target FROM w, k),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio FROM t),
f AS (SELECT * EXCLUDE (ratio), floor(ratio) AS whole, ratio - floor(ratio) AS part, target - floor(ratio) * source_size AS need FROM r),
p AS (SELECT d.*, f.* EXCLUDE (source), n / 281474976710656.0::DOUBLE AS u, CASE WHEN part > 0 THEN
   CASE WHEN size < {SHORT} THEN part * (1.0 + 0.5 * least(1.0, (1.0 - part) / part) * ((source_size - short_size)::DOUBLE / source_size))
   ELSE part * (1.0 - 0.5 * least(1.0, (1.0 - part) / part) * (short_size::DOUBLE / source_size)) END ELSE 0.0 END AS inclusion
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
q AS (SELECT *, CASE WHEN inclusion > 0 THEN (u / (1.0 - u)) / (inclusion / (1.0 - inclusion)) END AS quotient FROM p),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY quotient NULLS LAST, n, size ROWS UNBOUNDED PRECEDING) AS upto FROM q)
SELECT doc_id, size, source_size, target,
 (size * (whole + CASE WHEN need > 0 AND 2 * upto - size <= 2 * need THEN 1 ELSE 0 END))::BIGINT AS taken FROM o"""
