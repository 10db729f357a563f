"""Document fingerprints by spot signatures (built-in functions only).

A signature is a common word (antecedent) and the chain of the next content words after it;
common words between are stepped over. A document's fingerprint is the sorted set of its
signatures. Documents are compared by the Jaccard likeness of their sets; ``near_pairs``
joins only documents whose set lengths allow the likeness asked for, on the signatures that
a pair so alike must share.

Texts with words but without a whole chain have one signature, of all their words. Null and
empty texts, and texts without words, have the empty fingerprint; two empty fingerprints are
alike (1.0) but ``near_pairs`` links nothing with them. Repeated rows and equal ids are
ordered by their text's hash; equal rows are interchangeable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from caseledger.llm.words import table
from caseledger.session import materialize

# Common words of four languages, the antecedents of the chains.
COMMON = tuple(dict.fromkeys((
    "a an and are as at be but by for from had has have he her his i in is it its not of on or "
    "she that the their they this to was we were which with you "
    "aber als am auf aus bei das dass dem den der des die ein eine einem einen einer er es für "
    "hat ich ihr im ist mit nach nicht noch nur oder sich sie sind so und vom von war wie zu zum zur "
    "au aux avec ce cette ces dans de du elle en est et il ils je la le les leur mais ne nous ou "
    "par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con del desde el ella ellos entre esta este ha las lo los más muy no nos para pero "
    "por porque si sin sobre su sus también una uno y ya").split()))
CHAIN, DISTANCE = 2, 1


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def signatures(text: Column, chain: int = CHAIN, distance: int = DISTANCE) -> Column:
    """Sorted distinct signatures, 12 hexadecimal digits each."""
    def of(words: Column) -> Column:
        common = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*COMMON), i)), lambda i: i.isNotNull())

        def chains(content: Column) -> Column:
            # The j-th common word stands at i, so i - j content words stand before it.
            def one(i, j):
                last = i - j + (chain - 1) * distance + distance
                return F.when(last <= F.size(content), F.substring(F.md5(F.concat_ws(
                    " ", words[i], *[content[i - j + k * distance + distance - 1] for k in range(chain)])), 1, 12))
            return F.filter(F.transform(common, one), lambda s: s.isNotNull())

        found = _let(F.filter(words, lambda w: ~w.isin(*COMMON)), chains)
        return _let(found, lambda s: F.when(F.size(s) > 0, F.sort_array(F.array_distinct(s)))
                    .when(F.size(words) > 0, F.array(F.substring(F.md5(F.array_join(words, " ")), 1, 12)))
                    .otherwise(F.array().cast("array<string>")))
    return _let(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""), of)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / (F.size(a) + F.size(b) - both))


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(pairs between fingerprint classes with their likeness, membership of every row).

    Membership has the id and the class, which is named by the digest of its fingerprint, so
    equal and null ids are told apart like any others. Classes
    fall into partitions by set length, of lengths that differ by less than the threshold,
    so a class meets only its own and the next partition. In a partition, sets meet on their
    rarest signatures: two sets with likeness of at least t share one of the first
    n - ceil(t n) + 1 of each in any fixed order. Candidates are then compared exactly.
    """
    rows = docs.select(F.col(id_col).alias("id"), signatures(F.col(text_col).cast("string")).alias("sigs"))
    rows = materialize(rows.withColumn("print", F.sha2(F.array_join("sigs", ","), 256)), "spots")
    members = rows.groupBy(F.col("print").alias("class")).agg(F.first("sigs").alias("sigs"), F.size(F.first("sigs")).alias("n"))
    classes = materialize(members.where("n > 0"), "spot-classes")
    rarity = classes.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    prefix = (classes.select("class", "n", F.explode("sigs").alias("sig")).join(rarity, "sig")
              .groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("order")))
    part = F.floor(F.log(F.col("n")) / math.log(1 / threshold)).cast("int")
    heads = prefix.select("class", "n", part.alias("part"), F.explode(F.slice(
        "order", 1, (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))).alias("head"))
    heads = heads.select("class", "n", "part", F.col("head.sig").alias("sig"))
    left = heads.select(F.col("class").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = heads.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("part").alias("part"), "sig")
    pairs = (left.join(right, ["part", "sig"]).where((F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
             .where(F.col("na") >= F.col("nb") * threshold).select("a", "b").distinct())
    sets = classes.select("class", "sigs")
    pairs = (pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
             .select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= threshold))
    return pairs, rows.select(F.col("id").alias(id_col), F.col("print").alias("class"))


def _bounds(keys: DataFrame, n: int) -> list[int]:
    """At most ``n`` - 1 distinct values that cut the ids into even ranges."""
    cuts = keys.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    return sorted(set(cuts or []))


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many bounds lie below the value, found in two steps of about sqrt(len) each; null: 0."""
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    if not groups:
        return F.lit(0)
    tops = F.array(*[F.lit(g[-1]) for g in groups])
    inner = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
    return _let(F.size(F.filter(tops, lambda t: t < value)), lambda k: F.when(value.isNull(), 0).otherwise(
        k * width + F.when(k < len(groups), F.size(F.filter(F.get(inner, k), lambda b: b < value))).otherwise(0)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text, signatures, and next_text, next_sigs: those of the next row by descending id, the first row's
    after the last (null ids come last).

    Ids are cut into even ranges; each range is ordered on its own, and the first row of a
    range is also sent to the range before it. Only range bounds and one id per range reach
    the driver. Each row crosses the network once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(rows.select("id"), parts)
    rows = rows.withColumn("range", _bucket(F.col("id"), bounds))
    heads = [(r["range"], r["head"]) for r in rows.select("id", "range").groupBy("range").agg(F.max("id").alias("head")).sort(F.desc("range")).collect()]
    # The head of a range follows the last row of the next higher one; the very first follows the very last.
    before = {r: heads[i - 1][0] for i, (r, _) in enumerate(heads)}
    goes = F.create_map(*[F.lit(x) for r, h in heads for x in (r, before[r])]) if heads else F.create_map(F.lit(0), F.lit(0))
    tops = F.create_map(*[F.lit(x) for r, h in heads if h is not None for x in (r, h)]) if any(h is not None for _, h in heads) else F.create_map(F.lit(-1), F.lit(0))
    # A range whose head is null holds null ids alone.
    head = F.col("id").eqNullSafe(F.try_element_at(tops, F.col("range")))
    rows = rows.withColumn("guest", F.explode(
        F.when(head, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    rows = rows.withColumn("range", F.when(F.col("guest"), F.element_at(goes, F.col("range"))).otherwise(F.col("range")))
    # Texts travel, signatures do not: they are made where the window finds its rows.
    rows = rows.repartition("range").withColumn("sigs", signatures(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("id"), F.xxhash64("text"), "text")
    ahead = F.lead(F.struct("text", "sigs")).over(order)
    return rows.select("id", "text", "sigs", "guest", ahead.alias("ahead")).where("NOT guest").select(
        F.col("id").alias(id_col), "text", "sigs", F.col("ahead.text").alias("next_text"), F.col("ahead.sigs").alias("next_sigs"))


def op2_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sigs", "next_sigs", F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sigs", "next_sigs", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       signatures(F.col("edited")).alias("edited_sigs"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("sigs", "").alias("fingerprint"),
        F.array_join("edited_sigs", "").alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


_LIST = ", ".join(f"'{w}'" for w in COMMON)


def _sigs_sql(text: str) -> str:
    """The signature set in SQL: positions of content words, then chains after each common word."""
    words = f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return f"(SELECT s.sigs FROM (SELECT {words} AS ws) q, LATERAL (SELECT list_filter(q.ws, lambda w: w NOT IN ({_LIST})) AS cs, list_filter(range(1, len(q.ws) + 1), lambda i: q.ws[i] IN ({_LIST})) AS xs) p, LATERAL (SELECT list_filter(list_transform(range(1, len(p.xs) + 1), lambda j: CASE WHEN p.xs[j] - j + 2 <= len(p.cs) THEN substr(md5(q.ws[p.xs[j]] || ' ' || p.cs[p.xs[j] - j + 1] || ' ' || p.cs[p.xs[j] - j + 2]), 1, 12) END), lambda x: x IS NOT NULL) AS found) f, LATERAL (SELECT CASE WHEN len(f.found) > 0 THEN list_sort(list_distinct(f.found)) WHEN len(q.ws) > 0 THEN [substr(md5(array_to_string(q.ws, ' ')), 1, 12)] ELSE [] END AS sigs) s)"


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text FROM d),
e AS (SELECT *, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited FROM o),
f AS (SELECT *, {_sigs_sql('text')} AS a, {_sigs_sql('edited')} AS b, {_sigs_sql('next_text')} AS c FROM e)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
 array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
 CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END AS near_edited,
 CASE WHEN len(a) = 0 AND len(c) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a, c))::DOUBLE / (len(a) + len(c) - len(list_intersect(a, c))) END AS near_next
FROM f"""
