"""Benchmark decontamination: passages of benchmark items found by a prefix-filtered set join (built-in functions only).

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter item. Its
shingles are its runs of ``SHINGLE`` words (a window of fewer words is one shingle). Documents
are exploded into their shingles once; a bitmap of all shingles of the benchmark, of bounded
size, lets only those through that an item may hold, each with the few words around it. These
give every shingle's number of occurrences in the documents, by which shingles are ordered. A
document that holds a window holds all its shingles, so the necessary prefix is one shingle, the
rarest: windows join on it. Windows with a shingle that no document has are dropped, places where
the window would stick out of the document or of the words around the shingle are refused, and
the rest is compared word by word.

Null and empty texts, and texts without words, have no words: no window, no hit. Rows of the
documents are told apart by a number written with them, so null and repeated ids are documents
of their own. A null item_id brings windows but no item; items of equal id are one item. Equal
windows of several items count for each of them. Other columns of the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.near import may_match
from caseledger.llm.words import table
from caseledger.operators.skew import broadcast_within
from caseledger.session import materialize, staged

WINDOW, SHINGLE = 10, 5
# What stands between words; capitals and their small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(column: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(column).cast("string"), F.lit("")), BETWEEN), lambda w: w != "")


def _lower(words: Column) -> Column:
    """A-Z in small letters, nothing else."""
    return F.transform(words, lambda w: F.translate(w, CAPITALS, SMALL))


def _codes(words: Column) -> Column:
    """A hash of each word that equal words share whatever their case; boundaries of words do not depend on case."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _shingle(codes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(codes, at + k) for k in range(size)])


def _windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(window, item, words): every window of every item; the window's name is a digest of its words."""
    rows = benchmark.select(F.col(item_col).alias("item"), _lower(_words(text_col)).alias("ws")).where(F.size("ws") > 0)
    length = F.least(F.size("ws"), F.lit(window))
    rows = rows.select("item", "ws", F.explode(F.sequence(F.lit(1), F.size("ws") - length + 1)).alias("at"), length.alias("length"))
    rows = rows.select("item", F.slice("ws", F.col("at"), F.col("length")).alias("words"))
    return rows.select(F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("window"), "item", "words").distinct()


def _window_shingles(windows: DataFrame, sizes: list[int], shingle: int) -> DataFrame:
    """(window, words, size, at, hash) of each distinct window's shingles."""
    rows = windows.select("window", "words").distinct().withColumn("codes", _codes(F.col("words")))
    rows = rows.withColumn("size", F.least(F.size("words"), F.lit(shingle)))
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))))
    of_size = F.lit(None).cast("long")
    for s in sizes:
        of_size = F.when(F.col("size") == s, _shingle(F.col("codes"), F.col("at"), s)).otherwise(of_size)
    return rows.select("window", "words", "size", "at", of_size.alias("hash"))


def _places(docs: DataFrame, known: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(row, id, n_words, pos, hash, before, around): shingles that an item may have, and one row without pos per document."""
    rows = docs.withColumn("row", F.monotonically_increasing_id()).withColumn("ws", _words("text"))
    rows = rows.select("row", "id", "ws", F.size("ws").cast("long").alias("n_words"), _codes(F.col("ws")).alias("codes"))

    def of_size(s: int) -> Column:
        starts = F.slice("codes", 1, F.greatest(F.size("codes") - (s - 1), F.lit(0)))
        return F.transform(starts, lambda _, i: F.struct(i.alias("pos"), _shingle(F.col("codes"), i, s).alias("hash")))
    none = F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.lit(None).cast("long").alias("hash")))
    rows = rows.select("row", "id", "n_words", "ws", F.explode(F.concat(*map(of_size, sizes), none)).alias("s")).select(
        "row", "id", "n_words", "ws", "s.pos", "s.hash")
    rows = may_match(rows, "hash", known).where("pos IS NULL OR __may")
    before = F.least(F.col("pos"), F.lit(window - 1))
    return rows.select("row", "id", "n_words", "pos", "hash", before.alias("before"), F.when(
        F.col("pos").isNotNull(), F.slice("ws", F.col("pos") - before + 1, before + window)).alias("around"))


def occurrences(places: DataFrame, shingles: DataFrame) -> DataFrame:
    """(row, start, stop, window): every place where a document's words are a window's words."""
    heard = places.where("pos IS NOT NULL")
    often = heard.groupBy("hash").agg(F.count(F.lit(1)).alias("often"))
    # One row per window: its rarest shingle, if documents have all its shingles.
    first = F.min_by(F.struct("hash", "at", "words"), F.struct("often", "hash", "at"))
    prefix = shingles.join(often, "hash").groupBy("window", "size").agg(first.alias("p"), F.count(F.lit(1)).alias("there"))
    prefix = prefix.where(F.col("there") == F.size("p.words") - F.col("size") + 1).select("window", "p.hash", "p.at", "p.words")
    pairs = heard.select("row", "pos", "hash", "before", "around").join(broadcast_within(prefix), "hash")
    start, length = F.col("before") - F.col("at"), F.size("words")
    pairs = pairs.where((start >= 0) & (start + length <= F.size("around")))
    pairs = pairs.where(_lower(F.slice("around", start + 1, length)) == F.col("words"))
    begin = F.col("pos") - F.col("at")
    return pairs.select("row", begin.alias("start"), (begin + length).alias("stop"), "window")


def covered(spans: Column) -> Column:
    """How many words the spans (start, stop) of one document cover."""
    none = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("end"))
    total = F.aggregate(F.sort_array(spans), none, lambda a, s: F.struct(
        (a["seen"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["end"]))).alias("seen"), F.greatest(a["end"], s["stop"]).alias("end")))
    return total["seen"].cast("long")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: the id, n_words, n_hit (words inside occurrences), items (sorted ids as strings)."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    with staged(_windows(benchmark, item_col, item_text_col, window), "windows") as windows:
        # At most ``shingle`` different sizes.
        size = F.least(F.size("words"), F.lit(shingle))
        sizes = sorted(r[0] for r in windows.select(size).distinct().collect())
        known = _window_shingles(windows, sizes, shingle)
        with staged(_places(docs, known.select("hash").distinct(), sizes, window), "places") as places:
            with staged(occurrences(places, known), "occurrences") as found:
                hits = found.groupBy("row").agg(covered(F.collect_set(F.struct("start", "stop"))).alias("n_hit"))
                items = found.select("row", "window").distinct().join(windows.select("window", "item"), "window")
                items = items.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
                rows = places.where("pos IS NULL").select("row", "id", "n_words")
                rows = rows.join(hits.join(items, "row", "left"), "row", "left")
                none = F.array().cast("array<string>")
                return materialize(rows.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                                               F.coalesce("items", none).alias("items")), "contamination")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
n AS (SELECT item_id, ws, least(len(ws), {WINDOW}) AS l FROM b WHERE len(ws) > 0),
g AS (SELECT DISTINCT item_id, l, array_to_string(ws[i:i + l - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(ws) - l + 2)) AS i FROM n) q),
l AS (SELECT DISTINCT l FROM g),
p AS (SELECT doc_id, l, i, array_to_string(ws[i:i + l - 1], ' ') AS k FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, l WHERE len(ws) >= l) q),
o AS (SELECT p.doc_id, p.i, p.l, g.item_id FROM p JOIN g ON p.l = g.l AND p.k = g.k),
h AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS w FROM o) q GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM o WHERE item_id IS NOT NULL) q GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN m ON d.doc_id = m.doc_id"""
