"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

A document's set holds its distinct five-word shingles (with fewer words, the whole sequence
as one). Its sketch has ``COORDINATES`` bins, filled in rounds: in the first rounds every
element falls into a hashed bin, in the later ones all elements compete for one given bin, so
after at most twice as many rounds as bins every bin is filled, and the share of equal bins
of two sets is concentrated around their likeness. Bands of ``ROWS`` bins propose candidates
(a pair at the threshold is missed by all bands with a probability below 1e-7); links are
confirmed on the full sets.

Documents with the same words are one class, so exact copies are never compared. Classes of a
bucket are first compared with the bucket's smallest class only. Where classes that buckets
connect (a family) still fall into several components, members of different components are
compared tile by tile, so that any family is cut into tasks of bounded size, and pairs whose
sketches agree well enough are confirmed on the full sets; only confirmed links leave a task.
Components are then found by alternating star contraction.

Null texts, empty texts and texts without words have an empty set, are linked with nothing
and are kept. Repeated rows and equal ids are documents of their own; rows with equal words
share a component. A null id counts as no id: its component is the smallest id reachable, or
null. Ties cannot occur: the smallest id represents a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from caseledger.llm.words import ODD, batches, grams, hash_words, mix, small_batches, table
from caseledger.session import materialize

COORDINATES, ROWS, SHINGLE = 96, 4, 5
BANDS = COORDINATES // ROWS
TILE, TILE_BYTES, FAMILY, LEAST_BITS, MOST_BITS = 1024, 8 << 20, 16_384, 16, 26
# Rows of texts or sets, and blocks of two tiles, that a Python worker takes at once.
ROWS_AT_ONCE, BLOCKS_AT_ONCE = 1000, 4
_EMPTY = np.uint64(2**64 - 1)


def sketch(elements: np.ndarray, offsets: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """A row of ``t`` filled bins per set (no set may be empty)."""
    n = len(offsets) - 1
    out = np.full((n, t), _EMPTY, np.uint64)
    left, sizes = np.arange(n), np.diff(offsets)
    owner = np.repeat(left, sizes)
    for r in range(2 * t):
        if not len(left):
            break
        x = mix(elements + ODD * np.uint64(2 * r + 1))
        place = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if r < t else r - t
        least = np.full(len(left) * t, _EMPTY, np.uint64)
        np.minimum.at(least, owner * t + place, mix(x + np.uint64(r)) >> np.uint64(1))
        rows = out[left]
        rows = np.where(rows == _EMPTY, least.reshape(-1, t), rows)
        out[left] = rows
        open_ = (rows == _EMPTY).any(1)
        if not open_.all():
            keep = open_[owner]
            elements, owner = elements[keep], (np.cumsum(open_) - 1)[owner[keep]]
            left = left[open_]
    return out


def shingle_sets(texts: list[str | None]) -> tuple[list[np.ndarray], list[bytes]]:
    """Each text's sorted distinct shingles, and a 16-byte digest of its word sequence."""
    words, offsets = hash_words(texts, lower=True)
    runs, at = grams(words, offsets, SHINGLE)
    sets, keys = [], []
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(offsets[:-1], np.diff(offsets)).astype(np.uint64)
    first, second = mix(words + place * ODD), mix((words ^ ODD) + mix(place))
    first, second = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64))) for v in (first, second))
    for i in range(len(texts)):
        a, b = offsets[i], offsets[i + 1]
        if b - a >= SHINGLE:
            sets.append(np.unique(runs[at[i]:at[i + 1]]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = mix(np.array([whole * ODD + w], np.uint64))[0]
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
        keys.append(np.array([first[b] - first[a], second[b] - second[a]], np.uint64).tobytes())
    return sets, keys


def sketches(docs: DataFrame) -> DataFrame:
    """(id, text) to (id, key, n, bands, codes)."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(over="ignore"):
            for pdf in parts:
                texts = pdf["text"].tolist()
                for a, b in batches(texts):
                    sets, keys = shingle_sets(texts[a:b])
                    n = np.array([len(s) for s in sets])
                    some = np.flatnonzero(n)
                    bands, codes = [[]] * len(sets), [b""] * len(sets)
                    if len(some):
                        bins = sketch(np.concatenate([sets[i] for i in some]), np.concatenate(([0], np.cumsum(n[some]))))
                        band = np.zeros((len(some), BANDS), np.uint64)
                        for r in range(ROWS):
                            band = mix(band * ODD + bins[:, r::ROWS] + np.arange(BANDS, dtype=np.uint64))
                        for j, i in enumerate(some):
                            bands[i], codes[i] = band[j].view(np.int64), (bins[j] & np.uint64(255)).astype(np.uint8).tobytes()
                    yield pd.DataFrame({"id": pdf["id"].iloc[a:b].to_numpy(), "key": keys, "n": n, "bands": bands, "codes": codes})
    return docs.mapInPandas(run, "id long, key binary, n long, bands array<long>, codes binary")


def full_sets(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(text) and (cid, key) to (cid, n, shingles): the set of each asked class, as packed sorted numbers.

    Texts and classes meet on the digest of the words alone, so it does not matter how many
    rows share an id; copies of a class give equal sets, of which one stays.
    """
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(over="ignore"):
            for pdf in parts:
                all_texts = pdf["text"].tolist()
                for a, b in batches(all_texts):
                    sets, keys = shingle_sets(all_texts[a:b])
                    yield pd.DataFrame({"key": keys, "n": np.array([len(s) for s in sets], np.int64), "shingles": [s.tobytes() for s in sets]})
    sets = may_match(texts.select("text").mapInPandas(run, "key binary, n long, shingles binary"), "key", asked.select("key"))
    found = sets.where("__may").select("key", "n", "shingles").join(asked.select("cid", "key"), "key")
    return found.groupBy("cid").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))


@F.pandas_udf(LongType())
def _in_both(a: pd.Series, b: pd.Series) -> pd.Series:
    """How many numbers two packed sorted sets share."""
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                      for x, y in zip(a, b)], dtype="int64")


def may_match(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` with ``__may``: False only where ``column`` is certainly not among ``ids``.

    The ids set bits of a bitmap of 16 cells for each, from 2**16 cells to 2**26 (at most 2**20
    rows, 16 MB), which is small enough to broadcast at any size of the input; beyond four
    million ids more rows pass, and the join that follows stays exact.
    """
    n = ids.count()
    bits = min(max(math.ceil(math.log2(16 * max(n, 1))), LEAST_BITS), MOST_BITS)
    cell = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << bits))
    bits = ids.toDF(column).select(cell.alias("c")).select(F.shiftright("c", 6).alias("__word"), F.expr("shiftleft(1L, cast(c % 64 as int))").alias("bit")).groupBy("__word").agg(F.bit_or("bit").alias("__bits"))
    rows = rows.withColumn("__cell", cell).withColumn("__word", F.shiftright("__cell", 6))
    rows = rows.join(F.broadcast(bits), "__word", "left")
    return rows.withColumn("__may", F.coalesce(F.expr("shiftrightunsigned(__bits, cast(__cell % 64 as int)) & 1") == 1, F.lit(False))).drop("__cell", "__word", "__bits")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (v, root): alternating large and small stars, until every vertex points at its smallest."""
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        # Settled: every vertex points at one other, and none that is pointed at points on.
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").isEmpty():
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "edges")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have an intersection of at least ``percent`` of their union."""
    left = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    rows = pairs.join(left, "a").join(right, "b")
    rows = rows.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    rows = rows.select("a", "b", (F.col("na") + F.col("nb")).alias("total"), _in_both("sa", "sb").alias("both"))
    return rows.where(100 * F.col("both") >= percent * (F.col("total") - F.col("both"))).select("a", "b")


def linked_within(rows: DataFrame, members: DataFrame, sets: DataFrame, percent: int, slack: float = 0.19) -> DataFrame:
    """(group, cid, root, codes) and (cid, n, shingles) to links (a, b) that join different roots of a group.

    A group is cut into tiles of about ``TILE`` members and at most ``TILE_BYTES``; each pair of
    tiles is one row of bounded size. There, pairs of
    different roots whose sketches agree well enough are confirmed on the full sets, the most
    promising first; a confirmed pair makes one root of two, so what is already connected is
    not compared again. Only the confirmed links leave the task.
    """
    tiles = F.greatest(F.ceil(F.col("members") / TILE), F.ceil(8 * F.col("elements") / TILE_BYTES)).cast("int")
    rows = rows.join(members, "group").withColumn("tile", F.pmod(F.xxhash64("cid"), tiles).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    # The sets join by class, so that a family's blocks are dealt apart.
    blocks = rows.join(sets.select("cid", "shingles"), "cid").groupBy("group", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")).agg(
        F.collect_list(F.struct("cid", "root", "tile", "codes", "shingles")).alias("rows"))

    def links(i, j, rows) -> list[tuple[int, int]]:
        cid, root, tile = (np.array([r[c] for r in rows]) for c in ("cid", "root", "tile"))
        codes = np.frombuffer(b"".join(bytes(r["codes"]) for r in rows), np.uint8).reshape(len(rows), -1)
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        names, at = np.unique(root, return_inverse=True)
        head = list(range(len(names)))

        def find(x: int) -> int:
            while head[x] != x:
                head[x] = head[head[x]]
                x = head[x]
            return x
        found, xs, ys, likely = [], [], [], []
        for x in range(len(rows)):
            # Pairs within a tile are met in the block of that tile alone.
            ok = (cid > cid[x]) & (at != at[x]) & ((tile != tile[x]) | (i == j))
            near = np.flatnonzero(ok)
            share = (codes[near] == codes[x]).mean(1) if len(near) else np.empty(0)
            good = share >= percent / 100 - slack
            xs.append(np.full(good.sum(), x)), ys.append(near[good]), likely.append(share[good])
        xs, ys, likely = (np.concatenate(v) if v else np.empty(0, int) for v in (xs, ys, likely))
        for k in np.argsort(-likely, kind="stable"):
            x, y = int(xs[k]), int(ys[k])
            p, q = find(at[x]), find(at[y])
            small, large = sorted((len(sets[x]), len(sets[y])))
            if p == q or 100 * small < percent * large:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * both >= percent * (small + large - both):
                head[p] = q
                found.append((int(cid[x]), int(cid[y])))
        return found

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            found = [pair for i, j, rows in zip(pdf["i"], pdf["j"], pdf["rows"]) for pair in links(i, j, rows)]
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    return blocks.mapInPandas(compare, "a long, b long")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per row: id, key (digest of its words), n_shingles, component_id, component_key.

    The component_id is no key of a component: it is null where all ids are, and unlinked texts
    with equal ids share it. The component_key is one: the key of the component's row with the
    smallest id (of equal ids, with the smallest key).
    """
    with small_batches(docs.sparkSession, ROWS_AT_ONCE):
        return _near_components(docs, id_col, text_col, percent)


def _near_components(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(sketches(docs), "sketches")
    classes = rows.groupBy("key").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("codes").alias("codes"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    banded = classes.where("n > 0").select("cid", F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = materialize(banded.join(hubs, "bucket"), "shared")
    asked = shared.select("cid").distinct().join(classes.select("cid", "key", "least"), "cid")
    asked = materialize(asked, "asked")
    # Rows with an id that is some class's smallest, or with none.
    texts = may_match(docs, "id", asked.select("least")).where("__may")
    sets = materialize(full_sets(texts, asked), "sets")
    stars = shared.where("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    edges = materialize(confirmed(stars, sets, percent), "stars")
    roots = components(edges)
    # A family is what buckets connect. Families that hold several components are compared as a
    # whole; one of more than FAMILY classes is compared bucket by bucket.
    families = components(stars).withColumnRenamed("v", "cid").withColumnRenamed("root", "family")
    labelled = asked.select("cid").join(families, "cid", "left").join(roots.withColumnRenamed("v", "cid"), "cid", "left")
    labelled = materialize(labelled.select("cid", F.coalesce("family", "cid").alias("family"), F.coalesce("root", "cid").alias("root")), "labelled")
    sizes = labelled.groupBy("family").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("members")).where("x < y")
    open_ = labelled.join(sizes.select("family", "members"), "family")
    large = open_.where(F.col("members") > FAMILY).join(shared.select("cid", "bucket"), "cid").select(
        F.concat(F.lit("b"), F.col("bucket").cast("string")).alias("group"), "cid", "root")
    groups = open_.where(F.col("members") <= FAMILY).select(F.concat(F.lit("f"), F.col("family").cast("string")).alias("group"), "cid", "root").union(large)
    groups = materialize(groups, "groups")
    groups = groups.join(classes.select("cid", "codes", "n"), "cid")
    members = groups.groupBy("group").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("members"),
                                          F.sum("n").alias("elements")).where("x < y").select("group", "members", "elements")
    with small_batches(docs.sparkSession, BLOCKS_AT_ONCE):
        links = materialize(linked_within(groups.select("group", "cid", "root", "codes"), members, sets, percent), "links")
    roots = components(edges.union(links))
    named = classes.select("cid", "key", "least").join(roots.withColumnRenamed("v", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = materialize(named, "named")
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "key"))
    least = named.groupBy("root").agg(first.alias("first")).select("root", F.col("first.least").alias("component_id"), F.col("first.key").alias("component_key"))
    named = named.join(least, "root").select("key", "component_id", "component_key")
    return rows.select("id", "key", "n").join(named, "key").select(
        F.col("id").alias(id_col), "key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "component_key")


@F.pandas_udf(BinaryType())
def word_key(texts: pd.Series) -> pd.Series:
    """The digest of a text's words that ``near_components`` returns."""
    keys: list[bytes] = []
    with np.errstate(over="ignore"):
        for a, b in batches(all_texts := texts.tolist()):
            keys += shingle_sets(all_texts[a:b])[1]
    return pd.Series(keys)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """All columns of ``docs``, one row of each group of near-duplicates: one with the smallest id.

    Groups are told apart by their component_key, so that null ids and equal ids of different
    texts stay documents of their own.
    Rows without words all stay. Rows that certainly lose nothing pass without a join; the
    others are joined with the decisions by id and digest.
    """
    found = near_components(docs, id_col, text_col, percent).where("n_shingles > 0")
    first = F.col(id_col).eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("component_key"))
    found = materialize(found.select(F.col(id_col).cast("long").alias("__id"), F.col("key").alias("__key"), first.alias("__first")), "found")
    chosen = found.where("__first").groupBy("__id", "__key").agg(F.count(F.lit(1)).alias("n"))
    chosen = materialize(chosen, "chosen")
    touched = found.where("NOT __first").select("__id").union(chosen.where("n > 1").select("__id"))
    rows = may_match(docs.withColumn("__id", F.col(id_col).cast("long")), "__id", touched)
    sure = rows.where("NOT __may").drop("__may", "__id")
    rest = rows.where("__may").withColumn("__key", word_key(F.col(text_col).cast("string")))
    empty = rest.where(F.col("__key") == F.lit(bytes(16)))
    # Equal id and digest: the first row of them.
    kept = rest.where(F.col("__key") != F.lit(bytes(16))).join(chosen.select(F.col("__id").alias("__c"), F.col("__key").alias("__k")),
                     F.col("__id").eqNullSafe(F.col("__c")) & (F.col("__key") == F.col("__k")), "left_semi").dropDuplicates(["__id", "__key"])
    return sure.unionByName(empty.unionByName(kept).drop("__may", "__id", "__key"))


def op4_fast_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
r AS (SELECT doc_id AS a, doc_id AS root FROM s UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.a),
m AS (SELECT a, min(root) AS root FROM r GROUP BY a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, root AS component_id, doc_id = root AS kept FROM s JOIN m ON m.a = s.doc_id"""
