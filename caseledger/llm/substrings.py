"""Substring dedup: repeated passages found with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words. Every window has a minimizer, its run of six words of
the smallest hash; windows that follow each other with the same minimizer form a segment.
Equal windows have equal minimizers, so only segments whose minimizer at least two documents
hold can repeat. Each distinct one of these segments, with the smallest document id it occurs
in, is dealt to a shard by minimizer and kept in an FM-index there: the Burrows-Wheeler
transform of their words in a wavelet matrix. Backward search streams the windows of all
segments through it; the interval that a whole window reaches gives the smallest document in
which it starts. Where that is no smaller document than the segment's own, the segment as a whole
is the interval that repeats; otherwise the shard reports the windows that start earlier.
Occurrences in later documents are covered intervals; covered words are removed.

A minimizer with very many distinct segments (more than ``HOT``) has them cut into their windows,
which are dealt by their own hash, so no shard grows with one minimizer; distinct windows keep
their smallest id, so the answers are the same. Minimizers meet in aggregations that combine
where the rows are, and no row set of one minimizer is ever gathered in a task.

Null and empty texts have no words. Rows with a null id are neither searched nor a source, so
they lose nothing. Rows are told apart by a hash of their id and text: rows of equal id do not
remove each other's words, and repeated rows get equal results. Texts shorter than a window
lose nothing. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.near import may_match
from caseledger.llm.words import ODD, batches, grams, hash_words, mix, table
from caseledger.session import materialize, staged

WINDOW, GRAM = 13, 6
HOT, SHARD_WORDS = 20_000, 400_000


class WaveletMatrix:
    """Rank over a sequence of small integers: one packed bit vector with block counts per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.n, self.levels = len(symbols), []
        for bit in reversed(range(max(1, int(size - 1).bit_length()))):
            ones = (symbols >> bit) & 1
            packed = np.packbits(np.concatenate((ones.astype(bool), np.zeros(64 - len(ones) % 64, bool))), bitorder="little").view(np.uint64)
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)))[:-1].astype(np.int32)
            zeros = len(ones) - int(ones.sum())
            self.levels.append((bit, packed, counts, zeros))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbol: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before a and before b."""
        start = np.zeros(len(symbol), np.int64)
        for bit, packed, counts, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)

            def before(i):
                word = i >> 6
                mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
                ones = counts[word] + np.bitwise_count(packed[word] & mask)
                return np.where(one, ones + zeros, i - ones)
            start, a, b = before(start), before(a), before(b)
        return a - start, b - start


class FmIndex:
    """Segments (words as small integers from 1) with a backward search; each segment carries a value."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray, values: np.ndarray, size: int):
        n_seg = len(offsets) - 1
        # A separator of its own after each segment, below all words.
        text = np.empty(len(words) + n_seg, np.int64)
        ends = offsets[1:] + np.arange(n_seg)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside], text[ends] = words + n_seg, np.arange(n_seg)
        rank, step = np.unique(text, return_inverse=True)[1], 1
        while True:
            key = rank * (len(text) + 1)
            key[:-step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            rank = np.empty_like(fresh)
            rank[order] = fresh
            if fresh[-1] == len(text) - 1:
                break
            step *= 2
        bwt = np.where(inside[order - 1], text[order - 1] - n_seg, 0)
        self.tree = WaveletMatrix(bwt, size)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(np.where(inside, text - n_seg, 0), minlength=size))))
        segment = np.cumsum(~inside) - ~inside
        self.values = np.append(values[segment[order]], np.iinfo(np.int64).max)
        self.n = len(text)

    def least(self, words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """For each start the least value of a segment that holds those ``length`` words."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        open_ = np.arange(len(starts))
        for k in reversed(range(length)):
            c = words[starts[open_] + k]
            a, b = self.tree.rank(c, low[open_], high[open_])
            low[open_], high[open_] = self.first[c] + a, self.first[c] + b
            # What only one place of the index can still match is that place: the window itself.
            open_ = open_[(high[open_] - low[open_]) > 1]
        spans, back = np.unique(low * (self.n + 1) + high, return_inverse=True)
        low, high = spans // (self.n + 1), spans % (self.n + 1)
        return np.minimum.reduceat(self.values, np.stack((low, high), 1).ravel())[::2][back]


def _segments(words: np.ndarray, offsets: np.ndarray):
    """(text, first word, number of words, minimizer) of every segment."""
    count = np.diff(offsets)
    runs, _ = grams(words, np.array([0, len(words)]), GRAM)
    span = WINDOW - GRAM + 1
    windows = np.maximum(count - WINDOW + 1, 0)
    if not windows.sum():
        none = np.empty(0, np.int64)
        return none, none, none, none
    owner = np.repeat(np.arange(len(count)), windows)
    start = np.repeat(offsets[:-1], windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    best, at = runs[start], start.copy()
    for k in range(1, span):
        other = runs[start + k]
        less = other < best
        best, at = np.where(less, other, best), np.where(less, start + k, at)
    head = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]))))
    tail = np.append(head[1:], len(at)) - 1
    return owner[head], start[head] - offsets[owner[head]], start[tail] - start[head] + WINDOW, best[head].view(np.int64)


def _hash_runs(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of words, from prefix sums of position-weighted hashes."""
    weights = np.full(len(words), ODD, np.uint64)
    if len(words):
        weights[0] = 1
    weights = np.multiply.accumulate(weights)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words) * weights, dtype=np.uint64)))
    # Dividing by the weight of the first place makes equal runs equal wherever they stand.
    undo = np.full(len(words), np.uint64(pow(int(ODD), -1, 2**64)), np.uint64)
    if len(words):
        undo[0] = 1
    undo = np.multiply.accumulate(undo)
    return mix((total[starts + lengths] - total[starts]) * undo[starts] + lengths.astype(np.uint64)).view(np.int64)


def _each(parts: Iterator[pd.DataFrame], of) -> Iterator[pd.DataFrame]:
    """``of`` (rows, their words, offsets) over pieces of bounded size."""
    with np.errstate(over="ignore"):
        for pdf in parts:
            texts = pdf["text"].tolist()
            for a, b in batches(texts):
                words, offsets = hash_words(texts[a:b], lower=False)
                out = of(pdf.iloc[a:b], words, offsets)
                if out is not None:
                    yield out


def shared_minimizers(docs: DataFrame) -> DataFrame:
    """(id, text) to the minimizers (m) that at least two ids hold, combined where they are found."""
    def of(rows: pd.DataFrame, words: np.ndarray, offsets: np.ndarray) -> pd.DataFrame | None:
        owner, _, _, m = _segments(words, offsets)
        if not len(m):
            return None
        ids = rows["id"].to_numpy(np.int64)[owner]
        order = np.lexsort((ids, m))
        m, ids = m[order], ids[order]
        head = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
        return pd.DataFrame({"m": m[head], "least": ids[head], "most": ids[np.append(head[1:], len(m)) - 1]})
    held = docs.mapInPandas(lambda parts: _each(parts, of), "m long, least long, most long")
    held = held.groupBy("m").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    return held.where("least < most").select("m")


def segments(docs: DataFrame) -> DataFrame:
    """(id, doc, text) to (m, seg, id, doc, place): the minimizer and the hash of each segment; place packs
    its first word and its number of words."""
    def of(rows: pd.DataFrame, words: np.ndarray, offsets: np.ndarray) -> pd.DataFrame | None:
        owner, first, n, m = _segments(words, offsets)
        if not len(m):
            return None
        return pd.DataFrame({"m": m, "seg": _hash_runs(words, offsets[owner] + first, n), "id": rows["id"].to_numpy(np.int64)[owner],
                             "doc": rows["doc"].to_numpy(np.int64)[owner], "place": first << 32 | n})
    return docs.mapInPandas(lambda parts: _each(parts, of), "m long, seg long, id long, doc long, place long")


def _cut(texts: DataFrame) -> DataFrame:
    """(text, places) to the words of segments: (piece, m, seg, part, least, words).

    A piece is the segment itself, or each window of a segment that is to be cut.
    """
    def of(rows: pd.DataFrame, words: np.ndarray, offsets: np.ndarray) -> pd.DataFrame | None:
        out = []
        for i, places in enumerate(rows["places"]):
            own = words[offsets[i]:offsets[i + 1]]
            short = (own >> np.uint64(32)).astype(np.uint32)
            for p in places:
                first, n = p["place"] >> 32, p["place"] & 0xFFFFFFFF
                if p["often"]:
                    at = first + np.arange(n - WINDOW + 1)
                    keys = _hash_runs(own, at, np.full(len(at), WINDOW))
                    out += [(int(key), int(key), p["seg"], k, p["least"], short[at[k]:at[k] + WINDOW].tobytes()) for k, key in enumerate(keys)]
                else:
                    out.append((p["seg"], p["m"], p["seg"], -1, p["least"], short[first:first + n].tobytes()))
        return pd.DataFrame(out, columns=["piece", "m", "seg", "part", "least", "words"]) if out else None
    return texts.mapInPandas(lambda parts: _each(parts, of), "piece long, m long, seg long, part long, least long, words binary")


def _search(shards: DataFrame) -> DataFrame:
    """(shard, piece, least, words) sorted by shard to (piece, part, source): the windows of a piece that start in a
    smaller id than the piece itself, and that id."""
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        words, least = rows["words"].tolist(), rows["least"].to_numpy()
        raw = np.frombuffer(b"".join(words), np.uint32)
        offsets = np.concatenate(([0], np.cumsum([len(w) // 4 for w in words])))
        known, symbols = np.unique(raw, return_inverse=True)
        symbols = symbols.astype(np.int64) + 1
        index = FmIndex(symbols, offsets, least, len(known) + 1)
        count = np.diff(offsets) - WINDOW + 1
        starts = np.repeat(offsets[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found = np.concatenate([index.least(symbols, starts[k:k + 500_000], WINDOW) for k in range(0, len(starts), 500_000)])
        owner = np.repeat(np.arange(len(count)), count)
        earlier = np.flatnonzero(found < least[owner])
        part = earlier - (np.cumsum(count) - count)[owner[earlier]]
        return pd.DataFrame({"piece": rows["piece"].to_numpy()[owner[earlier]], "part": part, "source": found[earlier]})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, shard = [], None
        for pdf in parts:
            for key, rows in pdf.groupby("shard", sort=False):
                if key != shard and held:
                    yield one(pd.concat(held))
                    held = []
                shard = key
                held.append(rows)
        if held:
            yield one(pd.concat(held))
    return shards.mapInPandas(run, "piece long, part long, source long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, doc): the name of a row is a hash of its id and text."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return docs.withColumn("doc", F.xxhash64("id", "text"))


def _earlier(docs: DataFrame, unique: DataFrame, hot: int) -> DataFrame:
    """(seg, least, doc, place) to (seg, parts): the windows of a segment that start in a smaller id than the segment."""
    often = unique.groupBy("m").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("m", F.lit(True).alias("often"))
    marked = unique.join(often, "m", "left")
    places = marked.groupBy("doc").agg(F.collect_list(
        F.struct("place", "m", "seg", "least", F.coalesce("often", F.lit(False)).alias("often"))).alias("places"))
    texts = may_match(docs, "doc", unique.select("doc")).where("__may").select("doc", "text")
    # Rows with equal id and text bring their pieces twice, which changes no answer.
    with staged(_cut(texts.join(places, "doc")), "pieces") as cut:
        # Windows cut from several segments are one piece.
        pieces = cut.where("part < 0").select("piece", "m", "least", "words").unionByName(
            cut.where("part >= 0").groupBy("piece").agg(F.first("m").alias("m"), F.min("least").alias("least"), F.first("words").alias("words")))
        shards = max(1, math.ceil((cut.agg(F.sum(F.length("words") / 4)).first()[0] or 0) / SHARD_WORDS))
        dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("m"), F.lit(shards)).cast("int"))
        found = _search(dealt.select("shard", "piece", "least", "words").repartition("shard").sortWithinPartitions("shard", "piece"))
        windows = cut.where("part >= 0").select("piece", "seg", "part", "least")
        sources = windows.groupBy("piece").agg(F.min("least").alias("source"))
        windows = windows.join(sources, "piece").where("source < least").select("seg", "part", "source")
        rows = found.withColumnRenamed("piece", "seg").unionByName(windows)
        # At most as many as a segment has windows.
        return materialize(rows.groupBy("seg").agg(F.collect_set(F.struct("part", "source")).alias("parts")), "earlier")


def repeats(docs: DataFrame, hot: int | None = None) -> DataFrame:
    """(id, text, doc) to (doc, places): the runs of words whose windows also start in a smaller id, packed as places."""
    docs = docs.where("id IS NOT NULL AND text IS NOT NULL")
    with staged(shared_minimizers(docs), "minimizers") as shared:
        rows = may_match(segments(docs), "m", shared).where("__may").drop("__may").join(shared, "m")
        with staged(rows, "segments") as rows:
            unique = rows.groupBy("seg").agg(F.first("m").alias("m"), F.min("id").alias("least"),
                                             F.min(F.struct("id", "doc", "place")).alias("at"))
            with staged(unique.select("seg", "m", "least", "at.doc", "at.place"), "distinct") as unique:
                earlier = _earlier(docs, unique, HOT if hot is None else hot)
                held = rows.select("seg", "id", "doc", "place").join(unique.select("seg", "least"), "seg").join(earlier, "seg", "left")
                first = F.shiftright("place", 32)
                windows = F.transform(F.filter("parts", lambda p: p["source"] < F.col("id")),
                                      lambda p: F.shiftleft(first + p["part"], 32).bitwiseOR(F.lit(WINDOW)))
                covered = F.when(F.col("least") < F.col("id"), F.array("place")).otherwise(windows)
                held = held.where("least < id OR parts IS NOT NULL").select("doc", F.explode(covered).alias("place"))
                return materialize(held.groupBy("doc").agg(F.collect_set("place").alias("places")), "repeats")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int | None = None) -> DataFrame:
    """One row per row: the id, n_words, n_removed and the kept words joined by single spaces."""
    docs = _keyed(docs, id_col, text_col)
    found = repeats(docs, hot)
    rows = may_match(docs, "doc", found.select("doc"))
    none = F.lit(None).cast("array<long>")
    rows = rows.where("NOT __may").select("id", "text", none.alias("places")).unionByName(
        rows.where("__may").select("id", "text", "doc").join(found, "doc", "left").select("id", "text", "places"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            n, removed, kept = [], [], []
            for text, places in zip(pdf["text"], pdf["places"]):
                # bytes.split() parts at ASCII white space alone.
                words = text.encode("utf-8", "surrogatepass").split() if text is not None else []
                n.append(len(words))
                if places is not None and len(words) >= WINDOW:
                    places, cover = np.asarray(places, np.int64), np.zeros(len(words) + 1, np.int64)
                    first = places >> 32
                    np.add.at(cover, first, 1)
                    np.add.at(cover, first + (places & 0xFFFFFFFF), -1)
                    words = [w for w, c in zip(words, np.cumsum(cover)) if not c]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"id": pdf["id"], "n_words": n, "n_removed": removed, "kept": kept})

    return rows.mapInPandas(run, "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)


def op9_fm_index_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i, ws FROM w WHERE len(ws) >= {WINDOW}),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS k FROM g),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS lo FROM h),
c AS (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM f WHERE lo < doc_id),
r AS (SELECT doc_id, list(DISTINCT p) AS ps FROM c GROUP BY doc_id),
k AS (SELECT w.doc_id, ws, CASE WHEN ps IS NULL THEN ws ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda x: NOT list_contains(ps, x)), lambda x: ws[x]) END AS kept FROM w LEFT JOIN r ON w.doc_id = r.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(kept))::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""
