"""Cross-tokenizer alignment: the tokens of two tokenizers linked where their bytes overlap.

Both tokenizers cut the same bytes (a space and the text). Their end offsets are two sorted
lists; the shorter drives a galloping search, exponential steps and then a binary search, into
the longer. Common ends cut the tokens into groups; the ranks of a token's two ends in the other
list differ by the tokens it overlaps, which gives the links as ranges. Texts are encoded once:
every document's distinct linked id pairs are written with it, packed; counted over all documents;
and looked up again. The pairs that most documents hold, at most ``HEAD_PAIRS``, are broadcast,
the others are joined, so the size of the count table changes the way but no result.

Null and empty texts have no tokens and get zeros, and so do texts that a tokenizer does not
give back byte for byte. Rows are told apart by a number written with them, so null and repeated
ids are documents of their own, and copies count as documents. Ties for an id's highest count
all are highest. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.words import batches, table
from caseledger.session import materialize, staged

TOKENIZERS = "/opt/tokenizers"
HEAD_PAIRS = 1 << 20
BLOCK, CHARACTERS = 64, 500_000
# Fixed value: the words a byte-level BPE works on.
BPE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_tokenizers(folder: str = TOKENIZERS, bpe: str = "byte_bpe_50k.json", pieces: str = "piece_bpe_32k.model") -> tuple[bytes, bytes]:
    """The two files, about 2 MB whatever the input; they are broadcast, so executors need no copy."""
    return Path(folder, bpe).read_bytes(), Path(folder, pieces).read_bytes()


def _byte_symbols() -> dict[str, int]:
    """The character that stands for each byte: itself if it is printable, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, bpe: bytes, pieces: bytes):
        spec, symbols = json.loads(bpe), _byte_symbols()
        vocabulary = spec["model"]["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", []) if t.get("special")}
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("the merges are not in the order of their ids")
        ranks = {bytes(symbols[c] for c in s): i for s, i in vocabulary.items() if s not in special}
        self.a = tiktoken.Encoding("bpe", pat_str=BPE_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for word, i in ranks.items():
            self.a_bytes[i] = word
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))
        # An id's decimals and what follows it: in the group, at the end of its tokens of A, of B.
        self.width = max(len(self.a_bytes), len(self.b_bytes))
        self.decimals = [f"{i}{end}".encode() for end in ",|;" for i in range(self.width)]

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A and of B; none of either unless both give the bytes back."""
        if not text:
            return [], []
        whole = " " + text
        a, b, raw = self.a.encode_ordinary(whole), self.b.encode(text), whole.encode("utf-8", "surrogatepass")
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return [], []
        return a, b


@lru_cache(maxsize=2)
def _pair(bpe: bytes, pieces: bytes) -> Pair:
    return Pair(bpe, pieces)


def gallop(values: np.ndarray, ends: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value the first place in ``ends``, not before its start, whose end is not below it.

    Steps double from the start until they pass the value, then the last step is halved. All
    searches advance together; ``ends[-1]`` must not be below any value.
    """
    low, high, step, last = start.copy(), start.copy(), 1, len(ends) - 1
    open_ = np.flatnonzero(ends[start] < values)
    while len(open_):
        probe = np.minimum(low[open_] + step, last)
        below = ends[probe] < values[open_]
        high[open_] = probe
        open_ = open_[below]
        low[open_] = probe[below]
        step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = ends[middle] < values[open_]
        low[open_[below]], high[open_[~below]] = middle[below], middle[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def align(short: np.ndarray, long: np.ndarray, first: np.ndarray):
    """Ends of the driving list in the other: (places, common, low, count).

    ``first`` is the place in ``long`` where each driving token's text starts. The token
    overlaps ``count`` tokens of the other list from ``low``; ``common`` marks ends of both.
    """
    heads = np.arange(0, len(short), BLOCK)
    anchors = gallop(short[heads], long, first[heads])
    places = gallop(short, long, np.maximum(np.repeat(anchors, BLOCK)[:len(short)], first))
    common = long[places] == short
    passed = places + common  # how many ends of the other list lie at or before this end
    low = np.concatenate(([0], passed[:-1]))
    return places, common, low, places - low + 1


def _batch(pair: Pair, texts: list[str | None]) -> pd.DataFrame:
    """n_a, n_b, n_groups, n_links, groups_sha256 and the packed distinct pairs of each text."""
    coded = [pair.encode(t) for t in texts]
    n_a, n_b = (np.array([len(c[k]) for c in coded]) for k in (0, 1))
    out = {"n_a": n_a, "n_b": n_b, "n_groups": np.zeros(len(texts), np.int64), "n_links": np.zeros(len(texts), np.int64),
           "groups_sha256": [""] * len(texts), "pairs": [b""] * len(texts)}
    for swapped in (False, True):
        mine = np.flatnonzero((n_a > 0) & ((n_a > n_b) == swapped))
        if not len(mine):
            continue
        a, b = (np.array([i for m in mine for i in coded[m][k]], np.int64) for k in (0, 1))
        text_a, text_b = np.repeat(np.arange(len(mine)), n_a[mine]), np.repeat(np.arange(len(mine)), n_b[mine])
        at_a, at_b = (np.concatenate(([0], np.cumsum(n[mine]))) for n in (n_a, n_b))
        # Offsets run on from text to text, so a text's last end is common to both lists.
        ends_a, ends_b = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        if swapped:
            places, common, low, count = align(ends_b, ends_a, at_a[text_b])
        else:
            places, common, low, count = align(ends_a, ends_b, at_b[text_a])
        driver = np.repeat(np.arange(len(places)), count)
        other = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        link_a, link_b = (other, driver) if swapped else (driver, other)
        last, far = np.flatnonzero(common), places[common]
        last_a, last_b = (far, last) if swapped else (last, far)
        out["n_links"][mine] = np.bincount(text_a[link_a], minlength=len(mine))
        out["n_groups"][mine] = np.bincount(text_a[last_a], minlength=len(mine))
        _write_groups(pair, out["groups_sha256"], mine, a, b, last_a, last_b, at_a + at_b)
        code = text_a[link_a] << 32 | a[link_a] * len(pair.b_bytes) + b[link_b]
        code, held = np.unique(code, return_counts=True)
        cuts = np.searchsorted(code >> 32, np.arange(len(mine) + 1))
        for k, m in enumerate(mine):
            span = slice(cuts[k], cuts[k + 1])
            out["pairs"][m] = pack(code[span] & 0xFFFFFFFF, held[span])
    return pd.DataFrame(out)


def _write_groups(pair: Pair, digests: list[str], mine: np.ndarray, a: np.ndarray, b: np.ndarray,
                  last_a: np.ndarray, last_b: np.ndarray, at: np.ndarray) -> None:
    """Digest the ids of each text, group by group: those of A, then those of B."""
    ends_here_a, ends_here_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ends_here_a[last_a], ends_here_b[last_b] = 1, 1
    group_a, group_b = np.cumsum(ends_here_a) - ends_here_a, np.cumsum(ends_here_b) - ends_here_b
    # Before an id of A stand the ids of B of earlier groups; before an id of B those of A up to its own.
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.concatenate(([0], last_b + 1))[group_a]] = a + ends_here_a * pair.width
    order[np.arange(len(b)) + (last_a + 1)[group_b]] = b + ends_here_b * 2 * pair.width
    shown = list(map(pair.decimals.__getitem__, order.tolist()))
    for k, m in enumerate(mine):
        digests[m] = hashlib.sha256(b"".join(shown[at[k]:at[k + 1]])[:-1]).hexdigest()


def pack(codes: np.ndarray, held: np.ndarray) -> bytes:
    """Sorted codes as differences and how often each is held, byte plane by byte plane (which compresses well)."""
    both = np.stack((np.diff(codes, prepend=0), held)).astype("<u4")
    return np.ascontiguousarray(both.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1)).tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(packed, np.uint8).reshape(2, 4, -1).transpose(0, 2, 1)
    both = np.ascontiguousarray(planes).view("<u4")[..., 0].astype(np.int64)
    return np.cumsum(both[0]), both[1]


def _unpack_all(packed: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, held) of all pairs."""
    rows = [unpack(p) for p in packed]
    codes, held = (np.concatenate([r[k] for r in rows]) if rows else np.empty(0, np.int64) for k in (0, 1))
    return np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows]), codes, held


def aligned(docs: DataFrame, tokenizers: tuple[bytes, bytes]) -> DataFrame:
    """(row, id, text) to (row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs)."""
    files = docs.sparkSession.sparkContext.broadcast(tokenizers)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = _pair(*files.value)
        for pdf in parts:
            texts = pdf["text"].tolist()
            for a, b in batches(texts, CHARACTERS):
                out = _batch(pair, texts[a:b])
                yield pd.concat([pdf[["row", "id"]].iloc[a:b].reset_index(drop=True), out], axis=1)
    return docs.mapInPandas(run, "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, docs, best): how many documents hold each linked pair, and whether no pair of its A id is held by more."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            codes, docs = np.unique(_unpack_all(pdf["pairs"])[1], return_counts=True)
            yield pd.DataFrame({"pair": codes, "docs": docs})
    counts = rows.select("pairs").where("length(pairs) > 0").mapInPandas(run, "pair long, docs long")
    counts = counts.groupBy("pair").agg(F.sum("docs").alias("docs"))
    with staged(counts, "counts") as counts:
        a = F.floor(F.col("pair") / size_b)
        # At most one row for each id of A.
        most = F.broadcast(counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most")))
        marked = counts.withColumn("a", a).join(most, "a")
        return materialize(marked.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-counts")


def _head(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The pairs of at least some power of two documents, as many as ``most`` allows: (codes, docs * 2 + best, that power)."""
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    sizes = sorted(((r["power"], r["count"]) for r in counts.groupBy(power).count().collect()), reverse=True)
    total, least = 0, 64
    for p, n in sizes:
        if total + n > most:
            break
        total, least = total + n, p

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            value = pdf["docs"].to_numpy() * 2 + pdf["best"].to_numpy().astype(np.int64)
            yield pd.DataFrame({"codes": [pdf["pair"].to_numpy().astype("<u4").tobytes()], "values": [value.astype("<i8").tobytes()]})
    # 12 bytes a pair, so a bounded number of bytes.
    rows = counts.where(F.col("docs") >= F.lit(2.0**least)).mapInPandas(run, "codes binary, values binary").collect()
    codes = np.frombuffer(b"".join(r["codes"] for r in rows), "<u4")
    order = np.argsort(codes)
    complete = total == sum(n for _, n in sizes)
    return codes[order], np.frombuffer(b"".join(r["values"] for r in rows), "<i8")[order], complete


def align_tokens(docs: DataFrame, tokenizers: tuple[bytes, bytes], id_col: str = "doc_id", text_col: str = "text",
                 head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """One row per row: the id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size_b = sentencepiece.SentencePieceProcessor(model_proto=tokenizers[1]).get_piece_size()
    keep = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    with staged(aligned(docs, tokenizers), "aligned", compression="zstd") as rows:
        counts = pair_counts(rows, size_b)
        codes, values, complete = _head(counts, head_pairs)
        head = docs.sparkSession.sparkContext.broadcast((codes, values))

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            codes, values = head.value
            for pdf in parts:
                pairs = pdf.pop("pairs")
                row, code, held = _unpack_all(pairs)
                at = np.minimum(np.searchsorted(codes, code), max(0, len(codes) - 1))
                known = codes[at] == code if len(codes) else np.zeros(len(code), bool)
                value = np.where(known, values[at], 0) if len(codes) else np.zeros(len(code), np.int64)
                best, total = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
                np.add.at(best, row, held * (value & 1))
                np.add.at(total, row, held * (value >> 1))
                cuts = np.searchsorted(row[~known], np.arange(len(pdf) + 1))
                code, held = code[~known], held[~known]
                rest = [pack(code[i:j], held[i:j]) if j > i else b"" for i, j in zip(cuts, cuts[1:])]
                yield pdf.assign(n_best=best, count_sum=total, rest=rest)
        known = rows.select(*keep, "pairs").mapInPandas(
            run, "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest binary")
        names = [F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
        if complete:
            return materialize(known.select(*names), "alignment")
        with staged(known, "known") as known:
            tail = _tail(known.where("length(rest) > 0").select("row", "rest")).join(counts, "pair").groupBy("row").agg(
                F.sum(F.when(F.col("best"), F.col("held")).otherwise(0)).alias("more_best"), F.sum(F.col("held") * F.col("docs")).alias("more"))
            done = known.drop("rest").join(tail, "row", "left")
            for column, more in (("n_best", "more_best"), ("count_sum", "more")):
                done = done.withColumn(column, F.col(column) + F.coalesce(more, F.lit(0)))
            return materialize(done.select(*names), "alignment")


def _tail(rows: DataFrame) -> DataFrame:
    """(row, rest) to (row, pair, held)."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for a in range(0, len(pdf), 256):
                row, code, held = _unpack_all(pdf["rest"].iloc[a:a + 256])
                yield pd.DataFrame({"row": pdf["row"].to_numpy()[a:a + 256][row], "pair": code, "held": held})
    return rows.mapInPandas(run, "row long, pair long, held long")


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align_tokens(table(spark, sf_dir, "documents"), read_tokenizers())
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
