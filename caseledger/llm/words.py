"""Words as 64-bit hashes, computed for a batch of texts at once, and small shared helpers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space as the contracts define it, and its complement as a pattern.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
ODD = np.uint64(0x9E3779B97F4A7C15)

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def batches(texts: Sequence[str | None], most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text is not None else 0
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def hash_words(texts: Sequence[str | None], lower: bool, letters: np.ndarray | None = None):
    """Hashes of all words of ``texts`` in order, and where each text's words start (n + 1 offsets).

    ``letters`` marks the byte values that belong to words; without it words are the runs of
    bytes that are no ASCII white space. Null and empty texts have no words.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data] if letters is None else letters[data]
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    inside[ends - 1] = False
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate(([0], np.searchsorted(first, ends)))
    if not len(first):
        return np.empty(0, np.uint64), offsets
    length = last - first
    where = np.flatnonzero(inside)
    place = np.arange(len(where)) - np.repeat(np.cumsum(length) - length, length)
    value = _BYTE[data[where]] * _powers(int(length.max()))[place]
    return mix(np.add.reduceat(value, np.cumsum(length) - length) + length.astype(np.uint64) * ODD), offsets


def grams(words: np.ndarray, offsets: np.ndarray, n: int):
    """Hashes of all runs of ``n`` words within a text, and the offsets of each text's runs."""
    count = np.diff(offsets)
    if len(words) < n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    total = len(words) - n + 1
    out = np.zeros(total, np.uint64)
    for k in range(n):
        out = (out + words[k:k + total]) * ODD
        out ^= out >> np.uint64(29)
    runs = np.maximum(count - n + 1, 0)
    whole = np.repeat(offsets[:-1], runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    return mix(out[whole]), np.concatenate(([0], np.cumsum(runs)))


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """At most so many rows reach a Python worker at once, in the jobs that run inside the block.

    Rows that hold a text or a set are large, and a worker holds a batch several times over.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
