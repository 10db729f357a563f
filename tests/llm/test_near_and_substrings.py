"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np

from caseledger.llm import near, substrings
from caseledger.llm.words import hash_words

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_components(rows, percent=85):
    sets = []
    for _, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def family(rng, size, words, edits):
    """A chain of edits, so that neighbours are alike and ends are not."""
    text, out = [f"w{rng.randrange(5000)}" for _ in range(words)], []
    for _ in range(size):
        out.append(" ".join(text))
        text = list(text)
        for _ in range(edits):
            text[rng.randrange(words)] = f"v{rng.randrange(5000)}"
    return out


def test_components_match_brute_force(spark):
    rng = random.Random(4)
    texts = family(rng, 60, 120, 1) + family(rng, 12, 60, 2) + family(rng, 30, 30, 1)
    texts += ["", None, " \t\n", "one two", "ONE two", "one  two ", "É a b c d", "é a b c d"] + [texts[0]] * 20
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows += [rows[0], (None, texts[3]), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "'x' AS key", "2 AS bucket")
    got = [tuple(r) for r in near.near_components(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


def test_residual_components_are_compared(spark, monkeypatch):
    monkeypatch.setattr(near, "TILE", 8)
    rng = random.Random(9)
    rows = list(enumerate(family(rng, 150, 80, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in near.near_components(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got) == sorted(brute_components(rows))


def test_families_of_either_size_give_equal_links(spark, monkeypatch):
    """Above FAMILY a family is compared bucket by bucket, below it in full; recall of the links is printed."""
    rng = random.Random(12)
    rows = list(enumerate(family(rng, 120, 90, 1) + family(rng, 40, 40, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute_components(rows))
    for size in (near.FAMILY, 20):
        monkeypatch.setattr(near, "FAMILY", size)
        got = sorted(tuple(r) for r in near.near_components(docs).select("doc_id", "n_shingles", "component_id").collect())
        print(f"families up to {size}: {sum(a == b for a, b in zip(got, want)) / len(want):.3f} of the components are right")
        assert got == want


def test_near_copies_under_one_id_and_none(spark):
    """Two thousand near copies that share an id, and as many without one, are one class each and link as texts do."""
    rng = random.Random(13)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    for one_id in (7, None):
        rows = [(one_id, " ".join(base[:k % 200] + [f"v{k}"] + base[k % 200 + 1:])) for k in range(2_000)] + [(one_id, "quite another text of six words")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        out = near.near_components(docs).select("n_shingles", "component_id", "component_key").collect()
        assert len(out) == len(rows) and len({r["component_key"] for r in out}) == 2 and {r["component_id"] for r in out} == {one_id}
        kept = near.deduplicate(docs).collect()
        assert len(kept) == 2


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate((a[:340], rng.integers(0, 2**63, 60, dtype=np.uint64)))
    with np.errstate(over="ignore"):
        rows = near.sketch(np.concatenate((a, b, a[:1])), np.array([0, 400, 800, 801]))
    assert (rows != near._EMPTY).all() and abs((rows[0] == rows[1]).mean() - 340 / 460) < 0.2


def test_deduplicate_keeps_one_of_each_group(spark):
    rows = [(3, "a b c d e f", "p"), (1, "a b c d e f", "q"), (1, "a b c d e f", "q"), (2, None, "r"), (2, None, "r"), (4, "", None), (5, "other text", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in near.deduplicate(docs).collect()]
    assert sorted(got, key=key) == sorted([rows[1], rows[3], rows[4], rows[5], rows[6]], key=key)
    assert near.deduplicate(docs.where("false")).count() == 0


def test_deduplicate_keeps_distinct_texts_of_null_and_equal_ids(spark):
    rows = [(None, "one two three four five six"), (None, "quite another text without an id"), (None, "quite another text without an id"), (7, "some words under seven here"),
            (7, "different words under the same id"), (7, "different words under the same id"), (8, "some words under seven here"), (None, "some words under seven here"), (9, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in near.deduplicate(docs).collect()]
    assert sorted(got, key=key) == sorted([rows[0], rows[1], rows[3], rows[4], rows[8]], key=key)


def brute_removal(rows, window=substrings.WINDOW):
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[k:k + window])
                least[g] = min(i, least.get(g, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {k + j for k in range(len(w) - window + 1) if i is not None and least[tuple(w[k:k + window])] < i for j in range(window)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def passages(rng):
    common = [f"p{rng.randrange(50)}" for _ in range(60)]
    rows = []
    for i in range(60):
        w = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 80))]
        if i % 3:
            a = rng.randrange(45)
            at = rng.randrange(len(w) + 1)
            w[at:at] = common[a:a + rng.randrange(5, 60)]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(70, "x " * 200), (71, "x " * 100), (72, None), (73, ""), (None, rows[1][1]), (5, rows[7][1]), rows[4], (74, "É b " * 30), (75, "É b " * 30)]
    return rows


def test_removal_matches_brute_force(spark, monkeypatch):
    rows = passages(random.Random(2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS m", "2 AS seg", "3 AS words")
    for hot, shard in ((substrings.HOT, substrings.SHARD_WORDS), (3, 300)):
        monkeypatch.setattr(substrings, "HOT", hot)
        monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
        got = [(r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in substrings.remove_repeats(docs).collect()]
        assert sorted(got, key=key) == sorted(brute_removal(rows), key=key)
    assert substrings.remove_repeats(docs.where("false")).count() == 0


def test_removal_of_rows_of_one_id(spark):
    """Very many rows of one id, and of none: each loses its own words, and none to another of them."""
    rng = random.Random(6)
    common = [f"p{rng.randrange(50)}" for _ in range(40)]
    rows = [(3, " ".join(common))]
    for k in range(1_500):
        w = [f"w{rng.randrange(300)}" for _ in range(30)]
        w[k % 25:k % 25] = common[:13 + k % 28]
        rows.append((7 if k % 4 else None, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in substrings.remove_repeats(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_removal(rows), key=key)


def test_wavelet_rank_and_fm_search():
    rng = np.random.default_rng(5)
    s = rng.integers(0, 37, 1000)
    tree = substrings.WaveletMatrix(s, 37)
    c, a, b = rng.integers(0, 37, 200), rng.integers(0, 1001, 200), rng.integers(0, 1001, 200)
    x, y = tree.rank(c, a, b)
    assert all(x[i] == (s[:a[i]] == c[i]).sum() and y[i] == (s[:b[i]] == c[i]).sum() for i in range(200))
    words = rng.integers(1, 4, 300)
    offsets = np.arange(0, 301, 20)
    index = substrings.FmIndex(words, offsets, np.arange(15)[::-1].copy(), 4)
    starts = np.array([20 * k + j for k in range(15) for j in range(16)])
    want = [min(14 - k for k in range(15) if any((words[20 * k + j:20 * k + j + 5] == words[p:p + 5]).all() for j in range(16))) for p in starts]
    assert index.least(words, starts, 5).tolist() == want


def test_word_hashes_follow_the_words():
    h, at = hash_words(["a b c  a", None, "A", ""], lower=True)
    assert at.tolist() == [0, 3, 3, 4, 4] and h[0] == h[2] == h[3] and h[1] != h[0]


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 301), (301, 300)]
    random.Random(1).shuffle(edges)
    got = {r["v"]: r["root"] for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 150)}, **{i: 200 for i in range(201, 207)}, 301: 300}
    assert got == want
    assert near.components(spark.createDataFrame([], "a long, b long")).count() == 0
