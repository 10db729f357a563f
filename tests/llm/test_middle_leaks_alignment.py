"""Fill-in-middle, decontamination and alignment against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from caseledger.llm import alignment, decontamination, middle


def plain(df, *columns):
    return sorted(map(str, map(tuple, df.select(*columns or "*").collect())))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill in the middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD_TEXTS = [None, "", " ", "a", " a", "a ", "a b\tc\n\nd  ", " x  y", "<P> is a mark", "a <M>", "<S", "<P<", "x <P y> <S z> <M w>", "\U0001F600 b $1 \\2 c", "word " * 300]


def brute_middle(i, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted(x % (n + 1) for x in h[:2])
    pre, mid, suf = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return i, n, form, len(pre), len(mid), sha(out), sha(text)


def test_middle_on_odd_texts(spark):
    rows = [(i, t) for t in ODD_TEXTS for i in (None, -7, *range(12))] + [(3, "a b c d")] * 2
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, output string, n int")
    got = middle.restore(middle.to_middle(df))
    assert plain(got, "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256),
                 F.sha2(F.col("restored").cast("binary"), 256)) == sorted(str(brute_middle(*r)) for r in rows)
    assert {r["form"] for r in got.collect()} == {"plain", "psm", "spm"}
    assert middle.to_middle(df.where("false")).count() == 0


def test_middle_of_a_very_long_text(spark):
    """A million tokens: counted possessive groups do not deepen the stack."""
    df = spark.range(8).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab \n"), 1_000_000).alias("text"))
    rows = middle.restore(middle.to_middle(df)).where("form <> 'plain'").select("n", (F.col("restored") == F.repeat(F.lit("ab \n"), 1_000_000)).alias("same")).collect()
    assert rows and all(r["n"] == 1_000_001 and r["same"] for r in rows)


# --- decontamination

def low_words(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def brute_hits(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        ws = low_words(text)
        n = min(len(ws), 10)
        for i in range(len(ws) - n + 1 if ws else 0):
            windows[tuple(ws[i:i + n])].add(item)
    out = []
    for i, text in docs:
        ws, hit, found = low_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(ws) - n + 1):
                if tuple(ws[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(ws[k:k + n])]
        out.append(str((i, len(ws), len(hit), sorted(str(x) for x in found if x is not None))))
    return sorted(out)


ITEMS = [(1, " ".join(f"w{k}" for k in range(25))), (2, "one two THREE four"), (3, "solo"), (4, ""), (None, "no id has this item of quite some words here in it"),
         (5, None), (12, " ".join(f"w{k}" for k in range(5, 18))), (1, "again under one id"), (6, "Été d'hiver"), (7, "a a a a a a a a a a a a"), (8, "?!")]


def test_hits_equal_brute_force(spark):
    rng = random.Random(5)
    pool = [low_words(t) for _, t in ITEMS if t]
    docs = [(None, "solo"), (None, None), (3, ""), (3, "..."), (4, "SOLO, w0 w1"), (4, "été d hiver"), (4, "ÉTé D hiver"), (5, "a " * 9), (5, "a " * 30), (6, "Kelvin solo")]
    for k in range(200):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            ws = rng.choice(pool)
            a = rng.randrange(len(ws) + 1)
            parts += ws[a:a + rng.randrange(1, 20)] if rng.random() < 0.7 else [rng.choice(("w3", "the", "a", "w9", "four")) for _ in range(rng.randrange(5))]
        docs.append((k % 40, rng.choice((" ", ", ", "\n")).join(parts)))
    docs += docs[20:30]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id long, text string, items string, pos int").repartition(3)
    marks = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, hash int")
    got = decontamination.find_contamination(df, marks)
    assert plain(got, "doc_id", "n_words", "n_hit", "items") == brute_hits(docs, ITEMS)


def test_hits_of_nothing(spark):
    docs = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert plain(decontamination.find_contamination(docs, marks.where("false"))) == ["(1, 5, 0, [])"]
    assert plain(decontamination.find_contamination(docs, marks)) == ["(1, 5, 2, ['1'])"]
    assert decontamination.find_contamination(docs.where("false"), marks).count() == 0


# --- alignment

@pytest.fixture(scope="module")
def tools():
    a = tokenizers.Tokenizer.from_file(f"{alignment.TOKENIZERS}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/piece_bpe_32k.model")


def brute_alignment(rows, tools):
    pair = alignment.Pair(*alignment.read_tokenizers())
    coded, links, groups = [], [], []
    for _, text in rows:
        a, b = (tools[0].encode(" " + text, add_special_tokens=False).ids, tools[1].encode(text)) if text else ([], [])
        wa, wb = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
        if text and not b"".join(wa) == b"".join(wb) == (" " + text).encode():
            a, b, wa, wb = [], [], [], []
        # Bytes and the tokens they belong to.
        at_a, at_b = ([k for k, w in enumerate(ws) for _ in w] for ws in (wa, wb))
        spans = sorted(set(zip(at_a, at_b)))
        coded.append((a, b))
        links.append([(a[x], b[y]) for x, y in spans])
        parts, x, y = [], 0, 0
        for k in range(1, len(at_a) + 1):
            if k == len(at_a) or at_a[k] != at_a[k - 1] and at_b[k] != at_b[k - 1]:
                parts.append(",".join(map(str, a[x:at_a[k - 1] + 1])) + "|" + ",".join(map(str, b[y:at_b[k - 1] + 1])))
                x, y = at_a[k - 1] + 1, at_b[k - 1] + 1
        groups.append(parts)
    held = Counter(p for found in links for p in set(found))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return sorted(str((i, len(a), len(b), len(g), len(found), sum(held[p] == most[p[0]] for p in found), sum(held[p] for p in found),
                       sha(";".join(g)) if a else "")) for (i, _), (a, b), g, found in zip(rows, coded, groups, links))


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("head_pairs", [1 << 20, 700, 0])
def test_alignment_equals_brute_force(spark, tools, head_pairs):
    """All pairs broadcast, some, and none."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 5 = 0").collect()]
    rows += [(None, None), (None, "a"), (5, "a"), (5, "a"), (7, ""), (8, " "), (9, "  x\n\ny "), (10, "<|endoftext|> <s> hi </s>"), (11, "▁ под"),
             (12, "日本語 \U0001F600 \x00 \x07"), (13, "x" * 5000), (14, "é ﬁ it's we'll  12345 ...")]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, pairs string, row int").repartition(3)
    got = alignment.align_tokens(df, alignment.read_tokenizers(), head_pairs=head_pairs)
    assert plain(got, *COLUMNS) == brute_alignment(rows, tools)


def test_alignment_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert plain(alignment.align_tokens(df, alignment.read_tokenizers()), *COLUMNS) == ["(1, 0, 0, 0, 0, 0, 0, '')"]
    assert alignment.align_tokens(df.where("false"), alignment.read_tokenizers()).count() == 0


def test_gallop_finds_the_first_end():
    import numpy as np
    rng = np.random.default_rng(3)
    for _ in range(30):
        ends = np.unique(rng.integers(0, 10_000, rng.integers(1, 400)))
        values = np.unique(rng.integers(0, ends[-1] + 1, 50))
        want = np.searchsorted(ends, values)
        assert (alignment.gallop(values, ends, np.zeros(len(values), np.int64)) == want).all()
        assert (alignment.gallop(values, ends, np.maximum(want - rng.integers(0, 9, len(want)), 0)) == want).all()


def test_packed_pairs_come_back():
    import numpy as np
    codes, held = np.array([0, 7, 50_256 * 32_000 + 31_999]), np.array([1, 300, 70_000])
    assert all((x == y).all() for x, y in zip(alignment.unpack(alignment.pack(codes, held)), (codes, held)))
    assert not len(alignment.unpack(alignment.pack(codes[:0], held[:0]))[0])
