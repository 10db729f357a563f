"""The two classifiers: feature maps against plain Python, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseledger.llm import language, toxicity

ODD = [(1, None, "en"), (2, "", "fr"), (3, "12 34 !!", "en"), (None, "hello there", "en"), (5, "x" * 300_000, None),
       (6, "hello there", "en"), (6, "hello there", "en")]


def test_presence_is_the_set_of_ngrams():
    texts = ["Ab c", "ab  C", "", "é1é"]
    rows = language.presence(texts)
    assert (rows[0] == rows[1]).all() and not rows[2].any()
    # a, b, c, "ab", "b ", " c", "c ", "ab ", "b c", " c ", "ab c", "b c " at most
    assert rows[0].sum() <= 12 and rows[3].any()
    k = language.kernel(rows[[0, 3]], rows[[1, 3]])
    assert k[0, 0] == pytest.approx(1.0, rel=1e-5) and k[1, 1] == pytest.approx(1.0, rel=1e-5)


def test_folded_scores_equal_kernel_scores():
    rng = np.random.default_rng(1)
    marks, rows = rng.random((5, language.CELLS)) < 0.01, rng.random((4, language.CELLS)) < 0.01
    weights = rng.normal(size=(5, 3))
    folded = (marks / np.sqrt(marks.sum(1))[:, None]).T @ weights
    direct = language.kernel(rows, marks) @ weights
    assert np.allclose((rows @ folded) / np.sqrt(rows.sum(1))[:, None], direct, atol=1e-4)


def test_language_held_out(spark):
    from caseledger.llm.queries import QUERIES
    out = QUERIES["op10_string_kernel_language"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "2 AS lang_pred")
    model = language.fit(language.learned_from(docs), "text", "lang")
    rows = language.classify(docs, model, "text", "found").collect()
    assert [r["found"]["lang_pred"] for r in rows][:3] == ["und"] * 3 and len(rows) == len(ODD)
    assert language.fit(docs.where("false"), "text", "lang") is None
    assert {r["found"]["lang_pred"] for r in language.classify(docs, None, "text", "found").collect()} == {"und"}


def spoken(rng, letters, n=30):
    return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(n))


def held(spark, docs, model, want):
    rows = language.classify(spark.createDataFrame(docs, "text string, lang string"), model, "text", "found").collect()
    return sum(r["found"]["lang_pred"] == r["lang"] for r in rows) / len(rows) >= want


def test_language_of_copies_is_learned(spark):
    rng = np.random.default_rng(7)
    es, en = [(spoken(rng, "abcdefgh"), "es") for _ in range(40)], [(spoken(rng, "efghijkl"), "en") for _ in range(300)]
    docs = spark.createDataFrame(es + en, "text string, lang string")
    # One text of "es" has 20,000 copies: whatever its hash is, all 40 texts are learned from.
    copies = docs.where("lang = 'es'").limit(1).crossJoin(spark.range(20_000)).select("text", "lang")
    plain, model = (language.fit(x, "text", "lang") for x in (docs, docs.union(copies)))
    assert plain[0] == model[0] == ["en", "es"] and np.array_equal(plain[1], model[1])
    new = [(spoken(rng, "abcdefgh"), "es") for _ in range(30)] + [(spoken(rng, "efghijkl"), "en") for _ in range(30)]
    assert held(spark, new, model, 0.95)
    # Too small a share is no bar: each language has as many texts as it can have.
    only = language.fit(copies, "text", "lang")
    assert only[0] == ["es"] and held(spark, es, only, 1.0)


def test_pipeline_stage_keeps_letters_when_no_language_is_learned(spark):
    texts = ["hello there", "12 34 !!", None, "", "\u4f60\u597d", "5 x", "hello there"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang", "'web' AS source", "length(text) AS n_chars")
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    apart = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    # No labels at all; labels on rows that are not learned from only; a language called "und".
    for rows in (none, docs.where("doc_id = 0").withColumn("doc_id", F.lit(apart).cast("long")).union(none.where("doc_id > 0")), docs.withColumn("lang", F.lit("und"))):
        got = [r["text"] for r in corpus_pipeline.keep_known_languages(spark, rows, "").collect()]
        assert sorted(got) == sorted([texts[0], texts[4], texts[5], texts[6]])


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(8)
    letters = {f"l{k:02}": "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8, replace=False)) for k in range(12)}
    docs = [(spoken(rng, own), name) for name, own in letters.items() for _ in range(40)]
    model = language.fit(spark.createDataFrame(docs, "text string, lang string"), "text", "lang", per_language=40, landmarks=8, most_languages=4)
    assert model[0] == sorted(letters) and held(spark, [(spoken(rng, own), name) for name, own in letters.items() for _ in range(5)], model, 0.9)


def test_features_match_plain_hashing():
    cells, owner = toxicity.features(["a B a", "", None, "b"])
    sets = [set(cells[owner == i]) for i in range(4)]
    assert len(cells[owner == 0]) == 3 + 2 + 1 + 1 and not sets[1] and not sets[2]
    assert sets[3] < sets[0]  # the word alone is a feature of both


def test_toxicity_catches_planted_words(spark):
    bad = ["vile", "rotten"]
    def text(i, toxic):
        words = [f"w{(i * 7 + k * k) % 97}" for k in range(40)]
        return " ".join(words[:20] + (bad if toxic else []) + words[20:])
    docs = spark.createDataFrame([(i, text(i, i % 4 == 0)) for i in range(800)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 800)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where("doc_id < 500"), "doc_id", "text", "toxic")
    rows = toxicity.score(docs.where("doc_id >= 500"), model, "text").collect()
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in rows)
    assert len(model[0]) < 2000  # sparse


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, None), (None, 1), (6, 1), (6, 0), (99, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, labels, "doc_id", "text", "toxic"), "text").collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    for none in (labels.where("false"), labels.where("toxic = 1")):
        model = toxicity.train(docs, none, "doc_id", "text", "toxic")
        assert len({r["score"] for r in toxicity.score(docs, model, "text").collect()}) == 1
    assert toxicity.score(docs.where("false"), model, "text").count() == 0


def test_training_does_not_depend_on_how_files_are_split(spark):
    """The sample in many small splits gives the weights that whole files give."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k * k) % 97}" for k in range(60)) + (" vile" if i % 4 == 0 else "")) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, toxic int")
    models = []
    for size in ("128m", "4k"):
        before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            models.append(toxicity.train(docs, labels, "doc_id", "text", "toxic", rounds=2))
        finally:
            for c, v in before.items():
                spark.conf.set(c, v)
    assert np.array_equal(models[0][0], models[1][0]) and np.allclose(models[0][1], models[1][1]) and models[0][2] == pytest.approx(models[1][2])


def test_one_id_with_very_many_texts_stays_bounded(spark):
    docs = spark.createDataFrame([(1 if i < 300 else i, f"text {i} of words") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in [1, *range(300, 400)]], "doc_id long, toxic int")
    few = docs.where("doc_id <> 1").union(docs.where("doc_id = 1").orderBy(F.xxhash64("text")).limit(4))
    all_, some = (toxicity.train(d, labels, "doc_id", "text", "toxic", rounds=1, texts_per_id=4) for d in (docs, few))
    assert np.array_equal(all_[0], some[0]) and np.allclose(all_[1], some[1])
