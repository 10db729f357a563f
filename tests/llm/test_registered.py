"""The registered queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest

import check
import corpus_pipeline
from caseledger.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert check.compare(spark, check.connect(SF), SF, name) == ""


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, SF).cache()
        if k < 4:
            assert docs.columns == columns, name
        if k == 0:
            assert docs.count() == before.count()  # every document has letters
        elif k == 1:
            con = duckdb.connect()
            con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
            # The stage takes a likeness of 0.8, op4's contract one of 0.85; the SQL is the same otherwise.
            assert ORACLES["op4_fast_similarity_sketch"].count(">= 85 *") == 1
            at_80 = ORACLES["op4_fast_similarity_sketch"].replace(">= 85 *", ">= 80 *")
            kept = {r[0] for r in con.sql(f"SELECT doc_id FROM ({at_80}) q WHERE kept").fetchall()}
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} == kept and docs.count() == len(kept)
        elif k == 2:
            assert docs.count() == before.count() and docs.where("text RLIKE '@mail[0-9]' AND text RLIKE '[0-9]@mail'").count() == 0
            assert docs.where("n_chars <> length(text)").count() == 0
        elif k == 3:
            assert docs.groupBy("doc_id").count().where("count > 3").count() == 0
        else:
            words = before.selectExpr("sum(size(filter(split(text, '[ \\\\t-\\\\r]+'), w -> w <> '')))").first()[0]
            assert docs.selectExpr("sum(n_words)").first()[0] == words


def test_pipeline_key_comes_from_the_settings(spark):
    docs = spark.createDataFrame([(1, "mail ann@example.org or 10.1.2.3", "en", "web", 32)], "doc_id long, text string, lang string, source string, n_chars long")
    with pytest.warns(UserWarning, match="pseudonymKey"):
        public = corpus_pipeline.hide_personal_data(spark, docs, SF).first()["text"]
    spark.conf.set(corpus_pipeline.KEY_SETTING, "a key of one's own")
    try:
        own = corpus_pipeline.hide_personal_data(spark, docs, SF).first()["text"]
    finally:
        spark.conf.unset(corpus_pipeline.KEY_SETTING)
    assert own != public and "ann" not in own


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
