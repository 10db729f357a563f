"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last
returns the pieces of the packed sequences. Columns that ``documents`` has beside its own are
dropped at the first stage. An empty table passes through every stage.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm import language, mixing, near, packing, pseudonyms
from caseledger.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR_PERCENT, TEXTS_AT_ONCE = 80, 1000
KEY_SETTING = "spark.caseledger.pseudonymKey"


def _few_texts_at_once(spark: SparkSession) -> None:
    """Python workers get a thousand rows at a time from here on: rows are whole texts, and of ten thousand of
    them (Spark's default) a worker would hold some hundred megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_AT_ONCE)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without a letter go. Where no language can be learned, only they go."""
    _few_texts_at_once(spark)
    docs = docs.select(*COLUMNS)
    model = language.fit(language.learned_from(docs), "text", "lang")
    if model is None:
        return docs.where(language.has_letter("text"))
    # The score is 0 without a letter and above 0 with one, whatever the languages are called.
    return language.classify(docs, model, "text", "__language").where(F.col("__language.score") > 0).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a likeness of 0.8 or more."""
    _few_texts_at_once(spark)
    return near.deduplicate(docs, percent=NEAR_PERCENT).select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data under pseudonyms; n_chars follows the text.

    The key is the session's setting ``spark.caseledger.pseudonymKey``. Without it the key is the
    public one of the examples, with which anyone can undo the pseudonyms; a warning says so.
    """
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: the pseudonyms are made with the public key of the examples", stacklevel=2)
        key = pseudonyms.DEMO_KEY
    return pseudonyms.pseudonymize(docs, key, n_chars_col="n_chars").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).where("mix_copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of permitted lengths."""
    return packing.pack(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near duplicates", drop_near_duplicates),
    ("personal data", hide_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The classifier cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
