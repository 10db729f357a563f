"""Fill-in-middle transformation: texts cut into prefix, middle and suffix at token ends (built-in functions only).

A token is white space and the word after it, or white space at the text's end. ``regexp_count``
gives a text's number of tokens; hashes of the row's id choose the two cuts, the form and whether
the text stays plain. One pattern per row, in which a possessive group counts the prefix's tokens
and another the middle's, captures the three parts in a single match and puts them in order.
Possessive counted groups are matched in a loop, so the depth of the stack does not depend on the
text.

Texts that are empty, or that hold one of the marks already, stay plain; null texts count as
empty. A null id hashes as if its digits were the empty string. Equal ids get equal numbers, so
repeated rows get equal results; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.words import table

# The marks, and a token's pattern.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TOKEN = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80


def _number(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def to_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per row: the id, n (tokens), form (plain, psm or spm) and output."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = rows.select("__id", "text", F.regexp_count("text", F.lit(TOKEN)).cast("long").alias("n"), digest.alias("digest"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (_number(F.col("digest"), 2) % 100 >= fim_percent)
    form = F.when(plain, "plain").when(_number(F.col("digest"), 3) % 100 < spm_percent, "spm").otherwise("psm")
    x, y = (_number(F.col("digest"), k) % (F.col("n") + 1) for k in (0, 1))
    rows = rows.select("__id", "text", "n", form.alias("form"), F.least(x, y).alias("first"), F.greatest(x, y).alias("last"))
    count = (F.col("first").cast("string"), (F.col("last") - F.col("first")).cast("string"))
    unit = f"((?:{TOKEN}){{"
    pattern = F.concat(F.lit(r"(?s)\A" + unit), count[0], F.lit("}+)" + unit), count[1], F.lit(r"}+)(.*)\z"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return rows.select(F.col("__id").alias(id_col), "n", "form", output.alias("output"))


def parts(output: Column, form: Column) -> Column:
    """(prefix, middle, suffix) of an output; null for a plain one. The marks stand in no part, nor across its ends."""
    cut = F.split(output, "<[PSM]>", -1)
    spm = form == "spm"
    return F.when(form != "plain", F.struct(
        F.when(spm, F.get(cut, F.lit(2))).otherwise(F.get(cut, F.lit(1))).alias("prefix"), F.get(cut, F.lit(3)).alias("middle"),
        F.when(spm, F.get(cut, F.lit(1))).otherwise(F.get(cut, F.lit(2))).alias("suffix")))


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`to_middle` with prefix_chars, middle_chars and the restored text, made from output and form."""
    rows = rows.withColumn("__parts", parts(F.col("output"), F.col("form")))
    p = F.col("__parts")
    return rows.select("*", F.length(p["prefix"]).cast("long").alias("prefix_chars"), F.length(p["middle"]).cast("long").alias("middle_chars"),
                       F.when(p.isNull(), F.col("output")).otherwise(F.concat(p["prefix"], p["middle"], p["suffix"])).alias("restored")).drop("__parts")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = restore(to_middle(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS ts,
  sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT doc_id, text, ts, len(ts) AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
  ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {FIM_PERCENT} THEN 'plain'
   WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(ts[1:a], '') AS pre, array_to_string(ts[a + 1:b], '') AS mid, array_to_string(ts[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
 CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
  ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
