"""Files of many packets and cases from several sources: what is stored, exchanged and parsed, and how often."""

import gzip
import os
import pathlib

from conftest import rows
from pyspark.sql import functions as F

from caseledger.functions.packets import BLANK
from caseledger.plans import bronze
from caseledger.schemas import PACKET_DATA
from caseledger.sources.readers import scan_quarantine
from caseledger.sources.tables import write_quarantine
from workloads import composites
from workloads import parsing as P

SF = "/root/testdata/sf0.001"
PACKET = ("<packet><metadata><ma_goi_tin>{0}</ma_goi_tin><su_kien>INSERT</su_kien><id_ban_ghi>R{0}</id_ban_ghi>"
          "</metadata><du_lieu><name>n{0}</name></du_lieu></packet>")


def _raw(spark, *texts):
    files = spark.createDataFrame([(text, f"f{n}") for n, text in enumerate(texts)], "value string, file_name string")
    return files.withColumn("ingested_at", F.lit(P.INGESTED).cast("timestamp"))


def test_a_staged_row_holds_one_packet(spark):
    """rows of whole files made a scan hold the packets of thousands of files at once."""
    raw = _raw(spark, "<packets>" + "".join(PACKET.format(n) for n in range(7)) + "</packets>", "<a/>", None)
    for layout in (PACKET_DATA, None):
        with bronze.validated_files(raw, layout) as (accepted, rejected):
            stored = spark.read.parquet(*accepted.inputFiles())
            assert stored.where("packet IS NOT NULL").count() == 7 and "array" not in stored.schema.simpleString()
            assert rows(accepted, "id_ban_ghi", "file_name") == [(f"R{n}", "f0") for n in range(7)]
            assert rows(rejected, "file_name", "raw_content") == [("f1", "<a/>"), ("f2", None)]


def test_orders_are_exchanged_and_not_their_texts(spark):
    """F16, F17: the texts of all packets went through the exchange that groups them into files."""
    files = P.files_of_packets(spark, SF)
    below = files._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "<packet>" not in below
    whole = P.packets_of_orders(spark, SF).groupBy(F.floor(F.col("o_orderkey") / P.PER_FILE).alias("no")).agg(
        F.array_join(F.sort_array(F.collect_list("packet")), "").alias("body"))
    parts = F.array_join(F.sort_array(F.expr("regexp_extract_all(body, '(?s)<packet>.*?</packet>', 0)")), "")
    assert rows(files.select("no", parts.alias("body"))) == rows(whole)


def test_the_landing_zone_is_compressed(spark, monkeypatch):
    """the texts of the landing zone were most of the bytes written."""
    seen = []
    scan = P.readers.scan_raw_documents
    monkeypatch.setattr(P.readers, "scan_raw_documents", lambda spark, path, pattern: seen.append((path, pattern)) or scan(spark, path, pattern))
    P.landing(spark, SF).collect()
    (zone, _), = seen
    written = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(zone) for f in files if f.startswith("part-"))
    texts = P.packets_of_orders(spark, SF).agg(F.sum(F.octet_length("packet"))).first()[0]
    assert written * 4 < texts


def test_packets_of_both_batches_are_parsed_once(spark, monkeypatch):
    """two unions and two appends parsed every packet four times."""
    parsed, made = spark.sparkContext.accumulator(0), P.bronze_packets

    @F.udf("string")
    def counted(value):
        parsed.add(1)
        return value

    monkeypatch.setattr(P, "bronze_packets", lambda spark, sf: made(spark, sf).withColumn("id_ban_ghi", counted("id_ban_ghi")))
    P.application_from_sources(spark, SF).collect()
    assert parsed.value == P.B.table(spark, SF, "orders").count()


def test_python_workers_take_a_bounded_number_of_bytes(spark):
    """files of an Arrow batch are bounded by bytes, too; the parser gives the columns of all of them."""
    texts = ["<packets>" + PACKET.format(n) * (n % 3) + "</packets>" for n in range(40)]
    accepted, rejected = bronze.validate_packets(_raw(spark, *texts))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 16 * 2 ** 20
    assert accepted.count() == sum(n % 3 for n in range(40)) and rejected.count() == 14
    assert accepted.where("data_payload = concat('{\"name\": \"n', ma_goi_tin, '\"}')").count() == accepted.count()


def test_changes_of_a_repeated_batch_are_taken_out_once(spark, monkeypatch):
    """batches that arrive twice were taken out of the payloads twice."""
    made, versions = [], P.silver.document_versions
    monkeypatch.setattr(P.silver, "document_versions", lambda packets, cdc: made.append(1) or versions(packets, cdc))
    living = P.B.table(spark, SF, "orders").where("o_orderkey % 9 <> 0 AND (o_orderkey % 4 <> 0 OR o_orderkey % 7 = 0)").count()
    assert P.document_tombstones(spark, SF).count() == living and len(made) == 3


def _landed(folder, *texts):
    """Compressed and plain files with odd names."""
    zone = pathlib.Path(folder, "raw", "ngày 1")
    zone.mkdir(parents=True)
    for n, text in enumerate(texts):
        data = text if isinstance(text, bytes) else text.encode()
        (zone / f"a+{n} é.xml{'.gz' if n % 2 else ''}").write_bytes(gzip.compress(data) if n % 2 else data)
    return str(zone.parent)


def test_texts_of_rejected_files_are_read_again_and_not_staged(spark, name, folder, monkeypatch):
    """large rejected files stood in the staged rows, several in a batch of a scan."""
    bad = ["", "<a/>", " \u2003\n", "<packet>", "<html>Đơn\r\nx\n\n</p>", b"<x>\xe9\xff</x>", "<packet><du_lieu/></packet>"]
    zone = _landed(folder, PACKET.format(1), *bad, "<p>" + PACKET.format(2) + PACKET.format(3) + "</p>")
    texts, stage = [], bronze.staged

    def seen(df, *args, **options):
        texts.append(df.where("value IS NOT NULL").count() if "value" in df.columns else "raw_content" in df.columns)
        return stage(df, *args, **options)

    monkeypatch.setattr(bronze, "staged", seen)
    monkeypatch.setattr(bronze, "REREAD_AT_ONCE", 2)
    table = name("application_xml")
    bronze.ingest_xml(spark, zone, table, f"{folder}/quarantine", "*.xml*")
    assert texts == [0, False]
    assert rows(spark.table(table), "ma_goi_tin") == [("1",), ("2",), ("3",)]
    raw = bronze.scan_raw_documents(spark, zone, "*.xml*")
    wanted = bronze.validate_packets(raw)[1]
    kept = scan_quarantine(spark, f"{folder}/quarantine")
    columns = "file_name", "raw_content", "error_reason"
    readable = ~F.col("raw_content").contains("<x>")  # JSON holds no invalid bytes
    assert rows(kept.where(readable), *columns) == rows(wanted.where(readable), *columns)
    assert kept.count() == len(bad)
    assert rows(kept, "file_name", "error_reason") == rows(wanted, "file_name", "error_reason")
    assert kept.where("ingested_at IS NULL").count() == 0 and kept.select("ingested_at").distinct().count() == 1


def test_large_files_are_read_by_few_tasks_at_a_time(spark, name, folder, monkeypatch):
    """all cores of an executor held large files at once, each in some ten copies."""
    many = "<p>" + "".join(PACKET.format(n) for n in range(90)) + "</p>"
    zone = _landed(folder, *["<a/>", PACKET.format("x")] * 2, *[many, "<b>"] * 3, *["<c>" + "z" * 9_000, "<d/>"] * 4)
    monkeypatch.setattr(bronze, "LARGE_BYTES", 2_000)
    chosen, of = [], bronze._of_files
    monkeypatch.setattr(bronze, "_of_files", lambda raw, names: chosen.append(list(names)) or of(raw, names))
    table = name("application_xml")
    bronze.ingest_xml(spark, zone, table, f"{folder}/quarantine", "*.xml*")
    large = [n for names in chosen for n in names if n.endswith(".xml") and os.path.getsize(pathlib.Path(zone, "ngày 1", os.path.basename(n).replace("%20", " "))) > 2_000]
    few = max(1, spark.sparkContext.defaultParallelism // 4)
    assert len(set(large)) == 7 and len(large) == 7 + 4  # the rejected ones twice
    assert all(len(names) <= few for names in chosen if set(names) & set(large))
    raw = bronze.scan_raw_documents(spark, zone, "*.xml*", sizes=True)
    assert raw.where("stored_bytes > 1000000").rdd.getNumPartitions() == 0  # other files are not read
    accepted, rejected = bronze.validate_packets(raw)
    assert rows(spark.table(table), "ma_goi_tin", "file_name") == rows(accepted, "ma_goi_tin", "file_name")
    kept = scan_quarantine(spark, f"{folder}/quarantine")
    assert rows(kept.drop("ingested_at")) == rows(rejected.drop("ingested_at")) and kept.count() == 13


def test_a_zone_without_rejected_files_has_an_empty_quarantine(spark, name, folder):
    zone = _landed(folder, PACKET.format(1))
    table = name("application_xml")
    bronze.ingest_xml(spark, zone, table, f"{folder}/quarantine")
    assert spark.table(table).count() == 1 and scan_quarantine(spark, f"{folder}/quarantine").count() == 0


def test_white_space_is_the_same_for_both_parsers(spark):
    """Java's Unicode white space, which Arrow's expressions do not know by that name."""
    signs = spark.range(1, 0xD800).select(F.col("id"), F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("value"))
    white = rows(signs.where(F.col("value").rlike(r"(?U)^\s*$")), "id")
    assert len(white) == 25 and rows(signs.where(F.col("value").rlike(BLANK)), "id") == white
    assert rows(bronze.parsed_without_text(signs).where("blank"), "id") == white


def test_a_rejected_file_of_over_twenty_million_characters_is_read_back(spark, folder):
    """the JSON reader made a row of nulls of it, so that it was missing from the result."""
    file = spark.range(1).repartition(1).select(
        F.lit("f").alias("file_name"), F.repeat(F.concat(F.lit("é<"), F.col("id")), F.lit(7_000_000)).alias("raw_content"),
        F.lit("r").alias("error_reason"), F.lit(P.INGESTED).cast("timestamp").alias("ingested_at"))
    write_quarantine(file, f"{folder}/quarantine")
    back = scan_quarantine(spark, f"{folder}/quarantine").select("error_reason", F.char_length("raw_content"))
    assert rows(back) == [("r", 21_000_000)]


def test_a_row_of_the_landing_zone_holds_one_page(spark, monkeypatch):
    """all pages of a file were gathered into one row, in memory."""
    pages, seen = P.B.table(spark, SF, "pages"), []
    plan = composites.pages_of_files(spark, SF)
    assert plan.count() == pages.count() and "collect_list" not in plan._jdf.queryExecution().toString()
    scan = bronze.scan_raw_documents
    monkeypatch.setattr(bronze, "scan_raw_documents", lambda *args, **options: seen.append(scan(*args, **options)) or seen[-1])
    composites.ingest_xml(spark, SF).collect()
    files = seen[0].where("value NOT LIKE '<packets>%'")
    assert files.count() == pages.select(F.col("page_id") % 50).distinct().count()
    assert files.agg(F.sum(F.octet_length("value"))).first()[0] == pages.agg(F.sum(F.octet_length("html") + 1)).first()[0]
