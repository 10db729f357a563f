"""The declared layout in the JVM against the tolerant parser: the same result, or none."""

import json
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseledger.functions.layouts import declared_column
from caseledger.functions.packets import parse_column
from caseledger.plans import bronze
from caseledger.schemas import APPLICATION_XML, PACKET_DATA

META = "<metadata><ma_goi_tin> P1 \n</ma_goi_tin><su_kien>{e}</su_kien><id_ban_ghi>HS_1</id_ban_ghi></metadata>"


def packet(data="<du_lieu/>", e="INSERT", meta=META):
    return f"<packet>{meta.format(e=e)}{data}</packet>"


ITEM = ('<document_array><document action="INSERT"><id>1</id><name>Đơn &amp; "tờ" \\ khai</name></document>'
        "{more}</document_array>")
DATA = "<du_lieu><name>A\tb\r\nc</name><Agencyid></Agencyid><Statusid/>" + ITEM + "</du_lieu>"
DECLARED = [
    packet(), packet("<du_lieu></du_lieu>"), packet(""), packet(e="PATCH"), packet(DATA.format(more="")),
    packet(DATA.format(more='<document><id/></document><document action=""><name> </name></document>')),
    "<?xml version='1.0' encoding='UTF-8'?>\n" + packet(DATA.format(more="")) + "\n\n",
    f"<packets>{packet()}\n{packet(DATA.format(more=''))}</packets>",
    packet(meta=""), packet(meta="<metadata/>"),
    packet("<du_lieu>\n  <name>n</name>\n  <payment_array>\n <payment action='ADD'><id>1</id><amount>5</amount></payment></payment_array></du_lieu>"),
    packet("<du_lieu><name>𝄞   \x7f</name></du_lieu>"),
]
OTHER = [
    None, "", "  ", "<oops>", "<root/>", "<packets/>", packet() + "trailing", packet() + packet(), "x" + packet(),
    packet("<du_lieu><unknown>1</unknown></du_lieu>"), packet("<du_lieu><name>1</name><name>2</name></du_lieu>"),
    packet("<du_lieu k='1'/>"), packet("<du_lieu>text</du_lieu>"), packet("<du_lieu><name k='1'>x</name></du_lieu>"),
    packet("<du_lieu><document_array/></du_lieu>"), packet("<du_lieu><document_array>t</document_array></du_lieu>"),
    packet("<du_lieu><document_array><document>t</document></document_array></du_lieu>"),
    packet("<du_lieu><document_array><document action='INSERT'/></document_array></du_lieu>"),
    packet("<du_lieu><document_array><document kind='1'><id>1</id></document></document_array></du_lieu>"),
    packet("<du_lieu><name>a<!-- c -->b</name></du_lieu>"), packet("<du_lieu><name><![CDATA[<x>]]></name></du_lieu>"),
    packet("<du_lieu><name>&#65;</name></du_lieu>"), packet("<du_lieu><name>&foo;</name></du_lieu>"),
    packet("<du_lieu><name>a</name>"), packet("<du_lieu><name><b>1</b></name></du_lieu>"),
    packet("<du_lieu><name>\x01</name></du_lieu>"), packet("<du_lieu><name>a ]]> b</name></du_lieu>"),
    "<?xml version='1.0' encoding='UTF-16'?>" + packet(), " <?xml version='1.0'?>" + packet(),
    f"<packets>{packet()}</packets><packets/>", f"<packets>{packet()}<other/></packets>",
    f"<packets><a>{packet()}</a></packets>", packet(packet()), packet("<du_lieu/><du_lieu><name>1</name></du_lieu>"),
    packet("<x:du_lieu xmlns:x='u'/>"), packet("<du_lieu xmlns='u'/>"), "﻿" + packet(),
    packet("<du_lieu><name>b = \"c\"</name></du_lieu>"),
]


def parsed(spark, texts):
    """(declared, tolerant) of every text, as plain rows in the order of the texts."""
    raw = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    found = raw.select("i", declared_column(F.col("value")).alias("d"), parse_column(F.col("value")).alias("t")).orderBy("i")
    return [tuple(None if p is None else [tuple(f[:-1]) + (f[-1] and json.loads(f[-1]),) for f in p["found"]]
                  for p in (r["d"], r["t"])) for r in found.collect()]


def test_declared_files_equal_the_tolerant_parser(spark):
    for text, (mine, wanted) in zip(DECLARED, parsed(spark, DECLARED), strict=True):
        assert mine is not None and mine == wanted, text


def test_other_files_are_left_to_the_tolerant_parser(spark):
    for text, (mine, _) in zip(OTHER, parsed(spark, OTHER), strict=True):
        assert mine is None, text


def test_payload_text_is_that_of_the_tolerant_parser(spark):
    """Down to the character where members stand in the declared order."""
    raw = spark.createDataFrame([(t,) for t in DECLARED], "value string")
    both = raw.select(declared_column(F.col("value")).alias("d"), parse_column(F.col("value")).alias("t"))
    assert both.where("d IS NULL OR NOT d <=> t").count() == 0


tags = st.sampled_from(["packets", "packet", "metadata", "du_lieu", "name", "Statusid", "document_array", "document", "id", "su_kien", "x"])
pieces = st.recursive(
    st.sampled_from(["", "", "t", " ", "&amp;", "=\"", "\n"]),
    lambda inner: st.builds(lambda t, a, xs: f"<{t}{a}>{''.join(xs)}</{t}>", tags,
                            st.sampled_from(["", "", "", " action='A'", " k='v'"]), st.lists(inner, max_size=3)),
    max_leaves=12)
items = st.lists(st.sampled_from(["<id>1</id>", "<name/>", "<name>n</name>", "<x/>", "t"]), max_size=3).map("".join)
documents = st.lists(st.builds("<document{}>{}</document>".format, st.sampled_from(["", " action='A'"]), items), max_size=3)
data = st.lists(st.one_of(st.sampled_from(["<name>a</name>", "<Statusid/>", " ", "<Agencyid>1</Agencyid>"]),
                          documents.map(lambda d: f"<document_array>{''.join(d)}</document_array>"), pieces), max_size=4)
files = st.one_of(pieces, st.builds(lambda d, m: packet(f"<du_lieu>{''.join(d)}</du_lieu>", meta=m), data,
                                    st.sampled_from([META, "", "<metadata>t</metadata>", META + META])))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(files, min_size=150, max_size=200))
def test_no_file_differs(spark, texts):
    for text, (mine, wanted) in zip(texts, parsed(spark, texts), strict=True):
        assert mine is None or mine == wanted, text


def test_declared_files_need_no_python(spark):
    raw = spark.createDataFrame([(packet(), "f", datetime(2024, 1, 1))], "value string, file_name string, ingested_at timestamp")
    good, bad = bronze.split_valid_invalid(bronze.validate_declared(raw))
    assert good.schema == APPLICATION_XML and good.first()["ma_goi_tin"] == "P1" and bad.count() == 0
    for frame in (good, bad):
        assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


def test_one_landing_zone_through_both_parsers(spark):
    texts = DECLARED + OTHER
    raw = spark.createDataFrame([(t, f"f{i:03}", datetime(2024, 1, 1)) for i, t in enumerate(texts)],
                                "value string, file_name string, ingested_at timestamp")
    with bronze.validated_files(raw, PACKET_DATA) as frames:
        mine = [sorted(map(tuple, f.collect()), key=str) for f in frames]
    with bronze.validated_files(raw) as frames:
        wanted = [sorted(map(tuple, f.collect()), key=str) for f in frames]
    assert mine == wanted and all(mine)


def test_an_empty_zone(spark):
    raw = spark.createDataFrame([], "value string, file_name string, ingested_at timestamp")
    with bronze.validated_files(raw, PACKET_DATA) as (good, bad):
        assert good.count() == bad.count() == 0
