"""Validation of XML packet files and their conversion to JSON payloads.

Tags may nest to any depth and differ from file to file, which no ``from_xml`` schema
can declare, and the SQL ``xpath`` functions raise on malformed text. So a file that is not of
a declared layout (:mod:`caseledger.functions.layouts`) is
parsed once, in an Arrow-batched function that only reports what is there; the rules and
everything after them are column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from caseledger.schemas import PACKET

# Accepted events and the reasons stored with rejected files.
EVENTS = ("INSERT", "UPDATE", "DELETE")
REASONS = {
    "empty": "File rỗng hoặc không có nội dung",
    "no_packet": "Không tìm thấy thẻ <packet> nào trong file",
    "no_metadata": "Thiếu thẻ <metadata> quan trọng",
    "no_packet_id": "Thiếu mã gói tin (ma_goi_tin)",
    "bad_event": "Sự kiện không hợp lệ hoặc bị thiếu (su_kien: {event})",
    "no_record_id": "Thiếu ID bản ghi hồ sơ (id_ban_ghi) - Không thể merge ở Silver",
    "no_data": "Thiếu thẻ <du_lieu> bao bọc payload",
    "malformed": "Lỗi cú pháp XML (Parse Error): {detail}",
    "other": "Lỗi không xác định: {detail}",
}

FIELDS = ("ma_goi_tin", "ma_du_lieu", "loai_du_lieu", "ngay_cap_nhat", "su_kien", "id_ban_ghi")

# Fixed value: nothing but white space as Unicode has it, for Java's expressions and for Arrow's.
BLANK = r"\A[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*\z"

# What one file holds, before any rule is applied: a parse problem, or its packets.
PARSED = StructType([
    StructField("syntax", StringType()),
    StructField("failure", StringType()),
    StructField("found", ArrayType(StructType([
        StructField("has_metadata", BooleanType()),
        *[StructField(name, StringType()) for name in FIELDS],
        StructField("data_payload", StringType()),
    ]))),
])


def _parser() -> Callable[[pa.Array], pa.Array]:
    """Texts to ``PARSED`` structs: one parse per file, Arrow columns in and out, no rules."""
    import gc
    from json.encoder import encode_basestring as quote
    from xml.etree import ElementTree

    names, kind = FIELDS, to_arrow_type(PARSED)

    def json_of(node) -> str:
        """Text for a plain leaf, else an object; repeated tags become lists."""
        marks = [f"{quote('@' + k)}: {quote(v)}" for k, v in node.items()]
        if not len(node):
            text = "null" if node.text is None else quote(node.text)
            return "{" + ", ".join([*marks, f'"#text": {text}']) + "}" if marks else text
        values, repeated = {}, set()
        for child in node:
            if len(child) or child.items():
                value = json_of(child)
            else:  # most are plain leaves, not worth a call
                value = "null" if child.text is None else quote(child.text)
            tag = child.tag
            if tag in values:
                repeated.add(tag)
                value = f"{values[tag]}, {value}"
            values[tag] = value
        if repeated:
            values |= {tag: f"[{values[tag]}]" for tag in repeated}
        return "{" + ", ".join(marks + [f"{quote(tag)}: {value}" for tag, value in values.items()]) + "}"

    def facts(packet):
        metadata, data = packet.find("metadata"), packet.find("du_lieu")
        known = metadata is not None
        return (known, *[(metadata.findtext(n) or "").strip() if known else "" for n in names],
                None if data is None else json_of(data))

    def parse(batch: pa.Array) -> pa.Array:
        syntax, failure, ends, found = [], [], [0], []
        gc.disable()  # trees have no cycles, and a collection would walk a large one again and again
        for text in batch.cast(pa.binary()):
            problem = odd = None
            packets = []
            try:
                root = ElementTree.fromstring(text.as_py() or b"")
                packets = [facts(p) for p in ([root] if root.tag == "packet" else root.iter("packet"))]
            except ElementTree.ParseError as error:
                problem = str(error)
            except Exception as error:  # one odd file must not stop the job
                odd = str(error)
            syntax.append(problem)
            failure.append(odd)
            found += packets
            ends.append(len(found))
        gc.enable()
        item = kind.field("found").type.value_type
        columns = zip(*found) if found else [()] * item.num_fields
        rows = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, item)], fields=list(item))
        return pa.StructArray.from_arrays(
            [pa.array(syntax, pa.string()), pa.array(failure, pa.string()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, type=kind.field("found").type)], fields=list(kind))

    return parse


def parse_column(text: Column) -> Column:
    """The ``PARSED`` struct of a file's text."""
    # Declared non-deterministic so that a filter on the result is not pushed below it,
    # which would parse every file twice.
    return F.arrow_udf(_parser(), PARSED).asNondeterministic()(text)


def parsed_without_text(raw: DataFrame, text: str = "value") -> DataFrame:
    """The other columns of files, ``blank`` and ``parsed``.

    A column function keeps the row that it is called for until its result is there; here
    the text is not needed any more once it is in the Arrow batch.
    """
    parse, white = _parser(), BLANK

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            texts = batch.column(text)
            rest = {name: batch.column(name) for name in batch.schema.names if name != text}
            blank = pc.fill_null(pc.match_substring_regex(texts, white), True)
            yield pa.RecordBatch.from_pydict(rest | {"blank": blank, "parsed": parse(texts)})

    rest = StructType([field for field in raw.schema if field.name != text])
    return raw.mapInArrow(facts, StructType([*rest, StructField("blank", BooleanType()), StructField("parsed", PARSED)]))


def packet_problem(packet: Column, events: Sequence[str] = EVENTS) -> Column:
    """Why one packet is refused, by the first rule that it breaks; null if by none."""
    event = F.replace(F.lit(REASONS["bad_event"]), F.lit("{event}"), packet["su_kien"])
    return (F.when(~packet["has_metadata"], REASONS["no_metadata"])
            .when(packet["ma_goi_tin"] == "", REASONS["no_packet_id"])
            .when(~packet["su_kien"].isin(*events), event)
            .when(packet["id_ban_ghi"] == "", REASONS["no_record_id"])
            .when(packet["data_payload"].isNull(), REASONS["no_data"]))


def blank_column(text: Column) -> Column:
    """Whether a text is missing or nothing but white space."""
    return F.coalesce(text, F.lit("")).rlike(BLANK)


def judged_column(blank: Column, parsed: Column, events: Sequence[str] = EVENTS) -> Column:
    """Struct ``(is_valid, error_msg, packets)`` of a file, ``blank`` or not, by what a parser found in it.

    One bad packet rejects its whole file. Null where the parser gave null.
    """
    def with_detail(reason: str, detail: Column) -> Column:
        return F.replace(F.lit(REASONS[reason]), F.lit("{detail}"), detail)

    def judged(parsed: Column) -> Column:
        broken = F.filter(F.transform(parsed["found"], lambda p: packet_problem(p, events)), lambda r: r.isNotNull())
        reason = (F.when(blank, REASONS["empty"])
                  .when(parsed["syntax"].isNotNull(), with_detail("malformed", parsed["syntax"]))
                  .when(parsed["failure"].isNotNull(), with_detail("other", parsed["failure"]))
                  .when(F.size(parsed["found"]) == 0, REASONS["no_packet"]).otherwise(F.get(broken, F.lit(0))))
        rows = F.transform(parsed["found"], lambda p: F.struct(*[p[f.name].alias(f.name) for f in PACKET]))
        return F.when(parsed.isNotNull(), F.transform(F.array(reason), lambda r: F.struct(
            r.isNull().alias("is_valid"), r.alias("error_msg"),
            F.when(r.isNull(), rows).otherwise(F.array().cast(ArrayType(PACKET))).alias("packets")))[0])

    return F.transform(F.array(parsed), judged)[0]


def validate_column(text: Column, events: Sequence[str] = EVENTS) -> Column:
    """:func:`judged_column` of any file, by the tolerant parser."""
    return judged_column(blank_column(text), parse_column(text), events)
