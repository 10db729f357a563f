"""Packets of a declared layout, parsed inside the JVM.

``from_xml`` needs a schema and silently leaves out whatever the schema does not name. So the
elements and attributes that the parse holds are counted and compared with those that stand in
the text: only a file of which nothing was left out is taken here. Every other one (undeclared or
repeated tags, comments, CDATA, character references, namespaces, other encodings, malformed text)
gives null and goes to the tolerant parser of :mod:`caseledger.functions.packets`, which
gives the same result for declared files too, save that members of a JSON object stand in the
order of the file there and in the order of the layout here.

A layout is the schema of ``<du_lieu>``: strings are leaves, a struct with one array of structs is
a list of items, and names that begin with ``@`` are attributes of an item.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from caseledger.functions.packets import FIELDS, PARSED
from caseledger.schemas import PACKET_DATA

PACKED, SINGLE, CORRUPT = "packets", "packet", "corrupt"
# An absent element is null and an empty one the empty text, as no text can hold this value.
OPTIONS = {"attributePrefix": "@", "ignoreSurroundingSpaces": "false", "nullValue": "\0",
           "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
_DECLARATION = r"""^<\?xml\s+version=["']1\.0["'](\s+encoding=["'](?i:utf-8)["'])?\s*\?>"""
_ELSEWHERE = r"""<[!?]|&#|\]\]>|=\s+["']|[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"""
_SPACES = " \t\n\r"
# Fixed value: the white space that Python's strip() takes off, as far as XML allows it.
_BLANKS = _SPACES + "\x85\xa0                　"


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def _sum(items: Column, of: Callable[[Column], Column]) -> Column:
    """Over an array; 0 for null."""
    return F.coalesce(F.aggregate(items, F.lit(0), lambda total, item: total + of(item)), F.lit(0))


def _count(text: Column, literal: str) -> Column:
    """How often a literal stands in a text; one that cannot overlap itself."""
    return (F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / len(literal)


def _present(parent: Column, names: list[str]) -> Column:
    return _total([parent[name].isNotNull().cast("int") for name in names])


def _quoted(value: Column) -> Column:
    """The value as a JSON string; null for null."""
    plain = F.concat(F.lit('"'), value, F.lit('"'))
    return F.when(value.rlike(r'["\\\x00-\x1f]'), _once(
        F.to_json(F.array(value)), lambda j: F.substring(j, F.lit(2), F.length(j) - 2))).otherwise(plain)


def _object(members: list[tuple[str, Column]]) -> Column:
    """A JSON object of the members that are not null."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *[
        F.concat(F.lit(json.dumps(name, ensure_ascii=False) + ": "), value) for name, value in members]), F.lit("}"))


def _leaf(value: Column) -> Column:
    return F.when(value == "", F.lit("null")).otherwise(_quoted(value))


class _Layout:
    """Walks a declared layout; every method builds column expressions only."""

    def __init__(self, data: StructType):
        self.data = data
        self.leaves = [f.name for f in data if isinstance(f.dataType, StringType)]
        self.lists = {f.name: (f.dataType[0].name, f.dataType[0].dataType.elementType.names)
                      for f in data if not isinstance(f.dataType, StringType)}

    def schema(self) -> StructType:
        metadata = reduce(lambda s, name: s.add(name, StringType()), FIELDS, StructType())
        packet = StructType().add("metadata", metadata).add("du_lieu", self.data)
        return StructType().add(SINGLE, ArrayType(packet)).add(CORRUPT, StringType())

    @staticmethod
    def fields(names: list[str]) -> list[str]:
        return [n for n in names if not n.startswith("@")]

    def items(self, data: Column, name: str) -> Column:
        return data[name][self.lists[name][0]]

    def no_data(self, packet: Column) -> Column:
        data = packet["du_lieu"]
        return data.isNotNull() & (_present(data, self.data.names) == 0)

    def elements(self, packet: Column) -> Column:
        """How many elements of a packet the parse holds, itself included."""
        metadata, data = packet["metadata"], packet["du_lieu"]
        inner = [F.when(data[name].isNotNull(), 1 + _sum(
            self.items(data, name), lambda item: 1 + _present(item, self.fields(names)))).otherwise(0)
            for name, (_, names) in self.lists.items()]
        return (1 + F.when(metadata.isNotNull(), 1 + _present(metadata, list(FIELDS))).otherwise(0)
                + F.when(data.isNotNull(), 1 + _present(data, self.leaves) + _total(inner)).otherwise(0))

    def attributes(self, packet: Column) -> Column:
        return _total([_sum(self.items(packet["du_lieu"], name), lambda item: _present(
            item, [n for n in names if n.startswith("@")])) for name, (_, names) in self.lists.items()])

    def bare(self, packet: Column) -> Column:
        """Lists without items and items without elements, whose text the parse does not hold."""
        data = packet["du_lieu"]
        return _total([F.when(data[name].isNotNull() & (F.coalesce(F.size(self.items(data, name)), F.lit(0)) <= 0), 1).otherwise(0)
                       + _sum(self.items(data, name), lambda item: (_present(item, self.fields(names)) == 0).cast("int"))
                       for name, (_, names) in self.lists.items()])

    def payload(self, data: Column) -> Column:
        def item(value: Column, names: list[str]) -> Column:
            ordered = sorted(names, key=lambda n: not n.startswith("@"))
            return _object([(n, _quoted(value[n]) if n.startswith("@") else _leaf(value[n])) for n in ordered])

        def some(name: str) -> Column:
            tag, names = self.lists[name]
            objects = F.transform(self.items(data, name), lambda i: item(i, names))
            listed = F.when(F.size(objects) == 1, objects[0]).otherwise(
                F.concat(F.lit("["), F.array_join(objects, ", "), F.lit("]")))
            return F.when(data[name].isNotNull(), _object([(tag, listed)]))

        members = [(n, some(n) if n in self.lists else _leaf(data[n])) for n in self.data.names]
        return F.when(data.isNotNull(), F.when(_present(data, self.data.names) == 0, "null").otherwise(_object(members)))

    def facts(self, packet: Column) -> Column:
        metadata = packet["metadata"]
        names = [F.coalesce(F.btrim(metadata[n], F.lit(_BLANKS)), F.lit("")).alias(n) for n in FIELDS]
        return F.struct(metadata.isNotNull().alias("has_metadata"), *names, self.payload(packet["du_lieu"]).alias("data_payload"))


def declared_column(text: Column, data: StructType = PACKET_DATA) -> Column:
    """The ``PARSED`` struct of a file, or null where the file is not wholly of the layout.

    A file is one ``<packet>`` or ``<packets>`` of them.
    """
    layout = _Layout(data)

    def whole(body: Column, tree: Column, packed: Column) -> Column:
        found = tree[SINGLE]
        return (tree[CORRUPT].isNull() & (F.size(found) > 0)
                & (packed | (F.size(found) == 1))
                & (_sum(found, layout.bare) == 0)
                & (_count(body, "<") - _count(body, "</") == packed.cast("int") + _sum(found, layout.elements))
                & (_count(body, '="') + _count(body, "='") == _sum(found, layout.attributes))
                & (_count(body, "<du_lieu/>") + _count(body, "<du_lieu></du_lieu>")
                   == _sum(found, lambda p: layout.no_data(p).cast("int"))))

    def parsed(body: Column) -> Column:
        packed = body.startswith(f"<{PACKED}>") & body.endswith(f"</{PACKED}>")
        single = body.startswith(f"<{SINGLE}>") & body.endswith(f"</{SINGLE}>")
        plain = (packed | single) & ~body.rlike(_ELSEWHERE) & (
            single | (_count(body, f"</{PACKED}") == 1))
        wrapped = F.when(plain, F.when(packed, body).otherwise(
            F.concat(F.lit(f"<{PACKED}>"), body, F.lit(f"</{PACKED}>"))))
        return _once(F.from_xml(wrapped, layout.schema(), OPTIONS), lambda tree: F.when(
            whole(body, tree, packed), F.struct(
                F.lit(None).cast("string").alias("syntax"), F.lit(None).cast("string").alias("failure"),
                F.transform(tree[SINGLE], layout.facts).alias("found")))).cast(PARSED)

    body = F.when(text.startswith("<?xml"), F.regexp_replace(text, _DECLARATION, "")).otherwise(text)
    return _once(F.btrim(body, F.lit(_SPACES)), parsed)
