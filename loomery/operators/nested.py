"""Deeply nested records into flat, related tables by Dewey labels.

Every node of a record gets the path of ordinals that leads to it from the root ("0.3.1"); the label
of its parent is the label cut at its last ordinal, so no join is needed to keep parent and child together.
Nodes with the same schema path ("generated[].evidence") form one table.

Shapes that differ are brought to one: JSON held in a string counts as what it holds, a lone value
where a list belongs is a list of one, a record wrapped in another value is the record. A null
element keeps its ordinal and gives no row. Defined results: null, empty, cut-off or otherwise
incomplete bodies give no row; repeated reports give rows of their own; very long bodies are read
whole by one task each, and nothing is gathered across records.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AROUND = " \t\r\n\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0　﻿"


@dataclass(frozen=True)
class Slot:
    """A member of an object that holds children: a list of them, or one object."""

    key: str
    many: bool = True
    item: str | None = None  # the key of a child that names it; None: the child itself
    slots: tuple[Slot, ...] = field(default=())
    records: bool = True  # children are objects; else scalars


def _no_constant(name: str) -> None:
    raise ValueError(name)


def complete(text: str | None) -> object:
    """The value of a complete JSON text (blanks and byte-order marks around it don't matter), else None."""
    if not text:
        return None
    text = text.strip(_AROUND)
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        return _deep(text)
    except ValueError:
        return None


_BLANK, _SCALAR = re.compile(r"[ \t\n\r]*"), re.compile(r"true|false|null|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?")


def _skip(text: str, i: int) -> int:
    return _BLANK.match(text, i).end()


def _deep(text: str) -> object:
    """The same for nesting beyond the parser's stack: open lists and objects are kept in a list of their own."""
    around: list[tuple[object, str | None]] = []  # containers, each with the key that its next value gets
    i = _skip(text, 0)
    try:
        while True:
            c = text[i]
            if c in "[{":
                new: object = [] if c == "[" else {}
                i = _skip(text, i + 1)
                if text[i] != ("]" if c == "[" else "}"):
                    key = None
                    if c == "{":
                        key, i = _key(text, i)
                    around.append((new, key))
                    continue
                value, i = new, i + 1
            elif c == '"':
                value, i = json.decoder.scanstring(text, i + 1, True)
            elif m := _SCALAR.match(text, i):
                value, i = json.loads(m[0]), m.end()
            else:
                return None
            while True:  # a value ends: put it into what is around it
                i = _skip(text, i)
                if not around:
                    return value if i == len(text) else None
                box, key = around.pop()
                if isinstance(box, list):
                    box.append(value)
                else:
                    box[key] = value
                if text[i] == ",":
                    i = _skip(text, i + 1)
                    if isinstance(box, dict):
                        key, i = _key(text, i)
                    around.append((box, key))
                    break
                if text[i] != ("]" if isinstance(box, list) else "}"):
                    return None
                value, i = box, i + 1
    except (IndexError, ValueError):
        return None


def _key(text: str, i: int) -> tuple[str, int]:
    if text[i] != '"':
        raise ValueError(i)
    key, i = json.decoder.scanstring(text, i + 1, True)
    i = _skip(text, i)
    if text[i] != ":":
        raise ValueError(i)
    return key, _skip(text, i + 1)


def opened(value: object) -> object:
    """A structure held in a string, however often quoted, as what it holds."""
    while isinstance(value, str) and value.strip(_AROUND)[:1] in ("{", "[", '"') and (inner := complete(value)) is not None:
        value = inner
    return value


def record_in(value: object, keys: frozenset[str]) -> dict | None:
    """The first object, from the outside in, that has one of ``keys``, however deep it lies."""
    level = [value]
    while level:
        below = []
        for v in map(opened, level):
            if isinstance(v, dict):
                if keys & v.keys():
                    return v
                below += v.values()
            elif isinstance(v, list):
                below += v
        level = below
    return None


def nodes(obj: dict, slots: tuple[Slot, ...], path: str = "", label: tuple[int, ...] = ()) -> Iterator[tuple[str, tuple[int, ...], str, object]]:
    """(schema path, label, item, node) below ``obj``. The ordinal of a member is the place of its slot."""
    for k, slot in enumerate(slots):
        value = opened(obj.get(slot.key))
        here = f"{path}.{slot.key}" if path else slot.key
        if slot.many:
            kids = value if isinstance(value, list) else [] if value is None else [value]
            here += "[]"
        else:
            kids = [value]
        for i, kid in enumerate(kids):
            kid = opened(kid)
            if kid is None or slot.records and not isinstance(kid, dict) or not slot.many and not kid:
                continue
            own = (*label, k, i)
            named = kid.get(slot.item) if slot.item and isinstance(kid, dict) else "" if isinstance(kid, dict) else kid
            yield here, own, "" if named is None else named if isinstance(named, str) else json.dumps(named, ensure_ascii=False), kid
            if isinstance(kid, dict):
                yield from nodes(kid, slot.slots, here, own)


NODES = "path string, label string, parent string, item string, attributes string"


def shred(df: DataFrame, key: str, body: str, slots: tuple[Slot, ...], paths: list[str] | None = None, attributes: bool = True) -> DataFrame:
    """df(key, body) → (key, path, label, parent, item, attributes), one row per node; ``paths`` keeps only those tables.

    attributes: the node's own scalar members as JSON (null if not wanted).
    """
    keys = frozenset(s.key for s in slots)
    want = set(paths) if paths else None
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                record = record_in(complete(text), keys)
                if record is None:
                    continue
                for path, label, item, node in nodes(record, slots):
                    if want is None or path in want:
                        dotted = ".".join(map(str, label))
                        scalars = json.dumps({k: v for k, v in node.items() if not isinstance(v, (dict, list))}, ensure_ascii=False) if attributes and isinstance(node, dict) else None
                        for col, v in zip(out, (row, path, dotted, ".".join(map(str, label[:-2])), item, scalars)):
                            col.append(v)
                if len(out[0]) > 20000:
                    yield _batch(batch, out)
                    out = ([], [], [], [], [], [])
            yield _batch(batch, out)

    def _batch(batch: pa.RecordBatch, out: tuple[list, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), *(pa.array(c, pa.string()) for c in out[1:])], names=[key, "path", "label", "parent", "item", "attributes"])

    return df.select(key, body).where(F.col(body).isNotNull()).mapInArrow(work, f"{key} {kind}, {NODES}")


def table_of(nodes: DataFrame, path: str) -> DataFrame:
    """The table of one schema path: its nodes with their label and the label of the parent, which leads to the parent's table."""
    return nodes.where(F.col("path") == path).drop("path")


def unfold(df: DataFrame, key: str, column: str, slot: int = 0) -> DataFrame:
    """(key, label, parent, the fields) of a column that holds a struct or an array of structs: its nodes by the same labels, in the JVM.

    A null struct or element gives no row; an element keeps its place.
    """
    kids = F.col(column) if df.schema[column].dataType.typeName() == "array" else F.array(column)
    rows = df.select(key, F.posexplode(kids).alias("_p", "_n")).where(F.col("_n").isNotNull())
    return rows.select(key, F.concat(F.lit(f"{slot}."), F.col("_p").cast("string")).alias("label"), F.lit("").alias("parent"), "_n.*")


def ordinal(label: Column, depth: int) -> Column:
    """Place in the list at nesting ``depth`` (0: outermost) of a node's label; a label holds slot and place by turns."""
    return F.element_at(F.split(label, r"\."), 2 * depth + 2).cast("bigint")


_EVIDENCE = Slot("evidence", many=False, item="keyword")
REPORT = (
    Slot("generated", item="detail_url", slots=(_EVIDENCE, Slot("domainApplicabilityList", records=False))),
    Slot("excluded", item="detail_url", slots=(_EVIDENCE,)),
    Slot("stats", many=False, slots=(
        Slot("queryStats", item="query", slots=(Slot("engines", records=False),)),
        Slot("seedDiscovery", many=False, slots=(Slot("seedPageStats", item="seedUrl"),)),
        Slot("audit", many=False, slots=(Slot("candidateSamples", item="url"),)),
    )),
)
#: Schema path → (section, nesting depth of its place, that of its inner place or None).
SECTIONS = {
    "generated[]": ("generated", 0, None),
    "excluded[]": ("excluded", 0, None),
    "generated[].evidence": ("generated.evidence", 0, None),
    "excluded[].evidence": ("excluded.evidence", 0, None),
    "generated[].domainApplicabilityList[]": ("generated.domainApplicabilityList", 0, 1),
    "stats.queryStats[]": ("stats.queryStats", 1, None),
    "stats.queryStats[].engines[]": ("stats.queryStats.engines", 1, 2),
    "stats.seedDiscovery.seedPageStats[]": ("stats.seedDiscovery.seedPageStats", 2, None),
    "stats.audit.candidateSamples[]": ("stats.audit.candidateSamples", 2, None),
}


def report_children(reports: DataFrame) -> DataFrame:
    """(report_id, section, pos, sub_pos, item): the children of the run reports."""
    rows = shred(reports, "report_id", "body", REPORT, list(SECTIONS), attributes=False)
    pick = lambda at: F.coalesce(*(F.when(F.col("path") == p, v) for p, v in at.items()))
    section = pick({p: F.lit(s) for p, (s, _, _) in SECTIONS.items()})
    pos = pick({p: ordinal(F.col("label"), d) for p, (_, d, _) in SECTIONS.items()})
    sub = pick({p: F.lit(-1).cast("bigint") if d is None else ordinal(F.col("label"), d) for p, (_, _, d) in SECTIONS.items()})
    return rows.select("report_id", section.alias("section"), pos.alias("pos"), sub.alias("sub_pos"), "item")
