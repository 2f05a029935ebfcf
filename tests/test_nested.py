"""Nested records: shapes, labels and parents."""

import json

from pyspark.sql import functions as F

from loomery.operators import nested as N

REPORT = {
    "generated": [{"detail_url": "u0", "evidence": {"keyword": "k"}, "domainApplicabilityList": ["a", None, "b"]}, None, {"evidence": {}, "domainApplicabilityList": "solo"}],
    "excluded": {"detail_url": "x", "evidence": json.dumps({"engine": "e"})},
    "stats": json.dumps({"queryStats": [None, {"query": "q", "engines": "one"}], "seedDiscovery": {"seedPageStats": json.dumps([{"seedUrl": "s"}])}, "audit": {"candidateSamples": None}}),
}
WANT = {
    ("generated", 0, -1, "u0"), ("generated", 2, -1, ""), ("generated.evidence", 0, -1, "k"), ("generated.domainApplicabilityList", 0, 0, "a"), ("generated.domainApplicabilityList", 0, 2, "b"),
    ("generated.domainApplicabilityList", 2, 0, "solo"), ("excluded", 0, -1, "x"), ("excluded.evidence", 0, -1, ""), ("stats.queryStats", 1, -1, "q"), ("stats.queryStats.engines", 1, 0, "one"),
    ("stats.seedDiscovery.seedPageStats", 0, -1, "s"),
}


def test_report_children(spark):
    body = json.dumps(REPORT)
    bodies = [body, "﻿ " + body + "\n", json.dumps(body), json.dumps([{"x": 1}, {"report": REPORT}]), body[:-5], "", None, "null", "[]", "{\"generated\": NaN}"]
    df = spark.createDataFrame([(i, b, "clash") for i, b in enumerate(bodies)], "report_id long, body string, path string")
    got = {}
    for r in N.report_children(df).collect():
        got.setdefault(r.report_id, set()).add((r.section, r.pos, r.sub_pos, r.item))
    assert got == {i: WANT for i in range(4)}


def test_labels_lead_to_parents(spark):
    df = spark.createDataFrame([(1, json.dumps(REPORT))], "report_id long, body string")
    rows = N.shred(df, "report_id", "body", N.REPORT).collect()
    labels = {r.label: r.path for r in rows}
    for r in rows:
        assert r.parent == ".".join(r.label.split(".")[:-2])
        if r.parent:
            assert labels[r.parent] == r.path.rsplit(".", 1)[0]


def test_empty_table(spark):
    assert N.report_children(spark.createDataFrame([], "report_id long, body string")).count() == 0


def test_any_depth_of_quoting_wrapping_and_nesting(spark):
    body = json.dumps(REPORT)
    for _ in range(7):
        body = json.dumps(body)
    wrapped = json.dumps(REPORT)
    for i in range(40):
        wrapped = f'{{"a": 1, "b{i}": [{wrapped}]}}'
    deep = '{"generated": [{"detail_url": "u", "x": ' + '[{"y": ' * 60_000 + "1.5e3" + "}]" * 60_000 + "}]}"
    df = spark.createDataFrame([(1, body), (2, wrapped), (3, deep), (4, deep[:-1]), (5, "[" * 200_000)], "report_id long, body string")
    got = {}
    for r in N.report_children(df).collect():
        got.setdefault(r.report_id, set()).add((r.section, r.pos, r.sub_pos, r.item))
    assert got == {1: WANT, 2: WANT, 3: {("generated", 0, -1, "u")}}


def test_parser_without_a_stack_equals_the_library():
    import random

    r = random.Random(3)

    def value(depth):
        k = r.random()
        if depth and k < 0.5:
            return [value(depth - 1) for _ in range(r.randrange(4))] if k < 0.25 else {r.choice("ab\n\u00e9"): value(depth - 1) for _ in range(r.randrange(4))}
        return r.choice([None, True, False, 0, -12, 1.5, 2e300, "", "x\"\\", "\u706f", "[1"])

    for _ in range(500):
        v = value(5)
        text = json.dumps(v, indent=r.choice([None, 1]), ensure_ascii=r.random() < 0.5)
        assert N._deep(text) == v
        cut = text[: r.randrange(len(text))]
        try:
            want = json.loads(cut, parse_constant=N._no_constant)
        except ValueError:
            want = None
        assert N._deep(cut) == want
    for bad in ("[1,]", "{,}", '{"a" 1}', "[1 2]", "01", "NaN", "[tru]", "{1: 2}", "", "]", '"a'):
        assert N._deep(bad) is None


def test_unfold_struct_and_list(spark):
    df = spark.createDataFrame([(1, [("a", 1), None, ("b", 2)], ("z", 9)), (2, None, None), (3, [], ("y", 8))], "id long, xs array<struct<k:string,v:int>>, x struct<k:string,v:int>")
    assert [tuple(r) for r in N.unfold(df, "id", "xs").collect()] == [(1, "0.0", "", "a", 1), (1, "0.2", "", "b", 2)]
    assert [tuple(r) for r in N.unfold(df, "id", "x", 3).collect()] == [(1, "3.0", "", "z", 9), (3, "3.0", "", "y", 8)]


def test_child_tables_join_their_parents(spark):
    df = spark.createDataFrame([(1, json.dumps(REPORT))], "report_id long, body string")
    rows = N.shred(df, "report_id", "body", N.REPORT)
    audits, evidence = N.table_of(rows, "generated[]"), N.table_of(rows, "generated[].evidence")
    both = evidence.alias("e").join(audits.alias("a"), F.expr("e.report_id = a.report_id and e.parent = a.label")).select("a.item", "e.item")
    assert [tuple(r) for r in both.collect()] == [("u0", "k")]
