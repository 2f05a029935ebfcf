"""Caps per contributor against a plain sort."""

import random

from pyspark.sql import functions as F

from loomery.llm import capping


def brute(rows, cap):
    by = {}
    for i, c, q in rows:
        if c is not None:
            by.setdefault(c, []).append((-q, i))
    return {i for v in by.values() for _, i in sorted(v)[cap:]}


def test_equals_plain_sort_under_skew_and_ties(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["hot"] * 6 + ["b", "c", None]), r.choice([0, 0, 0, 500, 1000 + r.randrange(40)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id long, contributor string, quality long")
    got = {x.row_id for x in capping.ranked(df).where("rank > cap").collect()}
    assert got == brute(rows, 30)
    got = {x.row_id for x in capping.ranked(df, 1).where("rank > cap").collect()}
    assert got == brute(rows, 1)


def test_ranks_are_exact(spark):
    rows = [(i, "h", (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id long, contributor string, quality long")
    want = {i: n for n, (_, i) in enumerate(sorted((-q, i) for i, _, q in rows), 1)}
    assert {x.row_id: x["rank"] for x in capping.ranked(df).collect()} == want


def test_small_and_empty(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, None, 1)], "row_id long, contributor string, quality long")
    assert {x.row_id for x in capping.ranked(df).where("rank > cap").collect()} == {1}
    assert capping.ranked(df.limit(0)).count() == 0


def test_host(spark):
    df = spark.createDataFrame([(" WWW.A.example. ",), ("a.example",), ("m.a.example",), (None,)], "h string")
    assert [r[0] for r in df.select(capping.host(F.col("h"))).collect()] == ["a.example", "a.example", "m.a.example", None]
