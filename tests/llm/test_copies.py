"""Copies hidden by formatting."""

from loomery.llm import copies

PAGES = "audit_id long, run_id long, detail_title string, canon string"
HITS = "ordinal long, run_id long, title string, h string"


def test_groups_and_copies(spark):
    p = spark.createDataFrame([(5, 1, "The Last Well | Ink", "x"), (3, 1, "ink_THE LAST, WELL!", "x"), (9, 2, "the last well | ink", "x"), (7, 1, "Thelastwell - ink", "x"), (8, 1, "The last-well ink", "x"), (1, 1, "!!!", "x"), (2, 1, None, "x"), (4, 1, "", "x"), (6, None, "z", "x"), (10, None, "Z", "x")], PAGES)
    h = spark.createDataFrame([(3, 1, "the last well/ink", "y"), (11, 1, "étude", "y"), (12, 1, "ÉTUDE", "y"), (13, 1, "étude", "y")], HITS)
    rows = copies.titles(p, h)
    got = {(r.src, r.first_id, r.row_id) for r in copies.find(rows).collect()}
    assert got == {("page_audit", 3, 5), ("page_audit", 3, 7), ("page_audit", 6, 10), ("candidate", 11, 12), ("candidate", 11, 13)}
    counts = {(r.src, r.first_id): r.copies for r in copies.counts(rows).collect()}
    assert counts[("page_audit", 3)] == 3 and counts[("candidate", 11)] == 3 and counts[("candidate", 3)] == 1


def test_hash_collision_is_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(copies, "_digest", lambda: F.lit(b"same"))
    p = spark.createDataFrame([(1, 1, "a", ""), (2, 1, "b", ""), (3, 1, "A", ""), (4, 2, "a", "")], PAGES)
    h = spark.createDataFrame([], HITS)
    assert [(r.first_id, r.row_id) for r in copies.find(copies.titles(p, h)).collect()] == [(1, 3)]
    assert sorted((r.first_id, r.copies) for r in copies.counts(copies.titles(p, h)).collect()) == [(1, 2), (2, 1), (4, 1)]
    assert [(bytes(r.h), r.spellings) for r in copies.collisions(copies.titles(p, h)).collect()] == [(b"same", 3)]


def test_empty(spark):
    assert copies.find(copies.titles(spark.createDataFrame([], PAGES), spark.createDataFrame([], HITS))).count() == 0


def test_title_of_half_the_rows_stays_spread(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    p = spark.range(40_000, numPartitions=8).selectExpr("id as audit_id", "1L as run_id", "if(id % 2 = 0, 'Same Title', concat('t', id div 4)) as detail_title", "'' as first_chapter_title")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = copies.find(copies.titles(p, spark.createDataFrame([], HITS)), heavy=10, least=100)
        rows = found.where("first_id = 0").select(F.spark_partition_id().alias("t")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes = sorted(Counter(r.t for r in rows).values())
    assert len(rows) == 19_999 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert found.count() == 19_999 + 10_000
