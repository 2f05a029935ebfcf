"""Sources, sinks, plans and streams on temporary folders."""

import json

from pyspark.sql import functions as F

from loomery.plans import pipelines as PL
from loomery.sources import files, sinks
from loomery.streaming import incremental as I


def test_sources(spark, tmp_path):
    (tmp_path / "l.txt").write_text("﻿# note\n a.example \n\nWWW.b.example\n#x\n", encoding="utf-8")
    assert sorted(r.value for r in files.lines(spark, str(tmp_path / "l.txt")).collect()) == ["WWW.b.example", "a.example"]
    assert sorted(r.value for r in files.lines(spark, str(tmp_path / "l.txt"), domains=True).collect()) == ["a.example", "b.example"]
    (tmp_path / "d.json").write_text(json.dumps({"a": 1, "b": ["x"]}))
    (tmp_path / "bad.json").write_text("{")
    assert files.json_documents(spark, str(tmp_path / "d.json"), "a int, b array<string>, c string").first().asDict() == {"a": 1, "b": ["x"], "c": None}
    assert files.json_config(str(tmp_path / "bad.json"), {}) == {} and files.json_config(str(tmp_path / "none.json"), 3) == 3
    assert [(r.lang, r.pos, r.value) for r in files.keyed_lists(spark, {"en": ["x", "y"]}).orderBy("pos").collect()] == [("en", 0, "x"), ("en", 1, "y")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("en", "a", None), ("de", "b", 1)], "lang string, k string, v int")
    sinks.tables(df, str(tmp_path / "t"), ["lang"])
    assert {(r.lang, r.k, r.v) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("en", "a", None), ("de", "b", 1)}
    sinks.json_lines(df, str(tmp_path / "j"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"lang":"de","k":"b","v":1}', '{"lang":"en","k":"a","v":null}']
    sinks.append_new(df, "k", str(tmp_path / "log"), None)
    sinks.append_new(df.unionByName(df), "k", str(tmp_path / "log"), spark.read.parquet(str(tmp_path / "log")))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["a", "b"]
    head = sinks.index_document(df, "v1", F.lit("2025-03-04 05:06:07").cast("timestamp")).first()
    assert head.asDict() == {"schema": "v1", "version": "2025.03.04.0506", "updated_at": "2025-03-04T05:06:07Z", "rules": 2}
    assert sinks.before_after(df, df.limit(1), "s").first().removed == 1
    assert sinks.rule_source(df).count() == 2


def test_candidates_of_seeds(spark):
    seeds = spark.createDataFrame([(0, "https://a.x/list"), (1, "https://b.x/list")], "seed_no long, seed_url string")
    pages = spark.createDataFrame([("https://a.x/list",)], "url string")
    links = spark.createDataFrame([("https://a.x/list", i, f"https://{'a' if i < 4 else 'c'}.x/{i % 5}#f") for i in range(7)], "page_url string, pos long, url string")
    chosen, stats = PL.discover_candidates(seeds, pages, links, per_domain=3, total=4)
    assert [r.url for r in chosen.orderBy("ordinal").collect()] == ["https://a.x/0", "https://a.x/1", "https://a.x/2", "https://c.x/4"]
    assert {(r.seed_no, r.status, r.candidates, r.selected) for r in stats.collect()} == {(0, "ok", 7, 4), (1, "fetch_failed", 0, None)}


def test_small_plans(spark):
    sites = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1)], "domain string, good int")
    known = spark.createDataFrame([("b",)], "domain string")
    verdict = F.when(F.col("good") == 1, "ok").otherwise("no")
    assert {r.domain for r in PL.validate_sites(sites, known, verdict, ["ok"]).where("keep").collect()} == {"a", "b", "c"}
    assert {r.domain for r in PL.validate_sites(sites, known, F.lit("no"), ["ok"], recheck=True).where("keep").collect()} == set()
    good, bad = PL.split(sites, F.when(F.col("good") == 1, True))
    assert good.count() == 2 and bad.count() == 1
    kw = spark.createDataFrame([(0, "blue well"), (1, "best comic")], "pos int, keyword string")
    ds = spark.createDataFrame([(0, "a.x"), (1, "b.x")], "pos int, domain string")
    got = [r.query for r in PL.expand_queries(kw, ds, ["comic"], ["{keyword}", "{keyword} online"], 1).orderBy("place").collect()]
    assert got == ["best comic", "best comic online", "best comic site:a.x", "blue well", "blue well online", "blue well site:a.x"]


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "2025-01-01 00:10:00"), ("a", "2025-01-01 00:20:00"), ("b", "2025-01-01 01:30:00")], "k string, t string").select("k", F.col("t").cast("timestamp").alias("t")).write.parquet(src)
    read = lambda: spark.readStream.schema("k string, t timestamp").parquet(src)
    for _ in range(2):
        I.append_unknown(read(), "k", str(tmp_path / "log"), str(tmp_path / f"c{_}")).awaitTermination(60)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["a", "b"]
    q = I.windowed_counts(read(), ["k"], "t", "1 hour").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {(r.k, r.n) for r in spark.table("w").collect()} == {("a", 2), ("b", 1)}
    q = I.first_seen(read(), ["k"], "t", "2 hours").writeStream.format("memory").queryName("f").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.k for r in spark.table("f").collect()) == ["a", "b"]
