"""HTML operators on inline pages."""

from pyspark.sql import functions as F

from loomery.operators import html as H

PAGE = """<html><head><title>T</title><meta content="/c.jpg" property="og:image"></head><body><script>var a = "<a href='x'>";</script>
<a class=x href="/s/1" title="Work &amp; One"><img src="/t.png"></a><a href='../z'>Chapter 2</a> <a href="https://o.example/chapter-3#x"><b>Ch</b></a>
<img srcset="/a.webp 1x, /b.webp 2x"><noscript><img src="/n.jpg"></noscript></body></html>"""


def test_anchors_and_images(spark):
    df = spark.createDataFrame([(1, PAGE, "https://h.example/p/q/r"), (2, "", "https://h.example"), (3, None, None)], "id long, html string, base string")
    got = {(r.pos, r.url, r.text) for r in H.anchors(df, "html", "base").where("id = 1").collect()}
    assert got == {(0, "https://h.example/s/1", ""), (1, "https://h.example/p/z", "Chapter 2"), (2, "https://o.example/chapter-3#x", "Ch")}
    assert {r.image for r in H.images(df, "html", "base", "logo").collect()} == {"https://h.example/t.png", "https://h.example/n.jpg", "https://h.example/a.webp", "https://h.example/b.webp"}
    assert df.where("id = 1").select(H.cover(F.col("html"), "logo").alias("c")).first().c == "/c.jpg"


def test_chapters(spark):
    df = spark.createDataFrame([(1, PAGE, "https://h.example/p/q/r")], "id long, html string, base string")
    got = H.chapters(df, "id", "html", "base", chapter="(?i)chapter", noise="Free", exclude="/list").orderBy("rank").collect()
    assert [(r.url, r.rank) for r in got] == [("https://h.example/p/z", 1), ("https://o.example/chapter-3", 2)]


def test_catalog_links_look_back(spark):
    page = '<img src="/cover.png"><p>x</p><a href="/comic/1">One</a>' + " " * 600 + '<a href="/comic/2" title="Two"></a>'
    df = spark.createDataFrame([(1, page), (2, None)], "id long, html string")
    assert [(r.href, r.title, r.cover) for r in H.catalog_links(df, "id", "html", "/comic/").orderBy("pos").collect()] == [("/comic/1", "One", "/cover.png"), ("/comic/2", "Two", None)]


def test_rules_of_rows(spark):
    df = spark.createDataFrame([(1, "<i>a</i><b>c</b>", "<i>(.)</i>|<b>(.)</b>", [1, 2]), (2, "x", "(", [1]), (3, "x", None, None)], "id long, html string, p string, g array<int>")
    assert [(r.id, r.pos, r.value) for r in H.by_rule(df, "id", "html", "p", "g").orderBy("pos").collect()] == [(1, 0, "a"), (1, 1, "c")]


def test_more_rules_than_are_held(spark):
    n = 10_050
    df = spark.range(0, n, 1, 1).select("id", F.concat(F.lit("<i>"), F.col("id"), F.lit("</i>")).alias("html"), F.concat(F.lit("<i>("), F.col("id"), F.lit(")</i>")).alias("p"), F.array(F.lit(1)).alias("g"))
    got = H.by_rule(df, "id", "html", "p", "g").collect()
    assert len(got) == n and all(r.value == str(r.id) for r in got)


def test_rules_of_many_rows_and_stages(spark, monkeypatch):
    monkeypatch.setattr(H, "MOST_PATTERNS", 3)  # more rules than a task remembers
    page = '<a href="/c/1">One</a><img src="x.png"><a href="/c/2"></a>'
    rows = [(i, page if i % 7 else None, [("detail", f'(?#{i})<a href="([^"]*)">([^<]*)', [1], [2]), ("reader", 'src="([^"]*)"', [1, 9], None), ("broken", "(", [1], []), (None, None, None, None)]) for i in range(40)] + [(99, page, None)]
    df = spark.createDataFrame(rows, f"id long, html string, rules {H.RULES}")
    got = {(r.id, r.stage, r.pos, r.url, r.title) for r in H.by_stages(df, "id", "html", "rules").collect()}
    assert got == {x for i in range(40) if i % 7 for x in ((i, "detail", 0, "/c/1", "One"), (i, "detail", 1, "/c/2", None), (i, "reader", 0, "x.png", None))}
