"""URL, text and predicate functions on inline rows."""

import pytest
from pyspark.sql import functions as F

from loomery.functions import predicates as P
from loomery.functions import text as T
from loomery.functions import urls as U


def one(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(f(*map(F.col, names)).alias("x")).first().x


@pytest.mark.parametrize(
    "url,base,want",
    [
        ("//c.x/a", "http://h/p", "http://c.x/a"), ("//c.x/a", "", "https://c.x/a"), ("/a?b=1&amp;c=2", "https://h.x/p/q", "https://h.x/a?b=1&c=2"),
        ("../z", "https://h.x/p/q/r", "https://h.x/p/z"), ("https:\\/\\/h.x\\/i", "", "https://h.x/i"), ("  ", "https://h.x", ""), ("", "", ""), (None, "https://h.x", None),
    ],
)
def test_canonical_url(spark, url, base, want):
    assert one(spark, U.canonical_url, url, base) == want


@pytest.mark.parametrize("d,want", [("m.dm5.com", "dm5.com"), ("a.b.co.jp", "co.jp"), ("x.u.github.io", "u.github.io"), ("github.io", "github.io"), ("10.0.0.1", "10.0.0.1"), ("10.0.0.1:80", "0.1:80"), ("localhost", "localhost")])
def test_registered_domain(spark, d, want):
    assert one(spark, lambda c: U.registered_domain(c, ["github.io"]), d) == want


def test_hosts(spark):
    assert one(spark, U.domain_of, "https://WWW.A.com:443/x") == "a.com:443"
    assert one(spark, lambda c: U.normalize_domain(c), "mywww.site.com") == "mywww.site.com"
    assert one(spark, lambda c: U.normalize_domain(c, True), "mywww.site.com") == "mysite.com"
    assert one(spark, U.extract_domain, "http://localhost/x") == ""
    assert one(spark, U.same_site, "https://m.a.com/", "a.com") is True
    assert one(spark, U.same_site, "https://ba.com/", "a.com") is False
    assert one(spark, U.host_of, "www.A.com/") == "a.com"
    assert one(spark, U.defragment, "u#a#b") == "u"


def test_clean_text(spark):
    assert one(spark, T.clean_text, "<b>A &amp; B</b>\n<script>x</script>") == "A & B"
    assert one(spark, T.clean_text, None) is None


def test_ids(spark):
    assert one(spark, lambda c: T.safe_id(c), "www.A-b.com") == "a_b_com_auto_public"
    assert one(spark, T.safe_id, "a.com", "https://a.com/x") == "a_com_fbffbc23_auto_public"
    assert one(spark, lambda c: T.safe_id(c), "漫画") == "generated_auto_public"
    assert one(spark, T.comic_id, "斗罗大陆") == "08bb72dfa18be95e"


def test_titles(spark):
    assert one(spark, lambda c: T.clean_title(c, "更新.*$", "完结$", ["热血"]), "灵剑热血") == "灵剑"
    assert one(spark, lambda c: T.clean_title(c, "更新.*$", "完结$", ["热血"]), "灵热血") == "灵热血"
    assert one(spark, lambda c: T.clean_title(c, "更新.*$", "完结$", ["热血"]), "A完结") == "A"
    assert one(spark, T.meta_title, "<title>t</title><h1> </h1>") == "t"
    assert one(spark, T.meta_title, "<p>only text</p>") == "only text"


@pytest.mark.parametrize("t,want", [("One", True), ("海贼王", True), ("OK", False), ("第1话", False), ("{{title}}", False), ("Chapter 3", False), ("斗罗大陆第1话", True), ("manga", False), ("异世", False)])
def test_valid_title(spark, t, want):
    f = lambda c: P.valid_title(c, placeholder="^null$", chapter_like="(?i)chapter|第[0-9]+", bare=["manga"])
    assert one(spark, f, t) is want


def test_first_hit_in_list_order(spark):
    assert one(spark, lambda c: P.first_hit(c, ["b", "a"]), "xab") == "b"
    assert one(spark, lambda c: P.first_hit(c, ["q"]), "xab") is None
    assert one(spark, lambda c: P.contains_any(c, []), "x") is False


def test_small_ones(spark):
    assert T.layered({"a": "1", "b": "1"}, {"b": "2"}, {"c": "3"}) == {"a": "1", "b": "2", "c": "3"}
    assert one(spark, lambda c: U.unwrap(c, "uddg"), "https://r.x/l/?uddg=https%3A%2F%2Fa.x%2Fb&k=1") == "https://a.x/b"
    assert one(spark, lambda c: U.unwrap(c, "uddg"), "https://a.x/b") == "https://a.x/b"
    assert one(spark, lambda c: T.meta_content(c, "name", "description"), "<meta content='d' name='description'>") == "d"
    assert one(spark, T.head_of, "<HTML><Head x>A</head>") == "a"
    assert one(spark, lambda c: U.absolutize(c, F.lit("h.x")), "/a") == "https://h.x/a"
    assert one(spark, lambda a, b: T.first_of(a, b), "", "b") == "b"


def test_join_equals_the_library(spark):
    import random
    from urllib.parse import urljoin

    r = random.Random(2)
    part = lambda: r.choice(["..", ".", "a", "b.html", "c-d", "", "e"])
    bases = [f"https://h.example{r.choice(['', '/'])}" + "/".join(part() for _ in range(r.randrange(5))) * (i % 3 > 0) + r.choice(["", "?q=1", "#f"]) for i in range(60)]
    bases = [b for b in bases if b.startswith(("https://h.example/", "https://h.example?", "https://h.example#")) or b == "https://h.example"]
    rows = [(b, r.choice(["", "/"]) + "/".join(part() for _ in range(r.randrange(1, 5))) + r.choice(["", "?x=/../2", "#g", "?y#z"])) for b in bases for _ in range(15)] + [(bases[0], u) for u in ("?only=1", "#only", "mailto:a@b", "javascript:void(0)")]
    rows = [(b, u) for b, u in rows if not (u[:1] == "/" and "//" in u)]  # there the library climbs above the root
    df = spark.createDataFrame(rows, "b string, u string")
    got = df.select("b", "u", U.join(F.col("b"), F.col("u")).alias("j")).collect()
    wrong = [(x.b, x.u, x.j, urljoin(x.b, x.u)) for x in got if x.j != urljoin(x.b, x.u)]
    assert not wrong
