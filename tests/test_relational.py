"""Order-aware operators against small loops."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomery.operators import relational as R

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "", None]), st.integers(0, 9)), max_size=20))
def test_first_wins(spark, data):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(data)], "k string, o int, v int")
    want = {}
    for k, v in data:
        if k:
            want.setdefault(k, v)
    assert {r.k: r.v for r in R.first_wins(df, ["k"], "o").collect()} == want


@few
@given(st.lists(st.booleans(), max_size=25), st.integers(1, 3))
def test_streak_cut(spark, bad, n):
    df = spark.createDataFrame([("g", i, b) for i, b in enumerate(bad)], "g string, o int, b boolean")
    want, run = [], 0
    for i, b in enumerate(bad):
        want.append(i)
        run = run + 1 if b else 0
        if run >= n:
            break
    assert sorted(r.o for r in R.streak_cut(df, ["g"], "o", F.col("b"), n).collect()) == want


@few
@given(st.integers(0, 30), st.lists(st.integers(-1, 6), min_size=1, max_size=4))
def test_round_robin(spark, items, rooms):
    left, at, want = list(rooms), 0, []
    for i in range(items):
        for _ in range(len(left)):
            k = at % len(left)
            at += 1
            if left[k] > 0:
                left[k] -= 1
                want.append((i, k))
                break
    it = spark.createDataFrame([(i * 3,) for i in range(items)], "i long")
    bins = spark.createDataFrame([(k, r) for k, r in enumerate(rooms)], "b int, room int")
    assert sorted((r.i // 3, r.b) for r in R.round_robin(it, "i", bins, "room", "b").collect()) == want


def test_numbered_is_exact(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("o"))
    got = [(r.o, r.rn) for r in R.numbered(df, "o").orderBy("o").collect()]
    assert [n for _, n in got] == list(range(1, 5001))


def test_cascade_fill(spark):
    rows = [("q", 1, 1, "a"), ("q", 1, 2, "b"), ("q", 2, 1, "a"), ("q", 2, 2, "c"), ("q", 3, 1, "d")]
    df = spark.createDataFrame(rows, "q string, p int, r int, k string")
    assert [(r.k, r.place) for r in R.cascade_fill(df, "q", "p", "r", "k", 3).orderBy("place").collect()] == [("a", 1), ("b", 2), ("c", 3)]


def test_without_tokens_both_ways(spark):
    df = spark.createDataFrame([("spamhost",), ("good",), (None,), ("xx",)], "t string")
    tokens = spark.createDataFrame([("spam",), ("zzz",)], "w string")
    few_way = {r.t for r in R.without_tokens(df.where("t is not null"), "t", tokens, "w").collect()}
    many_way = {r.t for r in R.without_tokens(df.where("t is not null"), "t", tokens, "w", limit=1).collect()}
    assert few_way == many_way == {"good", "xx"}
    both = [{r.t for r in R.with_tokens(df.where("t is not null"), "t", tokens, "w", limit=n).collect()} for n in (2000, 1)]
    assert both == [{"spamhost"}] * 2


def test_short_tokens_and_nulls_both_ways(spark):
    texts = ["abc", "xyz", "李小龍傳", "王五", "q", "", None, "spamhost"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for words, hits in ((["bc", "小龍", "q", "spam", "", None], {"abc", "李小龍傳", "q", "spamhost"}), (["bc", "五"], {"abc", "王五"}), (["spam", "host"], {"spamhost"})):
        tokens = spark.createDataFrame([(w,) for w in words], "w string")
        for limit in (2000, 1):
            assert [r.t for r in R.with_tokens(df, "t", tokens, "w", limit).orderBy("t").collect()] == sorted(hits)
            assert [r.t for r in R.without_tokens(df, "t", tokens, "w", limit).orderBy("t").collect()] == sorted({t for t in texts if t is not None} - hits)
    none = spark.createDataFrame([], "w string")
    assert R.without_tokens(df, "t", none, "w").count() == len(texts) - 1 and R.with_tokens(df, "t", none, "w").count() == 0


def test_merge_and_latest(spark):
    a = spark.createDataFrame([("x", 1), ("y", None)], "k string, v int")
    b = spark.createDataFrame([("y", 2), ("z", 3)], "k string, v int")
    assert {(r.k, r.v) for r in R.merge_keyed(a, b, ["k"], ["v"]).collect()} == {("x", 1), ("y", 2), ("z", 3)}
    c = spark.createDataFrame([("x", 1, "old"), ("x", 2, "new")], "k string, o int, v string")
    assert R.latest(c, ["k"], "o").first().v == "new"


def test_running_sum_and_places_in_many_ranges(spark, monkeypatch):
    import random

    r = random.Random(1)
    monkeypatch.setattr(R, "RANGE_BYTES", 1)
    monkeypatch.setattr(R, "MOST_RANGES", 40)
    rows = [(r.randrange(5), f"h{i:04d}") for i in range(700)]
    df = spark.createDataFrame(rows, "n long, host string")
    got = {x.host: (x.total, x.place) for x in R.numbered(R.running(df, [F.desc("n"), F.col("host")], F.col("n"), "total"), [F.desc("n"), F.col("host")], "place").collect()}
    total = 0
    for place, (n, host) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1])), 1):
        total += n
        assert got[host] == (total, place)
    assert R.numbered(df.limit(0), "host").count() == 0


def test_streaks_against_brute_force(spark):
    import random

    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), i, r.random() < 0.6) for i in range(400)] + [("hot", 1000 + i, None if i % 7 else True) for i in range(50)]
    want = set()
    for g in {x[0] for x in rows}:
        run = 0
        for _, o, bad in [x for x in rows if x[0] == g]:
            want.add(o)
            run = run + 1 if bad else 0
            if run == 3:
                break
    got = R.streak_cut(spark.createDataFrame(rows, "g string, o long, bad boolean"), ["g"], "o", F.col("bad"), 3).collect()
    assert {x.o for x in got} == want and len(got) == len(want)


def test_chains_end_at_cycles_and_at_the_limit(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", None), ("s", "s")] + [(f"n{i}", f"n{i + 1}") for i in range(20)], "page string, next string")
    starts = spark.createDataFrame([(1, "a"), (2, "x"), (3, "s"), (4, "n0"), (5, "lone")], "id int, page string")
    got = {}
    for r in R.follow(starts, links, "id", "page", "next", 5).orderBy("step").collect():
        got.setdefault(r.id, []).append(r.page)
    assert got == {1: ["a", "b", "c"], 2: ["x", "y"], 3: ["s"], 4: [f"n{i}" for i in range(5)], 5: ["lone"]}
