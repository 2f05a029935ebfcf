"""Leaked evaluation passages against brute force."""

import random

from loomery.llm import leaks

EN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ZH = "如果银色的渡船带着九百袋谷物离开井野湖霞，回来时只剩一半，那么金霞塔江用多少袋"


def grams(text, letters):
    return {g for g, _, _ in leaks.windows(text, letters)}


def frames(spark):
    items = spark.createDataFrame([(1, "en", "t", EN), (2, "zh-Hans", "t", ZH), (3, "en", "t", "too short"), (4, "de", "t", EN.upper()), (5, None, "t", None)], "item_id long, lang string, task string, text string")
    docs = [(1, "x " + EN[: EN.index(" thirteen")].upper().replace(" ", ",  ") + " y"), (2, EN[: EN.index(" twelve")]), (3, "前" + ZH[3:34].replace("，", " ")), (4, ZH[:20]), (5, None), (6, ""), (7, "x " + EN + " y"), (7, "x " + EN + " y"), (8, "one " + EN.replace(" ", " something "))]
    return spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, item_id string"), items


def test_both_ways_equal_brute_force(spark):
    docs, items = frames(spark)
    want = set()
    for d in docs.collect():
        for i in items.collect():
            zh = (i.lang or "").startswith("zh")
            if grams(i.text, zh) & grams(d.text, zh):
                want.add((d.doc_id, i.item_id))
    assert want == {(1, 1), (1, 4), (3, 2), (7, 1), (7, 4)}
    for most in (leaks.MOST, 1):
        assert {(r.doc_id, r.item_id) for r in leaks.find(docs, items, most).collect()} == want
    assert leaks.find(docs.limit(0), items).count() == 0 and leaks.find(docs, items.limit(0)).count() == 0


def test_shortest_words(spark):
    items = spark.createDataFrame([(1, "en", "t", "a b c d e f g h i j k l")], "item_id long, lang string, task string, text string")
    docs = spark.createDataFrame([(1, "A B C D E F G H I J K L"), (2, "a b c d e f g h i j k")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in leaks.find(docs, items).collect()] == [(1, 1)]


def test_scrub_both_ways(spark):
    docs, items = frames(spark)
    more = spark.createDataFrame([(9, "İstanbul'da " + ZH + " İyi"), (9, "other text of the same id"), (10, "İ " + EN + " İ"), (None, EN)], "doc_id long, text string").selectExpr("*", "'c' as item_id")
    docs = docs.unionByName(more)
    got = sorted(((r.doc_id, r.text, r.removed) for r in leaks.scrub(docs, items).collect()), key=str)
    assert got == sorted(((r.doc_id, r.text, r.removed) for r in leaks.scrub(docs, items, 1).collect()), key=str)
    at = {(i, n > 0): (t, n) for i, t, n in got}
    assert at[7, True] == ("x  y", len(EN)) and at[2, False] == (EN[: EN.index(" twelve")], 0) and at[5, False] == (None, 0) and at[None, True] == ("", len(EN))
    assert at[3, True][1] > 20 and at[9, True] == ("İstanbul'da  İyi", len(ZH)) and at[10, True] == ("İ  İ", len(EN)) and (9, False) in at
    assert len(got) == docs.count()


def test_places_of_windows():
    text = "İİ one, two THREE four five six seven eight nine ten eleven twelve İ"
    (g1, a, b), *_ = [w for w in leaks.windows(text, False) if w[0].startswith("one")]
    assert text[a:b] == text[text.index("one") : text.rindex("twelve") + 6] and g1.split()[2] == "three"
    for g, a, b in leaks.windows("前" + ZH + "İ1", True):
        assert "".join(w for w, _, _ in leaks.words_of(("前" + ZH + "İ1")[a:b])) == g


def test_random_windows():
    r = random.Random(5)
    words = [r.choice("abcdefgh") * 3 for _ in range(300)]
    item = " ".join(words[100:140])
    g = leaks.Grams([(1, False, w) for w in grams(item, False)])
    for _ in range(50):
        a = r.randrange(0, 280)
        text = "; ".join(words[a : a + 20])
        assert set().union(*g.find(text).values()) == grams(text, False) & grams(item, False)
