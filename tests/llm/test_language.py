"""Languages of texts and passages."""

import pytest

from loomery.llm import language as L


@pytest.fixture(scope="module")
def model(sf_dir):
    import duckdb

    rows = duckdb.connect().execute(f"SELECT detail_title, lang FROM '{sf_dir}/page_audit.parquet' WHERE detail_title IS NOT NULL UNION ALL SELECT snippet, lang FROM '{sf_dir}/candidate.parquet' WHERE snippet IS NOT NULL").fetchall()
    return L.Model.train([(t, L.canonical(lab)) for t, lab in rows])


@pytest.mark.parametrize("label,want", [("zh_hans", "zh-Hans"), ("zh-CN", "zh-Hans"), ("zh-TW", "zh-Hant"), ("EN", "en"), ("English", "en"), ("deu", "de"), ("es-MX", "es"), (" ja ", "ja"), ("xx", None), ("und", None), ("auto", None), ("", None), (None, None), ("unknown", None)])
def test_labels(spark, label, want):
    from pyspark.sql import functions as F

    assert L.canonical(label) == want
    assert spark.createDataFrame([(label,)], "l string").select(L.canonical_column(F.col("l"))).first()[0] == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("The Last Garden of Babababa", {"en"}), ("Wie Diwewotu den Kessel verlor", {"de"}), ("El último jardín de Zova", {"es"}), ("Comment Hera a perdu le pont", {"fr"}), ("Мой кривой паром", {"ru"}), ("나와 지도 일기", {"ko"}), ("うつろな階段のひみつ", {"ja"}),
        ("这个网站列出了很多话", {"zh-Hans"}), ("這個網站列出了很多話", {"zh-Hant"}), ("The Last Kite of Bule Rolu 泉洞晨玉：流浪的雨伞从这里开始", {"en", "zh-Hans"}),
        ("You can read the first 20 chapters without an account. Les lecteurs réclament un volume imprimé, mais le studio attendra le printemps.", {"en", "fr"}),
        ("这个网站列出了很多话 / Inkwharf", {"zh-Hans"}), (None, set()), ("", set()), ("  ", set()), ("seed:https://a.example/list", set()), ("https://a.example/x", set()), ("12345", set()),
    ],
)
def test_languages(model, text, want):
    assert {lang for lang, _, _ in model.languages(text)} == want


def test_confidence_and_length(model):
    (lang, conf, size), = model.languages("The last garden of the old keeper. " * 3000)
    assert lang == "en" and 0.99 < conf <= 1 and size > 10_000


def test_label_cases(spark, model):
    rows = [("page_audit", 1, "The Last Garden of the Keeper", "en", "h.example"), ("page_audit", 2, "The Last Garden of the Keeper", "fr", "h.example"), ("candidate", 2, "这个网站列出了很多话", None, None), ("candidate", 3, None, "en", "h.example"), ("candidate", 4, "", None, "x"), ("candidate", 5, "Мой кривой паром", "rus", "h.example")]
    df = spark.createDataFrame(rows, "src string, row_id long, text string, label string, host string")
    priors = L.host_priors(df.select("host", "label"))
    none = lambda s, t: [False] * len(s)
    want = {("page_audit", 2, "en"), ("candidate", 2, "zh-Hans")}
    assert {(r.src, r.row_id, r.lang) for r in L.label(df, model, priors, none).collect()} == want
    # the way for more hosts than are broadcast
    assert {(r.src, r.row_id, r.lang) for r in L.label(df, model, priors, none, 1).collect()} == want
    assert L.label(df.limit(0), model, priors, none).count() == 0


def test_words_late_in_a_text_are_learnt(spark):
    df = spark.createDataFrame([(i, "the " * 150 + "zyxword " * 5, "en") for i in range(5)], "row_id long, text string, label string")
    assert "zyxword" in L.train([df]).words


def test_host_priors_are_probabilities(spark):
    df = spark.createDataFrame([("a.x", "en")] * 30 + [("b.x", "de"), ("c.y", "xx")], "host string, label string")
    p = {r.host: r for r in L.host_priors(df).collect()}
    assert {h: r.rows for h, r in p.items()} == {"a.x": 30, "b.x": 1, "c.y": 1}
    assert p["a.x"].weights[0] / p["a.x"].weight > p["b.x"].weights[0] / p["b.x"].weight
    assert all(abs(sum(r.weights) / r.weight - 1) < 1e-6 for r in p.values())


def test_own_label_is_left_out_of_the_host_prior():
    import math

    weights, weight = [1.0] * 9, 9.0
    weights[L.LANGS.index("de")] += 1  # the host's only label is this row's
    got = L.prior(weights, weight + 1, "de")
    assert got["de"] - L.DECLARED == pytest.approx(got["en"]) and sum(math.exp(v - (L.DECLARED if y == "de" else 0)) for y, v in got.items()) == pytest.approx(1)


def test_host_of_half_the_rows_stays_spread(spark, model):
    from collections import Counter

    from pyspark.sql import functions as F

    df = spark.range(8000, numPartitions=8).selectExpr("'candidate' as src", "id as row_id", "'The Last Garden of the Keeper' as text", "cast(null as string) as label", "if(id % 2 = 0, 'hot.example', concat('h', id, '.example')) as host")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = L.label(df, model, L.host_priors(df.select("host", "label")), lambda s, t: [False] * len(s), 100).withColumn("t", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes = sorted(Counter(r.t for r in got if r.row_id % 2 == 0).values())
    assert len(got) == 8000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_confidence_is_calibrated(sf_dir):
    """Heads of two words of clean titles: in each band of confidence about as many are right."""
    import duckdb

    rows = duckdb.connect().execute(f"SELECT detail_title, lang FROM '{sf_dir}/../sf0.01/page_audit.parquet' WHERE detail_title IS NOT NULL").fetchall()
    rows = [(t, L.canonical(lab)) for t, lab in rows]
    m = L.Model.train(rows[::2])
    bands: dict[int, list[int]] = {}
    for t, _ in rows[1::2]:
        whole = m.languages(t)
        head = m.languages(" ".join(t.split()[:2]))
        if len(whole) == 1 and whole[0][1] > 0.99 and len(t.split()) > 4 and head:
            bands.setdefault(int(head[0][1] * 4), []).append(head[0][0] == whole[0][0])
    share = {b: sum(v) / len(v) for b, v in bands.items() if len(v) >= 30}
    assert len(share) >= 2 and all(share[b] >= b / 4 - 0.15 for b in share) and share[max(share)] > 0.9


def test_linear_for_long_mixtures(model):
    import time

    for t in ("山 a 水 b слово " * 8000, "the last 山 le dernier 水 " * 8000, "Der letzte Garten the last garden " * 8000):
        began = time.time()
        assert model.languages(t)
        assert time.time() - began < 10


@pytest.mark.parametrize("lang,passage", [("es", "pero también nunca"), ("fr", "avec cette mais"), ("de", "nicht wenn über"), ("de", "nicht wenn über noch")])
@pytest.mark.parametrize("form", ["{p} you can read the chapters without this", "you can read {p} the chapters without this", "you can read the chapters without this {p}", "you can read, {p}, the chapters without this", "you can read '{p}' the chapters without this"])
def test_short_passages_in_every_place(form, lang, passage):
    m = L.Model.train([(s, lang) for lang, s in L.SEEDS.items()] * 40)
    assert {x for x, _, _ in m.languages(form.format(p=passage))} == {"en", lang}
    assert {x for x, _, _ in m.languages(form.format(p=" ".join(passage.split()[:1])))} == {"en"}


def test_every_row_trains(spark):
    """Rare words count in a corpus beyond any sample, which trains what its rows train when they are counted in one place."""
    rows = [(i, f"The last garden of keeper number{i % 50}", "en") for i in range(20_000)] + [(i, "el último zyxjardín del niño perdido", "es") for i in range(20_000, 20_003)] + [(30_000, "这个网站列出了很多话", "zh-CN"), (30_001, None, "en"), (30_002, "你好", None)]
    frames = [spark.createDataFrame(x, "row_id long, text string, label string").repartition(3) for x in (rows[:7], rows[7:])]
    got, want = L.train(frames), L.Model.train([(t, L.canonical(lab)) for _, t, lab in rows if t and len(t) > 8])
    assert "zyxjardín" in got.words and got.words == want.words and got.chars == want.chars and got.grams == want.grams
    assert L.train([frames[0].limit(0)]).words == L.Model.train([]).words


def test_plain_latin_texts_take_no_other_way(model, monkeypatch):
    """Texts that need no passages get what the passages give."""
    for c in map(chr, range(0x80, 0x10000)):
        if not 0xD800 <= ord(c) < 0xE000:
            m = L._TOKEN.fullmatch(c)
            assert bool(L._NOT_LATIN.fullmatch(c)) == bool(m and m.lastindex in (2, 3, 4)) and bool(L._LATIN_WORD.fullmatch(c)) == bool(m and m.lastindex == 1)
    texts = ["The Last Garden of the Old Keeper", "El último jardín, según él: www.a.example &amp; más", "theLastGardenOfTheOldKeeper", "Kova Zuni", "Wie l'été vor dem Haus. The last garden of the keeper", "Über alles! 20 °C", "a.b 第1话", "x"]
    quick = [model.languages(t, {"en": -1.0}) for t in texts]
    assert sum(model._plain_latin(t) is not None for t in texts) >= 4
    monkeypatch.setattr(L.Model, "_plain_latin", lambda self, text: None)
    for got, want in zip(quick, (model.languages(t, {"en": -1.0}) for t in texts)):
        assert [(a, n) for a, _, n in got] == [(a, n) for a, _, n in want] and [p for _, p, _ in got] == pytest.approx([p for _, p, _ in want])


def test_hosts_are_counted_once(spark):
    """The rows behind the host priors are read once, however many sums are made of them."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("a.x", "en")] * 30 + [("b.x", "de"), ("c.y", "xx")], "host string, label string").mapInArrow(look, "host string, label string")
    assert L.host_priors(df).count() == 3 and seen.value == 32


def test_texts_of_one_script_take_no_other_way(model, monkeypatch):
    """Texts in one script get what the walk through all tokens gives; a text in its label's language alone yields nothing where that is asked for."""
    import random
    import re

    for c in map(chr, range(0x80, 0x10000)):
        if not 0xD800 <= ord(c) < 0xE000:
            kind = m.lastindex if (m := L._TOKEN.fullmatch(c)) else None
            letter = L._LETTER.fullmatch(c)
            assert bool(L._NOT_HAN.fullmatch(c)) == (kind in (1, 2, 3)) and bool(letter) == (kind in (1, 2, 3, 4)) and bool(L._HAN_PART.fullmatch(c)) == (kind == 4)
            for k, lang in ((2, "ru"), (3, "ko")):
                words, others = L._ALONE[lang]
                assert (letter is not None and letter.lastindex == k - 1) == bool(words.fullmatch(c)) == (kind == k) and (kind == k or bool(others.fullmatch(c)) == (kind in (1, 2, 3, 4)))
            assert bool(L._LATIN_END.fullmatch(c)) == (kind == 5) and (c in L._SMALL_END) == (kind == 7) and bool(L._HAN_END.fullmatch(c)) == (kind in (5, 6))
    rng = random.Random(3)
    ends = [" ", " ", " ", ", ", ". ", " - ", "  – ", "'", "(", "\n", "12", "　", "・", "·", "@"]
    words = [L.SEEDS[x].split() for x in L.LATIN] + [list("山水這个這国國的ꀀ\ue000"), ["これ", "は", "本", "カタ", "国"], ["слово", "и", "дом"], ["한국", "어", "글"], ["theLastGardenOfThe", "l’été", "mixed слово", "山 a"]]
    texts = ["".join(x for w in rng.choices(rng.choice(words) + rng.choice(words) * rng.randint(0, 1), k=rng.randint(1, 12)) for x in (w, rng.choice(ends))) for _ in range(3000)]
    priors = [{"en": -1.0}, {"ja": -2.0, "de": 0.5}]
    every = lambda t: (model.pieces(t), [(lang, round(x, 9), n) for p in priors for lang, x, n in model.languages(t, p)])
    quick = [every(t) for t in texts]
    for t in texts:
        for lang in ("ru", "en", "ja"):
            got = model.languages(t, priors[0])
            assert model.languages(t, priors[0], lang) == ([] if [x for x, _, _ in got] == [lang] else got)
    for name in ("_alone", "_single"):
        monkeypatch.setattr(L.Model, name, staticmethod(lambda x: None))
    for name in ("_NOT_HAN", "_NOT_LATIN"):
        monkeypatch.setattr(L, name, re.compile(""))
    assert quick == [every(t) for t in texts]
