"""Abusive passages."""

import math
import pickle
import random
from collections import Counter

import pytest

from loomery.llm import abuse


@pytest.fixture(scope="module")
def model(sf_dir):
    """Weights and limits from the small tables, as the query fits them."""
    import duckdb

    con = duckdb.connect()
    texts = [t for (t,) in con.execute(f"SELECT text FROM '{sf_dir}/../sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    rated = con.execute(f"SELECT text, avg(unsafe) FROM '{sf_dir}/../sf0.01/documents.parquet' JOIN '{sf_dir}/../sf0.01/doc_rating.parquet' USING (doc_id) WHERE unsafe IS NOT NULL AND text IS NOT NULL GROUP BY doc_id, text").fetchall()
    vocabulary, bad = abuse.learn(rated)
    w = weigh(vocabulary, bad, texts)
    return w, limits([w.scan(vocabulary.text(t)) for t in texts])


def weigh(vocabulary, bad, texts):
    return abuse.Weights(vocabulary, bad, vocabulary.counted(Counter(x for t in texts for row in vocabulary.text(t) for x in row)))


def limits(found):
    """What ``score`` does by grouped aggregation."""
    out = []
    for k in (1, 2):
        passages = {h: s for f in found for s, h in f[k]}
        low = sum(s < abuse.TAIL + abuse.WIDTH for f in found for s, _ in f[k])
        out.append(abuse.calibrate(Counter(int(s / abuse.BIN) * abuse.BIN for s in passages.values()), low, sum(f[0] for f in found)))
    return out


def flagged(model, text):
    w, fit = model
    n, latin, cjk = w.scan(w.vocabulary.text(text))
    return any(s >= abuse.threshold(n, *fit[k]) for k, part in enumerate((latin, cjk)) for s, _ in part)


# none of these stands in the test tables
BAD = ["You absolute moron, nobody will ever read your trash.", "Those immigrants are filthy vermin, drown them all!!!", "F*ck off you stup1d b*tch", "watch horny girls, xxx clips, n4k3d and uncensored", "Du widerliches Stück Dreck, du Hurensohn", "Eres una puta y tu madre también", "Ferme ta gueule, gros conna*rd", "Ты жалкое ничтожество, сдохни", "你这个没用的畜生，我要杀了你全家。", "色情无码，裸*体巨乳", "お前みたいなクズは死ね", "너 같은 쓰레기 새끼는 그냥 죽어버려 병신아", "Worthless Scumbag", "Verdammter Hurensohn"]
GOOD = [None, "", "  ", "The clinic offers free screening for breast cancer to women over fifty.", "The soldier was killed in the battle and buried at home.", "Kill the process before you restart the server.", "I felt so stupid after losing my keys again.", "Garbage is collected on Mondays and recycling on Fridays.", "El perro se comió la basura otra vez.", "La chatte a eu quatre chatons hier soir.", "垃圾分类从下周开始实行。", "Mon puits creux vient de Puta Ziji"]
AROUND = "The art is clean and every panel gives the kite room to breathe. "


@pytest.mark.parametrize("t", BAD)
def test_bad(model, t):
    assert flagged(model, AROUND + t + " " + AROUND)


@pytest.mark.parametrize("t", GOOD)
def test_good(model, t):
    assert not flagged(model, t)


def test_lexicon_holds_no_sentences():
    x = abuse.lexicon()
    assert max(len(f.split()) for f in x.words) <= 3 and max(map(len, x.grams)) <= 6


def test_ratings_teach_words_the_lexicon_lacks():
    r = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    plain = lambda: " ".join(r.choices(words, k=30)) + ". "
    rated = [(plain() + "you are a moronic zorblat indeed, you asshole. " + plain(), 1.0) for _ in range(20)] + [(plain() + plain(), 0.0) for _ in range(60)] + [(plain(), 1.0) for _ in range(5)]
    vocabulary, bad = abuse.learn(rated)
    assert "zorblat" in vocabulary.learned and not set(words) & set(vocabulary.learned)
    w = weigh(vocabulary, bad, [t for t, _ in rated])
    codes = vocabulary.encode(["zorblat"])
    assert w.odds[vocabulary.ids["zorblat"]] > 0 and pickle.loads(pickle.dumps(w)).scores(codes) == w.scores(codes)


def test_calibration_recovers_the_law():
    r = random.Random(2)
    words, lam = 2_000_000, 1.7
    background = [abuse.TAIL + r.expovariate(lam) for _ in range(3000)]
    bins = Counter(int(s / abuse.BIN) * abuse.BIN for s in [*background, *(r.uniform(8, 14) for _ in range(400))])
    low = sum(s < abuse.TAIL + abuse.WIDTH for s in background)
    got, k = abuse.calibrate(bins, low, words)
    assert abs(got - lam) < 0.2 and abs(k * math.exp(-got * abuse.TAIL) * words / low - 1) < 0.25
    assert abuse.threshold(100, got, k) < abuse.threshold(10_000, got, k)
    # a sentence that stands in every other text changes the rate, not the law
    assert abuse.calibrate(bins, low + 10_000, words)[0] == got


def test_held_out_ratings(sf_dir):
    """Fit on one half of the rated documents of the large table, judged by the other: two raters of one mind decide."""
    import duckdb

    con, d = duckdb.connect(), f"{sf_dir}/../sf0.1"
    rated = con.execute(f"SELECT text, avg(unsafe), count(*), doc_id FROM '{d}/documents.parquet' JOIN '{d}/doc_rating.parquet' USING (doc_id) WHERE unsafe IS NOT NULL AND text IS NOT NULL GROUP BY doc_id, text").fetchall()
    vocabulary, bad = abuse.learn([r[:2] for r in rated if r[3] % 2])
    texts = [t for (t,) in con.execute(f"SELECT text FROM '{d}/documents.parquet' WHERE text IS NOT NULL AND doc_id % 10 = 0").fetchall()]
    w = weigh(vocabulary, bad, texts)
    fit = limits([w.scan(vocabulary.text(t)) for t in texts])
    sure = [(flagged((w, fit), t), y) for t, y, n, i in rated if not i % 2 and n > 1 and y in (0, 1)]
    yes, no = [f for f, y in sure if y], [f for f, y in sure if not y]
    assert len(yes) > 10 and sum(yes) / len(yes) > 0.85 and sum(no) / len(no) < 0.1


def test_maximal_segments_equal_definition():
    r = random.Random(4)
    for _ in range(300):
        s = [r.randrange(-5, 6) for _ in range(r.randrange(1, 12))]

        def rec(a, b):
            best = max(((sum(s[i:j]), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), key=lambda x: (x[0], x[1] - x[2]), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            return rec(a, best[1]) + [best] + rec(best[2], b)

        got = sorted(v for _, _, v in abuse.maximal(s))
        assert got == sorted(x[0] for x in rec(0, len(s)))


def test_maximal_segments_in_linear_time():
    import time

    for pattern in ([1.0, -2.0], [2.0, -1.0], [1.0, -1.0, 3.0, -4.0], [1.0]):
        s = pattern * (400_000 // len(pattern))
        began = time.time()
        list(abuse.maximal(s))
        assert time.time() - began < 10


def test_long_text_is_scanned_whole(model):
    assert flagged(model, "The site lists many chapters and the last three are sketches. " * 3000 + "Fuck you, you filthy whore, you stupid asshole!")


def test_scores_and_empty_tables(spark):
    bad = "Fuck you, you filthy whore, you stupid asshole!"
    df = spark.createDataFrame([(1, bad, "s", 0.5), (2, None, "s", 0.5), (3, "", None, 0.5), (1, bad, "s", 0.5)] + [(i, AROUND * 3, "s", 0.5) for i in range(10, 60)], "doc_id long, text string, source string, score double")
    rated = spark.createDataFrame([(1, 1), (2, None), (None, 1), (9, 1)], "doc_id long, unsafe int")
    got = abuse.score(df, rated, ["source"])
    assert sorted((r.doc_id, r.passages > 0) for r in got.where("doc_id < 10").collect()) == [(1, True), (1, True), (2, False), (3, False)]
    assert {(r.source, r.documents, r.flagged, r.low < r.rate < r.high or r.rate == 0) for r in abuse.rates(got).collect()} == {("s", 53, 2, True), (None, 1, 0, True)}
    assert abuse.ratings(df, rated) == [(bad, 1.0)] * 2
    assert abuse.score(df.limit(0), rated.limit(0)).count() == 0 and abuse.score(df, None).where("passages > 0").count() == 2


def test_codes_count_what_the_scan_takes():
    v = abuse.Vocabulary([])
    text = "A letter by Puta Ziji and many more unknown words. Dreckiger Abschaum lebt hier. 你这个没用的畜生"
    c = v.counted(Counter(x for row in v.text(text) for x in row))
    assert c["puta"] == 0 and c["abschaum"] == 1 and c["畜生"] == 1 and c[abuse.CJK_ALL] == 8 and c[""] == sum(len(r) for r in abuse.tokens(text) if r[0] < "\u3040")
    w = abuse.Weights(v, Counter(), Counter())
    assert w.scan(v.text(text))[0] == c[""] + 4


def test_counts_of_the_corpus(spark, model):
    v, texts = model[0].vocabulary, [BAD[0] + " " + AROUND, BAD[8], None, " ".join(["word"] * 700)]
    rows = abuse.encoded(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), v)
    got, want = abuse.train(rows, v, Counter({"": 50, abuse.CJK_ALL: 20, "moron": 3})), weigh(v, Counter({"": 50, abuse.CJK_ALL: 20, "moron": 3}), texts)
    assert got.odds == want.odds
