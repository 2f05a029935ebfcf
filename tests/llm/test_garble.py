"""Encoding repair: chains, restoration and held-out accuracy."""

import random

import pyarrow as pa
import pytest

from loomery.llm import garble


@pytest.fixture(scope="module")
def texts(sf_dir):
    import duckdb

    rows = duckdb.connect().execute(f"SELECT detail_title FROM '{sf_dir}/page_audit.parquet' UNION SELECT snippet FROM '{sf_dir}/candidate.parquet' UNION SELECT first_chapter_title FROM '{sf_dir}/page_audit.parquet'").fetchall()
    return sorted({r[0] for r in rows if r[0] and not r[0].isascii()})


@pytest.fixture(scope="module")
def split(texts):
    random.Random(1).shuffle(texts)
    model = garble.Model.train(texts[::2])
    clean = [t for t in texts[1::2] if not garble.HARD.search(t) and not model.judge(t)[0]]
    return model, clean


def test_round_trip_of_chains():
    t = "第1话：开始阅读 Größere Träume"
    for chain in [("utf_8", "latin_1"), ("utf_8", "web1252"), ("twice", "web1252"), ("utf_8", "cp437")]:
        g = garble.garble(t, chain)
        assert g != t and garble.ungarble(g, chain) == t


@pytest.mark.parametrize("chain", [("utf_8", "latin_1"), ("utf_8", "web1252"), ("utf_8", "gbk"), ("gbk", "latin_1"), ("utf_8", "mac_roman"), ("twice", "web1252"), ("cp1251", "web1252"), ("utf_8", "cp1251")])
def test_held_out_recall(split, chain):
    model, clean = split
    some = [g for t in clean if len(t) > 8 and (g := garble.garble(t, chain)) and g != t and sum(c > "\x7f" for c in g) >= 6]
    assert len(some) > 5
    assert sum(model.judge(g)[0] for g in some) / len(some) >= 0.9


def test_restores(split):
    model, _ = split
    got = model.judge("Capítulo 5".encode().decode("latin_1"))
    assert got[0] and got[2] == "Capítulo 5"
    got = model.judge("第169话今天早上更新，还附带两张彩页".encode().decode("latin_1"))
    assert got[0] and got[2] == "第169话今天早上更新，还附带两张彩页"


def test_right_texts_stay(split):
    model, _ = split
    for t in [None, "", "plain ascii", "Größere Träume", "L'été à Évremont", "(Μικρή ιστορία)", "Ｔｈｅ Ｌａｓｔ", "ﾛﾇｲｻﾚ", "½ tome", "© 2025", "¿Qué pasó aquí?"]:
        assert model.judge(t)[0] is False, t


def test_batch_equals_single(split):
    model, clean = split
    col = pa.array([None, "", *clean[:20], "x" * 10])
    for t, s in zip(col.to_pylist(), model.batch(col)):
        assert s == pytest.approx(model.score_one(t or ""), abs=1e-3)


def test_slices_change_nothing(split, monkeypatch):
    model, clean = split
    col = pa.array([None, "", *clean[:30], "é" * 500, ""])
    whole = model.batch(col)
    for size in (1, 50, 700):
        monkeypatch.setattr(garble, "SLICE", size)
        assert model.batch(col) == pytest.approx(whole, abs=1e-3)
        assert model.batch(col.slice(3, 10)) == pytest.approx(whole[3:13], abs=1e-3)


def test_find(spark, split):
    model, _ = split
    rows = [("page_audit", 1, "detail_title", "Cap\xc3\xadtulo 5"), ("page_audit", 1, "first_chapter_title", "Capítulo 5"), ("candidate", 7, "snippet", "a�b"), ("candidate", 8, "snippet", None), ("candidate", 9, "snippet", "")]
    df = spark.createDataFrame(rows, "src string, row_id long, field string, text string")
    assert {(r.row_id, r.field) for r in garble.find(df, model).collect()} == {(1, "detail_title"), (7, "snippet")}
    assert garble.find(df.limit(0), model).count() == 0


@pytest.mark.parametrize("word,enc", [("así está", "latin_1"), ("üöß", "latin_1"), ("¿Qué pasó", "latin_1"), ("élève", "latin_1")])
def test_short_garbled_words_in_long_texts(split, word, enc):
    model, _ = split
    around = "Después de la inundación abrió una tienda pequeña según contó él después. La última página pertenecía también a aquella colección increíblemente extensa y críticamente clásica. Los capítulos continuarán próximamente según anunció públicamente la redacción. " * 3
    text = around + f"El {word.encode().decode(enc)} vino. " + around
    found, _, restored = model.judge(text)
    assert found and restored == around + f"El {word} vino. " + around
    assert model.judge(around)[0] is False


def test_lost_bytes_are_not_restored():
    assert garble.ungarble("fr�h", ("cp1251", "utf_8")) is None


def test_all_runs_are_restored(split):
    model, clean = split
    r, tried, got = random.Random(3), 0, 0
    for t in clean:
        words = t.split(" ")
        odd = [i for i, w in enumerate(words) if not w.isascii()]
        chain = r.choice([("utf_8", "latin_1"), ("utf_8", "web1252"), ("utf_8", "mac_roman"), ("utf_8", "cp437")])
        for i in {odd[0], odd[-1]}:
            words[i] = garble.garble(words[i], chain) or words[i]
        if len(odd) > 2 and "�" not in (g := " ".join(words)) and not garble.HARD.search(g):
            tried += 1
            got += model.judge(g)[2] == t
    assert tried > 20 and got / tried >= 0.9


def test_held_out_exact_restoration_by_any_chain(sf_dir):
    """Clean titles and snippets, each garbled by a chain drawn at random that can be undone."""
    import duckdb

    d = f"{sf_dir}/../sf0.01"
    rows = sorted({t for (t,) in duckdb.connect().execute(f"SELECT detail_title FROM '{d}/page_audit.parquet' UNION ALL SELECT snippet FROM '{d}/candidate.parquet'").fetchall() if t and not t.isascii()})
    r = random.Random(4)
    r.shuffle(rows)
    half = len(rows) // 2
    model = garble.Model.train(rows[:half])
    clean = [t for t in rows[half:] if not garble.HARD.search(t) and not model.judge(t)[0] and len(t) >= 12]
    tried = found = exact = 0
    for t in clean[:900]:
        chain = r.choice(garble.CHAINS)
        g = garble.garble(t, chain)
        if g and "�" not in g and garble.ungarble(g, chain) == t and sum(c > "\x7f" for c in g) > 2:
            yes, _, restored = model.judge(g)
            tried, found, exact = tried + 1, found + yes, exact + (restored == t)
    assert tried > 100 and found / tried > 0.95 and exact / tried > 0.92


def test_half_repaired_text_is_no_restored_text(split):
    model, _ = split
    lost = "第1话：" + "灯笼与龙".encode().decode("gbk", "replace") + " Cap\xc3\xadtulo"
    assert model.judge(lost)[0] and model.judge(lost)[2] is None


def test_together_equals_one_by_one(split):
    model, clean = split
    texts = [*clean[:60], *(garble.garble(t, ("utf_8", "web1252")) or t for t in clean[:60]), None, "", "plain", "Глава", "cp\u00c3\u00a9"]
    assert garble.garbled(model, pa.array(texts, pa.string())) == [model.judge(t)[0] for t in texts]


def test_every_text_is_counted(spark):
    """A corpus beyond any sample trains what its texts train when they are counted in one place."""
    import numpy as np

    rows = [f"Глава {i}: größere Träume für Köln, después del jardín" for i in range(12_000)] + ["今天的灯笼"] * 3 + ["a�b", "CapÃ­tulo 5", "plain", None]
    model = garble.train(spark.createDataFrame([(t,) for t in rows], "text string").repartition(5))
    want = garble.Model.train(rows)
    assert garble.count(spark.createDataFrame([(t,) for t in rows], "text string")).n[0] == 12_004
    assert np.array_equal(model.logs, want.logs) and np.array_equal(model.clean, want.clean) and model.letters == want.letters and model.trained == want.trained
    assert garble.train(spark.createDataFrame([], "text string")).trained


def test_counts_add_up():
    texts = ["Größere Träume für alle", "Глава первая", "今天的灯笼 und mehr"]
    whole, part, rest = garble.Counts.of(texts), garble.Counts.of(texts[:1]), garble.Counts.of(texts[1:])
    assert all((v == rest.parts[k]).all() for k, v in (whole - part).parts.items())
    assert all((v == whole.parts[k]).all() for k, v in garble.Counts.of_cells(*(c.to_numpy() for c in whole.cells().columns)).parts.items())


def test_likelihoods_together_equal_one_by_one(split):
    model, clean = split
    texts = [*clean[:20], "a", "é", "第1话"]
    assert model.likelihoods(texts) == pytest.approx([model.likelihood(t) for t in texts], abs=1e-2) and model.likelihoods([]) == []


def test_garbled_says_what_diagnose_says(split):
    model, clean = split
    r = random.Random(5)
    texts = [t for c in clean[:150] if (t := garble.garble(c, r.choice(garble.CHAINS)))] + clean[:150] + ["a�b", "Ｔｈｅ Ｌａｓｔ", "Глава", "锟斤拷锟斤拷", "café � Ã©tÃ©"]
    for t in texts:
        score = model.score_one(t)
        assert model.garbled(t, score) == model.diagnose(t, score)[0], t


def test_what_recurs_is_tried_once(split, monkeypatch):
    """Words and texts that recur are not decoded by every chain again, whatever text they stand in."""
    import pickle

    model = pickle.loads(pickle.dumps(split[0]))
    calls, decode = [], garble.decode
    monkeypatch.setattr(garble, "decode", lambda *a: calls.append(a) or decode(*a))
    texts = [f"Cap\xc3\xadtulo {i} \u2013 despu\xc3\xa9s" for i in range(40)]
    got = [model.judge(t) for t in texts[:2]]
    assert any(a[0] == b"Cap\xc3\xadtulo" for a in calls)
    calls.clear()
    got += [model.judge(t) for t in texts[2:]]
    assert [g[2] for g in got] == [f"Capítulo {i} – después" for i in range(40)]
    assert sum(a[0] == b"Cap\xc3\xadtulo" for a in calls) < 10
    again = [model.told(t, model.score_one(t)) for t in texts[:5] for _ in range(2)]
    assert again == [g for g in got[:5] for _ in range(2)] and len(pickle.dumps(model)) == len(pickle.dumps(split[0]))
    calls.clear()
    assert model.told(texts[0], model.score_one(texts[0])) == got[0] and not calls


def test_remembered_equals_afresh(split):
    """What a worker remembers changes no diagnosis."""
    import pickle

    model, clean = split
    r = random.Random(6)
    texts = [t for c in clean[:120] if (t := garble.garble(c, r.choice(garble.CHAINS)))]
    warm = pickle.loads(pickle.dumps(model))
    for _ in range(2):
        r.shuffle(texts)
        for t in texts:
            assert warm.judge(t) == pickle.loads(pickle.dumps(model)).judge(t), t


def test_parts_are_runs_words_and_odd_spans():
    import re

    r = random.Random(7)
    for _ in range(500):
        text = "".join(r.choice("ab é世ж ü-") for _ in range(r.randrange(1, 30)))
        bad = frozenset(r.sample("é世жü-a", r.randrange(3)))
        lo = r.randrange(-1, len(text))
        hi = r.randrange(lo + 1, len(text) + 2)
        want = set()
        for x, y in garble.Model._runs(text, bad):
            if x < hi and y > lo:
                want |= {text[x:y]} | {m[0] for rx in ("[^ ]+", r"[^\x00-\x7f](?:.*[^\x00-\x7f])?", r"[^\x00-\x7f]+") for m in re.finditer(rx, text[x:y]) if x + m.start() < hi and x + m.end() > lo and not m[0].isascii()}
        assert garble.Model._parts(text, bad, lo, hi) == sorted(want, key=lambda p: (-len(p), p))


def test_never_says_what_the_pattern_says():
    for c in [*map(chr, range(0x3100)), "锟斤拷", "锟斤", "锟絏", "锟", "ï¿½", "ï¿", "�", "\u7121"]:
        assert garble._never(f"a{c}b") == bool(garble._NEVER.search(f"a{c}b")), c
    assert all(garble._encodable(c, wrong) for c in map(chr, range(32, 127)) for _, wrong in garble.CHAINS)
