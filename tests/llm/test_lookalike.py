"""Plain forms of look-alike texts."""

import pytest

from loomery.llm import garble, lookalike

PLAIN = ["", "The Last Well", "你好，世界！（一）", "第1話　夜", "🏳️‍🌈 ok", "👨‍👩‍👧", "1️⃣ ok", "(Μικρή ιστορία) here", "Пати а сор", "№ 5 ℃ ½ ²", "a\tb\nc", "«Как» он", "Señor Búho", "x" * 50_000, "〈a〉 \u2329b\u232a", "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ", "ㅋㅋㅋ", "n.º 1ª ① ™ µm ℹ️ ſo", "ภาษาไทย น้ำ"]
ODD = {
    "Juli​ Lalo": "Juli Lalo", "Julі Lalo у el jardín torсidο": "Juli Lalo y el jardín torcido", "ｔｈｅ １２": "the 12", "ｶﾗｰﾍﾟｰｼﾞ": "カラーページ", "⽇峰": "日峰", "Its расе is slow": "Its pace is slow",
    "Габo Йоби кoмпас": "Габо Йоби компас", "étude": "étude", "a b c": "a b c", "No　tesuko": "No tesuko", "ﬁn": "fin", "sho\xadrt": "short", "가": "가", "Kɑteѕ": "Kates", "x" * 50_000 + "​": "x" * 50_000,
    "Ⅷ ⅻ": "VIII xii", "ﬅop ﬆ": "stop st", "ﺍﻟﻌﺮﺑﻴﺔ": "العربية", "ﷺ": "صلى الله عليه وسلم", "ᴄᴀꜱᴇ"[:2] + "t": "cat", "ᎪᏟe": "ACe", "𝓣𝔥𝕖": "The", "Ǆ": "DŽ",
}


def test_plain_stays():
    assert lookalike.plain_texts([*PLAIN, None]) == [*PLAIN, None]


def test_odd_becomes_plain():
    assert dict(zip(ODD, lookalike.plain_texts(list(ODD)))) == ODD


def test_plain_form_is_stable():
    once = lookalike.plain_texts(list(ODD))
    assert lookalike.plain_texts(once) == once


def test_find_leaves_out_garbled_and_plain(spark):
    model = garble.Model.train(["Größere Träume für alle", "Después de la inundación", "Capítulo 3: el jardín", "今天的灯笼", "Глава первая"] * 3)
    rows = [("page_audit", 1, "Juli​ Lalo"), ("page_audit", 2, "plain"), ("candidate", 2, None), ("candidate", 3, ""), ("candidate", 4, "Juli​ Lalo"), ("candidate", 5, "Gr\xc3\xb6\xc3\x9fere\xa0Tr\xc3\xa4ume")]
    df = spark.createDataFrame(rows, "src string, row_id long, text string")
    assert {(r.src, r.row_id) for r in lookalike.find(df, model).collect()} == {("page_audit", 1), ("candidate", 4)}
    assert lookalike.find(df.limit(0), model).count() == 0


def test_normalize_keeps_every_row(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "ａ", "z"), (1, "ａ", "y"), (2, None, "x")], "plain long, t string, text string")
    out = lookalike.normalize(df.withColumnRenamed("plain", "id"), ["id"], F.col("t")).collect()
    assert sorted((r.id, r.text, r.plain) for r in out if r.text) == [(1, "ａ", "a")] * 2 and len(out) == 3


@pytest.mark.parametrize("text", list(ODD))
def test_prefilter_misses_nothing(text):
    import pyarrow as pa

    assert lookalike.suspects(pa.array([text])).to_pylist() == [True]


def test_mask_and_statement_agree_over_all_of_unicode():
    import unicodedata

    import pyarrow as pa

    chars = [c for c in map(chr, range(0x20, 0x110000)) if unicodedata.category(c) not in ("Cs", "Co", "Cn")]
    for around in ("{}", "a{}b", "д{}ж"):
        texts = [around.format(c) for c in chars if around == "{}" or not unicodedata.name(c, "").startswith(("CJK UNIFIED", "HANGUL SYLLABLE", "TANGUT", "EGYPTIAN", "CUNEIFORM"))]
        for at in range(0, len(texts), 20_000):
            part = texts[at : at + 20_000]
            changed = [p != t for p, t in zip(lookalike.plain_texts(part), part)]
            odd = lookalike.suspects(pa.array(part)).to_pylist()
            assert not [t for t, c, o in zip(part, changed, odd) if c and not o]


def test_nothing_is_spilled_to_disk():
    assert lookalike.connect().execute("SELECT current_setting('temp_directory')").fetchone() == ("",)
