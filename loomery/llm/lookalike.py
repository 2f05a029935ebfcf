"""One plain form for texts that look the same but are spelled with other characters.

DuckDB runs inside each Arrow partition: one embedded SQL statement maps compatibility forms, blanks,
invisible characters and look-alike letters with ``translate``, regular expressions and
``nfc_normalize``. A word that mixes scripts is written in the script of its unmistakable letters.

Compatibility forms are those of letters and digits in another dress (width, script style, position in the word, ligatures, Roman
numerals, radicals, small capitals), by rule over all of Unicode. Left as they are: punctuation of any form, tabs and line breaks, the ideographic space in Chinese or
Japanese text, joiners inside emoji sequences, ordinary signs
(among them raised, circled and squared ones, fractions and units), spacing jamo, words wholly in another script.
Defined results: null stays null, empty stays empty, a plain text is returned byte for byte; very
long texts go through the same statement; repeated rows get equal answers.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Look-alikes of Latin letters: Cyrillic, Greek, then what is none of the corpus's letters in any text.
CYRILLIC = ("асеорхуіјѕһԁԛԝгкмнтвзпАВСЕНІЈКМОРЅТХУԌԜԚҮҺ", "aceopxyijshdqwrkmhtb3nABCEHIJKMOPSTXYGWQYh")
GREEK = ("ονρικατυχωςϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ", "ovpikatuxwccjABEZHIKMNOPTYXC")
#: Cherokee capitals; they count only in words that hold Latin letters.
CHEROKEE = ("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ", "ABCDEHJKLMPRSTVWZ")
ALWAYS = ("\u0251\u0261\u0131\u0269\u029f\u057d\u0585\u0578\u0570\u0581\u050d", "agiiluonhgg")
#: Cyrillic and Greek letters that look like no other in print; a word holding one is a true word of its script.
_CYR_SAME = "асеорхуіјѕһԁԛԝАВСЕНІЈКМОРЅТХУԌԜԚҮҺ"
_GRK_SAME = "ονρϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ"
_BLANKS = "\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "  ⠀"
_UNSEEN = r"[\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF9}-\x{FFFB}\x{E0000}-\x{E007F}\x{E0100}-\x{E01EF}\x{1D173}-\x{1D17A}]"
_EMOJI = r"[#*0-9\x{A9}\x{AE}\x{203C}-\x{2BFF}\x{3030}\x{303D}\x{3297}\x{3299}\x{1F000}-\x{1FAFF}\x{FE0F}\x{20E3}\x{E000}\x{E001}]"


#: Kinds of compatibility decomposition that only change a letter's or digit's dress; of the unnamed kind, ligatures, pairs, Roman numerals and radicals.
_DRESS = {"font", "wide", "narrow", "initial", "medial", "final", "isolated"}
_PAIRS = ((0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2160, 0x217F), (0x2E80, 0x2FD5), (0xFB00, 0xFB17), (0xFB4F, 0xFB4F))
#: An ordinary sign that Unicode counts among the letters.
_SIGNS = "\u2139"


@lru_cache(maxsize=1)
def forms() -> dict[str, str]:
    """Compatibility forms and their plain letters and digits, by rule over all of Unicode; sound marks and blanks."""
    out = {}
    for c in map(chr, range(0xA0, 0x30000)):
        kind = unicodedata.decomposition(c)
        if kind[:1] == "<" and c not in _SIGNS and (unicodedata.category(c)[0] in "LN" or unicodedata.category(c) == "So"):
            kind = kind[1 : kind.index(">")]
            if (kind in _DRESS and unicodedata.category(c) != "So") or (kind == "compat" and any(a <= ord(c) <= b for a, b in _PAIRS)):
                out[c] = unicodedata.normalize("NFKC", c)
    for c, name in ((c, unicodedata.name(c, "")) for c in map(chr, range(0x1D00, 0x1D23))):
        if name.startswith("LATIN LETTER SMALL CAPITAL ") and len(name) == 28:
            out[c] = name[-1].lower()
    return out | {"ﾞ": "゙", "ﾟ": "゚"} | dict.fromkeys(_BLANKS, " ")  # sound marks, to be joined by NFC


@lru_cache(maxsize=1)
def singles() -> tuple[str, str]:
    """Forms that stand for one character."""
    kept = {c: d for c, d in forms().items() if len(d) == 1}
    return "".join(kept), "".join(kept.values())


def _ranges(chars) -> str:
    """Inside of a RE2 class that holds the characters."""
    out: list[list[int]] = []
    for cp in sorted(set(map(ord, chars))):
        if out and cp == out[-1][1] + 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "".join(rf"\x{{{a:X}}}" if a == b else rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in out)


@lru_cache(maxsize=1)
def kept_signs() -> str:
    """Punctuation and signs that composition would change; they are set aside (as noncharacters) and stay as they are."""
    return "".join(c for c in map(chr, range(0xA0, 0x3000)) if unicodedata.normalize("NFC", c) != c and unicodedata.category(c)[0] in "PS")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@lru_cache(maxsize=1)
def statement() -> str:
    """SQL over table ``batch`` (its last column is ``text``) that adds ``plain``."""
    compat = singles()
    several = {c: d for c, d in forms().items() if len(d) > 1}
    spelled = f"MAP {{{', '.join(f'{quoted(c)}: {quoted(d)}' for c, d in several.items())}}}"
    aside = "".join(map(chr, range(0xFDD0, 0xFDD0 + len(kept_signs()))))
    latin = r"\p{Latin}"
    others = CYRILLIC[0] + GREEK[0]
    like = CYRILLIC[1] + GREEK[1]
    back = str.maketrans("aceopxyABCEHKMOPTXYi", "асеорхуАВСЕНКМОРТХУі")
    to_cyr = ("aceopxyABCEHKMOPTXYisjh", "aceopxyABCEHKMOPTXYisjh".translate(back).translate(str.maketrans("sjh", "ѕјһ")))
    greek_only = ("".join(c for c in GREEK[0] if c not in "ϲϳϹ"), "".join(d for c, d in zip(*GREEK) if c not in "ϲϳϹ"))
    # RE2 has no class difference: spell the complement through ranges
    true_cyr = "[" + "".join(c for c in map(chr, range(0x400, 0x530)) if c.isalpha() and c not in _CYR_SAME) + "]"
    true_grk = "[" + "".join(c for c in map(chr, range(0x370, 0x400)) if c.isalpha() and c not in _GRK_SAME) + r"\x{1F00}-\x{1FFF}]"
    all_same = rf"^[{_CYR_SAME}{_GRK_SAME}]+$"
    foreign = rf"[\p{{Cyrillic}}\p{{Greek}}{ALWAYS[0]}{CHEROKEE[0]}]"
    return rf"""
WITH
 bare AS (SELECT *, text AS t0 FROM batch),
 joined AS (SELECT *, CASE WHEN regexp_matches(t0, '{_UNSEEN}') THEN
   translate(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t0,
     '({_EMOJI})\x{{FE0F}}', '\1' || chr(57345), 'g'), '({_EMOJI})\x{{200D}}({_EMOJI})', '\1' || chr(57344) || '\2', 'g'),
     '({_EMOJI})\x{{200D}}({_EMOJI})', '\1' || chr(57344) || '\2', 'g'),
     '{_UNSEEN}', '', 'g'), chr(57344) || chr(57345), chr(8205) || chr(65039)) ELSE t0 END AS s0 FROM bare),
 mapped AS (SELECT *, nfc_normalize(translate(CASE WHEN contains(s0, chr(12288)) AND NOT regexp_matches(s0, '[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}]') THEN replace(s0, chr(12288), ' ') ELSE s0 END,
     {quoted(compat[0] + kept_signs())}, {quoted(compat[1] + aside)})) AS s1 FROM joined),
 tied AS (SELECT *, translate(CASE WHEN regexp_matches(s1, '[{_ranges(several)}]') THEN nfc_normalize(array_to_string(list_transform(string_split(s1, ''), lambda c: coalesce(element_at({spelled}, c)[1], c)), '')) ELSE s1 END,
     {quoted(aside)}, {quoted(kept_signs())}) AS s2 FROM mapped),
 cutup AS (SELECT *, CASE WHEN regexp_matches(s2, '{latin}') AND regexp_matches(s2, '{foreign}') OR regexp_matches(s2, '[{ALWAYS[0]}ѕіјһϲ]')
     THEN regexp_extract_all(s2, '[\p{{L}}\p{{M}}]+|[^\p{{L}}\p{{M}}]+') END AS w FROM tied),
 judged AS (SELECT *, regexp_matches(s2, '{true_cyr}') AS has_cyr, regexp_matches(s2, '{true_grk}') AS has_grk FROM cutup),
 fixed AS (SELECT *, CASE WHEN w IS NULL THEN s2 ELSE array_to_string(list_transform(w, lambda x, i:
     CASE WHEN NOT regexp_matches(x, '{foreign}') THEN x
          WHEN regexp_matches(x, '{true_grk}') AND NOT regexp_matches(x, '{latin}') THEN x
          WHEN regexp_matches(x, '{true_cyr}') AND NOT regexp_matches(x, '[{ALWAYS[0]}]') THEN
               CASE WHEN regexp_matches(x, '{latin}') OR regexp_matches(x, '[ѕјһϲ]') THEN translate(x, {quoted(to_cyr[0])}, {quoted(to_cyr[1])}) ELSE x END
          WHEN regexp_matches(x, '{latin}') THEN translate(x, {quoted(others + ALWAYS[0] + CHEROKEE[0])}, {quoted(like + ALWAYS[1] + CHEROKEE[1])})
          WHEN regexp_matches(x, '[ѕіјһԁԛԝϲϳ]') AND NOT regexp_matches(x, '{true_cyr}') THEN translate(x, {quoted(others)}, {quoted(like)})
          WHEN regexp_matches(x, '{all_same}') AND ((regexp_matches(x, '[{_CYR_SAME}]') AND NOT has_cyr) OR (regexp_matches(x, '[{_GRK_SAME}]') AND NOT has_grk)
               OR (i > 2 AND regexp_matches(w[i - 2], '^{latin}') AND (i + 2 > len(w) OR regexp_matches(w[i + 2], '^{latin}')))) THEN translate(x, {quoted(others)}, {quoted(like)})
          ELSE x END), '') END AS plain FROM judged)
SELECT * EXCLUDE (t0, s0, s1, s2, w, has_cyr, has_grk, text) FROM fixed
"""


@lru_cache(maxsize=1)
def odd() -> str:
    """What can make a text other than plain by itself (RE2, one automaton pass), out of the statement's own tables; no other text needs it."""
    composed = [c for c in map(chr, range(0xA0, 0x30000)) if not 0xD800 <= ord(c) < 0xE000 and unicodedata.normalize("NFC", c) != c]
    jamo = map(chr, [*range(0x1100, 0x1200), *range(0xA960, 0xA980), *range(0xD7B0, 0xD800)])
    return f"[{_ranges([*forms(), *composed, *jamo, *ALWAYS[0], *'ѕіјһԁԛԝϲϳ'])}{_UNSEEN[1:-1]}" + r"\p{M}]"


def suspects(col: pa.Array) -> pa.Array:
    """Rows (as a mask) that may not be plain: odd characters, Latin beside Cyrillic, Greek or Cherokee letters, an ideographic space without Han or kana."""
    has = lambda p: pc.fill_null(pc.match_substring_regex(col, p), False)
    mixed = pc.and_(has(r"[\p{Cyrillic}\p{Greek}\p{Cherokee}]"), has(r"\p{Latin}"))
    spaced = pc.and_(has(r"\x{3000}"), pc.invert(has(r"[\p{Han}\p{Hiragana}\p{Katakana}]")))
    return pc.or_(pc.or_(has(odd()), mixed), spaced)


def connect() -> duckdb.DuckDBPyConnection:
    return duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})  # nothing is spilled to a worker's disk


@lru_cache(maxsize=1)
def _shared() -> duckdb.DuckDBPyConnection:
    return connect()  # one per worker process


def plain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose last column is ``text`` → the same with ``plain`` in its place."""
    con = _shared()
    for batch in batches:
        if not batch.num_rows:
            continue
        con.register("batch", pa.Table.from_batches([batch]))
        out = con.sql(statement()).to_arrow_table()
        yield from out.to_batches()


def normalize(df: DataFrame, key: list[str], text: Column) -> DataFrame:
    """(key columns, text, plain): every row, with its text and the plain form."""
    own = df.select(*key, text.alias("kept"), text.alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-2])
    out = own.mapInArrow(plain_batches, f"{kinds}, kept string, plain string")
    return out.withColumnRenamed("kept", "text")


def plain_texts(texts: list[str | None]) -> list[str | None]:
    """Plain forms of a short list, in its order."""
    if not texts:
        return []
    got = pa.Table.from_batches(plain_batches(iter([pa.record_batch({"i": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})])))
    return got.sort_by("i")["plain"].to_pylist()


def find(df: DataFrame, model) -> DataFrame:
    """df(src, row_id, text) → rows whose text isn't plain and isn't wrongly decoded, with the plain form."""
    from .garble import garbled

    held = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        con = _shared()
        for batch in batches:
            batch = batch.filter(suspects(batch.column(2)))
            if not batch.num_rows:
                continue
            con.register("batch", pa.Table.from_batches([pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(2)], names=["src", "row_id", "kept", "text"])]))
            got = con.sql(f"SELECT src, row_id, kept, plain FROM ({statement()}) WHERE plain <> kept").to_arrow_table()
            kept = [i for i, x in enumerate(garbled(m, got["kept"].combine_chunks())) if not x]
            yield from got.take(pa.array(kept, pa.int64())).select(["src", "row_id", "plain"]).to_batches()

    some = df.select("src", "row_id", "text").where(F.col("text").rlike(r"[^\x00-\x7f]"))
    return some.mapInArrow(work, "src string, row_id bigint, plain string")
