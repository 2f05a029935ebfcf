"""Text decoded with a wrong character encoding: find it, name the encoding chain, restore it.

A multinomial model over hashed byte bigrams (of the text's UTF-8 form) is trained on all texts of the
corpus, garbled synthetically by every chain of ``CHAINS``. A record is
suspect where the best contiguous run of log-odds (garbled by any chain : clean) is high enough,
so a garbled passage inside clean text counts as well. For a suspect the chains are tried in
the order of their posterior on the parts that reach into that run: encode strictly with the wrong encoding, decode strictly with
the right one. As a chain is a plain function, the posterior of clean : garbled by it is the ratio of the clean model's likelihoods
of the text before and after, times the prior; the best one above even odds is believed, and undone in all other parts of the
text that gain by it. What is still suspect goes through the same again. A text is called restored only if nothing that proves or
all but proves a wrong decoding is left in it.

Defined results: null, empty and pure ASCII texts are never garbled; repeated rows get equal
answers; in a suspect, U+FFFD and C1 controls prove a wrong decoding, restored or not; very long texts are
scored as a whole, in linear time.
"""

from __future__ import annotations

import codecs
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import compress
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import spread
from .arrowtext import best_segments, bytes_of, segment_bounds

BUCKETS = 1 << 15
#: How many texts the counts of a larger corpus weigh as beside the given phrases and the smoothing, on the clean side and for a chain. All texts are counted.
WEIGHT, CHAIN_WEIGHT = 9000, 1500
#: Words and characters that a task remembers before it counts what the chains make of them, and characters that are garbled at once.
MOST_KNOWN, MOST_CHARS, GARBLED_CHARS = 200_000, 4_000_000, 200_000
#: Log-odds (nats) of a run from which a text trains no clean model, and from which a record counts without a restored text.
SUSPECT, CERTAIN = 7.0, 30.0
#: Log-odds of a run from which the chains are tried; a text of few characters can hold less evidence.
TRIED, SHORT, SHORT_TRIED = 7.0, 24, 5.0
#: Share of records garbled by some chain, before looking (low, as bigrams take letters of one word for independent).
GARBLED = 0.001
#: Nats that another part of the text must gain by a chain that is believed already, and the gain that ends the search with the chain that was predicted or with one of UTF-8.
SWEEP, PROVEN = 3.0, 40.0
#: What a word costs that mixes scripts or letter case.
BROKEN = 12.0

#: Bytes scored at once.
SLICE = 1 << 21
#: Encodings of one byte a character, in which the bytes of ``_MULTI`` and UTF-8 become two signs or more.
_ONE = ["latin_1", "web1252", "mac_roman", "cp850", "cp437", "cp1251", "koi8_r", "cp866"]
_MULTI = ["gbk", "big5", "cp932", "euc_jp", "cp949"]
_CYR = ["cp1251", "koi8_r", "cp866"]
_LAT = ["latin_1", "web1252", "mac_roman", "cp850", "cp437"]
#: (encoding of the bytes, encoding they were read in). "twice" is UTF-8 read wrongly, written again and read wrongly again.
CHAINS = (
    [("utf_8", w) for w in [*_LAT, *_CYR, *_MULTI]]
    + [("twice", w) for w in ("web1252", "latin_1")]
    + [(r, w) for r in _MULTI for w in ("latin_1", "web1252", "utf_8", *_MULTI) if r != w]
    + [(r, w) for r in _CYR for w in ("latin_1", "web1252", "utf_8", "gbk", *_CYR) if r != w]
    + [("web1252", w) for w in ("utf_8", "mac_roman", "cp850", "cp437", "cp1251", "gbk", "big5", "cp932", "cp949")]
    + [("mac_roman", "web1252"), ("cp850", "web1252"), ("mac_roman", "utf_8")]
)
#: Nats that a run of Cyrillic words must gain.
GAIN = 8.3
_CYR_CHAINS = [(r, w) for r in _CYR for w in _CYR if r != w]
_LETTERS = "A-Za-z\u00c0-\u02af\u0370-\u045f\uff21-\uff3a\uff41-\uff5a"
_CYRILLIC = re.compile(f"(?<![{_LETTERS}])[\u0400-\u045f]+(?![{_LETTERS}])")
_CYRILLIC_LETTER = re.compile("[\u0400-\u045f]")
_EAST = re.compile("[\u3040-\u9fff\uac00-\ud7a3\uff61-\uff9f]")
_NOT_CYRILLIC = re.compile(r"[^\u0400-\u045f\x00-\x7f]")
_CYR_SPLIT = re.compile("([\u0400-\u045f]+)")
#: What no restored text holds: proofs of a wrong decoding, odd blanks.
_NEVER = re.compile("[\ufffd\x80-\x9f\x0b\x0c\x1c-\x1f\u1680\u2000-\u200a\u2028\u2029\u205f]|ï¿½|锟斤拷|锟絏?")
#: How all that it finds begins, but for what isn't printable.
_NEVER_HEADS = ("\ufffd", "ï¿½", "锟")
HARD = re.compile("[�\x80-\x9f]|ï¿½|锟斤拷|锟絏?")


@lru_cache(maxsize=1)
def _web1252() -> tuple[str, object]:
    """windows-1252 as browsers read it, as tables to decode and to encode by: the five unassigned bytes are C1 controls."""
    table = "".join(c if (c := bytes([b]).decode("cp1252", "ignore")) else chr(b) for b in range(256))
    return table, codecs.charmap_build(table)


def decode(data: bytes, enc: str, errors: str = "strict") -> str:
    if enc == "web1252":
        return codecs.charmap_decode(data, errors, _web1252()[0])[0]
    return data.decode(enc, errors)


def encode(text: str, enc: str) -> bytes:
    """Strict; raises UnicodeError if a character has no byte in ``enc``."""
    if enc == "web1252":
        return codecs.charmap_encode(text, "strict", _web1252()[1])[0]
    return text.encode(enc)


def garble(text: str, chain: tuple[str, str]) -> str | None:
    """What ``text`` looks like after the chain; None where the chain leaves it as it is or cannot apply."""
    right, wrong = chain
    try:
        if right == "twice":
            out = decode(decode(text.encode(), wrong, "replace").encode(), wrong, "replace")
        else:
            out = decode(encode(text, right), wrong, "replace")
    except UnicodeError:
        return None
    return out if out != text else None


def ungarble(text: str, chain: tuple[str, str]) -> str | None:
    """The original, if both ways are strict; U+FFFD stands for bytes that are lost."""
    right, wrong = chain
    if "�" in text:
        return None
    try:
        if right == "twice":
            return encode(encode(text, wrong).decode(), wrong).decode()
        return decode(encode(text, wrong), right)
    except (UnicodeError, KeyError):
        return None


#: Words that a worker remembers with what a chain or the letter pairs make of them (cleared when full).
MOST_WORDS = 100_000
#: Texts that a worker remembers with their diagnosis (cleared when full), and their greatest length.
MOST_TEXTS, MOST_TOLD = 20_000, 500
_WORDS: dict[int, dict[str, float]] = {}


def bigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of each byte with its successor; the last has no successor. Pairs of two ASCII bytes share bucket 0."""
    a = data.astype(np.uint32)
    b = np.append(a[1:], 0).astype(np.uint32)
    h = ((a * 256 + b) * np.uint32(2654435761) >> np.uint32(17)) & np.uint32(BUCKETS - 1)
    h[(a < 128) & (b < 128)] = 0
    return h


#: What right texts may also hold: letters in other widths, look-alike letters, and what can't be seen.
_ALIKE = str.maketrans("aceopxyijsvkhABCEHKMOPTXYN", "асеорхуіјѕνκһАВСЕНКМОРТХΥΝ")
_WIDE = {c: c + 0xFEE0 for c in [*range(48, 58), *range(65, 91), *range(97, 123)]}
_BLANKS = "\xa0\xad\u2002\u2007\u2009\u200b\u200c\u200d\u200e\u202f\u2060\u3000\ufeff"


#: Ordinary phrases in scripts and languages a corpus may quote now and then.
_ELSEWHERE = ["Μικρή ιστορία για τη θάλασσα και το παλιό σπίτι", "قصة قصيرة عن البحر والبيت القديم", "סיפור קצר על הים והבית הישן", "เรื่องสั้นเกี่ยวกับทะเล", "समुद्र और पुराने घर की छोटी कहानी", "Truyện ngắn về biển và ngôi nhà cũ", "Krótka opowieść o morzu i starej łodzi, źdźbło", "Deniz ve eski ev üzerine kısa öykü, ışık", "Uma história curta não é ilusão", "Коротка історія про море і їжака", "½ ¼ ¾ © ® ™ ° £ € § « » “ ” „ ’ – — … · • № ÷ × ± ² ³ ñ ¿ ¡ ø å æ"]
#: Right sentences of the nine languages, so that a small or bad sample leaves a usable model.
_BASE = [
    "Después de la inundación abrió una tienda pequeña y vendió cada espejo que dejó el río.", "Capítulo 5: el jardín olvidado, según él. ¿Qué pasó aquí? ¡Mañana será otro día!", "El corazón del niño está más allá de la montaña, en la última página.",
    "Après la crue, l'équipe a cherché un relecteur déjà présent à l'école.", "Chapitre 12 : le bateau gelé, le théâtre oublié, où rêve le garçon français.", "Édition spéciale : même si les trois derniers ne sont que des ébauches, ça va être très drôle.",
    "Größere Träume für alle: der müde Schlüssel über der Brücke, schöne Grüße aus Köln.", "Die Zeichnungen sind klar, und jedes Bild gibt dem Flügel Raum; er fährt später heim.", "Übermäßig großer Käfig, während der König zurückkehrt und Öl kauft.",
    "После наводнения он открывает лавку и продаёт то, что оставила река.", "Глава 34 вышла сегодня утром с двумя цветными страницами, читать главу.", "Последний паром города и тихий колокол: какой же упрямый дымоход, съешь ещё щавель.",
    "今天早上更新的第12话还附带两张彩页，开头节奏很慢，到了后面两个对手才终于谈话。", "洪水过后，他开了一家小店，专卖河水留下的镜子。妹妹更喜欢小说，但是漫画的结局更好。", "除非作者生病，否则每隔一周更新。开始阅读《灯笼与龙》。",
    "這個網站列出了很多話，不過最後三話只是草稿。讀者們一直希望出單行本。", "兩場戰爭之間，羅盤換了許多主人，誰也記不清它屬於誰。開始閱讀第7話。", "畫面乾淨，每一格都給鏡子留出了呼吸的空間，論壇裡這樣說。",
    "第5話は今朝公開され、カラーページも二枚ついています。", "はじめはゆっくりですが、やっとふたりが話します。単行本を望む声は多いのですが。", "洪水のあと、小さな店を開き、川が残した静かな手鏡を売ります。古井戸を読む",
    "홍수가 지나간 뒤 작은 가게를 열고 얼어붙은 우물을 팝니다.", "이 사이트에는 12화까지 있지만 마지막 세 화는 밑그림입니다. 첫 화 읽기", "번역 팀은 주말에 도와줄 교정자를 찾고 있습니다. 제5화 계단의 귀환",
]
#: Letters of other widths (but for narrow kana beside Latin letters) and radicals.
_WIDTHS = re.compile("[\uff00-\uff60\uffa0-\uffef\u2e80-\u2fd5]+|(?<![A-Za-z\uff61-\uff9f])[\uff61-\uff9f]+(?![A-Za-z\uff61-\uff9f])")
_PLAIN = re.compile("[\xad\u200b-\u200f\u2060\ufeff]")


def _plain(text: str) -> str:
    return _WIDTHS.sub(lambda m: unicodedata.normalize("NFKC", m[0]), _PLAIN.sub("", text))


#: Right words in other dress, so that none of them is taken for a wrong decoding.
_DRESS = (str.upper, str.lower, str.swapcase, lambda w: unicodedata.normalize("NFD", w))


def _variants(text: str) -> list[str]:
    """A text with one word in letters of another kind, and with odd blanks; a text's own hash says where."""
    i = zlib.crc32(text.encode("utf-8", "replace"))
    words = text.split(" ")
    w = i % len(words)
    words[w] = words[w].translate(_WIDE if i // 7 % 2 else _ALIKE)
    at = (i // 11) % (len(text) + 1)
    return [" ".join(words), text[:at] + _BLANKS[i % len(_BLANKS)] + text[at : at + 2] + _BLANKS[(i // 3) % len(_BLANKS)] + text[at + 2 :]]


#: By encoding, the characters seen so far and whether it has them (at most all of Unicode).
_CAN: dict[str, dict[str, bool]] = {}
_WORD, _ODD_RUN = re.compile("[^ ]+"), re.compile(r"[^\x00-\x7f]+")


def _cased(w: str) -> bool:
    """Written as words are: small, capital or with a capital at the head."""
    return w.islower() or w.isupper() or w[1:].islower()


def _around(text: str, a: int, b: int) -> tuple[str, str]:
    """The letters that join a part on either side, with the character beyond."""
    x, y = a, b
    while x > 0 and text[x - 1].isalpha() and a - x < 40:
        x -= 1
    while y < len(text) and text[y].isalpha() and y - b < 40:
        y += 1
    return (text[x - 1] if x else "\n") + text[x:a], text[b:y] + (text[y] if y < len(text) else "\n")


_LATIN, _LETTERED = re.compile("[A-Za-z\u00c0-\u024f\uff21-\uff5a]"), re.compile(r"[^\W\d_]+")
#: What shows that a part isn't just in other dress: no blank, no wide letter, nothing unseen.
_SEEN = re.compile("[^\x00-\x7f\xa0\xad\u2000-\u200f\u202f\u2060\u3000\ufeff\uff00-\uff60\u2e80-\u2fd5]")


def _broken(text: str) -> int:
    """How often words mix scripts or letter case as no one writes them."""
    out = 0
    for w in _LETTERED.findall(text):
        if not w.isascii():
            out += (not _cased(w) and w.lower() != w.upper()) + max(0, bool(_LATIN.search(w)) + bool(_CYRILLIC_LETTER.search(w)) + bool(_EAST.search(w)) - 1)
    return out


def _never(text: str) -> bool:
    """Whether no restored text holds what this one does."""
    return not (text.isprintable() and not any(h in text for h in _NEVER_HEADS)) and bool(_NEVER.search(text))


def _odd(text: str) -> set[str]:
    """The characters of a text but those that all encodings have, the blank and the signs of ASCII."""
    return {c for c in set(text) if not " " <= c <= "~"}


def _encodable(c: str, enc: str) -> bool:
    try:
        encode(c, enc)
        return not (c.isspace() and c not in " \xa0\x85")
    except UnicodeError:
        return False


def _at(d: np.ndarray) -> np.ndarray:
    """Number of each pair of bytes."""
    return d[:-1].astype(np.uint16) << 8 | d[1:]


def _pairs(data: bytes) -> np.ndarray:
    """How often each byte follows each byte, as 65,536 counts."""
    return np.bincount(_at(np.frombuffer(data, np.uint8)), minlength=65536)


@lru_cache(maxsize=1)
def _buckets() -> np.ndarray:
    """Bucket of each pair of bytes."""
    a = np.repeat(np.arange(256, dtype=np.uint8), 256)
    return bigrams(np.stack([a, np.tile(np.arange(256, dtype=np.uint8), 256)], 1).ravel())[::2]


def _hashed(pairs: np.ndarray) -> np.ndarray:
    c = np.bincount(_buckets(), pairs, BUCKETS)
    c[0] = 0
    return c


#: A word with what stands on either side. No encoding has signs up to "?" inside of a character, so a chain does the same to a word wherever it stands (but for how many U+FFFD a cut character of euc_jp leaves).
_BORDERED = re.compile("([\x00-?][^\x00-?]+)(?=([\x00-?]))")


#: By encoding, the characters counted so far and whether it has bytes for them (at most all of Unicode).
_HAS: dict[str, dict[str, bool]] = {}


def _has(c: str, enc: str) -> bool:
    try:
        encode(c, enc)
        return True
    except UnicodeError:
        return False


class Counts:
    """What a model is made of, as sums over texts: they can be counted in parts and added."""

    def __init__(self) -> None:
        #: Number of texts; pairs of bytes; hashed pairs in other dress and by chain; pairs of Cyrillic letters (0: a word's end).
        self.parts = {"n": np.zeros(1, np.int64), "clean": np.zeros(65536, np.int64), "dress": np.zeros(BUCKETS, np.int64), "letters": np.zeros(128 * 128, np.int64), "chains": np.zeros(len(CHAINS) * BUCKETS, np.int64)}
        self._known: Counter[tuple[str, str]] = Counter()
        self._chars = 0

    def __getattr__(self, name: str) -> np.ndarray:
        if name in ("n", "clean", "dress", "letters", "chains"):
            return self.parts[name]
        raise AttributeError(name)

    def __sub__(self, other: Counts) -> Counts:
        out = Counts()
        out.parts = {k: v - other.parts[k] for k, v in self.parts.items()}
        return out

    @staticmethod
    def of(texts: list[str]) -> Counts:
        out = Counts()
        for i in range(0, len(texts), 5000):
            out.add(texts[i : i + 5000])
        return out.done()

    def add(self, texts: list[str]) -> None:
        texts = [t.replace("\0", " ") for t in texts]
        whole = "\n".join(["", *texts, ""])
        self.n[0] += len(texts)
        self.clean[:] += _pairs(whole.encode("utf-8", "replace"))
        self.dress[:] += _hashed(_pairs("\n".join(["", *(v for t in texts for v in _variants(t)), ""]).encode("utf-8", "replace"))).astype(np.int64)
        odd = [w for w in _BORDERED.findall(whole) if not w[0].isascii()]
        self._known.update(odd)
        self._chars += sum(len(w[0]) for w in odd)
        if len(self._known) > MOST_KNOWN or self._chars > MOST_CHARS:
            self.done()

    def done(self) -> Counts:
        """Counts what is remembered."""
        words, times, size = [], [], 0
        for (w, end), n in self._known.items():
            words.append(w + end)
            times.append(n)
            size += len(w) + 1
            if size > GARBLED_CHARS:
                self._garble(words, np.array(times, float))
                words, times, size = [], [], 0
        if words:
            self._garble(words, np.array(times, float))
        self._known.clear()
        self._chars = 0
        return self

    def _garble(self, words: list[str], times: np.ndarray) -> None:
        def pairs(joined: str, ns: np.ndarray) -> np.ndarray:
            # a word has ASCII on either side, so what joins two words falls into no bucket
            data = joined.encode("utf-8", "replace") + b"\0"
            sizes = np.diff(np.flatnonzero(np.frombuffer(data, np.uint8) == 0), prepend=-1)
            more = ns > 1  # most words come once
            d = np.frombuffer(data, np.uint8)
            at = d[:-1].astype(np.uint16) << 8 | d[1:]
            again = at[np.repeat(more, sizes)[:-1]]
            return np.bincount(at, minlength=65536) + np.bincount(again, np.repeat(ns[more] - 1, sizes[more])[: len(again)], 65536).astype(np.int64)

        whole = "\0".join(words)
        chars = set(whole)
        for dress in _DRESS:
            self.dress[:] += _hashed(pairs(dress(whole), times)).astype(np.int64)
        seen: Counter[str] = Counter()
        for w, n in zip(words, times.tolist()):
            for x in _CYRILLIC.findall(w):
                seen[x.lower()] += n
        pair = np.zeros(128 * 128, np.int64)
        for x, n in seen.items():
            at = [0, *(ord(c) - 0x3FF for c in x), 0]
            np.add.at(pair, [a * 128 + b for a, b in zip(at, at[1:])], int(n))
        self.letters[:] += pair
        own: dict[str, tuple[list[str], np.ndarray, bytes]] = {}
        for k, (right, wrong) in enumerate(CHAINS):
            enc = "utf_8" if right == "twice" else right
            if enc not in own:
                # words that hold a character without bytes are left out
                can = _HAS.setdefault(enc, {})
                for c in chars.difference(can):
                    can[c] = _has(c, enc)
                bad = "".join(re.escape(c) for c in sorted(chars) if not can[c])
                good = [not x for x in map(re.compile(f"[{bad}]").search, words)] if bad else [True] * len(words)
                some = list(compress(words, good))
                own[enc] = some, times[np.array(good)], encode("\0".join(some), enc)
            some, ns, raw = own[enc]
            if not some:
                continue
            text = decode(raw, wrong, "replace")
            if right == "twice":
                text = decode(text.encode(), wrong, "replace")
            # a chain that leaves a word as it is says nothing, nor does one whose bytes are right UTF-8; what many bytes make single signs of is never the same
            if wrong == "utf_8" or not (wrong in _ONE and (enc == "utf_8" or enc in _MULTI)):
                got = text.split("\0")
                keep = ["\ufffd" in g for g in got] if wrong == "utf_8" else list(map(ne, got, some))
                if not all(keep):
                    text, ns = "\0".join(compress(got, keep)), ns[np.array(keep)]
            if len(ns):
                self.chains[k * BUCKETS : (k + 1) * BUCKETS] += _hashed(pairs(text, ns)).astype(np.int64)

    def cells(self) -> pa.RecordBatch:
        """All that isn't 0 as (cell, n), cells numbered through."""
        every = np.concatenate(list(self.parts.values()))
        at = np.flatnonzero(every)
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(every[at])], names=["cell", "n"])

    @staticmethod
    def of_cells(cells: np.ndarray, n: np.ndarray) -> Counts:
        out = Counts()
        every = np.zeros(sum(map(len, out.parts.values())), np.int64)
        every[cells] = n
        at = np.cumsum([len(v) for v in out.parts.values()])[:-1]
        out.parts = dict(zip(out.parts, np.split(every, at)))
        return out


@lru_cache(maxsize=1)
def _given() -> tuple[Counts, np.ndarray, np.ndarray]:
    """Counts of the given sentences, and pairs of phrases elsewhere and of what a corpus holds now and then: other letters and signs of Europe at the head and inside of words."""
    rare = "".join(f" {c} {c}a o{c}e" for c in map(chr, [*range(0xA1, 0x180), *range(0x2010, 0x2027), *range(0x2030, 0x203B), *range(0x20A0, 0x20B0), 0x2116, 0x2122]) if c != "\xad")
    return Counts.of(_BASE), _pairs("\n".join(["", *_ELSEWHERE, ""]).encode()), _pairs(rare.encode())


class Model:
    """Log-probabilities by bucket of clean text and of each chain, and the log-odds garbled : clean."""

    def __init__(self, logs: np.ndarray, odds: np.ndarray, trained: list[int], letters: dict[str, float], clean: np.ndarray):
        self.logs, self.odds, self.trained, self.letters, self.clean = logs, odds, trained, letters, clean

    @staticmethod
    def train(texts: list[str]) -> Model:
        texts = [t for t in texts if t and not t.isascii() and not HARD.search(t)]
        whole = Counts.of(texts)
        model = Model.first(whole)
        return Model.fit(whole - Counts.of([t for t in texts if model.score_one(t) >= SUSPECT]))  # without what the first takes for garbled

    @staticmethod
    def first(whole: Counts) -> Model:
        """What finds the garbled ones among the texts that train."""
        return Model.fit(whole if whole.n[0] >= 300 else Counts())

    @staticmethod
    def fit(counts: Counts) -> Model:
        base, elsewhere, rare = _given()
        part = min(1.0, WEIGHT / max(1, counts.n[0]))
        both = {k: v + part * counts.parts[k] for k, v in base.parts.items()}
        chains = both["chains"].reshape(len(CHAINS), BUCKETS) * min(1.0, CHAIN_WEIGHT / both["n"][0])
        c = np.stack([_hashed(3 * both["clean"] + 20 * elsewhere) + both["dress"], *chains])
        trained = [k for k in range(len(CHAINS)) if chains[k].any()]
        logs = np.log(c + 0.05) - np.log(c.sum(1, keepdims=True) + 0.05 * BUCKETS)
        own = [k + 1 for k in trained] or [0]
        top = logs[own]
        mix = top.max(0) + np.log(np.exp(top - top.max(0)).mean(0))
        odds = mix - logs[0]
        odds[0] = -0.15  # weak evidence strewn over a long text doesn't add up
        logs[:, 0] = 0
        total = both["letters"].sum() + 500
        name = lambda x: chr(x + 0x3FF) if x else " "
        letters = {name(p // 128) + name(p % 128): math.log((both["letters"][p] + 0.2) / total) for p in np.flatnonzero(both["letters"]).tolist()} | {"": math.log(0.2 / total)}
        # log-probability of each byte after each byte in clean texts, smoothed towards that of the byte
        c = (both["clean"] + 3 * elsewhere + rare).reshape(256, 256)
        one = (c.sum(0) + 0.5) / (c.sum() + 128)
        clean = np.log((c + 2 * one) / (c.sum(1, keepdims=True) + 2)).astype(np.float32)
        return Model(logs.astype(np.float32), np.clip(odds, -6, 4).astype(np.float32), trained, letters, clean)

    @cached_property
    def _known(self) -> dict[tuple[str, str, int | None, bool], list[tuple[int, str, float]]]:
        """Short parts that a worker remembers with ``_gains``."""
        return {}

    @cached_property
    def _told(self) -> dict[str, tuple[bool, str | None, str | None]]:
        """Texts that a worker remembers with ``diagnose``."""
        return {}

    @cached_property
    def _read(self) -> dict[str, tuple[tuple[float, ...], tuple[float, ...]]]:
        """Cyrillic words that a worker remembers with ``_readings``."""
        return {}

    @cached_property
    def _pair_odds(self) -> np.ndarray:
        """``odds`` by pair of bytes."""
        return self.odds[_buckets()]

    @cached_property
    def _by_bucket(self) -> np.ndarray:
        """``logs`` of the chains with the chains of a bucket side by side."""
        return np.ascontiguousarray(self.logs[1:].T)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}  # without what is remembered or made of the others

    def _scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        s = np.zeros(len(data), np.float32)
        if len(data):
            s[:-1] = self._pair_odds.take(_at(data))
            s[offs[1:][offs[1:] > offs[:-1]] - 1] = 0
        return s

    def score_one(self, text: str) -> float:
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        return float(best_segments(self._scores(data, np.array([0, len(data)])), np.array([0, len(data)]))[0]) if len(data) else 0.0

    def batch(self, col: pa.Array) -> np.ndarray:
        data, offs = bytes_of(col)
        out, at = np.zeros(len(col)), 0
        while at < len(col):  # some dozen numbers are held for each byte, so long texts are taken a few at a time
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + SLICE, "right")) - 1)
            part = offs[at : to + 1] - offs[at]
            out[at:to] = best_segments(self._scores(data[offs[at] : offs[to]], part), part)
            at = to
        return out

    def diagnose(self, text: str, score: float) -> tuple[bool, str | None, str | None]:
        """(garbled, chain, restored text) of a suspect."""
        now, chain, left = text, None, score
        while left >= (SHORT_TRIED if len(now) <= SHORT else TRIED) and (got := self._undo(now)):
            now, chain = got[1], chain or got[0]
            left = self.score_one(now)
        if (case := self._cyrillic_case(now)) and (chain is None or case[2]):
            now, chain = case[2] or now, chain or case[1]
            left = self.score_one(now)
        if chain:
            return True, chain, None if left >= CERTAIN or HARD.search(now) else now  # no chain explains what is left better than a clean text does
        if HARD.search(text) or (score >= CERTAIN and self.score_one(_plain(text)) >= CERTAIN):  # other widths and unseen characters are no wrong decoding
            raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            a, b = segment_bounds(self._scores(raw, np.array([0, len(raw)])))
            likely = self._order(raw[a : b + 1])
            return score >= (SHORT_TRIED if len(text) <= SHORT else TRIED), ">".join(CHAINS[likely[0]]) if likely else None, None
        return False, None, None

    def told(self, text: str, score: float) -> tuple[bool, str | None, str | None]:
        """``diagnose``, once for texts that recur."""
        got = self._told.get(text)
        if got is None:
            got = self.diagnose(text, score)
            if len(text) <= MOST_TOLD:
                if len(self._told) >= MOST_TEXTS:
                    self._told.clear()
                self._told[text] = got
        return got

    def garbled(self, text: str, score: float) -> bool:
        """What ``diagnose`` says first, without what it restores."""
        enough = score >= (SHORT_TRIED if len(text) <= SHORT else TRIED)
        if (enough and (HARD.search(text) or self._undo(text, True))) or self._cyrillic_case(text):
            return True
        return enough and score >= CERTAIN and self.score_one(_plain(text)) >= CERTAIN

    def _order(self, span: np.ndarray) -> list[int]:
        """The trained chains, likeliest for a run of bytes first."""
        post = (-self._by_bucket.take(bigrams(span), 0).sum(0, dtype=np.float64)).tolist() if len(span) else [0.0] * len(CHAINS)
        return sorted(self.trained, key=post.__getitem__)

    def likelihood(self, text: str) -> float:
        """Log-probability of a text's bytes, each after the one before, under the clean model."""
        d = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        return float(self.clean[d[:-1], d[1:]].sum())

    def likelihoods(self, texts: list[str]) -> list[float]:
        """``likelihood`` of several texts, none of them empty."""
        if not texts:
            return []
        raw = [t.encode("utf-8", "replace") for t in texts]
        d = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        s = np.zeros(len(d))
        s[:-1] = self.clean.ravel().take(d[:-1].astype(np.uint16) << 8 | d[1:])
        s[ends - 1] = 0
        return np.add.reduceat(s, np.concatenate([[0], ends[:-1]])).tolist()

    def _undo(self, text: str, any_chain: bool = False) -> tuple[str, str] | None:
        """(chain, text without what it did) of the likeliest chain, if it is likelier than a clean text; any_chain: only whether there is one."""
        raw = text.encode("utf-8", "replace")
        data = np.frombuffer(raw, np.uint8)
        scores = self._scores(data, np.array([0, len(data)]))
        a, b = segment_bounds(scores)
        order = self._order(data[a : b + 1])
        # a part beside the best run leaves its score as it is, so only those that reach into it can be the wrong ones
        lo, hi = len(raw[:a].decode("utf-8", "ignore")), len(raw[: b + 1].decode("utf-8", "ignore")) + 1
        chars = _odd(text)
        same: dict[frozenset[str], list[str]] = {}
        parts: dict[str, list[tuple[str, bytes]]] = {}  # by wrong encoding, with the bytes in it
        looked: dict[str, tuple[str, str, float, bool]] = {}  # what joins a part, likelihood with the characters beside it, whether it shows anything
        broken: dict[str, int] = {}  # words that no one writes so
        undone: dict[str, dict[bytes, str | None]] = {}  # by right encoding
        best, found = -math.log(GARBLED), None
        plain = _plain(text)
        if (float(scores[a:b].sum(dtype=np.float64)) if plain == text else self.score_one(plain)) < SUSPECT:  # other widths and unseen characters are no wrong decoding
            order = [k for k in order if CHAINS[k][0] in ("utf_8", "twice")]
        # the predicted chain first, then those of UTF-8, which prove themselves
        selves = [k for k in order[1:] if CHAINS[k][0] in ("utf_8", "twice")]
        for ks in filter(None, (order[:1], selves, [k for k in order[1:] if CHAINS[k][0] not in ("utf_8", "twice")])):
            if found and (any_chain or self._settled(order, *found[:2], ks, best, min(hi - lo, len(text)))):
                break
            for wrong in dict.fromkeys(CHAINS[k][1] for k in ks):
                if wrong not in parts:
                    bad = self._without(chars, wrong)
                    if bad not in same:
                        same[bad] = [] if chars == bad else [p for p in self._parts(text, bad, lo - 1, hi) if "\ufffd" not in p]
                    parts[wrong] = [(p, encode(p, wrong)) for p in same[bad]]
            new = {p: _around(text, at := text.find(p), at + len(p)) for ps in same.values() for p in ps if p not in looked}
            for (p, (x, y)), was in zip(new.items(), self.likelihoods([x[-1] + p + y[0] for p, (x, y) in new.items()])):
                looked[p] = x, y, was, bool(_SEEN.search(p))
            own = 0.0 if CHAINS[ks[0]][0] in ("utf_8", "twice") else math.log(len(self.trained))  # any bytes could be of these
            # the parts that can gain enough: no other text is likelier than certain
            some = [(wrong, part, raw_part) for wrong in dict.fromkeys(CHAINS[k][1] for k in ks) for part, raw_part in parts[wrong] if -looked[part][2] - own > best and (not own or looked[part][3])]
            tried: dict[int, list[tuple[str, str, float]]] = {k: [] for k in ks}  # (part, without what the chain did, gain)
            for (_, part, _), gains in zip(some, self._gains(some, looked, undone, own, ks[0] if ks == order[:1] else None)):
                for k, fixed, gain in gains:
                    if k in tried:
                        tried[k].append((part, fixed, gain))
            for k in ks:
                if found and self._settled(order, *found[:2], [k], best, min(hi - lo, len(text))):
                    break
                for part, fixed, gain in tried[k]:
                    if gain > best:
                        before, after, _, _ = looked[part]
                        if part not in broken:
                            broken[part] = _broken(before + part + after)
                        if (gain := gain - BROKEN * max(0, _broken(before + fixed + after) - broken[part])) > best:
                            best, found = gain, (k, part, fixed)
        if not found:
            return None
        k, part, fixed = found
        if any_chain:
            return ">".join(CHAINS[k]), fixed
        return ">".join(CHAINS[k]), self._sweep(text.replace(part, fixed), CHAINS[k])

    def _gains(self, some: list[tuple[str, str, bytes]], looked: dict[str, tuple[str, str, float, bool]], undone: dict[str, dict[bytes, str | None]], own: float, only: int | None) -> list[list[tuple[int, str, float]]]:
        """For each (wrong encoding, part, its bytes) the chains that gain more than the prior asks for, as (chain, without what it did, gain):
        one chain, or all those of UTF-8, or with ``own`` all others. They hang on the part and the characters beside it alone, so those of words are remembered."""
        out, new = [], []
        joined: dict[str, None] = {}  # what the chains make of parts, with the characters beside them
        for wrong, part, raw_part in some:
            before, after, was, _ = looked[part]
            key = before[-1] + part + after[0], wrong, only, bool(own)
            gains = self._known.get(key)
            if gains is None:
                gains, options = [], []
                for k in self._chains_of[wrong, bool(own)] if only is None else (only,):
                    right = CHAINS[k][0]
                    if right in _CYR and wrong in _CYR and not _NOT_CYRILLIC.search(part):
                        continue  # letters that stay Cyrillic are compared by pairs of letters, in ``cyrillic``
                    known = undone.setdefault(f"{right} {wrong}" if right == "twice" else right, {})
                    if raw_part not in known:
                        try:
                            fixed = encode(raw_part.decode(), wrong).decode() if right == "twice" else decode(raw_part, right)
                            known[raw_part] = None if _never(fixed) else fixed
                        except UnicodeError:
                            known[raw_part] = None
                    fixed = known[raw_part]
                    if fixed and fixed != part:
                        x = before[-1] + fixed + after[0]
                        joined[x] = None
                        options.append((k, fixed, x))
                new.append((gains, options, was))
                if len(part) <= SHORT:
                    self._known[key] = gains
            out.append(gains)
        likely = dict(zip(joined, self.likelihoods(list(joined))))
        for gains, options, was in new:
            gains += [(k, fixed, gain) for k, fixed, x in options if (gain := likely[x] - was - own) > -math.log(GARBLED)]
        if len(self._known) > MOST_WORDS:
            self._known.clear()
        return out

    @cached_property
    def _chains_of(self) -> dict[tuple[str, bool], list[int]]:
        """The trained chains by wrong encoding and whether they are of another right one than UTF-8."""
        out: dict[tuple[str, bool], list[int]] = {}
        for k in self.trained:
            out.setdefault((CHAINS[k][1], CHAINS[k][0] not in ("utf_8", "twice")), []).append(k)
        return out

    @staticmethod
    def _settled(order: list[int], k: int, part: str, ks: list[int], best: float, size: int) -> bool:
        """Whether the chains ``ks`` needn't be tried beside what is found."""
        if best < PROVEN:
            return False
        if k == order[0] and len(part) >= 0.8 * size:
            return True  # the prediction holds for the whole run
        return all(x != order[0] and CHAINS[x][0] not in ("utf_8", "twice") for x in ks) and CHAINS[k][0] in ("utf_8", "twice") and CHAINS[order[0]][0] in ("utf_8", "twice")

    def _sweep(self, text: str, chain: tuple[str, str]) -> str:
        """The text with a chain that is believed undone in every other part that gains by it."""
        out, at = [], 0
        for a, b in self._runs(text, self._without(_odd(text), chain[1])):
            for m in [(a, b)] if (whole := self._gain(text, a, b, chain)) else [(a + m.start(), a + m.end()) for m in _WORD.finditer(text[a:b])]:
                got = whole or self._gain(text, *m, chain)
                if got:
                    out += [text[at : m[0]], got]
                    at = m[1]
        return "".join(out) + text[at:]

    def _gain(self, text: str, a: int, b: int, chain: tuple[str, str]) -> str | None:
        part = text[a:b]
        if part.isascii() or not (fixed := ungarble(part, chain)) or fixed == part or HARD.search(fixed):
            return None
        before, after = _around(text, a, b)
        is_, was = self.likelihoods([before[-1] + fixed + after[0], before[-1] + part + after[0]])
        gain = is_ - was
        return fixed if gain >= SWEEP and gain - BROKEN * max(0, _broken(before + fixed + after) - _broken(before + part + after)) >= SWEEP else None

    def _cyrillic_case(self, text: str) -> tuple[bool, str, str | None] | None:
        if not _CYRILLIC.search(text):
            return None
        gain, chain, whole = self.cyrillic(text)
        return (True, ">".join(chain), whole) if gain >= GAIN else None

    def cyrillic(self, text: str) -> tuple[float, tuple[str, str] | None, str | None]:
        """Cyrillic read in another Cyrillic encoding is Cyrillic again: the best run of words that gain, letter case aside,
        by one of the chains, as (gain in nats, chain, restored text)."""
        best: tuple[float, tuple[str, str] | None, str | None] = (0.0, None, None)
        text = _PLAIN.sub("", text)
        words = [(m.start(), m.end(), m[0]) for m in _CYRILLIC.finditer(text)]
        # one word's case says something in a text that is mostly written as usual
        usual = 2 * sum(w.islower() or w.istitle() for _, _, w in words) > len(words)
        shout = len(words) > 1 and all(w.isupper() for _, _, w in words)
        gains = [self._readings(w)[usual and len(w) > 1] for _, _, w in words]
        for chain, own in zip(_CYR_CHAINS, zip(*gains)):
            a, now = 0, 0.0
            for k, gain in enumerate(own):
                now += gain
                if now <= 0:
                    now, a = 0.0, k + 1
                elif now > best[0] and not (shout and k - a + 1 < len(words)) and words[k][1] - words[a][0] > 1:
                    whole = "".join(ungarble(x, chain) or x if i % 2 else x for i, x in enumerate(_CYR_SPLIT.split(text[words[a][0] : words[k][1]])))
                    best = (now, chain, text[: words[a][0]] + whole + text[words[k][1] :])
        return best

    def _readings(self, w: str) -> tuple[tuple[float, ...], tuple[float, ...]]:
        """What a word gains by each chain of Cyrillic encodings, letter case aside and with it."""
        got = self._read.get(w)
        if got is None:
            own, plain, case = self._word(w), [], []
            for chain in _CYR_CHAINS:
                fixed = ungarble(w, chain)
                if fixed and _CYRILLIC.fullmatch(fixed) and (_cased(fixed) or not _cased(w)):
                    plain.append(self._word(fixed) - own)
                    case.append(plain[-1] + (4.0 if not _cased(w) and _cased(fixed) else 2.0 if w.isupper() and fixed.islower() else 0.0))
                else:
                    plain.append(-9.0)
                    case.append(-9.0)
            got = tuple(plain), tuple(case)
            if len(self._read) >= MOST_WORDS:
                self._read.clear()
            self._read[w] = got
        return got

    def _word(self, w: str) -> float:
        known = _WORDS.setdefault(id(self.letters), {})
        got = known.get(w)
        if got is None:
            x, get, rare = f" {w.lower()} ", self.letters.get, self.letters[""]
            got = sum(get(x[i : i + 2], rare) for i in range(len(x) - 1))
            if len(known) >= MOST_WORDS:
                known.clear()
            known[w] = got
        return got

    @staticmethod
    def _without(chars: set[str], wrong: str) -> frozenset[str]:
        """The characters that the wrong encoding couldn't have made."""
        can = _CAN.setdefault(wrong, {})
        for c in chars.difference(can):
            can[c] = _encodable(c, wrong)
        return frozenset([c for c in chars if not can[c]])

    @staticmethod
    def _runs(text: str, bad: frozenset[str]) -> list[tuple[int, int]]:
        """Places of the runs without any of some characters."""
        runs, at = [], 0
        for r in text.translate({ord(c): "\uffff" for c in bad}).split("\uffff") if bad else (text,):
            if not r.isascii():
                runs.append((at, at + len(r)))
            at += len(r) + 1
        return runs

    @classmethod
    def _parts(cls, text: str, bad: frozenset[str], lo: int, hi: int) -> list[str]:
        """The runs without any of some characters, their words and odd spans; all that reach into [lo, hi), longest first."""
        own = set()
        for x, y in cls._runs(text, bad):
            if x < hi and y > lo:
                own.add(text[x:y])
                odd = [m.span() for m in _ODD_RUN.finditer(text, x, y)]
                spans, end = [(odd[0][0], odd[-1][1]), *odd], x
                for a, b in odd:
                    if a >= end:  # else of the same word
                        end = text.find(" ", b, y) % (y + 1)
                        spans.append((max(x, text.rfind(" ", x, a) + 1), end))
                own.update(text[a:b] for a, b in spans if a < hi and b > lo)
        return sorted(own, key=lambda p: (-len(p), p))

    def judge(self, text: str | None) -> tuple[bool, str | None, str | None]:
        """(garbled, chain, restored text) of one text."""
        if not text or text.isascii():
            return False, None, None
        score = self.score_one(text)
        if score < SHORT_TRIED and not _CYRILLIC.search(text):
            return False, None, None
        return self.diagnose(text, score)


def garbled(model: Model, texts: pa.Array) -> list[bool]:
    """Which texts are garbled, scored together."""
    scores = model.batch(texts)
    out = [False] * len(texts)
    for i in np.flatnonzero(_suspects(scores, texts)):
        t = texts[int(i)].as_py()
        out[i] = bool(t) and not t.isascii() and model.garbled(t, float(scores[i]))
    return out


#: ``HARD`` for RE2.
_HARD = r"[\x{fffd}\x{80}-\x{9f}]|ï¿½|锟斤拷|锟絏?"


def count(texts: DataFrame, model: Model | None = None) -> Counts:
    """texts(text): counts of all that can train, or with a model of those among them that it takes for garbled."""
    held = texts.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, counts = held.value, Counts()
        for b in batches:
            col = b.column(0)
            col = col.filter(pc.invert(pc.match_substring_regex(col, _HARD)))
            if m is not None:
                col = col.take(pa.array(np.flatnonzero(m.batch(col) >= SUSPECT)))
            for i in range(0, len(col), 5000):
                counts.add(col.slice(i, 5000).to_pylist())
        yield counts.done().cells()

    got = texts.where(F.col("text").rlike(r"[^\x00-\x7f]")).mapInArrow(work, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    return Counts.of_cells(got["cell"].to_numpy(), got["n"].to_numpy())


def train(texts: DataFrame) -> Model:
    """texts(text): fit on all of them."""
    whole = count(texts)
    return Model.fit(whole - count(texts, Model.first(whole)))


FOUND = "src string, row_id bigint, field string, chain string, restored string"


def find(df: DataFrame, model: Model) -> DataFrame:
    """df(src, row_id, field, text) → the garbled rows with chain and, where it can be regained, the original."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            scores = m.batch(batch.column(3))
            keep = [(i, *got) for i, t in ((int(i), batch.column(3)[int(i)].as_py()) for i in np.flatnonzero(_suspects(scores, batch.column(3)))) if (got := m.told(t, float(scores[i])))[0]]
            at = [k[0] for k in keep]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in batch.columns[:3]), pa.array([k[2] for k in keep], pa.string()), pa.array([k[3] for k in keep], pa.string())], names=["src", "row_id", "field", "chain", "restored"])

    some = df.select("src", "row_id", "field", "text").where(F.col("text").rlike(r"[^\x00-\x7f]"))
    return some.mapInArrow(work, FOUND)


def _suspects(scores: np.ndarray, col: pa.Array) -> np.ndarray:
    """Rows worth a diagnosis: enough odds, or Cyrillic letters."""
    cyr = pc.fill_null(pc.match_substring_regex(col, r"\p{Cyrillic}"), False).to_numpy(zero_copy_only=False)
    short = pc.fill_null(pc.less_equal(pc.utf8_length(col), SHORT), False).to_numpy(zero_copy_only=False)
    return (scores >= TRIED) | ((scores >= SHORT_TRIED) & short) | cyr


def fields(pages: DataFrame, hits: DataFrame) -> DataFrame:
    """The audited fields as (src, row_id, field, text), one scan of either table."""
    rows = pages.select(F.col("audit_id").alias("row_id"), F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("detail_title", "first_chapter_title")))).alias("x"))
    return spread(
        rows.select(F.lit("page_audit").alias("src"), "row_id", "x.field", "x.text").unionByName(
            hits.select(F.lit("candidate").alias("src"), F.col("ordinal").alias("row_id"), F.lit("snippet").alias("field"), F.col("snippet").alias("text"))
        )
    )
