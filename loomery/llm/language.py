"""Language of each text and of each passage in it, with a confidence, by fusing evidence.

Text: scripts decide for Korean, Japanese and Russian; words (English, Spanish, French, German) and
characters (the two Chinese scripts) carry log-likelihoods of a multinomial model, trained on all
labelled rows and cleaned of wrong labels by its own verdicts. Where a text's clauses disagree, its words are
segmented by a hidden Markov model. Declared label, address suffix and host add log-priors; the host's
comes from grouped label counts over all rows, smoothed towards its suffix and that towards the whole.

Defined results: null, empty, blank and URL-only texts have no language (no row); repeated rows get equal
answers; a text without any known letter falls back on the priors; very long texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, reduce
from itertools import repeat
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import checkpointed, spread

LANGS = ("en", "zh-Hans", "zh-Hant", "ja", "ko", "es", "fr", "de", "ru")
LATIN = ("en", "es", "fr", "de")
HAN = ("zh-Hans", "zh-Hant", "ja")
#: Most hosts whose priors are broadcast (else they are joined); different words that a task remembers before it hands their counts on.
HOSTS, MOST_WORDS = 20_000, 300_000
#: A passage has this many words, in Chinese and Japanese this many characters.
PASSAGE_WORDS, PASSAGE_CHARS = 3, 6
#: Log-cost of a change of language inside a clause and between clauses (at commas and quotes too); most a word can say; weight of a declared
#: label; strength of smoothing. Three clear words outweigh two changes, two words don't.
SWITCH, CLAUSE, CLIP, DECLARED, SMOOTH = 5.0, 5.0, 4.0, 1.5, 20.0
#: What a Han letter without kana says against Japanese; share of the text's log-likelihood that counts for a confidence, as words of one text aren't
#: independent.
KANA, WORTH = 0.25, 0.8
#: Nats by which words must tell a Latin passage from names; confidence from which a text overrules its label.
GAIN, OVERRULE = 2.0, 0.8

#: Log-likelihood of a language that isn't written in a piece's script.
ELSEWHERE = -24.0
#: Log-likelihoods of the languages of one script: ``LATIN``, ``HAN`` or a single language.
Vector = tuple[float, ...]
_KANA_ONLY: Vector = (ELSEWHERE, ELSEWHERE, 0.0)
_STAY = [0, 1, 2, 3]


def _sum(a: Vector, b: Vector) -> Vector:
    return tuple(map(add, a, b))


def _written(lang: str) -> tuple[str, ...]:
    """The languages that a passage of ``lang`` could be by its script."""
    return LATIN if lang in LATIN else HAN if lang in HAN else (lang,)


#: Common words of each language, a prior for the training counts.
SEEDS = {
    "en": "the of and to in is was for that with his her she he they you it are at by from on as not but this which their has have had will can one all when where who how my our what if or after before never always still last lost chapter read just moment without into some any time way more only other than then so very her every between",
    "es": "el la los las de del y que en un una es por con para su se al lo como más pero sus le ya o este esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante cómo mi según bajo después último capítulo leer nunca",
    "fr": "le la les de des du et que en un une est pour qui dans par sur se au avec ce il elle ne pas plus son sa ses ou mais nous vous leur cette aux même si après sous près quand comment dernier mon chez chapitre lire jamais vient",
    "de": "der die das und in zu den mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch unter mein wenn letzte kapitel folge nie von",
}
_NAMES = {
    "en": "en eng english", "es": "es spa spanish español espanol castellano", "fr": "fr fra fre french français francais", "de": "de deu ger german deutsch",
    "ru": "ru rus russian русский", "ja": "ja jpn jp japanese 日本語", "ko": "ko kor kr korean 한국어", "zh-Hans": "zh-hans zh-cn zh-sg zh-hans-cn chs zh-chs 简体中文 中文", "zh-Hant": "zh-hant zh-tw zh-hk zh-mo zh-hant-tw cht zh-cht 繁體中文",
}
_LABELS = {n: lang for lang, names in _NAMES.items() for n in names.split()}
_JUNK = re.compile(r"https?://[^\s　-鿿가-힣]+|[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}(?![A-Za-z])(?:/[A-Za-z0-9_\-./?=&#%]*)?|&[a-z]+;|&#\w+;")
_TOKEN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+(?:['’][A-Za-zÀ-ÖØ-öø-ɏ]+)*)|([Ѐ-ԯ]+)|([가-힣ᄀ-ᇿ]+)|([㐀-鿿豈-﫿々〆぀-ヿｦ-ﾟー]+)|([.!?。！？…\n·|_/;:«»\"“”()（）【】《》「」『』]|\s[-–—]\s)|([\s　]+)|([,'’‘‚‹›])")
#: What ``_JUNK`` holds at least, but for "://" and "&"; the first and the fourth kind of ``_TOKEN``; letters of the others that count.
_JUNK_LOOK = re.compile(r"\.[A-Za-z]{2}")
_LATIN_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+(?:['’][A-Za-zÀ-ÖØ-öø-ɏ]+)*")
_HAN_RUN = re.compile("[\u3400-\u9fff\uf900-\ufaff\u3005\u3006\u3040-\u30ff\uff66-\uff9f]+")
_NOT_LATIN = re.compile("[\u0400-\u052f\u1100-\u11ff\u3005\u3006\u3040-\u30ff\u3400-\ufaff\uff66-\uff9f]")
#: Letters of ``_TOKEN`` other than its fourth kind; that kind alone (with Yi and private signs); what ends a run of Han and kana; a letter, by the languages that are alone in their script; words and others' letters of these.
_NOT_HAN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u052f\u1100-\u11ff\uac00-\ud7a3]")
_HAN_PART = re.compile("[\u3005\u3006\u3040-\u30ff\u3400-\uabff\ud7a4-\ufaff\uff66-\uff9f]+")
_HAN_END = re.compile(r"[.!?。！？…\n·|_/;:«»\"“”()（）【】《》「」『』\s　]+")
#: What ends a clause of Latin words; such words, with what ends a part of a clause.
_LATIN_END = re.compile(r"[.!?。！？…\n·|_/;:«»\"“”()（）【】《》「」『』]|(?<!\s)\s[-–—]\s")
_LATIN_PART, _SMALL_END = re.compile(_LATIN_WORD.pattern + "|[,'’‘‚‹›]"), frozenset(",'’‘‚‹›")
_LETTER = re.compile("([\u0400-\u052f])|([\u1100-\u11ff\uac00-\ud7a3])|[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u3005\u3006\u3040-\u30ff\u3400-\uabff\ud7a4-\ufaff\uff66-\uff9f]")
_ALONE = {
    "ru": (re.compile("[\u0400-\u052f]+"), re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1100-\u11ff\u3005\u3006\u3040-\u30ff\u3400-\ufaff\uff66-\uff9f]")),
    "ko": (re.compile("[\u1100-\u11ff\uac00-\ud7a3]+"), re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u052f\u3005\u3006\u3040-\u30ff\u3400-\uabff\ud7a4-\ufaff\uff66-\uff9f]")),
}
_CAMEL = re.compile("[A-ZÀ-Þ]?[^A-ZÀ-Þ]+|[A-ZÀ-Þ]+")
_KANA = re.compile("[぀-ヺｦ-ﾝ]")
_URL_ONLY = re.compile(r"^\s*(?:\w+:\s*)?(?:https?://|www\.)\S+\s*$|^\s*[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+(?:/\S*)?\s*$", re.I)


def canonical(label: str | None) -> str | None:
    """The language a label names, in whatever spelling, or None."""
    s = (label or "").strip().lower().replace("_", "-")
    if not s:
        return None
    if s in _LABELS:
        return _LABELS[s]
    if s.startswith("zh"):
        return "zh-Hant" if re.search("hant|tw|hk|mo", s) else "zh-Hans"
    return _LABELS.get(s.split("-")[0]) if re.fullmatch(r"[a-z]{2,3}(-[a-z0-9]{2,8})*", s) else None


def canonical_column(label: Column) -> Column:
    """``canonical`` in the JVM, for the grouped label counts."""
    s = F.replace(F.lower(F.trim(label)), F.lit("_"), F.lit("-"))
    table = F.create_map(*(F.lit(x) for kv in sorted(_LABELS.items()) for x in kv))
    whole = F.try_element_at(table, s)
    return F.coalesce(whole, F.when(s.rlike("^zh.*(hant|tw|hk|mo)"), "zh-Hant").when(s.rlike("^zh"), "zh-Hans").when(s.rlike("^[a-z]{2,3}(-[a-z0-9]{2,8})*$"), F.try_element_at(table, F.split_part(s, F.lit("-"), F.lit(1)))))


@lru_cache(maxsize=8192)
def script_of(c: str) -> float:
    """Positive: a character of simplified Chinese only; negative: of traditional only (by the national character sets)."""
    def has(enc: str) -> bool:
        try:
            c.encode(enc)
            return True
        except UnicodeEncodeError:
            return False

    s, t = has("gb2312"), has("big5")
    return 2.0 if s and not t else -2.0 if t and not s else 0.0


class _Signs(dict):
    """What each Han letter says for the simplified script: what is learned, else by the character sets (at most all of Unicode)."""

    def __missing__(self, c: str) -> float:
        x = self[c] = script_of(c)
        return x


class Model:
    """Words and characters with their log-likelihoods."""

    def __init__(self, words: dict[str, tuple[float, ...]], chars: dict[str, float], grams: dict[str, tuple[float, ...]]):
        self.words, self.chars, self.grams = words, chars, grams
        self.signs = _Signs({c: x for c, x in chars.items() if x})

    @staticmethod
    def train(rows: list[tuple[str, str | None]]) -> Model:
        """rows: (text, canonical label). Wrong labels are outvoted: the second round trains on the first one's verdicts."""
        bags = [(lab, " ".join(w), h) for t, lab in rows for w, h in [_bag(t)] if w or h]
        model = None
        for _ in range(ROUNDS):
            model = Model.fit(_tally(model, *zip(*bags)) if bags else {})
        return model

    @staticmethod
    def fit(counts: dict[str, Counter]) -> Model:
        """counts: by language, of Latin words or Han characters."""
        wc = {lang: Counter({w: 3 for w in SEEDS[lang].split()}) + counts.get(lang, Counter()) for lang in LATIN}
        hc = {lang: counts.get(lang, Counter()) for lang in ("zh-Hans", "zh-Hant")}
        total = {lang: sum(c.values()) for lang, c in wc.items()}
        words = {}
        for w in {w for c in wc.values() for w in c}:
            if sum(c[w] for c in wc.values()) >= 2:
                ll = [math.log((wc[lang][w] + 0.3) / (total[lang] + 3000)) for lang in LATIN]
                top = max(ll)
                if top - min(ll) > 0.7:
                    words[w] = tuple(max(x - top, -CLIP) for x in ll)
        ns, nt = sum(hc["zh-Hans"].values()) + 2000, sum(hc["zh-Hant"].values()) + 2000
        chars = {c: max(-3.0, min(3.0, math.log((hc["zh-Hans"][c] + 0.5) / ns) - math.log((hc["zh-Hant"][c] + 0.5) / nt))) * 0.5 + script_of(c) for c in set(hc["zh-Hans"]) | set(hc["zh-Hant"])}
        tri = [Counter() for _ in LATIN]
        for c, lang in zip(tri, LATIN):
            for w, n in wc[lang].items():
                if w in words:
                    for i in range(len(w) - 2):
                        c[w[i : i + 3]] += n
        sums = [sum(c.values()) + 500 for c in tri]
        grams = {}
        for g in {g for c in tri for g in c}:
            ll = [math.log((c[g] + 0.2) / n) for c, n in zip(tri, sums)]
            grams[g] = tuple(x - max(ll) for x in ll)
        return Model(words, chars, grams)

    def latin(self, ws: list[str]) -> str | None:
        known = list(filter(None, map(self.words.get, ws)))
        if not known:
            return None
        s = list(map(sum, zip(*known)))
        top = max(s)
        return LATIN[s.index(top)] if sorted(s)[-2] < top - 2 else None

    def chinese(self, han: str) -> str | None:
        x = sum(map(self.chars.get, han, repeat(0.0)))
        return "zh-Hans" if x > 1 else "zh-Hant" if x < -1 else None

    def by_grams(self, text: str) -> list[float]:
        """Log-likelihoods of the Latin languages from letter trigrams, for text without known words (blanks lost)."""
        t = "".join(c for c in text.lower() if c.isalpha())
        s = [0.0] * 4
        for i in range(len(t) - 2):
            v = self.grams.get(t[i : i + 3])
            if v:
                for k in range(4):
                    s[k] += max(v[k], -2.5)
        return s

    def pieces(self, text: str) -> list[tuple[str, int, int, float, Vector]]:
        """Passages in order as (language, words or characters, clause, margin, log-likelihoods of ``LANGS``); the language is '?' for undecided Han and '' for undecided Latin."""
        return self._pieces(_clear(text))

    def _pieces(self, t: str) -> list[tuple[str, int, int, float, Vector]]:
        if not _NOT_HAN.search(t):
            runs = (run for part in _HAN_END.split(t) if (run := "".join(_HAN_PART.findall(part))))
            return [self._han(run, n) for n, run in enumerate(runs)]
        out: list[tuple[str, int, int, float, Vector]] = []
        latin: list[tuple[int, list[str], set[int]]] = []  # (place in out, words, places of those behind a comma or quote)
        if not _NOT_LATIN.search(t):
            for part in _LATIN_END.split(t):
                ws, border = [], set()
                for w in _LATIN_PART.findall(part):
                    if w[0] in _SMALL_END:
                        border.add(len(ws))
                    elif len(w) >= 14:
                        ws.extend(x.lower() for x in _CAMEL.findall(w))  # blanks may be lost
                    else:
                        ws.append(w.lower())
                if ws:
                    border.discard(0)
                    latin.append((len(out), ws, border))
                    out.append(("", 0, len(out), 0.0, ()))
            if latin:
                self._latin(latin, out)
            return out
        clauses: list[list[tuple[int, str]]] = [[]]
        for m in _TOKEN.finditer(t):
            k = m.lastindex
            if k == 5:
                if clauses[-1]:
                    clauses.append([])
            elif k == 6:
                # a blank ends a run of Han and kana
                if clauses[-1] and clauses[-1][-1][0] == 4:
                    clauses.append([])
            elif k == 7:
                if clauses[-1] and clauses[-1][-1][0] != 4:
                    clauses[-1].append((k, m[0]))
            else:
                if clauses[-1] and (clauses[-1][-1][0] == 4) != (k == 4):
                    clauses.append([])
                clauses[-1].append((k, m[0]))
        for n, clause in enumerate(clauses):
            if not clause:
                continue
            if clause[0][0] == 4:
                out.append(self._han("".join(w for _, w in clause), n))
                continue
            now = -1
            for k, w in clause:
                if k == 7:
                    if now == 1:
                        latin[-1][2].add(len(latin[-1][1]))
                    continue
                if k == 1:
                    if now != 1:
                        latin.append((len(out), [], set()))
                        out.append(("", 0, n, 0.0, ()))
                    latin[-1][1].extend(x.lower() for x in (_CAMEL.findall(w) if len(w) >= 14 else (w,)))  # blanks may be lost
                elif now == k:
                    lang, c, _, x, v = out[-1]
                    out[-1] = (lang, c + 1, n, x, v)
                else:
                    out.append(("ru" if k == 2 else "ko", 1, n, 12.0, (0.0,)))
                now = k
        if latin:
            self._latin(latin, out)
        return out

    def _han(self, run: str, n: int) -> tuple[str, int, int, float, Vector]:
        """The piece that a run of Han and kana is."""
        if _KANA.search(run):
            return "ja", len(run), n, 12.0, _KANA_ONLY
        s = sum(map(self.signs.__getitem__, run))
        # running Japanese has kana, so Han letters alone speak against it
        return "zh-Hans" if s > 1 else "zh-Hant" if s < -1 else "?", len(run), n, abs(s), (s / 2, -s / 2, -abs(s) / 2 - KANA * len(run))

    def _latin(self, latin: list[tuple[int, list[str], set[int]]], out: list[tuple[str, int, int, float, Vector]]) -> None:
        """Languages of the Latin clauses: one for all where they agree, else by Viterbi over the words."""
        get = self.words.get
        total, each = [0.0] * 4, []
        for _, ws, _ in latin:
            s0 = s1 = s2 = s3 = 0.0
            for v0, v1, v2, v3 in filter(None, map(get, ws)):
                s0 += v0
                s1 += v1
                s2 += v2
                s3 += v3
            s = [s0, s1, s2, s3]
            each.append(s)
            for k in range(4):
                total[k] += s[k]
        best = max(range(4), key=total.__getitem__)

        def one() -> None:
            margin = total[best] - max(total[k] for k in range(4) if k != best)
            for (at, ws, _), s in zip(latin, each):
                out[at] = (LATIN[best] if margin > 0 else "", len(ws), out[at][2], margin, tuple(s))

        # a path with a change scores no more than minus its cost
        if total[best] >= -min(CLAUSE, SWITCH):
            return one()
        steps = [(i, w, j == 0 or j in border) for i, (_, ws, border) in enumerate(latin) for j, w in enumerate(ws)]
        score, back = [0.0] * 4, []
        for _, w, first in steps:
            v = get(w) or (0.0, 0.0, 0.0, 0.0)
            most = max(score)
            change = most - (CLAUSE if first else SWITCH)
            if min(score) >= change:
                back.append(_STAY)
                score = list(map(add, score, v))
                continue
            top = score.index(most)
            row, now = [], []
            for k in range(4):
                if score[k] >= change:
                    row.append(k), now.append(score[k] + v[k])
                else:
                    row.append(top), now.append(change + v[k])
            back.append(row)
            score = now
        k = max(range(4), key=score.__getitem__)
        path = [0] * len(steps)
        for i in range(len(steps) - 1, -1, -1):
            path[i] = k
            k = back[i][k]
        if len(set(path)) == 1:
            return one()
        parts: list[list[tuple[str, int, int, float, Vector]]] = [[] for _ in latin]
        for (i, w, _), k in zip(steps, path):
            v = get(w) or (0.0,) * 4
            gain = v[k] - max(v[:k] + v[k + 1 :])
            if parts[i] and parts[i][-1][0] == LATIN[k]:
                lang, c, n, x, sums = parts[i][-1]
                parts[i][-1] = (lang, c + 1, n, x + gain, _sum(sums, v))
            else:
                parts[i].append((LATIN[k], 1, out[latin[i][0]][2], gain, v))
        # what the changes' costs let stand has evidence enough against its surroundings
        parts = [[(lang, c, n, max(x, GAIN), v) for lang, c, n, x, v in ps] for ps in parts]
        new = {at: ps for (at, _, _), ps in zip(latin, parts)}
        out[:] = [p for i, old in enumerate(out) for p in new.get(i, (old,))]

    def _plain_latin(self, t: str) -> tuple[int, Vector] | None:
        """(words, log-likelihoods) of a cleared text in Latin letters whose words tell one language; None for what ``pieces`` must look at."""
        if not t.isascii() and _NOT_LATIN.search(t):
            return None
        ws = _LATIN_WORD.findall(t)
        if max(map(len, ws), default=0) >= 14:
            ws = [x for w in ws for x in (_CAMEL.findall(w) if len(w) >= 14 else (w,))]
        get = self.words.get
        known = list(filter(None, map(get, " ".join(ws).lower().split(" "))))
        if not known:
            return None
        total = tuple(map(sum, zip(*known)))
        top, second = sorted(total)[:1:-1]
        # as in ``_latin``: no path with a change can score more, and one language leads
        return (len(ws), total) if top >= -min(CLAUSE, SWITCH) and top - second > 1e-9 else None

    @staticmethod
    def _alone(t: str) -> tuple[str, int] | None:
        """(language, words) of a cleared text whose only letters are Cyrillic or Hangul."""
        if t.isascii() or not (first := _LETTER.search(t)) or first.lastindex is None:
            return None
        lang = ("ru", "ko")[first.lastindex - 1]
        words, others = _ALONE[lang]
        return None if others.search(t) else (lang, len(words.findall(t)))

    @staticmethod
    def _single(parts: list[tuple[str, int, int, float, Vector]]) -> tuple[tuple[str, ...], int, Vector] | None:
        """(languages of the script, size, log-likelihoods) of pieces that are all of one language or follow it undecided."""
        told = {p[0] for p in parts}
        sure = [y for y in told if len(y) > 1]
        if len(sure) != 1:
            return None
        group = _written(sure[0])
        if len(told) > 1 and told != {sure[0], "?" if group is HAN else "" if group is LATIN else None}:
            return None
        size, v = 0, None
        for p in parts:
            size += p[1]
            v = _sum(v, p[4]) if v else p[4]
        return group, size, v

    def languages(self, text: str | None, prior: dict[str, float] | None = None, but: str | None = None) -> list[tuple[str, float, int]]:
        """(language, confidence, size) of a text, the main one first; [] where there is no text to judge, or where it is in ``but`` alone.

        The confidence is the posterior of the passage's language among all nine: likelihoods of its pieces times the prior.
        """
        if not text or text.isspace() or _URL_ONLY.match(text):
            return []
        prior = prior or {}
        t = _clear(text)
        if alone := self._alone(t):
            lang, size = alone
            return [] if lang == but else [(lang, _confidence(lang, (lang,), (0.0,), prior), size)]
        if one := self._plain_latin(t):
            size, v = one
            lang = _best(v, LATIN, prior)
            return [] if lang == but else [(lang, _confidence(lang, LATIN, v, prior), size)]
        parts = self._pieces(t)
        if not parts:
            return []
        if one := self._single(parts):
            group, size, v = one
            lang = _best(v, group, prior)
            return [] if lang == but else [(lang, _confidence(lang, group, v, prior), size)]
        known = Counter()
        for lang, c, _, x, _ in parts:
            if len(lang) > 1:
                known[lang] += c * (1 if lang in HAN else 3)
        # undecided pieces: the text's own other Han or kana (or Latin), else the posterior
        merged: list[list] = []
        spelled: Vector | None = None
        for lang, c, _, x, v in parts:
            if len(lang) < 2:
                group = HAN if lang else LATIN
                near = [y for y in group if known[y]]
                if group is LATIN and not near:
                    if spelled is None:
                        spelled = tuple(0.5 * g for g in self.by_grams(text))
                        v = _sum(v, spelled)
                    lang = _best(spelled, LATIN, prior)
                else:
                    lang = max(near, key=known.__getitem__) if near else _best(v, group, prior)
            if merged and merged[-1][0] == lang:
                merged[-1][1] += c
                merged[-1][2] += x
                merged[-1][3] = _sum(merged[-1][3], v)
            else:
                merged.append([lang, c, x, v])
        # a short piece between two of one language belongs to it (names, asides)
        need = lambda y: PASSAGE_CHARS if y in HAN else PASSAGE_WORDS
        joined: list[list] = []
        for p in merged:
            if p[1] < need(p[0]) or (p[0] in LATIN and p[2] < GAIN):
                joined.append([None, p[1], 0.0, p[3]])
            elif (same := next((j for j in reversed(joined) if j[0] is not None), None)) and same[0] == p[0]:
                same[1] += p[1]
                same[2] += p[2]
                same[3] = _sum(same[3], p[3])
            else:
                joined.append(p)
        long: dict[str, list] = {}
        for lang, c, x, v in joined:
            if lang:
                e = long.get(lang)
                long[lang] = [e[0] + c / need(lang), e[1] + x, _sum(e[2], v)] if e else [c / need(lang), x, v]
        if not long:
            by: dict[str, list] = {}
            for lang, c, x, v in merged:
                e = by.get(lang)
                by[lang] = [e[0] + c / need(lang), e[1] + x, _sum(e[2], v)] if e else [c / need(lang), x, v]
            lang, e = max(by.items(), key=lambda kv: (kv[1][1] >= GAIN, kv[1][0], kv[1][1]))
            long = {lang: e}
        if len(long) == 1:
            (lang, e), = long.items()
            long = {_best(e[2], _written(lang), prior): e}
        out = []
        for lang, (c, _, v) in long.items():
            out.append((lang, _confidence(lang, _written(lang), v, prior), round(c * need(lang))))
        if len(out) == 1 and out[0][0] == but:
            return []
        return sorted(out, key=lambda r: (-r[2] / need(r[0]), r[0]))


#: What the languages of other scripts weigh together, for priors that sum to about one.
_REST = math.exp(WORTH * ELSEWHERE)


def _confidence(lang: str, group: tuple[str, ...], v: Vector, prior: dict[str, float]) -> float:
    most = max(v)  # another script is out of the question for any length of text
    odds = {y: math.exp(WORTH * (a - most) + prior.get(y, 0.0)) for y, a in zip(group, v)}
    return odds[lang] / (sum(odds.values()) + _REST)


def _best(v: Vector, group: tuple[str, ...], prior: dict[str, float]) -> str:
    weights = [WORTH * a + prior.get(y, 0.0) for a, y in zip(v, group)]
    return group[weights.index(max(weights))]


def _bag(text: str) -> tuple[list[str], str]:
    """Latin words and (where there is no kana) Han characters of a text."""
    t = _clear(text)
    ws = _LATIN_WORD.findall(t)
    ws = " ".join(ws).lower().split(" ") if len(ws) > 2 else []
    if t.isascii() or _KANA.search(t):
        return ws, ""
    return ws, "".join(_HAN_RUN.findall(t))


def _clear(text: str) -> str:
    """A text without addresses and character references."""
    return _JUNK.sub(" ", text) if "://" in text or "&" in text or _JUNK_LOOK.search(text) else text


#: Rounds of training; all but the first count by the verdicts of the one before.
ROUNDS = 3


def _tally(model: Model | None, labels: Iterable[str | None], words: Iterable[str], han: Iterable[str]) -> dict[str, Counter]:
    """Counts of words and Han characters by language, which is the label or, with a model, its verdict."""
    held: dict[str | None, list[str]] = {}
    for lab, ws, h in zip(labels, words, han):
        if ws and (to := lab if model is None else model.latin(ws.split(" "))) in LATIN:
            held.setdefault(to, []).append(ws)
        if h and (to := lab if model is None else model.chinese(h)) in ("zh-Hans", "zh-Hant"):
            held.setdefault(to, []).append(h)
    return {lang: Counter(" ".join(x).split(" ") if lang in LATIN else "".join(x)) for lang, x in held.items()}


def host_priors(rows: DataFrame) -> DataFrame:
    """rows(host, label) → (host, rows, weights, weight): label counts of the host, smoothed towards its suffix and that towards all rows.

    A prior is weights / weight; both are kept, so that a row's own label can be left out. Hosts without any label have one, too.
    """
    every = rows.select(F.coalesce("host", F.lit("")).alias("host"), canonical_column(F.col("label")).alias("lang")).groupBy("host", "lang").agg(F.count("*").alias("n"))
    every = checkpointed(every)  # counts of hosts, read three times
    counts = every.where("lang is not null")
    suffix = counts.groupBy(F.element_at(F.split("host", r"\."), -1).alias("suffix"), "lang").agg(F.sum("n").alias("n"))
    whole = suffix.groupBy("lang").agg(F.sum("n").alias("n")).agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("g"), F.coalesce(F.sum("n"), F.lit(0)).alias("gn"))  # nine rows
    by_suffix = suffix.groupBy("suffix").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("s"), F.sum("n").alias("sn"))
    labelled = F.col("lang").isNotNull()
    by_host = every.groupBy("host").agg(F.sum("n").alias("rows"), F.map_from_entries(F.collect_list(F.when(labelled, F.struct("lang", "n")))).alias("h"), F.coalesce(F.sum(F.when(labelled, F.col("n"))), F.lit(0)).alias("hn"))
    x = by_host.withColumn("suffix", F.element_at(F.split("host", r"\."), -1)).join(by_suffix, "suffix", "left").join(F.broadcast(whole))
    part = lambda m, lang: F.coalesce(F.try_element_at(F.col(m), F.lit(lang)), F.lit(0))

    def one(lang: str) -> Column:
        g = (part("g", lang) + 1) / (F.col("gn") + len(LANGS))
        s = (part("s", lang) + SMOOTH * g) / (F.coalesce("sn", F.lit(0)) + SMOOTH)
        return part("h", lang) + SMOOTH * s

    return x.select("host", "rows", F.array(*map(one, LANGS)).alias("weights"), (F.col("hn") + SMOOTH).alias("weight"))


def prior(weights: Sequence[float], weight: float, said: str | None) -> dict[str, float]:
    """Log-prior of a row: its host's without the row's own label, and what the label itself says."""
    own = weight - (said is not None)
    out = {y: math.log(max(w - (y == said), 1e-3) / own) for y, w in zip(LANGS, weights)}
    if said:
        out[said] += DECLARED
    return out


def train(frames: list[DataFrame]) -> Model:
    """frames(row_id, text, label): fit on all rows. Texts are taken apart once; every round reads what is left of them."""
    rows = reduce(DataFrame.unionByName, (df.select(F.col("text").alias("t"), "label") for df in frames)).where(F.length("t") > 8)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(canonical(lab), " ".join(w), h) for t, lab in zip(*(c.to_pylist() for c in b.columns)) for w, h in [_bag(t)] if w or h]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in range(3)], names=["lang", "words", "han"])

    held = checkpointed(spread(rows).mapInArrow(bags, "lang string, words string, han string"))
    model = None
    for _ in range(ROUNDS):
        model = Model.fit(_counted(held, model))
    return model


def _counted(bags: DataFrame, model: Model | None) -> dict[str, Counter]:
    """``_tally`` over all rows."""
    before = bags.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = before.value, {}

        def out() -> pa.RecordBatch:
            got = [(lang, x, n) for lang, c in sums.items() for x, n in c.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "item", "n"])

        for b in batches:
            for lang, c in _tally(m, *(c.to_pylist() for c in b.columns)).items():
                sums.setdefault(lang, Counter()).update(c)
            if sum(map(len, sums.values())) > MOST_WORDS:
                yield out()
        yield out()

    got = bags.mapInArrow(work, "lang string, item string, n bigint").groupBy("lang", "item").agg(F.sum("n").alias("n")).toArrow()
    sums: dict[str, Counter] = {}
    for lang, x, n in zip(*(c.to_pylist() for c in got.columns)):
        sums.setdefault(lang, Counter())[x] = n
    return sums


def label(df: DataFrame, model: Model, priors: DataFrame, wrong_only=None, hosts: int = HOSTS) -> DataFrame:
    """df(src, row_id, text, label, host) → (src, row_id, lang, confidence, size), one row per language of a text.

    wrong_only: a function (source, texts) → mask of texts that are no case; then only rows come out whose label is
    missing, names no language or isn't the text's, and rows in several languages.
    """
    spark = df.sparkSession
    few = priors.limit(hosts + 1).collect()
    rows = df.where("text is not null and text <> ''").withColumn("host", F.coalesce("host", F.lit(""))).select("src", "row_id", "text", "label", "host")
    if len(few) <= hosts:
        held = spark.sparkContext.broadcast((model, {r.host: (r.weights, r.weight) for r in few}))
        rows = rows.select("*", F.lit(None).cast("array<double>").alias("weights"), F.lit(None).cast("double").alias("weight"))
    else:
        # hosts of more than a 1/hosts part of the rows are fewer than that: they are broadcast, and their rows stay where they are
        held = spark.sparkContext.broadcast((model, {}))
        limit = priors.agg(F.sum("rows").alias("n")).first().n // hosts
        near = rows.join(F.broadcast(priors.where(F.col("rows") > limit).drop("rows")), "host", "left")
        far = near.where("weights is null").drop("weights", "weight").join(priors.where(F.col("rows") <= limit).drop("rows"), "host", "left")
        rows = near.where("weights is not null").unionByName(far).select("src", "row_id", "text", "label", "host", "weights", "weight")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = held.value
        labels: dict[str | None, str | None] = {}
        priors_of: dict[tuple[str, str | None], dict[str, float]] = {}
        for b in batches:
            cases = []
            own = zip(b.column(5).to_pylist(), b.column(6).to_pylist()) if b.column(5).null_count < b.num_rows else [(None, None)] * b.num_rows
            for i, (text, lab, host, (ws, w)) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), own)):
                if lab not in labels:
                    if len(labels) > 5000:
                        labels.clear()
                    labels[lab] = canonical(lab)
                said = labels[lab]
                p = priors_of.get((host, said))
                if p is None:
                    if len(priors_of) > 20_000:
                        priors_of.clear()
                    ws, w = (ws, w) if ws else known.get(host) or ((1.0,) * len(LANGS), float(len(LANGS)) + 1)
                    p = priors_of[host, said] = prior(ws, w, said)
                found = m.languages(text, p, None if wrong_only is None else said)
                if found and (wrong_only is None or said is None or len(found) > 1 or (found[0][0] != said and found[0][1] >= OVERRULE)):
                    cases.append((i, found))
            if wrong_only is not None and cases:
                at = pa.array([i for i, _ in cases], pa.int64())
                no = wrong_only(b.column(0).take(at).to_pylist(), b.column(2).take(at))
                cases = [c for c, x in zip(cases, no) if not x]
            flat = [(i, *f) for i, found in cases for f in found]
            at = pa.array([f[0] for f in flat], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array([f[1] for f in flat], pa.string()), pa.array([f[2] for f in flat], pa.float64()), pa.array([f[3] for f in flat], pa.int64())], names=["src", "row_id", "lang", "confidence", "size"])

    return rows.mapInArrow(work, "src string, row_id bigint, lang string, confidence double, size bigint")


def no_cases(garbled) -> object:
    """Mask of texts that are look-alike, residue (of audits) or encoding cases; ``garbled``: broadcast of that model."""

    def mask(sources: list[str], texts: pa.Array) -> list[bool]:
        from .garble import garbled as find_garbled
        from .lookalike import plain_texts, suspects
        from .residue import residue

        m = garbled.value
        vals = texts.to_pylist()
        bad = [src == "page_audit" and residue(t) is not None for src, t in zip(sources, vals)]
        odd = [i for i, (s, x) in enumerate(zip(suspects(texts).to_pylist(), bad)) if s and not x]
        for i, p in zip(odd, plain_texts([vals[i] for i in odd])):
            bad[i] = p != vals[i]
        rest = [i for i, t in enumerate(vals) if not bad[i] and not t.isascii()]
        for i, x in zip(rest, find_garbled(m, pa.array([vals[i] for i in rest], pa.string()))):
            bad[i] = x
        return bad

    return mask
