"""Abusive, hateful and sexual passages: maximum-scoring segments over token log-odds.

A token (word or pair of words, or run of CJK letters, brought to plain spelling first) has a log-odds abusive : background
with Dirichlet priors on both sides. The prior of the abusive side is a lexicon of single words and short idioms in three
grades; its counts come from the passages of documents that raters called unsafe (found by the weights themselves, in
turns); the background's counts are those of the whole corpus, gathered by one grouped aggregation. Words, pairs and CJK
n-grams that the lexicon doesn't know are learned from the rated documents. A linear scan finds every maximal
segment; its score S in a text of n tokens counts when its expected number under the background, K n exp(-lambda S), is small
enough; K and lambda are fit to the scores of all documents' segments below that limit.

Defined results: null, empty and blank texts score 0 and are no case; repeated texts get equal scores; very long texts are
scanned whole; the length only enters the calibration through n. Without ratings the lexicon and the corpus decide alone.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import checkpointed, hash_sample

#: Rated documents that are read for fitting (about, taken evenly by the hash of their id).
RATED = 10_000
#: Pseudo-count of either side; prior log-odds of the lexicon's grades (plain abuse, words that need company, frames of address and threat).
BETA, GRADES = 0.5, (4.2, 2.2, 1.0)
#: Most that a token adds by grade, then a learned word, a learned pair and a letter of a learned CJK n-gram.
CAPS, LEARNED_WORD, LEARNED_PAIR, LEARNED_LETTER = (5.0, 3.2, 2.2), 1.2, 2.2, 0.7
#: Least a token can add; a token nobody knows, a CJK letter nobody knows; fewest rated passages that teach a token.
FLOOR, UNKNOWN, LETTER, TAUGHT = -3.0, -0.7, -0.3, 3
#: Log-odds unsafe : safe among rated texts, and nats against chance, from which a token of the passages counts as learned.
TELLS, CHANCE = 1.2, 3.5
#: Score from which segments enter the calibration, width of the scores taken for background, and expected false segments per text.
TAIL, WIDTH, EXPECTED = 2.0, 2.0, 0.0003
#: Words that a shorter text counts for.
SHORTEST = 100
#: What the calibration has seen before: segments of background, their lambda and the words for each.
PRIOR = (20.0, 2.0, 20_000)

#: Grades of the lexicon: words and short idioms of general use; a stem ends with "~".
PLAIN_ABUSE = """
moron morons imbecile imbeciles cretin scumbag scumbags dumbass dumbasses jackass asshole assholes bastards whore whores slut sluts slutty cunt cunts retard retards retarded fuck fucks fucked fucker fuckers fucking motherfuck~ shithead bullshit dickhead wanker wankers twat subhuman subhumans untermensch~ nigger~ faggot~ kike kikes wetback~ tranny raghead~ towelhead~ porn porno pornographic xxx blowjob~ cumshot~ handjob~ milf milfs threesome~ gangbang~ masturbat~ tits titties boobs horny creampie deepthroat cumming fisting rape rapist gook chink chinks paki pakis degenerates
gilipollas hijoputa hijaputa cabrón cabrones mierda puta putas puto putos zorra~ pendej~ subnormal~ maric~n coño polla pollas follar follando fóllate tetas porno culiar chingad~ malparid~ comemierda~ lameculos hostiaputa putilla sudaca~
connard~ connass~ conasse salope~ salaud~ enculé~ enculer merde putain pute putes gueule raclure~ bougnoul~ négro~ bicot~ youpin~ pédé~ tapette porno baise baiser baisée nique niquer bites couilles branleur branler pouffiasse~ sous-hommes sous-homme crevure ordure ordures
arschl~ arschgeig~ scheiß~ scheiss~ wichs~ hurens~ huren hure schlampe~ fotze~ missgeburt~ drecksau drecksack~ dreckskerl~ dreckstück pisser spast spasti~ mongo schwuchtel~ kanake~ kanacke~ neger untermenschen porno pornos fick~ gefickt titten muschi schwanzlutsch~ abschaum verreck~ vollidiot~ hackfresse fresse vergast vergasen judensau
дебил~ мразь мрази тварь твари урод уроды ублюд~ сволочь сволочи сука суки сучка блядь бляди блять шлюх~ хуй хуе~ хуё~ пизд~ ебан~ ебал~ ёбан~ уеб~ пидор~ пидар~ гандон~ мудак~ мудил~ дерьмо говно сдохн~ сдох чмо нелюд~ недочелов~ хач хачи чурк~ жид жиды трах~ сиськ~ минет порно порнух~ дроч~ подонок подонки гнида гниды паскуд~ ничтожеств~
傻逼 傻屄 煞笔 脑残 智障 狗娘养 狗日的 操你 草泥马 他妈的 你妈的 王八蛋 婊子 骚货 骚逼 贱人 贱货 贱种 杂种 狗杂种 人渣 去死吧 弄死你 砍死你 宰了你 杀你全家 劣等民族 支那 口交 肛交 自慰 淫荡 淫乱 约炮 做爱 无码 黄片 A片 色情片 裸聊 轮奸 强奸 鸡巴 操逼 奶子 賤人 賤貨 雜種 腦殘 畜牲 狗雜種 操你媽 幹你娘 婊子養 做愛 無碼 約炮 淫蕩 強姦 輪姦 雞巴
死ね 死ねよ くたばれ ゴミクズ クソ野郎 くそ野郎 馬鹿野郎 バカ野郎 くそったれ ぶっ殺す ぶっ殺し 殺してやる ヤリマン 売女 豚野郎 クソ女 クソアマ 中出し フェラ エロ動画 アダルト動画 無修正 手コキ セックス おまんこ ちんこ オナニー 劣等民族 ゴキブリども チョン公 土人ども
병신 개새끼 개새끼들 씨발 시발 씨팔 좆같 좆 미친년 미친놈 개년 걸레년 창녀 쌍놈 쌍년 뒈져 뒤져라 죽여버 찢어죽 포르노 야동 섹스 무수정 호로자식 육시랄 한남충 짱깨 쪽바리 깜둥이
"""
COMPANY = """
idiot idiots loser losers bastard bitch bitches pig pigs stupid dumb pathetic worthless brainless spineless useless disgusting filthy filth dirty goddamn shit shitty crap garbage trash scum vermin cockroach cockroaches parasite parasites leeches rats maggots plague savages animals beasts disease exterminat~ eradicat~ annihilat~ massacr~ lynch~ gas gassed slaughter~ wiped purge~ deport~ nude naked topless busty sex sexy uncensored hardcore stripping strip stripped cock dick pussy cum ass orgasm~ erotic explicit anal penetrat~ thrust moan~ escort hookup webcam adults uncut kill kills killed murder~ dies dead choke rot burn hang hanged shoot shot stab smash break beat strangle hurt bleed despis~ hate hates hated loathe~ ugly fat women men wives girls neck jaw fingers skull throat
idiota idiotas imbécil imbéciles estúpid~ inútil inútiles basura asqueros~ escoria plaga cucaracha~ parásit~ rata ratas alimaña~ animales extermin~ erradic~ expuls~ echarlos quemarlos matarlos gasear desnud~ sexo explícit~ erótic~ censura chicas mujeres calientes matar matarte mueras muérete cállate cara romper partir desgraciad~ miserable~ cerdo cerdos perro perros odia odian desprecia~ sangre
idiot~ imbécile~ crétin~ débile~ abruti~ inutile~ nulle pourriture~ vermine cafard~ parasite~ rats racaille~ animaux brûler brûle chasse chasser extermin~ éradiqu~ nue nues sexe sexuel~ explicite~ érotique~ chatte seins crève crever tuer tue frapper casser gueule sale sales dégoûtant~ minable~ cochon cochons chien chienne déteste~ méprise~ hais haine femmes porc porcs dégueulasse~ gorge
idiot~ trottel~ dumm~ dämlich~ schwachk~ depp~ wertlos~ nutzlos~ widerlich~ dreck~ müll abfall ungeziefer parasit~ kakerlake~ schmarotz~ ratten ratte tiere ausrott~ ausgerott~ vernicht~ verjag~ vertreib~ abschieb~ verbrenn~ nackt~ sex sexvideo~ heiß~ geil~ schwanz brüste zensur hass~ veracht~ stirb sterben umbring~ töten breche brech~ schlag~ knochen schwein~ schweine hund hunde frauen
идиот~ тупой тупая тупые тупиц~ кретин~ придур~ жалкий жалкое жалкая зареж~ никчемн~ никчёмн~ бездарн~ отброс~ мусор грязн~ вонюч~ паразит~ таракан~ крыс~ чума скот скоты зверь животные истреб~ уничтож~ выгнать гнать вышвырн~ сжечь вешать убить убью убей сломаю сломать порву морду пасть заткн~ ненавид~ презира~ голая голые голых голую секс~ эротик~ жёстк~ цензур~ женщин~ девк~ свинь~ собак~ кровь
废物 白痴 蠢货 蠢猪 笨蛋 没脑子 不要脸 恶心 没用的 下贱 下流 畜生 混蛋 垃圾 害虫 蟑螂 寄生虫 老鼠屎 蛆虫 败类 低等 滚出去 滚回去 滚开 闭嘴 去死 该死 不配 杀了你 打断 打死 弄死 消灭 灭绝 赶尽杀绝 赶出去 驱逐 烧死 吊死 裸体 全裸 裸女 美女 性爱 性感 色情 情色 激情 成人 诱惑 巨乳 乳房 欲望 廢物 蠢貨 蠢豬 沒腦子 不要臉 噁心 沒用的 下賤 滾出去 滾回去 滾開 閉嘴 不配 殺了你 打斷 消滅 滅絕 趕盡殺絕 趕出去 驅逐 害蟲 寄生蟲 裸體 性愛 誘惑
クズ ゴミ 馬鹿 バカ ばか アホ ブス キモい 気持ち悪い 役立たず 能無し 黙れ 消えろ 失せろ 殺す 殺し 潰す 害虫 寄生虫 ゴキブリ 生きる価値 皆殺し 追い出せ 追い払え 絶滅 駆除 根絶やし 人間じゃない 全裸 巨乳 エロ アダルト 過激 露出 濡れ
쓰레기 바보 멍청 등신 얼간이 더러운 역겨운 쓸모없는 한심한 닥쳐 꺼져 죽어 죽여 죽일 패버 때려 부러뜨 벌레 해충 바퀴벌레 기생충 짐승 박멸 몰살 말살 쫓아내 추방 불태워 알몸 벌거벗 나체 야한 성인 에로 노출 가슴
"""
FRAMES = """
you|your|yourself|they|those|them|you are|you're|youre|you all|all of you|you stupid|you should|you deserve|shut up|fuck you|go die|drop dead|go kill|kill you|kill yourself|kill them|hate you|hope you|i hope|i will|i'll|find you|hurt you|will kill|will find|get out|go back|keep out|driven out|wiped out|no right|deserve to|deserve no|not deserve|deserves to|to die|to live|no mercy|like you|such a|cut your|slit your|your throat|your head|your face|your teeth|your house|beat you|shoot you|rape you|to death|waste of|piece of|of shit|son of|nobody wants|nobody likes|everyone hates|everybody hates|everybody despises|they are|are animals|are vermin|are parasites|not human|of them|them all|adults only|sign up|having sex|have sex|live sex|free porn|on camera|pictures of|videos of|at home
eres|eres un|eres una|eres el|tu madre|hijo de|de puta|de mierda|vete a|te voy|voy a|que te|ojalá te|te mueras|te odian|todos te|pedazo de|de basura|son una|son unos|son unas|hay que|fuera de|no merecen|ni uno|que los|sin censura|mujeres desnudas
tu es|tu n'es|vous êtes|espèce de|ta gueule|sale race|va te|te faire|fils de|de pute|de merde|je vais|vais te|te tuer|te déteste|tous des|sont des|sont de|il faut|faut les|qu'on les|ne méritent|pas de vivre|dehors les|femmes nues|bande de|gros porc|ferme la|la ferme
du bist|ihr seid|du dumm|halt die|halts maul|halt's maul|fick dich|verpiss dich|geh sterben|du stück|stück scheiße|ich bring|bring dich|dich um|ich breche|breche dir|du hast|hassen dich|alle hassen|sie sind|alle sind|man muss|muss man|muss sie|raus mit|keine gnade|nackte frauen|ohne zensur
ты|вы|ты тупой|ты просто|пошёл вон|пошел вон|иди на|пошёл на|чтоб ты|чтобы ты|я тебя|тебя убью|тебе ноги|все тебя|тебя ненавидят|их надо|надо их|всех их|не люди|не заслуживают|вон из|без цензуры|голые женщины
你这个|你這個|你们这些|你們這些|你就是|全家|这些人|那些人|怎么不|给我滚|給我滾|都是|就是|都该|都該|不配活|不配做|お前|おまえ|お前ら|てめえ|こいつら|あいつら|奴ら|너는|너희|네놈|네년|저놈들|그놈들|이놈들
"""

_SEEN = re.compile("[\xad​-‏⁠﻿̶̵]")
_LEET = str.maketrans("013457@$+!|€", "oieastasti" + "le")
_ALIKE = str.maketrans("асеорхуіјѕһɑοϲνκ", "aceopxyijshaocvk")
_TOKEN = re.compile(r"[A-Za-zÀ-ɏ0-9@$+!|*'’]+|[Ѐ-ӿ]+|[㐀-鿿豈-﫿々぀-ヿ]+|[가-힣]+")
_CJK = re.compile("[぀-ヿ㐀-鿿가-힣]")
_IN_CJK = re.compile(r"(?<=[぀-ヿ㐀-鿿])[\s*·•.．_\-~|/＊]+(?=[぀-ヿ㐀-鿿])")
_HANGUL = re.compile("[가-힣]")
#: Hangul keeps its blanks, but for letters that stand alone.
_IN_HANGUL = re.compile(r"(?<=[가-힣])[*·•.．_\-~|/＊]+(?=[가-힣])|(?<=(?<![가-힣])[가-힣])[ ]+(?=[가-힣](?![가-힣]))")
_IN_WORD = re.compile(r"(?<=[A-Za-zÀ-ɏЀ-ӿ])[*·•._\-~](?=[A-Za-zÀ-ɏЀ-ӿ])")
_SPACED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ .*_\-]){3,}[^\W\d_](?![^\W\d_])")
#: What a word with its letters apart holds in any case (a quick look).
_APART = re.compile(r"[ .*_\-][^\W\d_][ .*_\-][^\W\d_][ .*_\-]")
_RUN = re.compile(r"(.)\1{2,}")
#: Capitalized words in a row, as names of people and places are written, unless the first only starts a sentence.
_NAME = re.compile(r"(?<![A-Za-zÀ-ɏЀ-ӿ])[A-ZÀ-ÞА-ЯЁ][a-zß-ÿа-яё]+(?: [A-ZÀ-ÞА-ЯЁ][a-zß-ÿа-яё]+)+(?![*·•@$+|0-9]*[A-Za-zÀ-ɏЀ-ӿ])")
_STARTS = frozenset("a an the you your no all every each keep only what if they these those this that i we he she it go shut drop kill und der die das du ihr alle kein keine nur les le la tous toutes un une tu vous seul aucun aucune los las el todos todas ningún ninguna solo tú eres un una все вы ты".split())
#: Most letters of a seed word that is a name by chance ("Puta Ziji").
NAME_MOST = 4
_SENTENCE = re.compile(r"[.!?。！？…\n]+")


@dataclass
class Lexicon:
    """Grades of words and pairs, of stems (without "~") and of CJK n-grams; the words by (first, last, length) for masked spellings."""

    words: dict[str, int] = field(default_factory=dict)
    stems: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    masked: dict[tuple[str, str, int], str] = field(default_factory=dict)

    def grade(self, token: str) -> int | None:
        g = self.words.get(token)
        if g is None:
            g = self.grams.get(token) if token[:1] >= "\u3040" else self.stems.get(token[:-1]) if token[-1:] == "~" else None
        return g


@lru_cache(maxsize=1)
def lexicon() -> Lexicon:
    x = Lexicon()
    entries = [(g, w) for g, lines in enumerate((PLAIN_ABUSE, COMPANY)) for w in lines.split()]
    for g, w in [*entries, *((2, w) for line in FRAMES.strip().split("\n") for w in line.split("|"))]:
        to = x.grams if w[0] >= "\u3040" else x.stems if w[-1] == "~" else x.words
        to.setdefault(w.rstrip("~").replace(" ", "") if to is x.grams else w.rstrip("~"), g)
    for w, g in sorted(x.words.items(), key=lambda kv: (kv[0].isascii(), kv[0])):
        if len(w) > 3 and g < 2 and " " not in w:
            x.masked[w[0], w[-1], len(w)] = w
    return x


#: Plain spellings of the words a worker has met (cleared when full).
_KNOWN_FORMS: dict[str, str] = {}
MOST_FORMS = 200_000
#: Sentences that a worker remembers with their codes (cleared when full).
MOST_SENTENCES = 20_000


def plain_word(w: str) -> str:
    got = _KNOWN_FORMS.get(w)
    if got is None:
        if len(_KNOWN_FORMS) >= MOST_FORMS:
            _KNOWN_FORMS.clear()
        got = _plain_word(w)
        if len(w) <= 40:
            _KNOWN_FORMS[w] = got
    return got


def _known(w: str) -> str | None:
    """The word itself or its stem, where the lexicon has it."""
    x = lexicon()
    if w in x.words:
        return w
    for n in range(min(len(w), 16), 3, -1):
        if w[:n] in x.stems:
            return w[:n] + "~"
    return None


def _plain_word(w: str) -> str:
    """A word's plain spelling: look-alikes, leet digits, masks and drawn-out letters undone where that gives a known word."""
    w = w.strip("'’!|+*" if w.strip("'’!|+*") else "")
    if (k := _known(w)) is not None:
        return k
    if not w.isascii():
        w2 = w.translate(_ALIKE)
        if w2.isascii() and (k := _known(w2)) is not None:
            return k
    if "*" in w:
        bare = w.replace("*", "")
        if (k := _known(bare)) is not None:
            return k
        if len(bare) > 1 and (m := lexicon().masked.get((w[0], w[-1], len(w)))):
            return m
        w = bare
    v = w.translate(_LEET) if not w.isalpha() and any(c.isalpha() for c in w) else w
    if (k := _known(v)) is not None:
        return k
    v = v.strip("'’")
    for to in (r"\1", r"\1\1"):
        if (k := _known(_RUN.sub(to, v))) is not None:
            return k
    x = re.sub(r"(.)\1+$", r"\1", v)
    return k if (k := _known(x)) is not None else v


def _starts(text: str, at: int) -> bool:
    """Whether a sentence starts at a place."""
    while at and text[at - 1] in " \t\"“„«»¿¡(":
        at -= 1
    return not at or text[at - 1] in ".!?。！？…\n:;"


def _unnamed(m: re.Match) -> str:
    """Runs of capitalized words as 'Nn', but for the words that the seeds know, whatever their letter case or spelling. Only
    one short seed alone among other words may be a name by chance, unless it follows the word that starts a sentence."""
    words = m[0].split(" ")
    low = [w.lower() for w in words]
    x = lexicon()
    if any(x.words.get(f"{a} {b}") is not None for a, b in zip(low, low[1:])):
        return m[0]
    keep = 1 if low[0] in _STARTS else 0
    if len(words) - keep < 2:
        return m[0]
    known = [i for i, w in enumerate(low) if i >= keep and x.grade(plain_word(w)) is not None]
    if len(known) == 1 and len(low[known[0]]) <= NAME_MOST and not (len(words) == 2 and known == [1] and _starts(m.string, m.start())):
        known = []
    return " ".join(w if i < keep or i in known else "Nn" for i, w in enumerate(words))


def sentences(text: str) -> list[str]:
    """Sentences in lower case, without names and with what hides letters undone."""
    t = text if text.isascii() else _SEEN.sub("", unicodedata.normalize("NFKC", text))
    t = _NAME.sub(_unnamed, t).lower()
    if _APART.search(t):
        t = _SPACED.sub(lambda m: re.sub(r"[ .*_\-]", "", m[0]), t)
    if not t.isascii():
        t = _IN_CJK.sub("", t)
        if _HANGUL.search(t):
            t = _IN_HANGUL.sub("", t)
    # a sign inside a word is a mask, not an end of a sentence
    return _SENTENCE.split(_IN_WORD.sub("*", t))


def words(sentence: str) -> list[str]:
    """A sentence as plain words and runs of CJK letters."""
    row: list[str] = []
    forms = _KNOWN_FORMS
    for w in _TOKEN.findall(sentence):
        if w[0] >= "\u3040":
            row.append(w)
        elif w in forms:
            row.append(forms[w])
        elif w.strip("'’!|+*@$"):
            row.append(plain_word(w))
    return row


def tokens(text: str) -> list[list[str]]:
    return [row for s in sentences(text) if (row := words(s))]


def features(row: list[str]) -> list[str]:
    """Words, pairs of words, and the CJK n-grams of two to four letters of a sentence, with repeats."""
    out, last = [], ""
    for w in row:
        if w[0] >= "\u3040":
            out += [w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)]
            last = ""
        else:
            out.append(w)
            if last:
                out.append(f"{last} {w}")
            last = w
    return out


def cut(run: str, grams: ahocorasick.Automaton | None) -> list[tuple[str, int]]:
    """A run of CJK letters as known n-grams (longest first, from the left) and ("", letters) between them."""
    hits = [(e + 1 - n, e + 1) for e, n in grams.iter(run)] if grams else []
    if not hits:
        return [("", len(run))]
    taken, picked = bytearray(len(run)), []
    for a, b in sorted(hits, key=lambda x: (x[0] - x[1], x[0])):
        if not any(taken[a:b]):
            taken[a:b] = b"\x01" * (b - a)
            picked.append((a, b))
    out, at = [], 0
    for a, b in sorted(picked):
        if a > at:
            out.append(("", a - at))
        out.append((run[a:b], b - a))
        at = b
    if at < len(run):
        out.append(("", len(run) - at))
    return out


class Vocabulary:
    """The tokens that have a weight of their own: the lexicon's and the learned ones, by number.

    A sentence is written as numbers: a known token's own, ``PAIR`` + its own for a pair that ends at the word before it in the
    list, -2 n for n unknown words, -2 k - 1 for k CJK letters that belong to no known n-gram.
    """

    PAIR = 1 << 24

    def __init__(self, learned: list[str]):
        self.learned = sorted(learned)
        x = lexicon()
        self.names = sorted({*x.words, *x.grams, *(f + "~" for f in x.stems), *learned})
        self.ids = {f: i for i, f in enumerate(self.names)}
        self.letters = [len(f) if f[0] >= "\u3040" else 0 for f in self.names]
        self.firsts = frozenset(f.split()[0] for f in self.names if " " in f)
        self._automaton = None
        self._memo: dict[str, list[int]] = {}

    def __getstate__(self) -> list[str]:
        return self.learned

    def __setstate__(self, learned: list[str]) -> None:
        self.__init__(learned)

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for g, n in zip(self.names, self.letters):
                if n:
                    self._automaton.add_word(g, n)
            self._automaton.make_automaton()
        return self._automaton

    def encode(self, row: list[str]) -> list[int]:
        out: list[int] = []
        unknown, last, get, firsts = 0, "", self.ids.get, self.firsts
        for w in row:
            if w[0] >= "\u3040":
                if unknown:
                    out.append(-2 * unknown)
                out += [self.ids[g] if g else -2 * k - 1 for g, k in cut(w, self.automaton)]
                unknown, last = 0, ""
                continue
            i, pair = get(w), get(f"{last} {w}") if last in firsts else None
            last = w
            if i is None and pair is None:
                unknown += 1
                continue
            if unknown:
                out.append(-2 * unknown)
                unknown = 0
            out.append(-2 if i is None else i)
            if pair is not None:
                out.append(self.PAIR + pair)
        if unknown:
            out.append(-2 * unknown)
        return out

    def text(self, text: str | None) -> list[list[int]]:
        out, memo = [], self._memo
        for s in sentences(text) if text and not text.isspace() else ():
            codes = memo.get(s)
            if codes is None:
                codes = self.encode(words(s))
                if len(memo) >= MOST_SENTENCES:
                    memo.clear()
                if len(s) <= 300:  # sentences of templates recur, names in them masked
                    memo[s] = codes
            if codes:
                out.append(codes)
        return out

    def counted(self, codes: dict[int, int]) -> Counter:
        """Numbers of the known tokens by name, of all words under '' and of all CJK letters under ``CJK_ALL``."""
        out: Counter = Counter()
        for x, n in codes.items():
            if x >= self.PAIR:
                out[self.names[x - self.PAIR]] += n
            elif x >= 0:
                out[self.names[x]] += n
                out[CJK_ALL if self.letters[x] else ""] += n * (self.letters[x] or 1)
            elif x % 2:
                out[CJK_ALL] += n * (-x // 2)
            else:
                out[""] += n * (-x // 2)
        return out


#: Key of the number of CJK letters in the counts.
CJK_ALL = "\u3000"


class Weights:
    """Log-odds of the known words, pairs and CJK n-grams."""

    def __init__(self, vocabulary: Vocabulary, bad: Counter, counts: Counter):
        """bad, counts: tokens of abusive passages and of the background (see ``Vocabulary.counted``)."""
        self.vocabulary = vocabulary
        self.odds: list[float] = []
        word, letter = bad[""] / max(counts[""], 1), bad[CJK_ALL] / max(counts[CJK_ALL], 1)
        x = lexicon()
        for f, n in zip(vocabulary.names, vocabulary.letters):
            g = x.grade(f)
            prior = BETA * math.exp(GRADES[g]) if g is not None else BETA
            s = math.log((bad[f] + prior) / (counts[f] * (letter if n else word) + BETA))
            if g in (None, 2) and not n and " " not in f:
                s = min(s, LEARNED_WORD) + UNKNOWN
            most = CAPS[g] if g is not None else LEARNED_LETTER * n if n else LEARNED_PAIR
            self.odds.append(max(FLOOR, min(most, s)))

    def scores(self, codes: list[int]) -> tuple[list[float], float, bool]:
        """One score for each known token and each run between; the words, with two CJK letters for one; whether there are any of those."""
        odds, letters, pair, out, n, cjk = self.odds, self.vocabulary.letters, Vocabulary.PAIR, [], 0.0, False
        for x in codes:
            if x < 0:
                k = -x // 2
                if x % 2:
                    out.append(LETTER * k)
                    n += k / 2
                    cjk = True
                else:
                    out.append(UNKNOWN * k)
                    n += k
            elif x < pair:
                out.append(odds[x])
                if letters[x]:
                    n += letters[x] / 2
                    cjk = True
                else:
                    n += 1
            else:
                out[-1] += odds[x - pair]
        return out, n, cjk

    def scan(self, rows: list[list[int]]) -> tuple[int, list[tuple[float, int]], list[tuple[float, int]]]:
        """(words; scores of at least ``TAIL`` and digests of the segments in sentences of words; the same in sentences with CJK letters) of an encoded text."""
        n, found = 0.0, ([], [])
        for codes in rows:
            scores, k, cjk = self.scores(codes)
            n += k
            if max(scores) > 0:
                for a, b, x in maximal(scores):
                    if x >= TAIL:  # equal passages have equal scores of their tokens
                        found[cjk].append((round(x, 4), xxhash.xxh3_64_intdigest(repr(scores[a:b])) >> 1))
        return math.ceil(n), *found


def maximal(scores: list[float]) -> Iterator[tuple[int, int, float]]:
    """All maximal scoring segments [a, b) with their sums, one left-to-right pass (Ruzzo and Tompa).

    Each open segment links to the last one before it that starts from a lower sum, so the search skips what lies between.
    """
    cum = 0.0
    stack: list[tuple[int, int, float, float, int]] = []  # a, b, sum before, sum after, link
    for i, s in enumerate(scores):
        before, cum = cum, cum + s
        if s <= 0:
            continue
        a, left, j = i, before, len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= cum:
                break
            a, left = stack[j][0], stack[j][2]
            link = stack[j][4]
            del stack[j:]
            j = link
        stack.append((a, i + 1, left, cum, j))
    for a, b, left, right, _ in stack:
        yield a, b, right - left


def _odds(n: float, expected: float) -> float:
    return math.log((n + BETA) / (expected + BETA))


def _telling(bad: int, good: int, share: float) -> bool:
    """Whether unsafe texts hold a token more often than chance would have it (Chernoff's bound on the binomial tail)."""
    n = bad + good
    p = bad / n if n else 0.0
    if p <= share or _odds(bad, good * share / (1 - share + 1e-9)) < TELLS:
        return False
    return n * (p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0)) >= CHANCE


def _holds(f: str) -> bool:
    """Whether a pair or n-gram holds a word of the lexicon that isn't a frame."""
    lex = lexicon()
    if f[0] >= "\u3040":
        return any(lex.grams.get(f[i:j], 2) < 2 for i in range(len(f)) for j in range(i + 2, len(f) + 1) if j - i < len(f))
    return " " in f and any(lex.grade(w) in (0, 1) for w in f.split())


def learn(rated: list[tuple[str, float]]) -> tuple[Vocabulary, Counter]:
    """(vocabulary, tokens of abusive passages) from texts with their mean ratings.

    The passage of an unsafe text is its best sentence under the weights; the weights follow from the passages: a few turns of
    each. Raters err, so a sentence without any evidence teaches nothing, nor does a token of fewer than ``TAUGHT`` passages.
    """
    docs = [(tokens(t), y) for t, y in rated if t]
    lex = lexicon()
    safe, unsafe = Counter(), Counter()
    for rows, y in docs:
        (unsafe if y >= 0.5 else safe).update({f for row in rows for f in features(row)})
    share = max(sum(y >= 0.5 for _, y in docs), 1) / max(len(docs), 1)
    weights = Weights(Vocabulary([]), Counter(), Counter())
    bad: Counter = Counter()
    for turn in range(4):
        picked, rest = [], []
        for rows, y in docs:
            if y < 0.5:
                rest += rows
                continue
            best = [max((s for _, _, s in maximal(weights.scores(weights.vocabulary.encode(row))[0])), default=0.0) for row in rows]
            top = max(best, default=0.0)
            for row, s in zip(rows, best):
                (picked if s >= 2.0 and (s == top or s >= 4.0) else rest).append(row)
        seen, plain = Counter(), Counter()
        for row in picked:
            seen.update(set(features(row)))
        for row in rest:
            plain.update(features(row))
        ratio = max(len(picked), 1) / max(len(rest), 1)
        # a picked sentence may be an ordinary one, but then texts that raters let pass hold it as often
        learned = [f for f, n in seen.items() if n >= TAUGHT and lex.grade(f) is None and _odds(n, plain[f] * ratio) > 0.7 and _telling(unsafe[f], safe[f], share)]
        # what disarms a word of the lexicon: pairs and n-grams around it that raters let pass
        learned += [f for f, n in plain.items() if n >= TAUGHT and n * ratio > 4 * seen[f] + 0.2 and lex.grade(f) is None and _holds(f)]
        vocabulary = Vocabulary(learned)
        bad, background = (vocabulary.counted(Counter(x for row in part for x in vocabulary.encode(row))) for part in (picked, rest))
        weights = Weights(vocabulary, bad, background)
    return vocabulary, bad


def ratings(docs: DataFrame, rated: DataFrame, limit: int = RATED) -> list[tuple[str, float]]:
    """(text, mean rating) of about ``limit`` rated documents; null ratings say nothing."""
    mean = rated.where("unsafe is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("unsafe").alias("y"))
    some = hash_sample(mean, "doc_id", limit)
    return [(r.text, r.y) for r in docs.select("doc_id", "text").where("text is not null").join(some, "doc_id").collect()]


CODES = "array<array<int>>"


def encoded(docs: DataFrame, vocabulary: Vocabulary, keep: list[str] | None = None) -> DataFrame:
    """docs(doc_id, text) → (doc_id, the columns of ``keep``, codes): every text is taken apart once, for the counts and for the scan."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    own = docs.select("doc_id", *(keep or []), "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        for b in batches:
            codes = pa.array([v.text(t) for t in b.column(b.num_columns - 1).to_pylist()], pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], codes], names=[*b.schema.names[:-1], "codes"])

    return checkpointed(own.mapInArrow(work, f"{kinds}, codes {CODES}"))


def train(rows: DataFrame, vocabulary: Vocabulary, bad: Counter) -> Weights:
    """rows(codes) → weights: the known tokens are counted over all documents (a number for each reaches the driver)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            c.update(b.column(0).flatten().flatten().to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.int32()), pa.array(c.values(), pa.int64())], names=["x", "n"])

    got = rows.select("codes").mapInArrow(work, "x int, n bigint").groupBy("x").agg(F.sum("n").alias("n"))
    # runs of unknown words come in all lengths: what they count for is summed up before it is collected
    run = F.when(F.col("x") < 0, -F.pmod(F.col("x"), F.lit(2)) - 2).otherwise(F.col("x"))
    sums = got.groupBy(run.alias("x")).agg(F.sum(F.when(F.col("x") < 0, F.col("n") * F.floor(-F.col("x") / 2)).otherwise(F.col("n"))).alias("n")).collect()
    return Weights(vocabulary, bad, vocabulary.counted({r.x: r.n for r in sums}))


def scan(rows: DataFrame, weights: Weights) -> DataFrame:
    """rows(…, codes) → (…, words, latin, cjk): the scores of each text's segments."""
    held = rows.sparkSession.sparkContext.broadcast(weights)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        for b in batches:
            n, latin, cjk = zip(*map(w.scan, b.column(b.num_columns - 1).to_pylist())) if b.num_rows else ((), (), ())
            kind = pa.list_(pa.struct([("s", pa.float64()), ("h", pa.int64())]))
            parts = [pa.array([[{"s": s, "h": h} for s, h in x] for x in col], kind) for col in (latin, cjk)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64()), *parts], names=[*b.schema.names[:-1], "words", "latin", "cjk"])

    return rows.mapInArrow(work, f"{kinds}, words bigint, latin array<struct<s:double,h:bigint>>, cjk array<struct<s:double,h:bigint>>")


def calibrate(bins: dict[float, int], low: int, words: int) -> tuple[float, float]:
    """(lambda, K) of the extreme-value law.

    bins: numbers of different passages by score (lower ends of bins of ``BIN``); low: all segments of scores within ``WIDTH`` above ``TAIL``,
    those of repeated passages too. There the background lies; lambda is fit to its different passages as an exponential
    that is cut off (equal ones are no independent evidence), K to all segments, both with ``PRIOR`` as what was seen before.
    """
    seen, lam0, per = PRIOR
    points = [(s + BIN / 2 - TAIL, n) for s, n in bins.items() if TAIL <= s + BIN / 2 < TAIL + WIDTH]
    count, total = sum(n for _, n in points), sum(x * n for x, n in points)
    a, b = 1e-3, 50.0
    for _ in range(60):  # where the posterior is highest, its slope is zero
        lam = (a + b) / 2
        slope = count * (1 / lam - WIDTH / math.expm1(min(lam * WIDTH, 700.0))) - total + seen * (1 / lam - 1 / lam0)
        a, b = (lam, b) if slope > 0 else (a, lam)
    return lam, (low + seen) / (words + seen * per) * math.exp(lam * TAIL)


#: Width of the bins of scores.
BIN = 0.1


def threshold(words: float, lam: float, k: float) -> float:
    """Score from which K n exp(-lambda S) falls under the expected number of false segments."""
    return math.log(max(k * max(words, SHORTEST) / EXPECTED, 1.0)) / lam


def score(docs: DataFrame, rated: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs(doc_id, text), rated(doc_id, unsafe) → (doc_id, the columns of ``keep``, score, passages), one row per document."""
    vocabulary, bad = learn(ratings(docs, rated) if rated is not None else [])
    codes = encoded(docs, vocabulary, keep)
    rows = checkpointed(scan(codes, train(codes, vocabulary, bad)))
    words = rows.agg(F.sum("words")).first()[0] or 0
    both = F.concat(*(F.transform(c, lambda x, k=k: F.struct(F.lit(k).alias("cjk"), x["s"].alias("s"), x["h"].alias("h"))) for k, c in ((False, "latin"), (True, "cjk"))))
    each = rows.select(F.explode(both).alias("x")).select("x.*").groupBy("cjk", "h").agg(F.max("s").alias("s"), F.count("*").alias("n"))  # different passages
    bins = each.groupBy("cjk", F.floor(F.col("s") / BIN).alias("b")).agg(F.count("*").alias("passages"), F.sum("n").alias("n")).collect()  # a row for each bin
    need = {}
    for cjk in (False, True):
        own = [(r.b * BIN, r.passages, r.n) for r in bins if r.cjk == cjk]
        lam, k = calibrate({s: n for s, n, _ in own}, sum(n for s, _, n in own if s + BIN / 2 < TAIL + WIDTH), words)
        need[cjk] = F.greatest(F.log(k * F.greatest("words", F.lit(SHORTEST)) / EXPECTED), F.lit(0.0)) / lam
    over = lambda c, cjk: F.size(F.filter(c, lambda x: x["s"] >= need[cjk]))
    best = F.greatest(*(F.coalesce(F.array_max(F.transform(c, lambda x: x["s"])), F.lit(0.0)) for c in ("latin", "cjk")))
    return rows.select("doc_id", *(keep or []), best.alias("score"), (over("latin", False) + over("cjk", True)).cast("bigint").alias("passages"))


def rates(scored: DataFrame, z: float = 1.96) -> DataFrame:
    """scored(source, passages) → (source, documents, flagged, rate, low, high) with Wilson's interval of the rate."""
    n, k = F.col("documents"), F.col("flagged")
    p = k / n
    mid, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    by = scored.groupBy("source").agg(F.count("*").alias("documents"), F.count_if(F.col("passages") > 0).alias("flagged"))
    return by.select("source", "documents", "flagged", p.alias("rate"), F.greatest(mid - half, F.lit(0.0)).alias("low"), F.least(mid + half, F.lit(1.0)).alias("high"))
