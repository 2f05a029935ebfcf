"""Byte-level BPE as a deterministic automaton over tokens.

The automaton is built by successive merge gadgets (Berglund, Martens and van der Merwe, "Constructing a
BPE Tokenization DFA", 2024). It starts with one state that loops on all bytes. The gadget of merge
(a, b) -> c takes arc b away from the state behind a (a copy of what a's arc led to), gives an arc c
to every state that still has arc a, and lets it lead where b's arc led. After all merges the paths of
the automaton are exactly the right tokenizations, one for each byte string.

A state is the class of what may follow a token, so it is named by that token. Tokens are numbered in preorder of the forest of
left parts, latest merge first: an arc that a gadget takes away is then missing together with one range of numbers (itself and
what was copied from it later), so a state's row of the transition table is a short list of ranges of closed arcs. The
rows are compiled once on the driver, completely, equal rows once, and broadcast. Encoding walks a
pre-split word from left to right: each reachable position holds the last token of its only right
tokenization, and the tokens that the trie finds there move it on where the table allows; ids are
read off backwards. Decoding emits the arc labels (bytes) of the ids.

Defined results: null and empty texts give an empty list; strings of special tokens are ordinary text;
very long texts and words are encoded whole, in time linear in their bytes times the longest token.
"""

from __future__ import annotations

import json
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Splits a text before the merges, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Most words a worker remembers.
WORD_CACHE = 100_000
#: Texts encoded at once.
ROWS = 500


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in the vocabulary file: printable Latin-1 as it is, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str | None = None) -> bytes:
    """The vocabulary file, by default byte_bpe_50k of the installed public tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        return f.read()


class Table:
    """The compiled automaton: labels of the tokens and, by state, the ranges of closed arcs."""

    def __init__(self, blob: bytes):
        model = json.loads(blob)["model"]
        letters = byte_letters()
        ids = model["vocab"]
        self.label: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in ids.items() if all(c in letters for c in t)}
        size = max(ids.values()) + 1
        step, left, right = [0] * size, [-1] * size, [-1] * size  # the gadget that made a token, and from what; bytes have 0
        taken: list[dict[int, int]] = [{} for _ in range(size)]  # by state, the arcs that gadgets took from it, in turn
        kids: list[list[int]] = [[] for _ in range(size)]  # tokens whose arcs were copied from a token's
        self.tokens = [i for i, b in self.label.items() if len(b) == 1]
        for k, pair in enumerate(model["merges"], 1):
            x, y = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = ids[x], ids[y], ids[x + y]
            # the gadget: arc b leaves the state behind a; c copies a's arcs in and the state that b leads to
            taken[a].setdefault(b, k)
            step[c], left[c], right[c] = k, a, b
            kids[a].append(c)
            self.tokens.append(c)
        self.place, end = self._number(kids, [t for t in self.tokens if left[t] < 0], size)
        # an arc taken at k is closed with its copies of k and later, which are numbered next to it
        own = [[(k, self.place[b], self._end(self.place[b], kids[b], step, end, k)) for b, k in arcs.items()] for arcs in taken]
        self.row = np.zeros(size, np.int32)  # the row of each state
        rows: dict[tuple, int] = {}
        spans: list[list[tuple[int, int]]] = []
        base: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for t in self.tokens:  # in the order of their gadgets
            key: tuple = (t,)
            if right[t] >= 0:
                r = right[t]
                n = bisect_left(own[r], (step[t],))
                base[t] = base[r] + [(a, b) for _, a, b in own[r][:n]]
                if not own[t]:
                    key = (r, n)
            if key not in rows:
                rows[key] = len(spans)
                spans.append(self._joined(base[t] + [(a, b) for _, a, b in own[t]]))
            self.row[t] = rows[key]
        self.first = np.cumsum([0, *map(len, spans)]).astype(np.int64)  # where a row's ranges begin
        self.opens = np.array([a for s in spans for a, _ in s], np.int32)
        self.closes = np.array([b for s in spans for _, b in s], np.int32)

    @staticmethod
    def _number(kids: list[list[int]], roots: list[int], size: int) -> tuple[np.ndarray, list[int]]:
        """Preorder places, children latest first, and the place behind each token's last descendant."""
        place, end, n = np.zeros(size, np.int32), [0] * size, 0
        stack = [(t, False) for t in roots]
        while stack:
            t, done = stack.pop()
            if done:
                end[t] = n
                continue
            place[t] = n
            n += 1
            stack.append((t, True))
            stack += [(c, False) for c in kids[t]]  # made in turn, so the latest is taken first
        return place, end

    @staticmethod
    def _end(start: int, kids: list[int], step: list[int], end: list[int], k: int) -> int:
        i = bisect_left(kids, k, key=step.__getitem__)
        return end[kids[i]] if i < len(kids) else int(start) + 1

    @staticmethod
    def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if out and a <= out[-1][1]:
                if b > out[-1][1]:
                    out[-1] = (out[-1][0], b)
            else:
                out.append((int(a), int(b)))
        return out


class Automaton:
    """A compiled table at work: the trie of the labels, and the words met so far."""

    def __init__(self, table: Table):
        self.label, self.place, self.row, self.first = table.label, table.place.tolist(), table.row.tolist(), table.first.tolist()
        self.opens, self.closes = array("i", table.opens.tobytes()), array("i", table.closes.tobytes())
        self.trie: dict = {}
        for i in table.tokens:
            node = self.trie
            for byte in self.label[i]:
                node = node.setdefault(byte, {})
            node[-1] = i
        self.words: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(PATTERN).findall

    def open(self, t: int, x: int) -> bool:
        """Whether the state behind t has arc x."""
        r, p = self.row[t], self.place[x]
        lo = self.first[r]
        i = bisect_right(self.opens, p, lo, self.first[r + 1])
        return i == lo or self.closes[i - 1] <= p

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        n = len(word)
        if n == 1:
            return (self.trie[word[0]][-1],)
        last = [-1] * (n + 1)
        trie = self.trie
        reach = [False] * (n + 1)
        reach[0] = True
        for i in range(n):
            if not reach[i]:
                continue
            t, node, j = last[i], trie, i
            while j < n:
                node = node.get(word[j])
                if node is None:
                    break
                j += 1
                x = node.get(-1)
                if x is not None and not reach[j]:
                    if t < 0 or self.open(t, x):
                        reach[j], last[j] = True, x
        out, j = [], n
        while j:
            out.append(last[j])
            j -= len(self.label[last[j]])
        return tuple(reversed(out))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        words = self.words
        for w in self.split(text or ""):
            got = words.get(w)
            if got is None:
                got = self.encode_word(w.encode("utf-8", "replace"))
                if len(w) <= 24:
                    if len(words) >= WORD_CACHE:
                        words.clear()
                    words[w] = got
            out += got
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.label[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def compiled(path: str | None = None) -> Table:
    """The table of a vocabulary file, compiled once by the driver."""
    return Table(vocabulary(path))


def automaton(table: Table) -> Automaton:
    """One automaton per worker process and broadcast table."""
    if not hasattr(table, "at_work"):
        table.at_work = Automaton(table)
    return table.at_work


def encode(docs: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(compiled(path))
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(held.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):  # ids take several times the space of their text
                b = whole.slice(at, ROWS)
                ids = [a.encode(t) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(work, f"{key} {kind}, ids array<int>")


def decode(rows: DataFrame, key: str, ids: str, path: str | None = None) -> DataFrame:
    """(key, text) of every row; null stays null."""
    held = rows.sparkSession.sparkContext.broadcast(compiled(path))
    kind = rows.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(held.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else a.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=[key, "text"])

    return rows.select(key, F.col(ids)).mapInArrow(work, f"{key} {kind}, text string")
