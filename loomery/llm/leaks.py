"""Evaluation passages inside training text.

Test items are cut into windows of n words (Chinese: letters and digits) in one normal form; the windows form a
hash set that is broadcast only after its size is checked. Beyond it, windows are joined by hash; of the corpus's windows only those
pass to the join that a bitmap of the items' hashes (of fixed size) lets through. Either way a hit is verified against the
window itself, and its place in the text is known, so found spans can be removed for any number of items.

Defined results: null and empty texts leak nothing; an item shorter than a window can't be found;
items with equal windows are each reported; repeated documents are each reported; very long texts
are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS, LETTERS = 12, 24
#: Most windows that are broadcast (some 250 bytes each); beyond, windows are joined by hash.
MOST = 200_000
#: Bits (as a power of two) of the map of the items' hashes.
MAP_BITS = 26
_WORD = re.compile(r"[^\W_]+")
_HAN = re.compile(r"^zh", re.I)


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Runs of letters and digits in lower case, with their places in the text."""
    low = text.lower()
    if len(low) == len(text):
        return [(m[0], m.start(), m.end()) for m in _WORD.finditer(low)]
    at = [i for i, c in enumerate(text) for _ in c.lower()]  # a lower case of two characters
    return [(m[0], at[m.start()], at[m.end() - 1] + 1) for m in _WORD.finditer(low)]


def windows(text: str | None, letters: bool) -> Iterator[tuple[str, int, int]]:
    """All windows of a text in normal form, with their places in it."""
    words = words_of(text or "")
    if not letters:
        names = [w for w, _, _ in words]
        for i in range(len(words) - WORDS + 1):
            yield " ".join(names[i : i + WORDS]), words[i][1], words[i + WORDS - 1][2]
        return
    run = "".join(w for w, _, _ in words)
    if len(run) < LETTERS:
        return
    at = [(min(a + k, b - 1)) for w, a, b in words for k in range(len(w))]
    for i in range(len(run) - LETTERS + 1):
        yield run[i : i + LETTERS], at[i], at[i + LETTERS - 1] + 1


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, letters, gram) of all items, distinct."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for i, lang, t in zip(*(c.to_pylist() for c in b.columns)):
                letters = bool(_HAN.match(lang or ""))
                for g in dict.fromkeys(g for g, _, _ in windows(t, letters)):
                    out[0].append(i), out[1].append(letters), out[2].append(g)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.string())], names=["item_id", "letters", "gram"])

    return items.select("item_id", "lang", "text").mapInArrow(work, "item_id bigint, letters boolean, gram string")


class Grams:
    """Hash set of windows, with what verifies a hit."""

    def __init__(self, rows: list[tuple[int, bool, str]]):
        self.hashes: dict[int, list[tuple[str, int]]] = {}
        self.starts: set[str] = set()
        self.runs: set[str] = set()
        for item, letters, gram in rows:
            self.hashes.setdefault(xxhash.xxh3_64_intdigest(gram), []).append((gram, item))
            if letters:
                self.runs.add(gram[:6])
            else:
                self.starts.add(gram[: gram.index(" ", gram.index(" ") + 1)])

    def hits(self, text: str | None) -> Iterator[tuple[int, str, int, int]]:
        """(item, window, from, to) of the windows of items that stand in the text."""
        if not text:
            return
        words = words_of(text)
        starts, runs, get = self.starts, self.runs, self.hashes.get
        names = [w for w, _, _ in words]
        for i in range(len(words) - WORDS + 1):
            if f"{names[i]} {names[i + 1]}" in starts:
                gram = " ".join(names[i : i + WORDS])
                for other, item in get(xxhash.xxh3_64_intdigest(gram), ()):
                    if other == gram:
                        yield item, gram, words[i][1], words[i + WORDS - 1][2]
        run = "".join(names)
        at: list[int] | None = None
        for i in range(len(run) - LETTERS + 1):
            if run[i : i + 6] in runs:
                gram = run[i : i + LETTERS]
                for other, item in get(xxhash.xxh3_64_intdigest(gram), ()):
                    if other == gram:
                        if at is None:
                            at = [min(a + k, b - 1) for w, a, b in words for k in range(len(w))]
                        yield item, gram, at[i], at[i + LETTERS - 1] + 1

    def find(self, text: str | None) -> dict[int, set[str]]:
        """item → windows of it that stand in the text."""
        found: dict[int, set[str]] = {}
        for item, gram, _, _ in self.hits(text):
            found.setdefault(item, set()).add(gram)
        return found


def _few(grams: DataFrame, most: int) -> Grams | None:
    """The hash set, if the items have no more than ``most`` windows."""
    few = grams.limit(most + 1).collect()
    return Grams([tuple(r) for r in few]) if len(few) <= most else None


def find(docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, item_id, windows): documents with the items whose passages they hold."""
    grams = item_windows(items)
    few = _few(grams, most)
    if few is None:
        hits = _joined(docs.select("doc_id", "text"), ["doc_id"], grams)
        return hits.groupBy("doc_id", "item_id").agg(F.countDistinct("gram").alias("windows"))
    held = docs.sparkSession.sparkContext.broadcast(few)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = held.value
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for i, t in zip(*(c.to_pylist() for c in b.columns)):
                for item, found in g.find(t).items():
                    out[0].append(i), out[1].append(item), out[2].append(len(found))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "item_id", "windows"])

    long = docs.select("doc_id", "text").where(F.length("text") >= min(2 * WORDS - 1, LETTERS))
    return long.mapInArrow(work, "doc_id bigint, item_id bigint, windows bigint")


def _digest(gram: str) -> int:
    return xxhash.xxh3_64_intdigest(gram) - (1 << 63)


def _bitmap(grams: DataFrame) -> np.ndarray:
    """Bits of the items' hashes; at most 2 to the power of ``MAP_BITS - 6`` numbers reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.array([_digest(g) for g in b.column(0).to_pylist()], np.int64) & ((1 << MAP_BITS) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(h >> 6), pa.array((np.uint64(1) << (h & 63).astype(np.uint64)).view(np.int64))], names=["at", "bits"])

    got = grams.select("gram").mapInArrow(work, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy()
    return out


def _joined(docs: DataFrame, key: list[str], grams: DataFrame) -> DataFrame:
    """docs(key…, text) → (key…, item_id, gram, start, stop) for any number of items: the corpus's windows that the bitmap lets through, joined by hash and verified."""
    held = docs.sparkSession.sparkContext.broadcast(_bitmap(grams))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*key).schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for b in batches:
            for i, t in enumerate(b.column(b.num_columns - 1).to_pylist()):
                found = [w for letters in (False, True) for w in windows(t, letters)]
                h = np.array([_digest(g) for g, _, _ in found], np.int64)
                low = h & ((1 << MAP_BITS) - 1)
                keep = np.flatnonzero((bits[low >> 6].view(np.uint64) >> (low & 63).astype(np.uint64)) & np.uint64(1))
                if not len(keep):
                    continue
                rows = pa.array([i] * len(keep), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(rows) for c in b.columns[:-1]), pa.array(h[keep]), pa.array([found[k][0] for k in keep], pa.string()), *(pa.array([found[k][n] for k in keep], pa.int64()) for n in (1, 2))],
                    names=[*b.schema.names[:-1], "h", "gram", "start", "stop"],
                )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_digest(g) for g in b.column(1).to_pylist()], pa.int64()), b.column(1)], names=["item_id", "h", "gram"])

    rows = docs.select(*key, "text").where(F.col("text").isNotNull()).mapInArrow(work, f"{kinds}, h bigint, gram string, start bigint, stop bigint")
    return rows.join(grams.select("item_id", "gram").mapInArrow(hashed, "item_id bigint, h bigint, gram string"), ["h", "gram"]).drop("h")


def scrub(docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, text, removed): texts without the leaked spans."""
    grams = item_windows(items)
    few = _few(grams, most)
    rows = docs.select("doc_id", "text")
    if few is not None:
        held = docs.sparkSession.sparkContext.broadcast(few)
        rows = rows.withColumn("spans", F.lit(None).cast("array<struct<start:bigint,stop:bigint>>"))
    else:
        held = None
        # rows are told apart by id and text; a document's spans are no more than its windows
        keyed = rows.withColumn("t", F.xxhash64("text"))
        spans = _joined(keyed.select("doc_id", "t", "text"), ["doc_id", "t"], grams).groupBy("doc_id", "t").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
        same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.t") == F.col("r.t"))
        rows = keyed.alias("l").join(spans.alias("r"), same, "left").select("l.doc_id", "l.text", "r.spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = held.value if held else None
        for b in batches:
            texts, removed = [], []
            for t, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                clean, n = cut(t, {(x, y) for _, _, x, y in g.hits(t)} if g else {(s["start"], s["stop"]) for s in found or ()})
                texts.append(clean), removed.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int64())], names=["doc_id", "text", "removed"])

    return rows.mapInArrow(work, "doc_id bigint, text string, removed bigint")


def cut(text: str | None, spans: set[tuple[int, int]]) -> tuple[str | None, int]:
    """Text without the characters of the spans, and how many those were."""
    if not spans:
        return text, 0
    out, at = [], 0
    for a, b in sorted(spans):
        if a > at:
            out.append(text[at:a])
        at = max(at, b)
    kept = "".join(out) + text[at:]
    return kept, len(text) - len(kept)
