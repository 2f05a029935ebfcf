"""The automaton against the published library, and round trips."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomery.llm import bpe


@pytest.fixture(scope="module")
def pair():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as P

    t = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return bpe.Automaton(bpe.compiled()), t


TEXTS = ["", " ", "a", "hello world", "<|endoftext|> x", "aaaaaaaaaaaaaaa", "第1话：灯笼", "나와 지도", "don't  stop\n\n now ", "\U0001f469‍\U0001f680", "x" * 20_000, "ÃƒÂ©" * 50]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_library(pair, text):
    a, t = pair
    ids = a.encode(text)
    assert ids == t.encode(text, add_special_tokens=False).ids
    assert a.decode(ids) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(pair, text):
    a, t = pair
    if "\ud800" <= max(text, default="") <= "\udfff":
        return
    assert a.encode(text) == t.encode(text, add_special_tokens=False).ids and a.decode(a.encode(text)) == text


def test_gadgets_by_hand():
    """Three merges over a and b: every right tokenization is a path, no other string of tokens is."""
    import itertools
    import json

    vocab = {"a": 0, "b": 1, "ab": 2, "aa": 3, "abab": 4}
    a = bpe.Automaton(bpe.Table(json.dumps({"model": {"vocab": vocab, "merges": ["a b", "a a", "ab ab"]}}).encode()))

    def by_merging(word):
        parts = list(word)
        for x, y in (("a", "b"), ("a", "a"), ("ab", "ab")):
            i, out = 0, []
            while i < len(parts):
                if parts[i : i + 2] == [x, y]:
                    out.append(x + y)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return tuple(vocab[p] for p in parts)

    for n in range(1, 9):
        for word in map("".join, itertools.product("ab", repeat=n)):
            assert a.encode_word(word.encode()) == by_merging(word), word
    label = {i: t for t, i in vocab.items()}
    for path in itertools.product(range(5), repeat=3):
        right = by_merging("".join(label[i] for i in path)) == path
        assert (a.open(path[0], path[1]) and a.open(path[1], path[2])) == right, path


def test_rows(spark):
    df = spark.createDataFrame([(1, "hi there", 1), (2, None, 2), (3, "", 3), (1, "hi there", 4)], "doc_id long, text string, ids long")
    got = bpe.encode(df, "doc_id", "text")
    assert sorted((r.doc_id, list(r.ids)) for r in got.collect()) == [(1, [5303, 612])] * 2 + [(2, []), (3, [])]
    assert sorted((r.doc_id, r.text) for r in bpe.decode(got, "doc_id", "ids").collect()) == [(1, "hi there")] * 2 + [(2, ""), (3, "")]
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


def test_random_bytes_stay_linear(pair):
    a, _ = pair
    word = bytes(random.Random(2).randrange(256) for _ in range(5000))
    assert b"".join(a.label[i] for i in a.encode_word(word)) == word


def _merged(text, merges):
    parts = list(text)
    for x, y in merges:
        i, out = 0, []
        while i < len(parts):
            if parts[i : i + 2] == [x, y]:
                out.append(x + y)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


def test_every_cell_of_random_vocabularies():
    """All pairs of tokens against merging itself: a pair is a path exactly if merging its text gives that pair."""
    import json

    r = random.Random(5)
    for _ in range(40):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        for _ in range(60):
            x, y = r.choice(list(vocab)), r.choice(list(vocab))
            if x + y not in vocab and len(x + y) < 9 and _merged(x + y, [*merges, (x, y)]) == [x + y]:
                vocab[x + y] = len(vocab)
                merges.append((x, y))
        a = bpe.Automaton(bpe.Table(json.dumps({"model": {"vocab": vocab, "merges": [list(m) for m in merges]}}).encode()))
        assert len(vocab) > 8
        for s in vocab:
            for t in vocab:
                assert a.open(vocab[s], vocab[t]) == (_merged(s + t, merges) == [s, t])
