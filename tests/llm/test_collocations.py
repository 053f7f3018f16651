"""Collocations against a plain count, tiles against a dictionary, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from claimloom.llm import collocations as c


def plain(docs, max_words, least, top, cover):
    counts, totals = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, max_words + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longest = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                inner = lang, words[at : at + size]
                longest[inner] = max(longest[inner], a)
    found = {}
    for (lang, words), a in candidates.items():
        if longest[lang, words] and 100 * longest[lang, words] >= cover * a:
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, k = min((1_000_000 * a * a // (l * r), k) for k, (l, r) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *cuts[k]))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1)
    )


def texts(seed, n):
    pick = random.Random(seed)
    words = ["a", "B", "c", "É", "é", "日本", "x\x1cy", "\x85", "don't", "12", "a\xa0b", "d", "e", "f"]
    signs = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r", "\x0b", "!?", " ; "]

    def text():
        size = pick.choice([0, 1, 5, 60, 60])
        return "".join(w + pick.choice(signs) for w in pick.choices(words, [40, 30, 20, 9, 9, 8, 7, 6, 5, 4, 3, 2, 2, 1], k=size))

    rows = [(text(), pick.choice(["en", "en", "en", "de", "und", None, ""])) for _ in range(n)]
    return rows + [(None, "en"), ("", "xx"), (" \t ", "yy"), ("Only once", "zz"), ("hot phrase here " * 3000, "en"), ("same text", "en")] + [
        ("same text again", "de")
    ] * 40


@pytest.mark.parametrize(
    "seed, max_words, least, top, cover, tokens, parts",
    [(1, 3, 10, 2000, 50, 2_000_000, 3), (2, 2, 2, 7, 50, 50, 11), (3, 4, 3, 20, 80, 300, 5), (4, 3, 1, 3, 30, 1000, 1)],
)
def test_against_a_plain_count(spark, monkeypatch, seed, max_words, least, top, cover, tokens, parts):
    monkeypatch.setattr(c.make_blocks, "__defaults__", (tokens,), raising=False)
    monkeypatch.setattr(c, "ROUND", 2)
    docs = texts(seed, 300)
    df = spark.createDataFrame([(*d, "k", 3) for d in docs], "text string, lang string, word string, n int")
    found = c.collocations(df.repartition(parts), max_words, least, top, cover)
    assert sorted(tuple(r) for r in found.collect()) == plain(docs, max_words, least, top, cover)


def test_no_rows(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert c.collocations(df).collect() == []
    assert c.collocations(spark.createDataFrame([("one two", "en"), (None, None)], df.schema)).collect() == []


@pytest.mark.parametrize("dense", [1, 8, 10**9])
def test_tiles(monkeypatch, dense):
    monkeypatch.setattr(c, "TILE_BITS", 4)
    monkeypatch.setattr(c, "DENSE", dense)
    random_ = np.random.default_rng(dense)
    left = np.concatenate([random_.integers(0, 12, 2000), random_.integers(0, 2**31 - 1, 300), np.full(40, 17)])
    right = np.concatenate([random_.integers(0, 12, 2000), random_.integers(0, 2**31 - 1, 300), np.full(40, 3)])
    x, y, n = c.tile_counts(left, right)
    assert Counter(dict(zip(zip(x.tolist(), y.tolist()), n.tolist()))) == Counter(zip(left.tolist(), right.tolist()))
    assert len(x) == len(set(zip(x.tolist(), y.tolist())))


def test_a_full_bit_table_loses_nothing():
    """With all bits set each phrase counts, with no bits none does."""
    tokens = np.array([5, 6, 7, 0, 5, 6, 7, 8, 5, 6])
    full, none = np.full(c.FILTER_BITS // 8, 255, np.uint8), np.zeros(c.FILTER_BITS // 8, np.uint8)
    head, tail, n = c.phrase_counts(tokens, 5, [full])
    found = {(int(h) >> 32, int(h) & 0xFFFFFFFF, int(t) >> 32): int(k) for h, t, k in zip(head, tail, n)}
    assert found == {(5, 6, 7): 2, (6, 7, 8): 1, (7, 8, 5): 1, (8, 5, 6): 1}
    assert len(c.phrase_counts(tokens, 5, [none])[0]) == 0
