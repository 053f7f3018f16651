"""Classes of near duplicates against brute force over all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from claimloom.llm import near_dedup as nd


def shingle_counts(text):
    words = [w.decode() for w in nd.words_of(text)]
    if not words:
        return Counter()
    if len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_similarity(x, y):
    keys = x.keys() | y.keys()
    shared = x.keys() & y.keys()
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in keys) for i in shared)


def plain_classes(docs):
    parent = {d: d for d, _ in docs}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    counts = {d: shingle_counts(t) for d, t in docs}
    for a in parent:
        for b in parent:
            if a < b and counts[a] and counts[b] and plain_similarity(counts[a], counts[b]) >= 0.8 - 1e-9:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: find(d) for d in parent}


def documents():
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [[pick.choice(vocabulary) for _ in range(pick.randint(60, 200))] for _ in range(40)]
    for base in range(12):
        for edits in (0, 1, 2, 3):
            copy = list(docs[base])
            for _ in range(edits):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            docs.append(copy)
    chain = [f"c{i}" for i in range(200)]
    for shift in range(0, 60, 10):  # neighbours are similar, the ends are not
        docs.append(chain[shift : shift + 130])
    texts = [" ".join(d) for d in docs]
    texts += ["one two", "One  TWO", "one three", "", None, "   ", "same line again\n" * 30, "same line again\n" * 31]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs():
    return documents()


def test_classes(spark, docs):
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, class_id string")
    found = {r["doc_id"]: r["class_id"] for r in nd.classify(frame.repartition(5)).collect()}
    assert found == plain_classes(docs)
    kept = nd.deduplicate(frame).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(found.values()))
    assert kept[0].asDict().keys() == {"doc_id", "text", "class_id"}


def test_hot_group_is_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 7)
    words = [f"h{i}" for i in range(80)]
    rows = [(n, " ".join([*words, f"tail{n}"])) for n in range(120)] + [(500, " ".join(words[:30]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in nd.classify(frame).collect()}
    assert found == {**{n: 0 for n in range(120)}, 500: 500}


def test_similarity_is_probability_jaccard(docs):
    counts = [(d, shingle_counts(t), nd.shingles(nd.words_of(t))) for d, t in docs if t and t.strip()]
    for _, x, a in counts[::7]:
        for _, y, b in counts[::5]:
            assert nd.similarity(a, b) == pytest.approx(plain_similarity(x, y), abs=1e-12)


def test_registers_agree_as_often_as_documents_are_similar():
    pick = np.random.default_rng(5)
    shared, own = pick.integers(1, 2**63, 300, dtype=np.uint64), pick.integers(1, 2**63, 200, dtype=np.uint64)
    weights = pick.integers(1, 5, 500)
    one = (np.sort(np.append(shared, own[:100])), weights[:400])
    other = (np.sort(np.append(shared, own[100:])), weights[100:])
    signed = nd.signatures([one, other], 20_000)
    assert (signed[0] == signed[1]).mean() == pytest.approx(nd.similarity(one, other), abs=0.015)


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nd.classify(empty).collect() == []
    rows = [(1, "a b c d e f g")] * 3 + [(None, "a b c d e f g"), (None, None), (2, "")]
    found = sorted(map(tuple, nd.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert found == sorted([(1, 1, 4)] * 3 + [(None, 1, 4), (None, None, 1), (2, 2, 1)], key=repr)
    kept = [r["doc_id"] for r in nd.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(kept, key=repr) == [1, 2, None]


def test_rows_are_told_apart_by_more_than_their_id(spark):
    words = " ".join(f"w{i}" for i in range(60))
    other, third = (" ".join(f"{k}{i}" for i in range(60)) for k in "xy")
    rows = [
        (1, words), (2, f"{words} extra"), (2, other), (None, f"{words} more"), (None, third), (None, f"{third} end"),
        (None, "all alone here as it is"), (7, f"{other} end"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, nd.classify(frame).collect()), key=repr)
    expected = [(1, 1, 3), (2, 1, 3), (None, 1, 3), (2, 2, 2), (7, 2, 2), (None, None, 2), (None, None, 2), (None, None, 1)]
    assert found == sorted(expected, key=repr)
    kept = {(r["doc_id"], r["text"]) for r in nd.deduplicate(frame).collect()}
    assert {(1, words), (2, other), (None, "all alone here as it is")} < kept
    assert len(kept) == 4 and len({t for d, t in kept if t.startswith(third)}) == 1


@pytest.mark.parametrize("block, few", [(200, 50), (6, 0), (200, 10**9)])
def test_edited_copies_around_the_threshold(spark, monkeypatch, block, few):
    """Many copies of one text, about half of them similar to no other: all classes are found either way."""
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "FEW_PAIRS", few)
    pick = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for n in range(70):
        copy = list(base)
        for at in pick.sample(range(100), pick.randint(1, 5)):
            copy[at] = f"e{pick.randrange(10**6)}"
        rows.append((n, " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in nd.classify(frame).collect()}
    assert found == plain_classes(rows)
    assert 1 < len(set(found.values())) < 60


def test_likely_pairs_include_all_similar_ones(docs):
    counted = [(i, nd.shingles(nd.words_of(t))) for i, t in docs if t and t.strip()]
    found = set(nd.likely([counted[::2], counted], 0.8))
    for i, a in counted[::2]:
        for j, b in counted:
            assert (i, j) in found or nd.similarity(a, b) < 0.8
