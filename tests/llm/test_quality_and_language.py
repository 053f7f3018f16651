"""Counts of quality rules against plain loops, forest and network by what they must tell apart."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import TESTDATA

from claimloom.llm import langid, quality
from claimloom.llm.registry import QUERIES

BLANK = " \t\n\r\x0b\x0c"
TEXTS = [
    None, "", "   \n\t", "one", "one two three", "a b c a b c", "a b c a b c a b", "x x x x x", "é ü 日本 🙂🙂",
    "same\nsame\n same\n\n\nsame", "#tag *b* $5 50% a&b |c| <d>", "a\xa0b c　d", "line\r\nline\r\n", "b c\x0bd\x0ce",
    " ".join(f"w{i % 40}" for i in range(400)), " ".join(f"w{i}" for i in range(60)), ("go on " * 40).strip(),
]


def plain_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = text.split("\n")
    doubled = sum(bool(line.strip(BLANK)) and line in lines[:i] for i, line in enumerate(lines))
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), doubled, len(covered), failed


def test_counts(spark):
    pick = random.Random(4)
    more = [" ".join(pick.choices(["a", "b", "É", "#", "\n"], k=pick.randint(1, 90))) for _ in range(80)]
    texts = [*TEXTS, *more]
    rows = [(i, t, 1.5) for i, t in enumerate(texts)] + [(None, "no id", 1.5), (3, "one", 1.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.judge(docs, labels).collect()
    assert len(found) == len(rows)
    for row in found:
        text = "no id" if row["doc_id"] is None else texts[row["doc_id"]]
        assert tuple(row[c] for c in (*quality.BASE, "base_failed")) == plain_counts(text), text
        assert row["kept"] == (not row["base_failed"]) and row["score"] is None
    assert quality.judge(docs.limit(0), labels).collect() == []


def test_repeated_words_of_many_different_words():
    pick = np.random.default_rng(0)
    ids = np.append(pick.permutation(2_500_000)[:1000] + 2_000_000, [2_000_001, 5, 6, 7, 5, 6, 7])
    assert quality.repeated_words(ids) == 6


def test_forest_finds_what_is_rare_and_costs_few_good_ones():
    pick = np.random.default_rng(1)
    good, bad = pick.normal(0, 1, (3000, 4)), pick.normal(0, 1, (200, 4))
    bad[:, 2:] += 9
    rows, wrong = np.concatenate([good, bad]), np.arange(3200) >= 3000
    forest = quality.calibrate(quality.grow(rows, wrong), rows, wrong)
    dropped = forest.score(rows) > forest.threshold
    assert dropped[wrong].mean() > 0.9
    assert dropped[~wrong].mean() <= quality.GOOD_LOST + 0.001
    same = quality.grow(rows, wrong)
    assert np.array_equal(same.score(rows), forest.score(rows))


def test_path_lengths_of_a_forest_are_those_of_its_trees():
    rows = np.array([[0.0], [1.0], [2.0], [100.0]])
    forest = quality.grow(rows, np.zeros(4, bool), trees=50)
    scores = forest.score(rows)
    assert scores[3] == scores.max() and ((0 < scores) & (scores < 1)).all()


@pytest.mark.parametrize("sf", ["0.01"])
def test_verdicts_on_labelled_documents(spark, sf):
    folder = f"{TESTDATA}/sf{sf}"
    found = QUERIES["op3_quality_rules"](spark, folder).select("doc_id", "kept", "base_failed")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.where("NOT base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


# --- language


def test_held_out_accuracy(spark):
    folder = f"{TESTDATA}/sf0.01"
    found = QUERIES["op4_language_id"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    right = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert len(right) > 100 and np.mean(right) > 0.97


def test_nothing_held_out_is_learnt_from(spark):
    rows = [(n, f"text {n} of some words", "held" if zlib.crc32(str(n).encode()) % 3 == 1 else "known") for n in range(90)]
    rows += [(None, "no id", "none"), (500, None, "none"), (501, "no language", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {lang for lang, _ in langid.training_sample(docs)} == {"known"}
    sample = langid.training_sample(docs, per_language=5)
    assert 0 < len(sample) <= 5


def test_texts_that_have_no_language(spark):
    network = langid.train([("aa", b"aaaa bbbb aaab " * 9), ("zz", b"zzzz yyyy zzzy " * 9)] * 20)
    rows = [(1, None, 2), (2, "", 2), (3, "123 !?", 2), (4, "aaaa bbbb", 2), (5, "zzzy " * 3000, 2), (4, "aaaa bbbb", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = langid.identify(docs, network).select("row.doc_id", "lang_pred", "score").collect()
    assert sorted((r[0], r[1]) for r in found) == [(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (5, "zz")]
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(docs.limit(0), network).collect() == []


def test_tables_of_byte_pairs_give_the_plain_convolution():
    network = langid.Network(["a", "b"], seed=3)
    x = np.random.default_rng(2).integers(0, 256, (5, 64 + langid.BEYOND), dtype=np.uint8)
    pooled = []
    for width, kernel in zip(langid.WIDTHS, network.kernels):
        signal = sum(kernel[k][x[:, k : k + 64]] for k in range(width))
        pooled.append(signal.max(1))
    expected = np.maximum(np.concatenate(pooled, 1) + network.bias, 0) @ network.dense + network.shift
    assert np.allclose(network.logits(x), expected, atol=1e-4)


def test_gradients():
    network = langid.Network(["a", "b", "c"], seed=5)
    network.kernels = [k.astype(float) for k in network.kernels]
    network.dense, network.bias = network.dense.astype(float), network.bias.astype(float) + 0.5
    pick = np.random.default_rng(6)
    x, y = pick.integers(97, 105, (4, 30), dtype=np.uint8), np.array([0, 1, 2, 1])

    def loss():
        pooled = []
        for width, kernel in zip(langid.WIDTHS, network.kernels):
            pooled.append(sum(kernel[k][x[:, k : k + 30 - langid.BEYOND]] for k in range(width)).max(1))
        logits = np.maximum(np.concatenate(pooled, 1) + network.bias, 0) @ network.dense + network.shift
        return -np.mean(logits[np.arange(4), y] - np.log(np.exp(logits).sum(1)))

    for values, gradient in zip(network.parameters(), network.step(x, y)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = values[at], 1e-4
        values[at] = kept + step
        high = loss()
        values[at] = kept - step
        low = loss()
        values[at] = kept
        assert (high - low) / (2 * step) == pytest.approx(gradient[at], rel=2e-2)


def test_one_row_per_label_is_learnt_from(spark, monkeypatch):
    """However many rows have the id of a label; what sets the threshold has grown no tree."""
    good, bad = (" ".join(f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)) + " " for w in ("word", "$!|"))
    rows = [(n % 40, (bad if n % 40 < 10 else good) + f"x{n}") for n in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n >= 10), 0) for n in range(40)], "doc_id long, quality int, toxic int")
    seen = []
    for name in ("grow", "calibrate"):
        kept = getattr(quality, name)
        monkeypatch.setattr(quality, name, lambda *a, kept=kept: (seen.append(len(a[-1])), kept(*a))[1])
    assert quality.learn(quality.count_rules(docs), labels) is not None
    assert seen == [40, 40]


def test_rows_are_scored_by_trees_that_have_not_seen_them():
    pick = np.random.default_rng(3)
    rows, bad = pick.normal(size=(400, len(quality.RULES))), np.arange(400) < 20
    forest = quality.grow(rows, bad, trees=30)
    own = forest.score(rows, grown=True)
    for row in (0, 200):
        unseen = [t for t in range(30) if row not in forest.grown_on[t]]
        part = quality.Forest(forest.column[unseen], forest.value[unseen], forest.depth, forest.scale)
        assert own[row] == pytest.approx(part.score(rows[row : row + 1])[0])
    few = quality.grow(rows[:3], bad[:3], trees=5)
    assert (few.score(rows[:3], grown=True) == few.score(rows[:3])).all()


@pytest.mark.parametrize("listed", [10, 50_000])
def test_the_threshold_is_set_on_all_labels(spark, listed):
    """Trees grow on a pool, but every labelled document counts for the threshold, also those beyond it."""
    pick = np.random.default_rng(8)
    rows = [(n, 100, 500, 0, 0, 0, *(pick.normal(size=len(quality.RULES)) + 4 * (n % 10 == 3)).tolist()) for n in range(900)]
    counted = spark.createDataFrame(rows, quality.COUNTED)
    labels = spark.createDataFrame([(n, int(n % 10 != 3), 0) for n in range(900)], "doc_id long, quality int, toxic int")
    forest = quality.learn(counted, labels, 60, listed)
    values, bad = np.array([r[6:] for r in rows]), np.arange(900) % 10 == 3
    in_pool = np.zeros(900, bool)
    for kind, size in ((False, 810), (True, 90)):
        dealt = f"pmod(xxhash64(doc_id, {quality.SEED}), {1 << 20}) < {60 / size} * {1 << 20}"
        ids = [r[0] for r in counted.where(dealt).select("doc_id").collect()]
        in_pool[[i for i in ids if bad[i] == kind]] = True
    assert 60 < in_pool.sum() < 240
    grown = quality.grow(values[in_pool], bad[in_pool])
    at = np.full(900, -1)
    at[in_pool] = np.arange(in_pool.sum())
    scores = grown.score(values, True, at)
    assert forest.threshold == pytest.approx(quality.calibrate(grown, scores, bad).threshold, abs=1e-12)
    assert np.array_equal(forest.column, grown.column)


def test_deciding_scores_of_many_equal_ones(spark):
    pick = np.random.default_rng(9)
    scores = np.round(pick.uniform(0.3, 0.7, 2000), 2)
    bad = pick.uniform(size=2000) < 0.2
    frame = spark.createDataFrame([(bool(b), float(s)) for b, s in zip(bad, scores)], "bad boolean, score double")
    forest = quality.grow(pick.normal(size=(9, 3)), np.arange(9) > 6, trees=3)
    whole = quality.calibrate(forest, scores, bad).threshold
    for listed in (1, 7, 300, 5000):
        some, kind, lost = quality.deciding(frame, int((~bad).sum()), listed)
        assert len(some) <= max(3, listed + 2)
        assert quality.calibrate(forest, some, kind, quality.GOOD_LOST, lost).threshold == whole
