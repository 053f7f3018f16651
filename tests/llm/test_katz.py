"""The backoff model against a plain one in dictionaries."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimloom.llm import katz

DOCS = [
    (1, "The cat sat on the mat. The cat ran."),
    (2, "the dog sat on THE mat"),
    (3, None),
    (4, ""),
    (5, "a b a b a b c a b d a b"),
    (6, "zebra quagga the cat sat on the mat once more"),
    (7, "a b a b a b c a b d a b"),
    (8, " \t the \n\x0bcat \x0c sat \r on the mat"),
    (None, "no id here but words the cat"),
    *[(n, f"w{n % 7} w{n % 5} w{n % 3} the cat w{n} é{n % 4}") for n in range(9, 120)],
]


def history_at(words, i, n):
    """The n - 1 tokens before token i; what would lie before the text is one start sign."""
    first = i - n + 1
    return tuple(words[first:i]) if first >= 0 else ("<s>", *words[:i])


def plain_scores(docs, order):
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    tokens = []
    for _, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        tokens.append([*re.findall("[^\x20\x09-\x0d]+", low), "</s>"])
    counts = [None] + [Counter() for _ in range(order)]
    for out, words in zip(held, tokens):
        for n in range(1, order + 1):
            for i in range(0 if out else len(words)):
                counts[n][(history_at(words, i, n) if n > 1 else (), words[i])] += 1
    total, types = sum(counts[1].values()), len(counts[1])

    def discounts(n):
        of = Counter(counts[n].values())
        plain = {r: 1 - 0.5 / r for r in range(1, 6)}
        if any(not of[r] for r in range(1, 7)) or 6 * of[6] >= of[1]:
            return plain
        rest = 6 * of[6] / of[1]
        found = {r: ((r + 1) * of[r + 1] / of[r] / r - rest) / (1 - rest) for r in range(1, 6)}
        return found if all(0 < d < 1 for d in found.values()) else plain

    small = [None] + [discounts(n) for n in range(1, order + 1)]
    mass = sum(small[1].get(c, 1) * c for c in counts[1].values()) / total
    rest = max(1 - mass, 1 / (total + types + 1))
    after = [None] + [{} for _ in range(order)]
    for n in range(2, order + 1):
        for (history, word), c in counts[n].items():
            after[n].setdefault(history, {})[word] = c

    def chance(n, histories, word):
        if n == 1:
            c = counts[1][((), word)]
            return small[1].get(c, 1) * c / total * (1 - rest) / mass if c else rest
        history = histories[n]
        seen = after[n].get(history)
        if not seen:
            return chance(n - 1, histories, word)
        size = sum(seen.values())
        given_up = sum((1 - small[n].get(c, 1)) * c for c in seen.values())
        left = max(given_up, 0.5) / size
        if word in seen:
            return (1 - left) / (1 - given_up / size) * small[n].get(seen[word], 1) * seen[word] / size
        below = sum(chance(n - 1, histories, w) for w in seen)
        return left / (1 - below) * chance(n - 1, histories, word)

    def histories_at(words, i):
        return [None, None] + [history_at(words, i, n) for n in range(2, order + 1)]

    out = []
    for (doc, _), is_held, words in zip(docs, held, tokens):
        found = [math.log10(chance(order, histories_at(words, i), w)) for i, w in enumerate(words)]
        known = [counts[1][((), w)] for w in words]
        base = sum(math.log10((c + 1) / (total + types + 1)) for c in known)
        out.append((doc, is_held, len(words), sum(c > 0 for c in known), total, base, sum(found)))
    vocabulary = [w for (_, w) in counts[1]] + ["never seen"]
    for words in tokens[:6]:
        for i in range(len(words)):
            assert math.isclose(sum(chance(order, histories_at(words, i), w) for w in vocabulary), 1, rel_tol=1e-9)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("block_tokens, bucket_tokens", [(1_500_000, 2_000_000), (50, 2_000_000), (50, 40), (200, 4)])
def test_scores(spark, block_tokens, bucket_tokens, order):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in DOCS], "doc_id long, text string, held string, block int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = {r["doc_id"]: tuple(r) for r in katz.score(docs.repartition(3), held, order, block_tokens, bucket_tokens).collect()}
    assert len(found) == len(DOCS)
    for expected in plain_scores(DOCS, order):
        row = found[expected[0]]
        assert row[:5] == expected[:5]
        assert row[5:] == pytest.approx(expected[5:], rel=1e-9)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert katz.score(docs, F.lit(False)).collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in katz.score(docs, F.lit(True)).collect()}
    assert rows[1]["score"] == 0.0 and rows[1]["n_known"] == 0 and rows[1]["train_tokens"] == 0


@pytest.mark.parametrize("order", [2, 3])
def test_one_context_in_a_third_of_all_tokens(spark, order):
    words = [" ".join(f"the w{n}x{i} of" for i in range(100)) for n in range(100)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").repartition(4)
    _, parts, model = katz.learn(docs, F.lit(False), order, block_tokens=3_000, bucket_tokens=500)
    assert model.buckets == 60 and model.context_tokens == 125
    for level in range(2, order + 1):
        rows = parts.where((F.col("kind") == "model") & (F.col("level") == level)).collect()
        sizes = [len(katz.unpacked(r["arrays"][1])) for r in rows]
        assert sum(sizes) > 20_000 and max(sizes) < 1_500
        asked = parts.where((F.col("kind") == "answer") & (F.col("level") == level)).groupBy("bucket").count().collect()
        assert len(asked) == model.buckets
    split = parts.where("kind = 'split' and level = 2").select(F.col("numbers")[0].alias("context"), "bucket")
    spread = {r["context"]: r["n"] for r in split.groupBy("context").agg(F.count_distinct("bucket").alias("n")).collect()}
    # 10,000 different words follow "the"; "of" has the same count, but only "the" and the end follow it
    assert len(spread) == 2 and max(spread.values()) > 30 and min(spread.values()) <= 2
    totals = parts.where("kind = 'totals' and level = 2").collect()
    known = [katz.Totals.of_numbers(r["numbers"]).table[:, 0] for r in totals]
    assert len(totals) == parts.where("kind = 'answer'").select("block").distinct().count() and all(k.tolist() == [10_000, 10_000] for k in known)


def test_a_task_for_each_block_and_bucket(spark, tmp_path):
    words = [" ".join(f"w{(n * i) % 997}" for i in range(100)) for n in range(200)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").repartition(4)
    blocks, parts, model = katz.learn(docs, F.lit(False), 2, block_tokens=1_000, bucket_tokens=500)
    assert 20 <= blocks.count() <= model.tasks <= 28 and blocks.select("block").distinct().count() == blocks.count()
    dealt = blocks.repartitionById(model.tasks, "block").groupBy(F.spark_partition_id()).count().collect()
    assert {r["count"] for r in dealt} == {1}
    scored = katz.with_answers(blocks, parts, model, lambda left, right: left, blocks.schema.simpleString()[7:-1].replace(":", " "))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2
