"""Quality rules: counts of each text, hard limits, and an isolation forest.

Every text is counted once and the counts are stored. The forest is grown on
the statistics of labelled documents: a tree splits a small subsample at random
values of random statistics, and what is rare ends up near the root, so a short
mean path length marks an anomaly. The threshold on that score is the one that
tells the labelled good from the labelled bad best, among those that cost at
most ``GOOD_LOST`` of the good. For that, every labelled document is scored, by the
trees that have not seen it.

Trees draw their subsamples from about ``POOL`` good and ``POOL`` bad documents,
or all if there are fewer: each of the two is as many as all trees draw together.
The pool is dealt by hash, and only it comes to the driver. The threshold is set
on all labelled documents: tasks score them, and of the scores only those come to
the driver that may decide.

Defined results
---------------
null and empty text: no words, all counts 0, base rules fail. A document with
several labels counts as good only if all of them do; one with several texts is
learnt from by one of them. No usable labels: the base rules alone decide. Repeated rows are judged alike. Very long texts are
counted whole. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import frees_memory, join_measured, slices, stored, texts_of

TREES, SUBSAMPLE, SEED = 200, 128, 11
#: Labelled documents of a kind that trees draw from.
POOL = TREES * SUBSAMPLE
#: Scores that are looked at one by one, and ranges that more of them are counted in.
LISTED, RANGES = 50_000, 1024
#: Share of bad rows in a subsample: few, so that they stay rare.
BAD_SHARE = 0.05
#: Share of labelled good documents that the threshold may cost.
GOOD_LOST = 0.005
LEAST_WORDS, MOST_REPEATED = 50, 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = [
    "word_length", "symbol_share", "upper_share", "digit_share", "mark_share", "bang_share", "bar_share",
    "dup_line_share", "repeat_share", "distinct_share", "line_words", "symbol_word_share",
]
COUNTED = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", " + ", ".join(f"{c} double" for c in RULES)
BLANKS = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SYMBOLS, MARKS = b"#*$%&|<>", b".,;:!?#*$%&|<>()[]{}\"'-_/\\@+=~^`"
SYMBOL_SET = frozenset(SYMBOLS)


def repeated_words(ids: np.ndarray) -> int:
    """Words in windows of three that occur twice or more."""
    if len(ids) < 4:
        return 0
    base = int(ids.max()) + 1
    if base < 2_000_000:
        key = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
        key = pairs[:-1] * base + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    found = np.zeros(len(key), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(key)] |= found
    return int(covered.sum())


def count_text(text: str) -> list[float]:
    """BASE and then RULES of one text."""
    data = text.encode()
    words = data.split()
    if not words:
        symbols = 0
        return [0, 0, symbols, 0, 0] + [0.0] * len(RULES)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    seen, doubled, lines = set(), 0, 0
    for line in data.split(b"\n"):
        if line.strip():
            lines += 1
            doubled += line in seen
            seen.add(line)
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = int(bytes_[:0x80].sum() + bytes_[0xC0:].sum() - bytes_[BLANKS].sum())
    symbols = int(bytes_[list(SYMBOLS)].sum())
    repeated = repeated_words(ids)
    with_symbol = sum(1 for w in words if not SYMBOL_SET.isdisjoint(w)) if symbols else 0
    return [
        len(words), chars, symbols, doubled, repeated,
        chars / len(words), symbols / chars, bytes_[65:91].sum() / chars, bytes_[48:58].sum() / chars,
        bytes_[list(MARKS)].sum() / chars, bytes_[33] / len(words), bytes_[124] / len(words),
        doubled / lines, repeated / len(words), len(numbers) / len(words) ** 0.8, np.log(len(words) / lines),
        with_symbol / len(words),
    ]


@frees_memory
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = np.array([count_text(t) for t in texts_of(part)], float).reshape(-1, len(BASE) + len(RULES))
            columns = [pa.array(rows[:, i].astype(np.int64)) for i in range(len(BASE))]
            columns += [pa.array(rows[:, i]) for i in range(len(BASE), rows.shape[1])]
            yield pa.record_batch([part.column("doc_id"), *columns], names=["doc_id", *BASE, *RULES])


def count_rules(docs: DataFrame) -> DataFrame:
    """doc_id, BASE and RULES of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count, COUNTED)


def mean_path(count: float) -> float:
    """Mean path length of an unsuccessful search among ``count`` rows."""
    if count <= 1:
        return 0.0
    return 1.0 if count == 2 else 2 * (np.log(count - 1) + np.euler_gamma) - 2 * (count - 1) / count


@dataclass
class Forest:
    """All trees side by side as heaps: (tree, node). A leaf has column -1 and its path length in ``value``."""

    column: np.ndarray
    value: np.ndarray
    depth: int
    scale: float
    threshold: float = np.inf
    #: Rows that each tree was grown on.
    grown_on: list[np.ndarray] | None = None

    def all_seen(self) -> bool:
        """Whether every tree has seen some row: there are few rows, which are then scored by all trees."""
        return bool((np.bincount(np.concatenate(self.grown_on)) == len(self.grown_on)).any())

    def score(self, rows: np.ndarray, grown: bool = False, at: np.ndarray | None = None) -> np.ndarray:
        """Anomaly score of each row, 0 to 1.

        ``grown``: the rows are those the forest was grown on; each is scored by the trees that have not seen it.
        ``at``: where each row is among those, -1 if it is not.
        """
        if grown and self.all_seen():
            return self.score(rows)
        at = np.arange(len(rows)) if at is None else at
        total, trees = np.zeros(len(rows)), np.zeros(len(rows))
        places = np.arange(len(rows))
        for tree, (column, value) in enumerate(zip(self.column, self.value)):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                split = column[node]
                right = rows[places, np.maximum(split, 0)] >= value[node]
                node = np.where(split < 0, node, 2 * node + 1 + right)
            unseen = np.ones(len(rows), bool)
            if grown:
                unseen = ~np.isin(at, self.grown_on[tree])
            total[unseen] += value[node][unseen]
            trees += unseen
        return 2.0 ** (-total / trees / self.scale)


def grow(rows: np.ndarray, bad: np.ndarray, trees: int = TREES, size: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    """A forest on labelled rows; subsamples hold ``BAD_SHARE`` of bad rows where there are any."""
    random = np.random.default_rng(seed)
    good_at, bad_at = np.flatnonzero(~bad), np.flatnonzero(bad)
    few = round(size * BAD_SHARE)
    size = min(size, len(rows))
    depth = max(1, int(np.ceil(np.log2(max(2, size)))))
    column = np.full((trees, 2 ** (depth + 1) - 1), -1)
    value = np.zeros(column.shape)
    grown_on = []
    for tree in range(trees):
        some = random.permutation(good_at)[: size - min(few, len(bad_at))]
        some = np.concatenate([some, random.permutation(bad_at)[: size - len(some)]])
        grown_on.append(some)
        waiting = [(0, 0, some)]
        while waiting:
            node, level, members = waiting.pop()
            part = rows[members]
            low, high = part.min(0), part.max(0)
            usable = np.flatnonzero(high > low)
            if level == depth or len(members) <= 1 or not len(usable):
                value[tree, node] = level + mean_path(len(members))
                continue
            which = random.choice(usable)
            cut = random.uniform(low[which], high[which])
            right = part[:, which] >= cut
            column[tree, node], value[tree, node] = which, cut
            waiting += [(2 * node + 1, level + 1, members[~right]), (2 * node + 2, level + 1, members[right])]
    return Forest(column, value, depth, max(1.0, mean_path(size)), grown_on=grown_on)


def calibrate(
    forest: Forest, rows: np.ndarray, bad: np.ndarray, good_lost: float = GOOD_LOST, lost: int | None = None
) -> Forest:
    """Set the threshold that catches most bad rows at a cost of at most ``good_lost`` of the good ones.

    A row is dropped if its score exceeds the threshold. Among thresholds that
    catch equally many, the highest is taken, half-way to the next bad score.
    ``rows`` are those the forest was grown on, or scores. ``lost``: how many of the good ones it may cost.
    """
    scores = rows if rows.ndim == 1 else forest.score(rows, grown=True)
    forest.grown_on = None  # tasks need it no more
    good, wrong = np.sort(scores[~bad]), np.sort(scores[bad])
    if not len(good) or not len(wrong):
        return forest
    least = good[len(good) - 1 - (int(good_lost * len(good)) if lost is None else lost)]
    caught = wrong[wrong > least]
    forest.threshold = float((least + caught[0]) / 2) if len(caught) else float(good[-1])
    return forest


@frees_memory
def _score_labelled(batches: Iterator[pa.RecordBatch], forest: Forest, pool: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        near = np.minimum(np.searchsorted(pool, ids), len(pool) - 1)
        rows = np.stack([batch.column(c).to_numpy() for c in RULES], 1)
        scores = forest.score(rows, True, np.where(pool[near] == ids, near, -1))
        yield pa.record_batch([batch.column("bad"), pa.array(scores)], names=["bad", "score"])


def deciding(scored: DataFrame, goods: int, listed: int = LISTED) -> tuple[np.ndarray, np.ndarray, int]:
    """Of stored scores those that ``calibrate`` needs: scores, bad, and how many of these good ones may be lost.

    The range that the decisive good score lies in is narrowed until few
    scores are in it. Beyond it only the least bad and the highest good score
    matter, whatever their number.
    """
    lost, low, high = int(GOOD_LOST * goods), 0.0, 1.0
    within = scored
    while within.count() > listed:
        step = F.least(F.floor((F.col("score") - low) / (high - low) * RANGES), F.lit(RANGES - 1))
        counts = within.groupBy(step.alias("step")).agg(
            F.count_if(~F.col("bad")).alias("goods"), F.min("score").alias("low"), F.max("score").alias("high")
        )
        for part in sorted(counts.collect(), key=lambda r: -r["step"]):
            if part["goods"] > lost:
                break
            lost -= part["goods"]
        low, high = part["low"], part["high"]
        within = scored.where(F.col("score").between(low, high))
        if low == high:
            within = within.where(~F.col("bad")).limit(1)  # they are all the same
            lost = 0
    found = within.toPandas()
    scores, bad = found["score"].to_numpy(float), found["bad"].to_numpy(bool)
    if (low, high) != (0.0, 1.0):
        above = scored.where(F.col("score") > high)
        ends = above.agg(F.min(F.when(F.col("bad"), F.col("score"))), F.max(F.when(~F.col("bad"), F.col("score")))).first()
        for score, is_bad in zip(ends, (True, False)):
            if score is not None:
                scores, bad, lost = np.append(scores, score), np.append(bad, is_bad), lost + (not is_bad)
    return scores, bad, lost


def learn(counted: DataFrame, labels: DataFrame, most: int = POOL, listed: int = LISTED) -> Forest | None:
    """A forest from stored counts and labels (doc_id, quality 0/1); None without labels of both kinds."""
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    kinds = stored(usable.groupBy("doc_id").agg((F.min("quality") == 0).alias("bad")), "kinds")
    joined = join_measured(counted.where(~base_failed()), kinds, ["doc_id"], "inner")
    # One row per label, however many rows have its id.
    one = joined.groupBy("doc_id", "bad").agg(F.min(F.struct(*RULES)).alias("rules"))
    one = stored(one.select("doc_id", "bad", "rules.*"), "labelled")
    sizes = dict(one.groupBy("bad").count().collect())
    if len(sizes) < 2:
        return None
    share = F.when(F.col("bad"), min(1.0, most / sizes[True])).otherwise(min(1.0, most / sizes[False]))
    pool = one.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < share * (1 << 20))
    found = pool.orderBy("doc_id").toPandas()
    bad = found["bad"].to_numpy(bool)
    forest = grow(found[RULES].to_numpy(float), bad)
    work = partial(_score_labelled, forest=forest, pool=found["doc_id"].to_numpy())
    scored = stored(one.mapInArrow(work, "bad boolean, score double"), "labelled-scores")
    scores, bad, lost = deciding(scored, sizes[False], listed)
    if lost == int(GOOD_LOST * np.count_nonzero(~bad)):
        return calibrate(forest, scores, bad)
    return calibrate(forest, scores, bad, GOOD_LOST, lost)


def base_failed():
    """The rules that need no model."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@frees_memory
def _score(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in RULES], 1)
        base = batch.select(["doc_id", *BASE, "base_failed"]).columns
        yield pa.record_batch(
            [*base, pa.array(forest.score(rows))], names=["doc_id", *BASE, "base_failed", "score"]
        )


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, BASE, base_failed, score and kept of each row."""
    counted = stored(count_rules(docs), "rules")
    forest = learn(counted, labels)
    marked = counted.withColumn("base_failed", base_failed())
    if forest is None:
        scored, limit = marked.select("doc_id", *BASE, "base_failed", F.lit(None).cast("double").alias("score")), 1.0
    else:
        kinds = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, score double"
        scored, limit = marked.mapInArrow(partial(_score, forest=forest), kinds), forest.threshold
    verdict = ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) <= F.lit(limit))
    return scored.withColumn("kept", verdict)
