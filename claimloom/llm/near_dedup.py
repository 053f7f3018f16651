"""Near-duplicate classes by ProbMinHash over weighted word shingles.

A document is the multiset of its five-word shingles. Each shingle sends a
Poisson process of arrivals at a rate equal to its count; an arrival falls on a
random register, and a register remembers the shingle whose arrival came first.
Once a shingle's next arrival is later than all first arrivals of its document
it stops. The share of registers on which two documents agree estimates their
probability Jaccard similarity, which is plain Jaccard where no shingle repeats.

Registers are cut into bands; documents that agree on a whole band share a
bucket. A bucket never emits all its pairs: members are verified against its
centre, first one pair per document, then those that are still in different
classes, and last the members outside a bucket's largest class against the
other classes in it, block by block. So every pair in a bucket is either
verified or already in one class. Where many members of a large bucket are
similar to none (edited copies just below the threshold) that last step
compares each of them with the whole bucket; only links leave the tasks.
Verification computes the exact similarity from the texts.

Defined results
---------------
Words are split at ASCII blanks, A-Z lower-cased. Fewer than five words: one
shingle of all words. Documents with the same words are one class. null text
and text without words: a class of its own. Rows are told apart by a number, not
by their id: rows of a null id, and different texts of one id, take part like
any other. A class without any id has a null class_id. ``deduplicate`` keeps one
row of each class, also of repeated rows. Empty table: no rows. Other columns
pass through ``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import as_row, frees_memory, join_measured, slices, stored, texts_of
from claimloom.operators.lookup import lookup

SHINGLE, SIMILAR = 5, 0.8
#: At a similarity of 0.8 all bands miss with probability (1 - 0.8^6)^32, 6e-5.
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
#: Arrivals drawn at once, and the most of one shingle at once.
DRAWN, STEPS = 1 << 18, 256
#: Members verified against one partner in one group.
BLOCK = 200
#: A bucket with so many open pairs at most has them verified one by one, a larger one block by block.
FEW_PAIRS = 50
#: Shingles compared at once between two blocks.
PANEL = 4096
SIGNED = "doc_id long, digest binary, bands array<long>"
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a document and how often each occurs."""
    if len(words) < SHINGLE:
        words = [b" ".join(words)] if words else []
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(found) >= SHINGLE:
        count = len(found) - SHINGLE + 1
        found = sum(found[k : k + count] * FACTORS[k] for k in range(SHINGLE))
    return np.unique(mix(found), return_counts=True)


def similarity(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard: sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    keys = np.union1d(one[0], other[0])
    if not len(keys):
        return 0.0
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, one[0])] = one[1]
    y[np.searchsorted(keys, other[0])] = other[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(-ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # for i the maximum is x_j / x_i where the ratio of j is at least that of i, else y_j / y_i
    upto = np.searchsorted(-ratio, -ratio, side="right")
    over = np.append(0, np.cumsum(x))[upto]
    under = y.sum() - np.append(0, np.cumsum(y))[upto]
    shared = (x > 0) & (y > 0)
    return float((1 / (over[shared] / x[shared] + under[shared] / y[shared])).sum())


def signatures(documents: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """The shingle on each register of each document: (documents, registers)."""
    sizes = [len(h) for h, _ in documents]
    owner = np.repeat(np.arange(len(documents)), sizes)
    element = np.concatenate([h for h, _ in documents])
    rate = np.concatenate([c for _, c in documents]).astype(float)
    first = np.full(len(documents) * registers, np.inf)
    holder = np.zeros(len(first), np.uint64)
    active, at, step = np.arange(len(element)), np.zeros(len(element)), 0
    while len(active):
        steps = int(min(STEPS, max(1, DRAWN // len(active))))
        for start in range(0, len(active), DRAWN):
            some = active[start : start + DRAWN]
            turns = np.arange(step, step + steps, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            drawn = mix(element[some][:, None] + turns)
            gaps = -np.log(((drawn >> np.uint64(11)).astype(float) + 0.5) / 2**53) / rate[some][:, None]
            arrival = at[some][:, None] + np.cumsum(gaps, 1)
            at[some] = arrival[:, -1]
            place = (mix(drawn ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
            place += owner[some][:, None] * registers
            place, arrival = place.ravel(), arrival.ravel()
            np.minimum.at(first, place, arrival)
            won = arrival == first[place]
            holder[place[won]] = np.repeat(element[some], steps)[won]
        step += steps
        last = first.reshape(-1, registers).max(1)
        active = active[at[active] < last[owner[active]]]
    return holder.reshape(-1, registers)


def band_keys(signed: np.ndarray) -> np.ndarray:
    """One key per band of each signature."""
    parts = signed.reshape(len(signed), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for row in range(ROWS):
        key = mix(key * FACTORS[0] + parts[:, :, row])
    return key.view(np.int64)


@frees_memory
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = [words_of(t) for t in texts_of(part)]
            some = [i for i, w in enumerate(words) if w]
            digests: list[bytes | None] = [None] * len(words)
            bands: list[np.ndarray | None] = [None] * len(words)
            if some:
                keys = band_keys(signatures([shingles(words[i]) for i in some]))
                for i, row in zip(some, keys):
                    digests[i] = hashlib.blake2b(b" ".join(words[i]), digest_size=16).digest()
                    bands[i] = row
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "digest", "bands"],
            )


def verify(pairs: DataFrame, texts: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose texts are similar. Members of one ``a`` are dealt to groups of about ``BLOCK``."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = join_measured(pairs, stored(sizes, "sizes"), ["a"], "left").select(
        "a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part")
    )
    members = dealt.select(F.col("b").alias("doc_id"), "a", "part", F.lit(False).alias("is_a"))
    partners = dealt.select(F.col("a").alias("doc_id"), "a", "part", F.lit(True).alias("is_a")).distinct()
    roles = stored(members.unionByName(partners), "roles")

    def similar(group: pd.DataFrame) -> pd.DataFrame:
        if not group["is_a"].any():
            return pd.DataFrame({"a": [], "b": []})
        partner = shingles(words_of(group["text"][group["is_a"]].iloc[0]))
        rest = group[~group["is_a"]]
        found = [b for b, t in zip(rest["doc_id"], rest["text"]) if similarity(partner, shingles(words_of(t))) >= least - 1e-9]
        return pd.DataFrame({"a": group["a"].iloc[0], "b": found})

    joined = join_measured(texts, roles, ["doc_id"], "inner")
    return joined.groupBy("a", "part").applyInPandas(similar, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id and label (smallest id of its component) of every node of ``edges`` (a, b).

    Labels spread over edges and are followed to their own label, so the
    number of rounds grows with the logarithm of a component's width.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        moved = stored(
            labels.join(near, "id")
            .join(jump, "label")
            .select("id", "label", F.least("near", "far", "label").alias("new")),
            "moved",
        )
        if moved.where("new <> label").isEmpty():
            return labels
        labels = moved.select("id", F.col("new").alias("label"))


def labelled(rows: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    """Adds ``name``: the label of ``key``, or ``key`` itself where it has none."""
    table = labels.select(F.col("id").alias(key), F.col("label").alias("_label"))
    return join_measured(rows, table, [key], "left").withColumn(name, F.coalesce("_label", key)).drop("_label")


def _joined(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after more edges, which are between labels."""
    more = components(edges)
    if labels is None:
        return more
    old = labelled(labels.select("id", F.col("label").alias("old")), more, "old", "label").select("id", "label")
    return stored(old.unionByName(more.join(old.select("id"), "id", "left_anti")), "joined")


def _unlinked(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose two sides have different labels."""
    return labelled(labelled(pairs, labels, "a", "of_a"), labels, "b", "of_b").where("of_a <> of_b")


def _link(labels: DataFrame, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Labels after the similar ones among ``pairs`` are linked."""
    similar = _unlinked(verify(stored(pairs.select("a", "b").distinct(), "pairs"), texts), labels)
    edges = stored(similar.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct(), "links")
    return labels if edges.isEmpty() else _joined(labels, edges)


def linked(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Labels of all ids that are near duplicates of others. ``members``: bucket, id."""
    buckets = with_centres(members)
    pairs = buckets.where("centre <> id").select(F.col("centre").alias("a"), F.col("id").alias("b"), "weight")
    nearest = pairs.groupBy("b").agg(F.max_by("a", F.struct("weight", "a")).alias("a"))
    labels = components(stored(verify(stored(nearest, "nearest"), texts), "links"))
    labels = _link(labels, _unlinked(pairs.select("a", "b").distinct(), labels), texts)
    # all pairs with a centre are settled; what is left are pairs of others that are not linked yet
    classes = labelled(buckets.where("centre <> id").select("bucket", "id"), labels, "id", "label")
    counts = classes.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    split = counts.groupBy("bucket").agg(
        F.max_by("label", F.struct("n", "label")).alias("largest"),
        F.sum("n").alias("n"),
        (F.sum("n") - F.max("n")).alias("strays"),
    )
    mixed = stored(classes.join(split.where("strays > 0"), "bucket"), "mixed")
    if mixed.isEmpty():
        return labels
    few = F.col("strays") * F.col("n") <= FEW_PAIRS
    found = verify(stored(_pairs_within(mixed.where(few)), "pairs"), texts)
    found = found.unionByName(similar_cells(mixed.where(~few), texts))
    edges = _unlinked(stored(found, "links").distinct(), labels)
    edges = stored(edges.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct(), "links")
    return labels if edges.isEmpty() else _joined(labels, edges)


def with_centres(members: DataFrame) -> DataFrame:
    """bucket, id, centre and weight of all buckets with two members or more.

    The centre is the member that shares buckets most: in a group of edited
    copies that is the one with the fewest edits, which most others resemble.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(members.join(sizes, "bucket"), "shared")
    weighed = shared.join(shared.groupBy("id").agg(F.sum("n").alias("weight")), "id")
    centres = weighed.groupBy("bucket").agg(F.max(F.struct("weight", F.negative("id").alias("minus"))).alias("top"))
    return stored(
        shared.join(centres, "bucket").select(
            "bucket", "id", F.negative("top.minus").alias("centre"), F.col("top.weight").alias("weight")
        ),
        "buckets",
    )


def _pairs_within(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of small buckets that are not linked yet."""
    small = mixed.where("label <> largest").select("bucket", F.col("id").alias("a"), F.col("label").alias("of_a"))
    rest = mixed.select("bucket", F.col("id").alias("b"), F.col("label").alias("of_b"), "largest")
    across = small.join(rest, "bucket").where("of_a <> of_b AND (of_b = largest OR a < b)")
    return across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_cells(mixed: DataFrame, texts: DataFrame, least: float = SIMILAR) -> DataFrame:
    """Similar pairs of large buckets, strays against all, a block of each at a time.

    Only pairs that are similar leave a task, and a text goes to as many tasks
    as there are blocks on the other side.
    """
    blocks = F.ceil(F.col("strays") / BLOCK).cast("int"), F.ceil(F.col("n") / BLOCK).cast("int")
    stray = mixed.where("label <> largest").select(
        "bucket", "id", "label", F.lit(True).alias("stray"),
        F.pmod(F.xxhash64("id"), blocks[0]).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), blocks[1] - 1)).alias("column"),
    )
    every = mixed.select(
        "bucket", "id", "label", F.lit(False).alias("stray"),
        F.explode(F.sequence(F.lit(0), blocks[0] - 1)).alias("row"),
        F.pmod(F.xxhash64("id"), blocks[1]).cast("int").alias("column"),
    )
    roles = stored(stray.unionByName(every).withColumnRenamed("id", "doc_id"), "cells")

    def cell(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["doc_id", "stray"])
        counted = [shingles(words_of(t)) for t in group["text"]]
        sides = [np.flatnonzero(group["stray"] == side) for side in (True, False)]
        ids, labels = group["doc_id"].to_numpy(), group["label"].to_numpy()
        found = [
            (ids[a], ids[b])
            for a, b in likely([[(i, counted[i]) for i in side] for side in sides], least)
            if labels[a] != labels[b] and similarity(counted[a], counted[b]) >= least - 1e-9
        ]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    joined = join_measured(texts, roles, ["doc_id"], "inner")
    return joined.groupBy("bucket", "row", "column").applyInPandas(cell, "a long, b long")


def likely(sides: list[list], least: float) -> list[tuple[int, int]]:
    """Pairs whose similarity may reach ``least``.

    A shared shingle i adds at most x_i / sum(x) and at most y_i / sum(y), so
    the similarity is no more than the share that either has in the other.
    """
    keys = np.intersect1d(*(np.concatenate([c[0] for _, c in side] or [np.zeros(0, np.uint64)]) for side in sides))
    bound = [np.zeros((len(sides[0]), len(sides[1]))) for _ in sides]
    for start in range(0, len(keys), PANEL):
        panel = keys[start : start + PANEL]
        shares = []
        for side in sides:
            share = np.zeros((len(side), len(panel)), np.float32)
            for row, (_, (found, counts)) in enumerate(side):
                at = np.minimum(np.searchsorted(panel, found), len(panel) - 1)
                hit = panel[at] == found
                share[row, at[hit]] = counts[hit] / counts.sum()
            shares.append(share)
        there = [(s > 0).astype(np.float32) for s in shares]
        bound[0] += shares[0] @ there[1].T
        bound[1] += there[0] @ shares[1].T
    rows, columns = np.nonzero(np.minimum(*bound) >= least - 1e-4)
    return [(sides[0][r][0], sides[1][c][0]) for r, c in zip(rows, columns)]


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row``, each with a number of its own. Written, so that the number stays."""
    return stored(as_row(docs).withColumn("number", F.monotonically_increasing_id()), "numbered")


def row_classes(rows: DataFrame) -> DataFrame:
    """number and class (the smallest number in it) of each numbered row."""
    texts = rows.select(F.col("number").alias("doc_id"), F.col("row.text").cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_sign, SIGNED), "signed")
    worded = signed.where("digest IS NOT NULL")
    same = worded.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = stored(same.where("n > 1").drop("n"), "same-words")
    firsts = stored(
        lookup(worded, first, "digest", ["doc_id"])
        .withColumn("first", F.coalesce("first", "doc_id"))
        .select("doc_id", "first", "bands"),
        "firsts",
    )
    members = firsts.where("doc_id = first").select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("id"))
    labels = linked(members, texts)
    classes = labelled(firsts.select("doc_id", "first"), labels, "first", "class")
    alone = signed.where("digest IS NULL").select("doc_id", F.col("doc_id").alias("class"))
    return classes.select("doc_id", "class").unionByName(alone).withColumnRenamed("doc_id", "number")


def _resolved(rows: DataFrame) -> DataFrame:
    """number, doc_id, class_id, class_size and ``stays`` of each numbered row."""
    ids = rows.select("number", F.col("row.doc_id").cast("long").alias("doc_id"))
    placed = stored(join_measured(ids, stored(row_classes(rows), "row-classes"), ["number"], "inner"), "placed")
    # The smallest id stays, rows without an id only if there is no other; of repeated rows the first one.
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "number")
    classes = placed.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(first).alias("first")
    )
    # Most classes are one row; only the others are looked up.
    many = stored(classes.where("class_size > 1").select("class", "class_id", "class_size", F.col("first.number").alias("kept")), "classes")
    found = lookup(placed, many, "class", ["number"])
    return found.select(
        "number",
        "doc_id",
        F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("number") == F.col("kept"), F.lit(True)).alias("stays"),
    )


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class) and class_size of each row."""
    return _resolved(numbered(docs.select("doc_id", "text"))).select("doc_id", "class_id", "class_size")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``, all columns: the one with the smallest id."""
    rows = numbered(docs)
    dropped = stored(_resolved(rows).where(~F.col("stays")).select("number"), "dropped")
    return join_measured(rows, dropped, ["number"], "left_anti").select("row.*")
