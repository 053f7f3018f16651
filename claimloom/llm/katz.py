"""Katz backoff language model over words, counted and evaluated block by block.

Texts are tokenized once into stored blocks of token numbers with a local
vocabulary. For each level n of the model a block asks about its distinct
n-grams: it sends, to the bucket an n-gram's hash picks, the n-grams with
their training counts and lower-order probabilities. A bucket merges what all
blocks sent, stores its part of the model, and answers each block with the
global counts, and with what the backoff weight of each context is made of:
its total, how often each small count occurs under it, and the lower-order
probability of all words seen after it. The blocks then evaluate their tokens
recursively: P(w|h) = s(h) d_r r / c(h) for a pair seen r times, else
alpha(h) P(w|shorter h).

d_r are Good-Turing discounts for r up to ``CUT`` (of count-of-counts over all
training n-grams; where those give no valid discount, 1 - 0.5/r). alpha(h) is
(1 - mass of the seen) / (1 - lower-order mass of the seen), so every context
sums to one exactly. A context whose seen words would leave nothing gives up
half a count (s(h) < 1). All words never seen in training are one word.

What moves between tasks is distinct n-grams per block, delta-coded, not
tokens. A context that alone would fill a good part of a bucket is dealt to
several by a hash of the following word, in as many parts as its count asks
for. A block knows that count from the answers to the level before, so no list
of such contexts is kept anywhere; what the parts of a context amount to is
summed by Spark and joined to the blocks that met the context.

Defined results
---------------
null and empty text: the end token alone. A null id: not held out, learnt from.
Repeated rows count twice and are scored twice. A word that only held-out
documents have is unknown. No training rows: unigram probabilities give the
unknown word everything, scores are 0. Empty table: no rows. Other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from claimloom.llm.common import frees_memory, release_memory, slices, stored, texts_of
from claimloom.operators.lookup import lookup

#: Words of context plus one.
ORDER = 2
#: Largest count that is discounted.
CUT = 5
#: Tokens of a block, and tokens that a bucket is meant to answer for.
BLOCK_TOKENS, BUCKET_TOKENS = 1_500_000, 2_000_000
#: A context is dealt to buckets in parts of at most one in so many of a bucket's tokens.
CONTEXT_SHARE = 4
END, START, UNKNOWN = b"", -2, -1
#: A block is numbered by the task that made it and its place among that task's blocks.
BLOCKS = "task int, step int, doc_ids array<long>, held array<boolean>, lengths array<int>, words binary, tokens binary"
#: ``kind``: ``ask`` to a bucket, ``answer`` to a block, ``model`` (a bucket's part of the tables); with
#: numbers instead of arrays ``sums``, ``split`` (a context dealt to several buckets, one bucket's share of its
#: totals), ``wants`` (such contexts of a block) and ``totals`` (these with their totals, to a block).
PARTS = "kind string, level int, bucket int, block int, arrays array<binary>, numbers array<double>"
SUMS = ["tokens", "types", *(f"n{r}" for r in range(1, CUT + 2))]


# --- arrays as bytes ---------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Compressed bytes of numbers, byte planes apart."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T if len(values) else values
    return zstandard.ZstdCompressor(level=1).compress(values.dtype.char.encode() + planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    kind = np.dtype(raw[:1].decode())
    planes = np.frombuffer(raw, np.uint8)[1:].reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread unsigned hashes of numbers."""
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def part(kind: str, level: int, bucket: int, block: int | None, arrays: list[bytes]) -> dict:
    return {"kind": kind, "level": level, "bucket": bucket, "block": block, "arrays": arrays, "numbers": None}


def figures(kind: str, level: int, bucket: int, rows: np.ndarray) -> list[dict]:
    return [part(kind, level, bucket, None, None) | {"numbers": row} for row in rows.astype(float).tolist()]


PART_SCHEMA = pa.schema(
    [("kind", pa.string()), ("level", pa.int32()), ("bucket", pa.int32()), ("block", pa.int32())]
    + [("arrays", pa.list_(pa.binary())), ("numbers", pa.list_(pa.float64()))]
)


def parts_table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, PART_SCHEMA)


# --- blocks ------------------------------------------------------------------


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased; ``bytes.split`` cuts at exactly the six ASCII blanks."""
    return text.encode().translate(LOWER).split()


@frees_memory
def make_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("task", pa.int32()), ("step", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))]
        + [("lengths", pa.list_(pa.int32())), ("words", pa.binary()), ("tokens", pa.binary())]
    )
    numbers: dict[bytes, int] = {END: 0}
    docs, held, tokens, size, step = [], [], [], 0, 0
    task = TaskContext.get().partitionId()

    def block() -> pa.RecordBatch:
        words = zstandard.ZstdCompressor(level=1).compress(b" ".join(numbers))
        lengths = [len(t) for t in tokens]
        row = [task, step, docs, held, lengths, words, packed(np.concatenate(tokens))]
        return pa.record_batch([pa.array([v], k.type) for v, k in zip(row, schema)], schema=schema)

    for batch in batches:
        for some in slices(batch, "text"):
            ids, out = some.column("doc_id").to_pylist(), some.column("held").to_pylist()
            for doc_id, is_held, text in zip(ids, out, texts_of(some)):
                words = words_of(text)
                words.append(END)
                known = [numbers.setdefault(w, len(numbers)) for w in words]
                tokens.append(np.array(known, np.uint32))
                docs.append(doc_id)
                held.append(is_held)
                size += len(known)
                if size >= most:
                    yield block()
                    numbers, docs, held, tokens, size, step = {END: 0}, [], [], [], 0, step + 1
    if docs:
        yield block()


class Block:
    """A stored block with its tokens, and the answers it has so far."""

    def __init__(self, row: dict, answers: list[dict], model: Model):
        self.number, self.docs, self.held = row["block"], row["doc_ids"], np.array(row["held"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        self.tokens = unpacked(row["tokens"]).astype(np.int64)
        self.words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b" ")
        self.learnt = np.repeat(~self.held, self.lengths)
        self.answers = {(a["level"], a["bucket"]): a["arrays"] for a in answers if a["kind"] == "answer"}
        self.split = {a["level"]: Totals.of_numbers(a["numbers"]) for a in answers if a["kind"] == "totals"}
        self.model = model

    def asked_words(self) -> list[np.ndarray]:
        """Local numbers of the words each bucket is asked about."""
        owner = np.array([zlib.crc32(w) for w in self.words], np.int64) % self.model.buckets
        order = np.argsort(owner, kind="stable")
        return np.split(order, np.searchsorted(owner[order], np.arange(1, self.model.buckets)))

    def ask_words(self) -> list[dict]:
        counts = np.bincount(self.tokens[self.learnt], minlength=len(self.words))
        return [
            part(
                "ask", 1, bucket, self.number,
                [zstandard.ZstdCompressor(level=1).compress(b" ".join([self.words[i] for i in some])), packed(counts[some])],
            )
            for bucket, some in enumerate(self.asked_words())
            if len(some)
        ]

    def level_one(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: global word number, training count, probability."""
        ids, counts = np.full(len(self.words), UNKNOWN), np.zeros(len(self.words), np.int64)
        for bucket, some in enumerate(self.asked_words()):
            if len(some):
                ids[some], counts[some] = map(unpacked, self.answers[1, bucket])
        chance = self.model.unigram(counts)
        return ids[self.tokens], counts[self.tokens], chance[self.tokens]

    def before(self, values: np.ndarray, first: int) -> np.ndarray:
        """The value of the token before each token, ``first`` for a document's first."""
        shifted = np.empty_like(values)
        shifted[1:] = values[:-1]
        shifted[np.cumsum(self.lengths) - self.lengths] = first
        return shifted

    def pairs(self, contexts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> Pairs:
        return Pairs(contexts, ids, 1 + sizes // self.model.context_tokens, self.model.buckets)

    def evaluate(self, upto: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per token: word number, count, probability of order ``upto``, context of the next order and its count."""
        ids, counts, chance = self.level_one()
        # every document starts once and ends once, so START occurs as often as the end token
        starts = counts[self.lengths[0] - 1]
        contexts, sizes = self.before(ids, START), self.before(counts, starts)
        for level in range(2, upto + 1):
            asked = self.pairs(contexts, sizes, ids)
            seen, grams, weights = asked.answers(self.answers, level)
            totals = asked.totals(weights, self.split.get(level, NO_TOTALS))
            chance = self.model.backoff(level, seen, totals, chance, asked)
            contexts = self.before(asked.of_tokens(grams, UNKNOWN), START)
            sizes = self.before(asked.of_tokens(seen, 0), starts)
        return ids, counts, chance, contexts, sizes

    def ask_pairs(self, level: int) -> list[dict]:
        ids, _, chance, contexts, sizes = self.evaluate(level - 1)
        asked = self.pairs(contexts, sizes, ids)
        counts = np.bincount(asked.inverse[self.learnt[asked.known]], minlength=len(asked.word))
        lower = np.zeros(len(asked.word))
        lower[asked.inverse] = chance[asked.known]
        out = [
            part("ask", level, bucket, self.number, asked.packed(some, counts, lower))
            for bucket, some in enumerate(asked.by_bucket)
            if len(some)
        ]
        split = np.flatnonzero(asked.parts > 1)
        if len(split):
            # by way of any bucket that this block asks, another one for each block
            bucket = int(asked.owner[split[self.number % len(split)]])
            wanted = np.unique(asked.context[split]).astype(float).tolist()
            out.append(part("wants", level, bucket, self.number, None) | {"numbers": wanted})
        return out


class Pairs:
    """Distinct (context, word) pairs of a block, in order, and the bucket of each.

    Tokens with an unknown context have no pair: nothing follows it in training.
    ``parts`` tells of each token into how many parts its context is dealt.
    """

    def __init__(self, contexts: np.ndarray, words: np.ndarray, parts: np.ndarray, buckets: int):
        self.known = np.flatnonzero(contexts != UNKNOWN)
        self.size = len(contexts)
        order = np.lexsort((words[self.known], contexts[self.known]))
        context, word = contexts[self.known][order], words[self.known][order]
        new = np.ones(len(order), bool)
        new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        self.context, self.word = context[new], word[new]
        self.parts = parts[self.known][order][new]
        spread = mixed(self.word) % self.parts.astype(np.uint64)
        self.owner = (mixed(mixed(self.context) + spread) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(self.owner, kind="stable")
        self.by_bucket = np.split(order, np.searchsorted(self.owner[order], np.arange(1, buckets)))

    def runs(self, some: np.ndarray) -> np.ndarray:
        """Where a new context starts among sorted pairs."""
        context = self.context[some]
        new = np.ones(len(some), bool)
        new[1:] = context[1:] != context[:-1]
        return np.flatnonzero(new)

    def packed(self, some: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> list[bytes]:
        """The pairs of a bucket; a word and its lower-order probability are listed once."""
        starts, word, chance = self.runs(some), self.word[some], lower[some]
        order = np.lexsort((chance, word))
        new = np.append(True, (np.diff(word[order]) != 0) | (np.diff(chance[order]) != 0))
        entry = np.empty(len(some), np.uint32)
        entry[order] = np.cumsum(new) - 1
        listed = order[new]
        values, which = np.unique(chance[listed], return_inverse=True)
        return [
            packed(np.diff(self.context[some][starts], prepend=0)),
            packed(np.diff(np.append(starts, len(some)))),
            packed(self.parts[some][starts] > 1),
            packed(entry),
            packed(counts[some].astype(np.uint32)),
            packed(np.diff(word[listed], prepend=0)),
            packed(values),
            packed(which.astype(np.uint32)),
        ]

    def answers(self, found: dict, level: int) -> tuple[np.ndarray, np.ndarray, list]:
        """Per pair its count and number; per bucket the contexts asked about and their totals."""
        counts, grams, weights = np.zeros(len(self.word), np.int64), np.full(len(self.word), UNKNOWN), []
        for bucket, some in enumerate(self.by_bucket):
            if len(some):
                counts[some], grams[some], *totals = map(unpacked, found[level, bucket])
                weights.append((self.context[some][self.runs(some)], totals))
        return counts, grams, weights

    def totals(self, weights: list, split: Totals) -> Totals:
        """What the backoff weights of this block's contexts are made of; those dealt to several buckets have it from ``split``."""
        contexts = np.concatenate([c for c, _ in weights]) if weights else np.zeros(0, np.int64)
        tables = [np.stack([t.astype(float) for t in totals], 1) for _, totals in weights]
        table = np.concatenate([np.zeros((0, CUT + 2)), *tables])
        whole = ~np.isin(contexts, split.contexts)
        return Totals(np.append(contexts[whole], split.contexts), np.concatenate([table[whole], split.table]))

    def of_tokens(self, values: np.ndarray, other: int) -> np.ndarray:
        """Values of pairs at their tokens; ``other`` where a token has no pair."""
        out = np.full(self.size, other)
        out[self.known] = values[self.inverse]
        return out


class Totals:
    """Per context: training count, how often each count up to CUT occurs, lower-order mass of the seen words."""

    def __init__(self, contexts: np.ndarray, table: np.ndarray):
        order = np.argsort(contexts)
        self.contexts, self.table = contexts[order], table[order]

    @classmethod
    def of_numbers(cls, numbers: list[float]) -> Totals:
        """From a context and its totals, one after the other."""
        table = np.array(numbers, float).reshape(-1, CUT + 3)
        return cls(table[:, 0].astype(np.int64), table[:, 1:])


NO_TOTALS = Totals(np.zeros(0, np.int64), np.zeros((0, CUT + 2)))


# --- buckets -----------------------------------------------------------------


def answer_words(table: pa.Table, buckets: int) -> pa.Table:
    """Merge the words asked of one bucket, number them, and answer each block."""
    rows = table.to_pylist()
    bucket = rows[0]["bucket"]
    asked = [
        (r["block"], zstandard.ZstdDecompressor().decompress(r["arrays"][0]).split(b" "), unpacked(r["arrays"][1]))
        for r in rows
    ]
    total: dict[bytes, int] = {}
    for _, words, counts in asked:
        for word, count in zip(words, counts.tolist()):
            total[word] = total.get(word, 0) + count
    seen = sorted((w for w, c in total.items() if c), key=lambda w: (-total[w], w))  # small numbers pack better
    number = {w: bucket + buckets * i for i, w in enumerate(seen)}
    counts = np.array([total[w] for w in seen], np.int64)
    model = [zstandard.ZstdCompressor(level=1).compress(b" ".join(seen)), packed(counts)]
    out = [part("model", 1, bucket, None, model), *figures("sums", 1, bucket, summed(counts)[None])]
    for block, words, _ in asked:
        arrays = [np.array([number.get(w, UNKNOWN) for w in words]), np.array([total[w] for w in words])]
        out.append(part("answer", 1, bucket, block, [packed(a) for a in arrays]))
    return parts_table(out)


def summed(counts: np.ndarray) -> np.ndarray:
    """SUMS of the n-grams of a bucket."""
    return np.array([counts.sum(), len(counts), *((counts == r).sum() for r in range(1, CUT + 2))], np.int64)


def answer_pairs(table: pa.Table, level: int, buckets: int, last: bool) -> pa.Table:
    """Merge the pairs asked of one bucket, store its part of the model, and answer each block."""
    rows = table.to_pylist()
    bucket, asked = rows[0]["bucket"], []
    for row in (r for r in rows if r["kind"] == "ask"):
        context, runs, split, entry, count, words, values, which = map(unpacked, row["arrays"])
        context, word, lower = np.repeat(np.cumsum(context), runs), np.cumsum(words)[entry], values[which][entry]
        asked.append((row["block"], context, word, count.astype(np.int64), lower, np.repeat(split, runs)))
    context, word, count, lower, split = (np.concatenate([a[i] for a in asked]) for i in range(1, 6))
    order = np.lexsort((word, context))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(context[order]) != 0) | (np.diff(word[order]) != 0)
    starts = np.flatnonzero(new)
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    context, word, lower, split = (v[order][starts] for v in (context, word, lower, split))
    count = np.add.reduceat(count[order], starts)
    seen = count > 0
    grams = np.where(seen, bucket + buckets * (np.cumsum(seen) - 1), UNKNOWN)
    runs = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    columns = [count, *((count == r) for r in range(1, CUT + 1)), np.where(seen, lower, 0.0)]
    totals = [np.add.reduceat(c.astype(float if c.dtype == float else np.int64), runs) for c in columns]
    own = split[runs]
    shares = np.stack([context[runs][own], *(t[own] for t in totals)], 1)
    model = [packed(np.diff(context[seen], prepend=0)), packed(word[seen]), packed(count[seen])]
    out = [
        part("model", level, bucket, None, model),
        *figures("sums", level, bucket, summed(count[seen])[None]),
        *figures("split", level, bucket, shares),
        *(row for row in rows if row["kind"] == "wants"),
    ]
    start = 0
    for block, asked_context, *_ in asked:
        at = back[start : start + len(asked_context)]
        start += len(asked_context)
        first = np.flatnonzero(np.append(True, np.diff(asked_context) != 0))
        group = np.searchsorted(context[runs], asked_context[first])
        arrays = [count[at], np.zeros(len(at), np.int8) if last else grams[at], *(t[group] for t in totals)]
        out.append(part("answer", level, bucket, block, [packed(a) for a in arrays]))
    return parts_table(out)


# --- the model's few global numbers -----------------------------------------


class Model:
    """Count-of-counts of each level, numbers of blocks' tasks and of buckets, and the tokens of a context's part."""

    def __init__(self, tasks: int, buckets: int, context_tokens: int):
        self.tasks, self.buckets, self.context_tokens, self.sums = tasks, buckets, context_tokens, {}

    def discounts(self, level: int) -> np.ndarray:
        """d_r for r from 0 to CUT (0 is not used)."""
        sums = dict(zip(SUMS, self.sums[level]))
        n = [0, *(float(sums[f"n{r}"]) for r in range(1, CUT + 2))]
        plain = np.array([1.0, *(1 - 0.5 / r for r in range(1, CUT + 1))])
        if min(n[1:]) <= 0:
            return plain
        rest = (CUT + 1) * n[CUT + 1] / n[1]
        if rest >= 1:
            return plain
        found = [((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) for r in range(1, CUT + 1)]
        return np.array([1.0, *found]) if all(0 < d < 1 for d in found) else plain

    def discounted(self, level: int, counts: np.ndarray) -> np.ndarray:
        return counts * np.where(counts <= CUT, self.discounts(level)[np.minimum(counts, CUT)], 1.0)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by their count; a count of 0 is the unknown word."""
        sums = dict(zip(SUMS, self.sums[1]))
        total = int(sums["tokens"])
        if not total:
            return np.ones(len(counts))
        small = self.discounts(1)
        mass = 1.0 - sum((1 - small[r]) * r * int(sums[f"n{r}"]) for r in range(1, CUT + 1)) / total
        rest = max(1.0 - mass, 1.0 / (total + int(sums["types"]) + 1))
        return np.where(counts > 0, self.discounted(1, counts) / total * ((1 - rest) / mass), rest)

    def backoff(self, level: int, seen: np.ndarray, totals: Totals, lower: np.ndarray, asked: Pairs) -> np.ndarray:
        """Probability of each token given its context, from that of the shorter context."""
        small = self.discounts(level)
        contexts = totals.contexts
        count, below = totals.table[:, 0], totals.table[:, -1]
        given_up = sum((1 - small[r]) * r * totals.table[:, r] for r in range(1, CUT + 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.maximum(given_up, 0.5) / count
            scale = (1 - rest) / (1 - given_up / count)
            alpha = rest / (1 - below)
            # a context that never occurs in training leaves all to the shorter one
            scale, alpha = np.where(count > 0, scale, 0.0), np.where(count > 0, alpha, 1.0)
            at = np.searchsorted(contexts, asked.context)
            known = scale[at] * self.discounted(level, seen) / count[at]
        out = lower.copy()
        at_token, pair = asked.known, asked.inverse
        out[at_token] = np.where(seen[pair] > 0, known[pair], alpha[at[pair]] * lower[at_token])
        return out


# --- frames ------------------------------------------------------------------


def blocks_of(docs: DataFrame, held: F.Column, block_tokens: int) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(held, F.lit(False)).alias("held"),
    )
    return stored(rows.mapInArrow(partial(make_blocks, most=block_tokens), BLOCKS), "katz-blocks")


@frees_memory
def _ask_words(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from parts_table(Block(row, [], model).ask_words()).to_batches()


def collect_sums(parts: DataFrame, level: int, model: Model) -> None:
    """Bring SUMS, which all blocks need, to the driver."""
    sums = parts.where("kind = 'sums'").agg(*[F.sum(F.col("numbers")[i]).alias(s) for i, s in enumerate(SUMS)]).first()
    model.sums[level] = np.array([int(v or 0) for v in sums], np.int64)


def split_totals(parts: DataFrame, level: int) -> DataFrame:
    """To each block the totals of those of its contexts that are dealt to several buckets, as one row.

    Such a row has at most as many contexts as the block has tokens. A context may be wanted by all blocks, so
    the join is one that survives hot keys.
    """
    names = [f"v{i}" for i in range(1, CUT + 3)]
    values = [F.sum(F.col("numbers")[i]).alias(name) for i, name in enumerate(names, 1)]
    shares = parts.where("kind = 'split'").groupBy(F.col("numbers")[0].alias("context")).agg(*values)
    wants = parts.where("kind = 'wants'").select("block", F.explode("numbers").alias("context"))
    found = lookup(wants, stored(shares, f"katz-split-{level}"), "context", ["block"], "inner")
    rows = found.groupBy("block").agg(F.flatten(F.collect_list(F.array("context", *names))).alias("numbers"))
    empty = F.lit(None).cast("array<binary>")
    return rows.select(
        F.lit("totals").alias("kind"), F.lit(level).alias("level"), F.lit(0).alias("bucket"),
        "block", empty.alias("arrays"), "numbers",
    )


def with_answers(blocks: DataFrame, parts: DataFrame, model: Model, work, schema: str) -> DataFrame:
    """Run ``work`` on each block with the answers it got, mostly one block in a task."""
    answers = parts.where("kind in ('answer', 'totals')").repartitionById(model.tasks, "block")
    own = blocks.repartitionById(model.tasks, "block")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(work, schema)


def learn(
    docs: DataFrame, held, order: int = ORDER, block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS
) -> tuple[DataFrame, DataFrame, Model]:
    """Stored blocks, stored parts (the model's tables and the answers), and the global numbers."""
    blocks = blocks_of(docs, held, block_tokens)
    size = F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))
    tokens, count, last, most = blocks.select(size, F.count(F.lit(1)), F.max("task"), F.max("step")).first()
    # tasks have read about the same, so these numbers leave few gaps; where they do, they are dealt round
    width, depth = (last or 0) + 1, (most or 0) + 1
    blocks = blocks.withColumn("block", F.col("task") + F.col("step") * F.lit(width)).drop("task", "step")
    buckets = int(max(8, (tokens or 0) // bucket_tokens))
    model = Model(max(1, min(width * depth, 2 * count)), buckets, max(1, bucket_tokens // CONTEXT_SHARE))

    def words(table: pa.Table) -> pa.Table:
        release_memory()
        return answer_words(table, buckets)

    asked = blocks.mapInArrow(partial(_ask_words, model=model), PARTS)
    parts = stored(by_bucket(asked, model).applyInArrow(words, PARTS), "katz-1")
    collect_sums(parts, 1, model)
    for level in range(2, order + 1):
        found = _level(blocks, parts, model, level, level == order)
        collect_sums(found, level, model)
        parts = parts.unionByName(found).unionByName(stored(split_totals(found, level), f"katz-totals-{level}"))
    return blocks, parts, model


def by_bucket(asked: DataFrame, model: Model) -> GroupedData:
    """What is asked of each bucket, a task for each."""
    return asked.repartitionById(model.buckets, "bucket").groupBy("bucket")


def _level(blocks: DataFrame, parts: DataFrame, model: Model, level: int, last: bool) -> DataFrame:
    buckets = model.buckets

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        release_memory()
        rows = [p for row in left.to_pylist() for p in Block(row, right.to_pylist(), model).ask_pairs(level)]
        return parts_table(rows)

    def answer(table: pa.Table) -> pa.Table:
        release_memory()
        return answer_pairs(table, level, buckets, last)

    asked = with_answers(blocks, parts, model, ask, PARTS)
    return stored(by_bucket(asked, model).applyInArrow(answer, PARTS), f"katz-{level}")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(
    docs: DataFrame, held, order: int = ORDER, block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    blocks, parts, model = learn(docs, held, order, block_tokens, bucket_tokens)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        release_memory()
        tables = [score_block(Block(row, right.to_pylist(), model), order) for row in left.to_pylist()]
        return pa.concat_tables(tables) if tables else score_schema().empty_table()

    return with_answers(blocks, parts, model, scored, SCORES)


def score_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in re.findall(r"(\w+) (\w+)", SCORES)])


def score_block(block: Block, order: int) -> pa.Table:
    _, counts, chance, _, _ = block.evaluate(order)
    starts = np.cumsum(block.lengths) - block.lengths
    train, types = int(block.model.sums[1][0]), int(block.model.sums[1][1])
    base = np.log10((counts + 1) / (train + types + 1))
    columns = [
        pa.array(block.docs, pa.int64()),
        pa.array(block.held),
        pa.array(block.lengths),
        pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)),
        pa.array(np.full(len(starts), train)),
        pa.array(np.add.reduceat(base, starts)),
        pa.array(np.add.reduceat(np.log10(chance), starts)),
    ]
    return pa.Table.from_arrays(columns, schema=score_schema())
