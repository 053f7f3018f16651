"""Phrases that occur together more often than their parts would by chance.

Texts are tokenized once into stored blocks of word numbers with a vocabulary
of their own. Words that are frequent enough get global numbers by language and
rank, which the blocks receive for their own words only. Inside a task, the
pairs (rank of a word, rank of the next) of a block are split into square tiles
of the table of all pairs: a tile with many pairs is counted with a dense
bincount over its cells, all others as sorted coordinates. Spark sums the counts
of all blocks. For longer phrases the frequent phrases of one length are ranked
by how often a block has them and paired with the word that follows, by the same
tiles: a phrase can only be frequent if both phrases it overlaps with are. Which
ones are, the tasks read from a bit table of fixed size; a bit that stands for
another phrase too only sends a count that the sum then drops.

A candidate is cut in two at each place; a cut scores a*a / (l*r), counts of
the phrase and both parts, and the lowest cut counts. Candidates inside a longer
one that occurs at least half as often are dropped.

Defined results
---------------
null or empty text: no words. A null language is ``und``. Repeated rows count
again. A phrase never spans two pieces of a text, nor two texts. Scores are
exact for counts below 10^15. Ties in score and count go by the UTF-8 bytes of
the phrase. No candidates, or an empty table: no rows. Other columns are ignored.
A vocabulary beyond 2^31 - 1 frequent words is an error.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import Scratch, frees_memory, join_measured, slices, stored
from claimloom.llm.katz import mixed, packed, unpacked
from claimloom.operators.dense_key import with_dense_key
from claimloom.operators.lookup import lookup

#: Words of the longest phrase, occurrences a candidate needs, rows reported per language.
MAX_WORDS, LEAST, TOP = 3, 10, 2000
#: Percent of a candidate's occurrences that a longer one needs to replace it.
COVER = 50
SCALE = 1_000_000
#: Words of a block, over all languages a task has open.
BLOCK_TOKENS = 3_000_000
#: A tile has 2^TILE_BITS ranks a side; with over 1/DENSE as many pairs as cells it is counted densely.
TILE_BITS, DENSE = 9, 8
#: Bits of the table that tells tasks which phrases are frequent, and of one row of it.
FILTER_BITS, ROW_BITS = 1 << 26, 1 << 15
#: Candidates of a language that one task ranks, as a multiple of the rows reported.
ROUND = 10
UNKNOWN_LANG = "und"

BOUNDARY = b"\xff"  # no byte of UTF-8
# The signs that end a piece, and the blanks besides the space.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b"\t"
FOLD = bytes(
    BOUNDARY[0] if b in ENDS else 32 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256)
)

BLOCKS = "block long, lang string, n_words long, words binary, counts binary, tokens binary"
BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64())]
    + [(name, pa.binary()) for name in ("words", "counts", "tokens")]
)
COUNT_SCHEMA = pa.schema([("head", pa.int64()), ("tail", pa.int64()), ("n", pa.int64())])


# --- blocks ------------------------------------------------------------------


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words, with BOUNDARY where a piece ends; what is left are blanks ``split`` knows."""
    return text.translate(FOLD).replace(BOUNDARY, b" \xff ").split()


class OpenBlock:
    """Texts of one language, as numbers of the words of this block."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {BOUNDARY: 0}
        self.tokens: list[np.ndarray] = []

    def add(self, words: list[bytes]) -> None:
        numbers = self.numbers
        known = [numbers.setdefault(w, len(numbers)) for w in words]
        known.append(0)
        self.tokens.append(np.array(known, np.int32))

    def row(self, lang: str) -> pa.RecordBatch:
        tokens = np.concatenate(self.tokens)
        counts = np.bincount(tokens, minlength=len(self.numbers))[1:]
        words = zstandard.ZstdCompressor(level=1).compress(b"\n".join(list(self.numbers)[1:]))
        number = int.from_bytes(os.urandom(8)) >> 1
        row = [number, lang, int(counts.sum()), words, packed(counts), packed(tokens)]
        return pa.record_batch([pa.array([v], k.type) for v, k in zip(row, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)


@frees_memory
def make_blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_TOKENS) -> Iterator[pa.RecordBatch]:
    opened: dict[str, OpenBlock] = {}
    held = 0
    for batch in batches:
        for some in slices(batch, "text"):
            texts = some.column("text").cast(pa.large_binary()).to_pylist()
            for lang, text in zip(some.column("lang").to_pylist(), texts):
                words = words_of(text or b"")
                if words:
                    opened.setdefault(lang, OpenBlock()).add(words)
                    held += len(words)
            if held >= size:
                yield from (block.row(lang) for lang, block in opened.items())
                opened, held = {}, 0
    yield from (block.row(lang) for lang, block in opened.items())


def blocks_of(docs: DataFrame) -> DataFrame:
    lang = F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang")
    return docs.select(F.col("text"), lang).mapInArrow(make_blocks, BLOCKS)


# --- words and their numbers -------------------------------------------------


def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b"\n")
            counts, size = unpacked(row["counts"]), len(words)
            if not len(counts):
                continue
            yield pa.record_batch(
                [
                    pa.array(np.full(size, row["block"])),
                    pa.array([row["lang"]] * size, pa.string()),
                    pa.array(np.arange(1, size + 1, dtype=np.int32)),
                    pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array(counts.astype(np.int64)),
                ],
                ["block", "lang", "local", "word", "n"],
            )


def numbered_words(listed: DataFrame, least: int) -> DataFrame:
    """Words that occur often enough: lang, word, n, id, start. Ids go by language, then by rank from ``start``."""
    sums = listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    place = F.struct("lang", (-F.col("n")).alias("n"), "word")
    keyed = with_dense_key(sums.withColumn("place", place), "place", "id", lambda df: stored(df, "ranked-words"))
    words = stored(keyed.drop("place"), "words")
    if (words.agg(F.max("id")).first()[0] or 0) >= 2**31:
        raise ValueError("more than 2^31 - 1 frequent words")
    starts = stored(words.groupBy("lang").agg(F.min("id").alias("start")), "starts")
    return stored(lookup(words, starts, "lang", ["word"]), "numbered-words")


def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with global numbers instead of their own; 0 for boundaries and rare words."""
    for batch in batches:
        known, numbers = batch.column("known"), batch.select(["counts", "tokens", "start"])
        for at, row in enumerate(numbers.to_pylist()):
            ids = np.zeros(len(unpacked(row["counts"])) + 1, np.int32)
            pairs = known[at].values
            if pairs is not None:
                ids[pairs.field("local").to_numpy()] = pairs.field("id").to_numpy()
            tokens = pa.array([packed(ids[unpacked(row["tokens"])])], pa.binary())
            yield pa.record_batch([pa.array([row["start"] or 1], pa.int64()), tokens], ["start", "tokens"])


def numbered_blocks(blocks: DataFrame, listed: DataFrame, words: DataFrame) -> DataFrame:
    found = join_measured(listed.drop("n"), words.drop("n"), ["lang", "word"], "inner")
    known = found.groupBy("block").agg(
        F.collect_list(F.struct("local", "id")).alias("known"), F.first("start").alias("start")
    )
    joined = blocks.select("block", "counts", "tokens").join(known, "block", "left")
    return joined.mapInArrow(renumber, "start long, tokens binary")


# --- counting by tiles -------------------------------------------------------


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of two rank columns with their counts."""
    cells = 1 << (2 * TILE_BITS)
    tile = (left >> TILE_BITS) << 32 | (right >> TILE_BITS)
    tiles, which, sizes = np.unique(tile, return_inverse=True, return_counts=True)
    dense = np.flatnonzero(sizes * DENSE > cells)
    found = []
    if len(dense):
        of_dense = np.searchsorted(dense, which)
        in_dense = (of_dense < len(dense)) & (dense[np.minimum(of_dense, len(dense) - 1)] == which)
        side = (1 << TILE_BITS) - 1
        cell = (left & side) << TILE_BITS | (right & side)
        for number, t in enumerate(dense):
            counts = np.bincount(cell[in_dense & (of_dense == number)], minlength=cells)
            used = np.flatnonzero(counts)
            row = ((tiles[t] >> 32) << TILE_BITS) + (used >> TILE_BITS)
            column = ((tiles[t] & 0xFFFFFFFF) << TILE_BITS) + (used & side)
            found.append((row, column, counts[used]))
        left, right = left[~in_dense], right[~in_dense]
    coordinates, counts = np.unique(left << 32 | right, return_counts=True)
    found.append((coordinates >> 32, coordinates & 0xFFFFFFFF, counts))
    return tuple(np.concatenate(part) for part in zip(*found))


def positions(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Bit of each phrase in the table of frequent ones."""
    return (mixed(head ^ mixed(tail + 1).view(np.int64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def keys(ids: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Up to four word numbers a phrase, as two numbers."""
    columns = [*ids, *[np.zeros(len(ids[0]), np.int64)] * (4 - len(ids))]
    return columns[0] << 32 | columns[1], columns[2] << 32 | columns[3]


def phrase_counts(tokens: np.ndarray, start: int, tables: Sequence[np.ndarray]) -> tuple[np.ndarray, ...]:
    """head, tail, n of all phrases of len(tables) + 2 words, with a bit table for each length between.

    ``phrase[p]`` is the rank of the phrase that starts at p, -1 for none.
    """
    word = np.where(tokens > 0, tokens - start, -1)
    phrase = word
    representative = np.empty(0, np.int64)  # where each ranked phrase first stands
    for length in range(2, len(tables) + 3):
        size = max(0, len(word) - length + 1)
        follows = word[length - 1 :][:size]
        at = np.flatnonzero((phrase[:size] >= 0) & (phrase[1 : size + 1] >= 0) & (follows >= 0))
        if length == len(tables) + 2:
            break
        ids = [tokens[at + k] for k in range(length)]
        spot = positions(*keys(ids))
        at = at[tables[length - 2][spot >> 3] >> (spot & 7).astype(np.uint8) & 1 == 1]
        # The phrase before and the word after name the longer phrase; more occurrences, lower rank.
        _, first, inverse, counts = np.unique(
            phrase[at] << 32 | word[at + length - 1], return_index=True, return_inverse=True, return_counts=True
        )
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        representative = at[first][order]
        phrase = np.full(len(word), -1)
        phrase[at] = rank[inverse]
    left, right, counts = tile_counts(phrase[at], word[at + length - 1])
    if length == 2:
        ids = [left + start, right + start]
    else:
        ids = [*(tokens[representative[left] + k] for k in range(length - 1)), right + start]
    return *keys(ids), counts


@frees_memory
def count_phrases(batches: Iterator[pa.RecordBatch], tables: Sequence[Broadcast]) -> Iterator[pa.RecordBatch]:
    bits = [np.frombuffer(t.value, np.uint8) for t in tables]
    for batch in batches:
        for row in batch.to_pylist():
            counted = phrase_counts(unpacked(row["tokens"]).astype(np.int64), row["start"], bits)
            for at in range(0, len(counted[0]), 200_000):
                some = [pa.array(c[at : at + 200_000].astype(np.int64)) for c in counted]
                yield pa.record_batch(some, schema=COUNT_SCHEMA)


def add_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        head, tail = (batch.column(k).to_numpy() for k in ("head", "tail"))
        yield pa.record_batch([pa.array(positions(head, tail))], ["spot"])


def bit_table(frequent: DataFrame) -> Broadcast:
    """The bits of all frequent phrases; of fixed size, so are the rows it is put together from."""
    spots = frequent.select("head", "tail").mapInArrow(add_positions, "spot long")
    row = F.floor(F.col("spot") / ROW_BITS).cast("int").alias("row")
    rows = spots.groupBy(row).agg(F.bitmap_construct_agg(F.col("spot") % ROW_BITS).alias("bits"))
    table = bytearray(FILTER_BITS // 8)
    for number, bits in rows.collect():
        table[number * ROW_BITS // 8 : (number + 1) * ROW_BITS // 8] = bits
    return frequent.sparkSession.sparkContext.broadcast(bytes(table))


def frequent_phrases(numbered: DataFrame, most: int, least: int) -> list[DataFrame]:
    """Phrases of 2, 3 .. ``most`` words that occur often enough: head, tail, n."""
    found: list[DataFrame] = []
    tables: list[Broadcast] = []
    for length in range(2, most + 1):
        counted = numbered.mapInArrow(partial(count_phrases, tables=tuple(tables)), "head long, tail long, n long")
        # A task has a phrase about once, so there is nothing to combine before the shuffle.
        dealt = counted.repartition("head", "tail")
        sums = dealt.groupBy("head", "tail").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        found.append(stored(sums, f"phrases-{length}"))
        if length < most:
            tables.append(bit_table(found[-1]))
    return found


# --- scores ------------------------------------------------------------------


def with_ids(phrases: DataFrame, length: int) -> DataFrame:
    """Word numbers as an array, and n."""
    halves = [(h, s) for h in ("head", "tail") for s in ("high", "low")][:length]
    ids = [F.shiftright(h, 32) if s == "high" else F.col(h).bitwiseAND(2**32 - 1) for h, s in halves]
    return phrases.select(F.array(*ids).alias("ids"), "n")


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """ids, a, and the lowest cut as score, l, r. ``counts`` has all words and phrases by ids."""
    cuts = candidates.select("ids", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    for name, part in (
        ("l", F.slice("ids", F.lit(1), F.col("k"))),
        ("r", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))),
    ):
        table = counts.select(F.col("ids").alias("part"), F.col("n").alias(name))
        cuts = lookup(cuts.withColumn("part", part), table, "part", ["ids"], measured=counts).drop("part")
    exact = {k: F.col(k).cast("decimal(15,0)") for k in "alr"}
    cuts = cuts.withColumns(
        {"top": exact["a"] * exact["a"] * F.lit(SCALE).cast("decimal(7,0)"), "bottom": exact["l"] * exact["r"]}
    ).withColumn("score", F.expr("top div bottom"))
    lowest = F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")
    return cuts.groupBy("ids").agg(lowest).select("ids", "cut.a", "cut.l", "cut.r", "cut.score")


def not_covered(found: DataFrame, longer: Sequence[DataFrame], cover: int) -> DataFrame:
    """Without candidates that lie inside a longer one that occurs ``cover`` percent as often or more."""
    if not longer:
        return found
    size = F.size("ids")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda length: F.transform(F.sequence(F.lit(1), size - length + 1), lambda at: F.slice("ids", at, length)),
        )
    )
    inside = reduce(DataFrame.unionByName, longer).select(F.explode(inner).alias("ids"), "n")
    most = stored(inside.groupBy("ids").agg(F.max("n").alias("longest")), "inside")
    covered = F.coalesce(100 * F.col("longest") >= cover * F.col("a"), F.lit(False))
    return lookup(found, most, "ids", ["ids"]).where(~covered).drop("longest")


def leaders(found: DataFrame, top: int) -> DataFrame:
    """The best of each language, with all that tie on score and count.

    In rounds, so that no task ranks all candidates of a language: each round
    deals them to groups and keeps the best of each group.
    """
    best = [F.desc("score"), F.desc("a")]

    def ranked(rows: DataFrame, groups: int) -> DataFrame:
        group = F.pmod(F.xxhash64("ids"), F.lit(groups))
        place = F.rank().over(Window.partitionBy("lang", group).orderBy(*best))
        return rows.withColumn("place", place).where(F.col("place") <= top).drop("place")

    def largest(rows: DataFrame) -> int:
        return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0

    size = largest(found)
    while size > ROUND * top:
        found = stored(ranked(found, -(-size // (ROUND * top // 2))), "leaders")
        size, before = largest(found), size
        if size > before // 2:  # ties
            break
    return stored(ranked(found, 1), "leaders")


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, cover: int = COVER
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best ``top`` phrases of each language.

    ``docs`` has ``text`` and ``lang``. Phrases have 2 to ``max_words`` (at most 4) words.
    """
    if not 2 <= max_words <= 4:
        raise ValueError("phrases have 2 to 4 words")
    scratch = Scratch(docs.sparkSession, "collocations")
    blocks = scratch.store(blocks_of(docs), "blocks")
    totals = stored(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
    listed = blocks.select("block", "lang", "words", "counts").mapInArrow(
        list_words, "block long, lang string, local int, word string, n long"
    )
    words = numbered_words(listed, least)
    numbered = scratch.store(numbered_blocks(blocks, listed, words), "numbered")
    scratch.clear("blocks")

    levels = [with_ids(p, k + 2) for k, p in enumerate(frequent_phrases(numbered, max_words, least))]
    scratch.clear("numbered")
    singles = words.select(F.array("id").alias("ids"), "n")
    counts = stored(reduce(DataFrame.unionByName, [singles, *levels]), "counts")
    candidates = counts.where(F.size("ids") > 1)
    kept = not_covered(scored(candidates, counts), [counts.where(F.size("ids") > 2)] if max_words > 2 else [], cover)
    named = words.select("id", "lang")
    kept = lookup(kept.withColumn("id", F.col("ids")[0]), named, "id", ["ids"]).drop("id")
    best = leaders(stored(kept, "scored"), top)

    spelt = best.select("ids", F.posexplode("ids").alias("at", "id"))
    spelt = lookup(spelt, words.select("id", "word"), "id", ["ids"])
    texts = spelt.groupBy("ids").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    joined = join_measured(best.join(texts, "ids"), totals, ["lang"], "left")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        joined.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
