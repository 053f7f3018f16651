"""Best-fit packing of token pieces into sequences, online and in bounded space.

Pieces are tokenized where the texts lie; only lengths travel on. Groups of
about ``GROUP_PIECES`` pieces, dealt by a hash, are packed by themselves. Pieces
of a group arrive longest first, so short ones fill what long ones leave. At any
time at most ``OPEN_BINS`` sequences are open; they are kept by free space with
a bitset of the free spaces in use, so the tightest sequence that still takes a
piece is the lowest set bit at or above its length. When a new sequence would
exceed the number, the fullest open one closes first. No piece is ever dropped.

Defined results
---------------
null and empty text: one piece that holds the end token. A document of more
than ``size`` tokens is cut so that all pieces but the first are full. Repeated
rows are separate documents. null doc_id: packed like any other. Empty table:
no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimloom.llm.common import frees_memory, slices, stored, texts_of

#: A tokenizer, and the same vocabulary as ranks.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Merging a longer word takes the rank file's library much longer.
LONG_WORD = 4096
#: Tokens of a sequence, and the id that ends each document.
SIZE, END_ID = 1024, 2
#: Open sequences of a group. 50,000 pieces of the test texts would open 13,263; the fullest close early,
#: for 31,989 sequences instead of 31,967 (31,963 is the least their tokens need).
OPEN_BINS = 12_288
#: Pieces packed by one task group.
GROUP_PIECES = 50_000
#: Sequences are numbered within a group of 2**40.
GROUP_SHIFT = 40
PIECES = "doc_id long, piece int, start long, length long, ids binary"
#: Tells a piece from all others, whatever its id.
NUMBER = "number"
PLACED = "sequence_id long, offset long"


class Encoder:
    """Ids as the tokenizer of ``path`` gives them.

    Texts go through the rank file of the same vocabulary, which is faster;
    those with very long words, and those that name a special token, through
    the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            tokens = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens={})

    def __call__(self, text: str) -> bytes:
        odd = any(s in text for s in self.special) or (
            len(text) > LONG_WORD and any(len(w) > LONG_WORD for w in text.split())
        )
        if odd:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


@cache
def encoder(path: str, ranks: str) -> Encoder:
    return Encoder(path, ranks)


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first may be shorter than ``size``."""
    first = length % size or size
    return [(0, first), *((at, size) for at in range(first, length, size))]


@frees_memory
def _pieces(batches: Iterator[pa.RecordBatch], path: tuple[str, str], size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    end, encode = np.array([end_id], "<u4").tobytes(), encoder(*path)
    for batch in batches:
        for part in slices(batch, "text"):
            rows = [
                (doc, number, start, length, ids[4 * start : 4 * (start + length)])
                for doc, ids in zip(
                    part.column("doc_id").to_pylist(),
                    (encode(t) + end for t in texts_of(part)),
                )
                for number, (start, length) in enumerate(cut(len(ids) // 4, size))
            ]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                names=["doc_id", "piece", "start", "length", "ids"],
            )


def token_pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, path: tuple[str, str] = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) and number of each piece.

    The number is that of the row in this reading: store the pieces before it is used twice.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut_up = rows.mapInArrow(partial(_pieces, path=path, size=size, end_id=end_id), PIECES)
    return cut_up.withColumn(NUMBER, F.monotonically_increasing_id())


class OpenBins:
    """At most ``most`` open sequences, found by free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.by_free: dict[int, list[int]] = {}
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def _put(self, free: int, number: int) -> None:
        self.by_free.setdefault(free, []).append(number)
        self.bits |= 1 << free
        self.open += 1

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.made, self.size
            self.made += 1
            if length < free and self.open >= self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self._take(fullest)
        if free > length:
            self._put(free - length, number)
        return number, self.size - free


def pack_group(pdf: pd.DataFrame, size: int, most: int) -> pd.DataFrame:
    bins = OpenBins(size, most)
    pdf = pdf.sort_values(["length", "_deal", "number"], ascending=[False, True, True])
    placed = np.array([bins.place(n) for n in pdf["length"].tolist()], np.int64).reshape(-1, 2)
    pdf["sequence_id"] = (pdf["_group"].to_numpy().astype(np.int64) << GROUP_SHIFT) + placed[:, 0]
    pdf["offset"] = placed[:, 1]
    return pdf.drop(columns=["_group", "_deal"])


def pack(
    pieces: DataFrame, size: int = SIZE, most: int = OPEN_BINS, per_group: int = GROUP_PIECES
) -> DataFrame:
    """Adds sequence_id and offset to stored pieces (number, length and more columns).

    Pieces are dealt by their number, so groups are even whatever the ids are.
    """
    groups = max(1, round(pieces.count() / per_group))
    dealt = pieces.withColumn("_deal", F.xxhash64(NUMBER))
    dealt = dealt.withColumn("_group", F.pmod("_deal", F.lit(groups)).cast("int"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, {PLACED}"

    def packed_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return pack_group(pdf, size, most)

    return dealt.groupBy("_group").applyInPandas(packed_group, schema)


def packed(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, number, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, size).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stored(pieces, "pieces"), size)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids. ``pieces`` are stored, ``placed`` their places."""
    joined = pieces.select(NUMBER, "ids").join(placed.select(NUMBER, "sequence_id", "offset", "length"), NUMBER)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"])).alias("ids"),
    )
