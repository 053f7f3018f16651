"""Byte-level BPE with a segment tree over byte positions.

A piece (one match of the split pattern) starts as one token per byte. Leaf i
of the tree holds the rank of the pair that starts at position i, with the
position in the low bits, so the root is the lowest rank and, among equals, the
leftmost pair. A merge changes three leaves (the merged token, its live left
neighbour, the token it swallowed) and the log n nodes above each. Ranks are
looked up by the two token ids; every way to cut a token's bytes into two
tokens is in that table, as the rank belongs to the joined bytes.

Short pieces, nearly all of a text, go through their trees side by side as
numpy rows, one merge of every piece at a time; long ones one by one. Both are
the same algorithm on the same layout.

Defined results
---------------
null and empty text: no ids, decoded to no bytes. Ids outside the vocabulary
raise on decoding. Special tokens are never produced; their text is ordinary
text. Very long texts are cut into segments at places where the pattern cuts
anyway. Repeated rows give the same result each; other columns pass through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache, cached_property, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import frees_memory, slices, texts_of
from claimloom.llm.pretoken import PIECES, Remembering, cut_ids

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Pieces up to this many bytes are merged side by side, in blocks of so many leaves.
SIDE_BY_SIDE, BLOCK_LEAVES = 256, 1 << 20
#: Bits of a leaf that hold the position, and a leaf without a pair.
PLACE_BITS = 32
#: Pieces of a generation that a worker remembers.
REMEMBERED = 150_000
NONE = np.int64(np.iinfo(np.int64).max)


class Ranks:
    """Tokens of a rank file, and the rank of each pair of tokens that joins to a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.known = np.zeros(size, bool)
        self.known[list(ranks.values())] = True
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    @cached_property
    def joins(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted pairs of tokens that join to a token, and its rank. Decoding needs none of this."""
        ranks = {t: r for r, t in enumerate(self.tokens) if t}
        pairs = {
            (ranks[t[:i]] << PLACE_BITS) | ranks[t[i:]]: rank
            for t, rank in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        }
        keys = np.array(sorted(pairs), np.int64)
        return keys, np.array([pairs[k] for k in keys.tolist()], np.int64)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """``joins`` for one lookup at a time; only long pieces need it."""
        return dict(zip(*(part.tolist() for part in self.joins)))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the two do not join."""
        keys, values = self.joins
        key = (left << PLACE_BITS) | right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, values[at], -1)


@cache
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


def merge_alone(piece: bytes, ranks: Ranks) -> np.ndarray:
    """Ids of one long piece."""
    size = len(piece)
    leaves = 1 << max(1, (size - 1).bit_length())
    ids = ranks.single[np.frombuffer(piece, np.uint8)]
    rank = ranks.of(ids[:-1], ids[1:])
    none = int(NONE)
    tree = [none] * (2 * leaves)
    tree[leaves : leaves + size - 1] = np.where(
        rank < 0, NONE, (rank << PLACE_BITS) | np.arange(size - 1)
    ).tolist()
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    token, after, before = ids.tolist(), list(range(1, size + 1)), list(range(-1, size - 1))
    mask, pairs = (1 << PLACE_BITS) - 1, ranks.pairs

    def put(place: int, value: int) -> None:
        node = place + leaves
        tree[node] = value
        while node > 1:
            node >>= 1
            lowest = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == lowest:
                break
            tree[node] = lowest

    def pair(place: int) -> int:
        other = after[place]
        found = pairs.get((token[place] << PLACE_BITS) | token[other], -1) if other < size else -1
        return none if found < 0 else (found << PLACE_BITS) | place

    while tree[1] != none:
        place, other = tree[1] & mask, after[tree[1] & mask]
        token[place] = tree[1] >> PLACE_BITS
        after[place] = after[other]
        if after[other] < size:
            before[after[other]] = place
        put(other, none)
        put(place, pair(place))
        if before[place] >= 0:
            put(before[place], pair(before[place]))
    out, place = [], 0
    while place < size:
        out.append(token[place])
        place = after[place]
    return np.array(out, np.uint32)


def merge_together(pieces: list[bytes], leaves: int, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces of at most ``leaves`` bytes, and how many each has: a tree per row, one merge of each at a time."""
    count = len(pieces)
    size = np.array([len(p) for p in pieces])
    grid = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(count, leaves)
    token = ranks.single[grid]
    place = np.arange(leaves)
    rank = ranks.of(token[:, :-1], token[:, 1:])
    tree = np.full((count, 2 * leaves), NONE)
    usable = (rank >= 0) & (place[None, 1:] < size[:, None])
    tree[:, leaves:-1] = np.where(usable, (rank << PLACE_BITS) | place[:-1], NONE)
    for node in range(leaves - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    after = np.tile(place + 1, (count, 1))
    before = np.tile(place - 1, (count, 1))
    alive = place[None, :] < size[:, None]
    rows = np.flatnonzero(tree[:, 1] != NONE)

    def put(rows: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
        node = places + leaves
        tree[rows, node] = values
        for _ in range(leaves.bit_length() - 1):
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pair(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        other = after[rows, places]
        inside = other < size[rows]
        found = ranks.of(token[rows, places], token[rows, np.where(inside, other, 0)])
        return np.where(inside & (found >= 0), (found << PLACE_BITS) | places, NONE)

    while len(rows):
        best = tree[rows, 1]
        at = best & ((1 << PLACE_BITS) - 1)
        other = after[rows, at]
        beyond = after[rows, other]
        token[rows, at] = best >> PLACE_BITS
        after[rows, at] = beyond
        alive[rows, other] = False
        has = beyond < size[rows]
        before[rows[has], beyond[has]] = at[has]
        put(rows, other, np.full(len(rows), NONE))
        put(rows, at, pair(rows, at))
        left = before[rows, at]
        has = left >= 0
        put(rows[has], left[has], pair(rows[has], left[has]))
        rows = rows[tree[rows, 1] != NONE]
    return token[alive].astype("<u4"), alive.sum(1)


def encode_pieces(pieces: list[bytes], ranks: Ranks) -> list[bytes]:
    """Little-endian 32-bit ids of each piece, in the order given."""
    out = [b""] * len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    for at in np.flatnonzero(sizes > SIDE_BY_SIDE).tolist():
        out[at] = merge_alone(pieces[at], ranks).astype("<u4").tobytes()
    leaves, below = 2, 0
    while below < SIDE_BY_SIDE:
        members = np.flatnonzero((sizes > below) & (sizes <= leaves))
        for start in range(0, len(members), max(1, BLOCK_LEAVES // leaves)):
            block = members[start : start + max(1, BLOCK_LEAVES // leaves)].tolist()
            ids, counts = merge_together([pieces[m] for m in block], leaves, ranks)
            raw, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            for at, low, high in zip(block, [0, *ends], ends):
                out[at] = raw[low:high]
        leaves, below = 2 * leaves, leaves
    return out


class Encoder:
    """Encodes chunks: every match of the split pattern by itself; pieces met before are remembered."""

    def __init__(self, ranks: Ranks):
        self.ranks, self.young, self.old = ranks, {}, {}
        self.remembered = Remembering(self.encode_run, lambda part: self.encode_run([part])[0])

    def encode_run(self, parts: list[str]) -> list[bytes]:
        pieces = PIECES.findall("".join(parts))
        known, old = self.young, self.old
        distinct = set(pieces)
        for piece in distinct & old.keys():
            known[piece] = old[piece]
        new = [p for p in distinct if p not in known]
        known.update(zip(new, encode_pieces([p.encode() for p in new], self.ranks)))
        found = [known[p] for p in pieces]
        if len(known) > REMEMBERED:
            self.old, self.young = known, {}
        ids = np.frombuffer(b"".join(found), "<u4")
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        # a token's place is where its piece ends, as only the ends of pieces matter
        ends = np.repeat(np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))), counts)
        part_ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        return cut_ids(ids, ends, part_ends)


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(ranks_of(path))


def encode_texts(texts: list[str], path: str = VOCABULARY) -> list[bytes]:
    """Little-endian 32-bit ids of each text."""
    return _encoder(path).remembered.all_ids(texts)


def decode_ids(ids: np.ndarray, ranks: Ranks) -> bytes:
    """The bytes the ids stand for."""
    ids = ids.astype(np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(ranks.known) or not ranks.known[ids].all()):
        raise ValueError("an id is not in the vocabulary")
    lengths = ranks.lengths[ids]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    from_start = np.arange(total) - np.repeat(ends - lengths, lengths)
    return ranks.bytes[np.repeat(ranks.starts[ids], lengths) + from_start].tobytes()


@frees_memory
def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            ids = encode_texts(texts_of(part), path)
            offsets = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.record_batch(
                [part.column("row"), pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["row", "ids"]
            )


@frees_memory
def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    ranks = ranks_of(path)
    for batch in batches:
        ids, lists = batch.column("ids"), batch.column("ids")
        flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        texts = [decode_ids(flat[a:b], ranks) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.record_batch(
            [batch.column("row"), ids, pa.array(texts, pa.binary())], names=["row", "ids", "decoded"]
        )


def encode(docs: DataFrame, keep: list[str] | None = None, path: str = VOCABULARY) -> DataFrame:
    """``row`` (the columns named in ``keep``, by default all) and ``ids`` (array of int) of each row."""
    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    rows = docs.select(kept, F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(partial(_encode, path=path), schema)


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Adds ``decoded`` (binary) to rows of ``row`` and ``ids``."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.select("row", "ids").mapInArrow(partial(_decode, path=path), schema)
