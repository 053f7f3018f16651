"""Removal of repeated byte strings by suffix sorting, over a whole corpus.

A byte goes if a string of ``LEAST`` bytes that covers it also starts earlier
(in a smaller doc_id, or earlier in the same document).

1. Anchors. Of the ``GRAM``-byte grams in each window of ``LEAST`` bytes the one
   with the smallest hash is an anchor. Equal windows have the same anchor at
   the same place, so every repeated string meets its earlier copy at an
   anchor's gram. An anchor's context is the windows it is the anchor of.
2. Anchors meet by gram in buckets. Of those with the same whole context only
   the first goes on; the context of a later one is covered as it is. This is
   done within a task first, so a passage that many documents share travels
   once per task.
3. Grams with several contexts remain. A string that two of them share has one
   of ``PARTS`` cores, so contexts of which no core's hash occurs in another are
   done with. The others are fetched, and each bucket sorts the suffixes of its
   contexts. Runs of the suffix array in which
   neighbours share ``LEAST`` bytes give the longest-previous-factor test: a
   suffix has an earlier match of that length if the smallest position before
   it (or after it) in its run is smaller than its own.
   Contexts of a gram that has more than ``HOT`` of them (the edges of a passage
   that many documents share) do not meet in one bucket: the strings of the
   parts whose core is shared are dealt by their own hash. A task sends on only
   the first place of each string, the others are covered.
4. Covered spans are united per document and cut out.

Contexts are compared by 128 bits: two hashes of 64 bits over byte tables and
bases of their own, besides the gram's; the suffixes of step 3 by their bytes,
strings of hot grams by a hash of 128 bits.

Defined results
---------------
null text: no bytes. An id stands for one text: repeated rows are the same
place, none is the earlier one, and all are cut alike. A null doc_id counts as
larger than all others; rows without an id are told apart (and put in order) by
a hash of their text, so only those with equal texts are repeated rows. Texts shorter than ``LEAST`` lose nothing. Empty table:
no rows. Other columns pass through ``remove_repeats``; as text, a character
that is cut in part is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import frees_memory, join_measured, release_memory, slices, stored, texts_of
from claimloom.llm.katz import packed, unpacked

LEAST, GRAM = 100, 32
#: Bytes a context may have before its anchor's start.
BEFORE = LEAST - GRAM
#: An anchor's strings by how far they reach before it, in so many parts. All
#: strings of a part have a core of LEAST - BEFORE / PARTS bytes in common.
PARTS = 4
#: Bytes hashed at once, anchors collapsed at once, bytes of text a bucket is meant to answer for.
PIECE, HELD, BUCKET_BYTES = 1 << 18, 300_000, 12 * 1024 * 1024
#: A gram with more contexts to look at has its strings dealt one by one.
HOT = 2_000
FOUND = "kind string, bucket int, arrays array<binary>"
FOUND_SCHEMA = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("arrays", pa.list_(pa.binary()))])
#: Odd bases of the two hashes.
BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


@cache
def _hashing(which: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, and powers of an odd base and of its inverse modulo 2**64."""
    random = np.random.default_rng(2024 + which)
    table = random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = BASES[which]
    size = PIECE + 4 * LEAST
    powers = np.full(size, base, np.uint64)
    inverse = np.full(size, pow(base, -1, 2**64), np.uint64)
    powers[0] = inverse[0] = 1
    return table, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding(values: np.ndarray, width: int, smaller=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of each ``width`` neighbours."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = smaller(out[: len(out) - step], out[step:])
        done += step
    return out


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the texts that lie side by side in ``data``: place, hashes of gram, context (two) and cores,
    and the bytes of the context before the anchor's start and from there on.

    ``starts`` and ``ends`` give for each byte the bounds of its text. Only
    texts of at least ``LEAST`` bytes have anchors.
    """
    table, powers, inverse = _hashing()
    size = len(data)
    if size < LEAST:
        empty = np.zeros(0, np.int64)
        return empty, *[empty.view(np.uint64)] * 3, np.zeros((0, PARTS), np.uint32), empty, empty
    prefix = np.zeros(size + 1, np.uint64)
    np.cumsum(table[data] * powers[:size], out=prefix[1:])
    grams = size - GRAM + 1
    gram = mix((prefix[GRAM:] - prefix[:grams]) * inverse[:grams]) | np.uint64(1)
    least = sliding(gram, LEAST - GRAM + 1)
    window = np.flatnonzero(np.arange(LEAST, LEAST + len(least)) <= ends[: len(least)])
    best = np.zeros(grams + BEFORE, np.uint64)
    best[BEFORE + window] = least[window]
    minima = np.flatnonzero(sliding(best, BEFORE + 1, np.maximum) == gram)
    # each window's anchor: the first minimum from its start on that is its own
    least = least[window]
    which = np.searchsorted(minima, window)
    other = np.flatnonzero(gram[minima[which]] != least)
    while len(other):
        which[other] += 1
        other = other[gram[minima[which[other]]] != least[other]]
    new = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(which) else which
    place = minima[which[new]]
    low, high = window[new], window[np.append(new[1:], len(which)) - 1] + LEAST
    sides = ((place - low) * 1000 + high - place).astype(np.uint64)
    context = mix(mix((prefix[high] - prefix[low]) * inverse[low]) + sides)
    table, powers, second = _hashing(1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(table[data] * powers[:size], out=sums[1:])
    check = mix(mix((sums[high] - sums[low]) * second[low]) + sides)
    cores = np.zeros((len(place), PARTS), np.uint32)
    for part in range(PARTS):
        near, far = part * BEFORE // PARTS, (part + 1) * BEFORE // PARTS
        # some window of the context starts between ``near`` and ``far`` before the anchor
        inside = (place - low >= near) & (place - (high - LEAST) <= far)
        first, last = np.where(inside, place - near, 0), np.where(inside, place + LEAST - far, 0)
        core = (mix((prefix[last] - prefix[first]) * inverse[first]) >> np.uint64(32)) | np.uint64(1)
        cores[:, part] = np.where(inside, core, np.uint64(0))
    return place, gram[place], context, check, cores, place - low, high - place


def text_anchors(none: list[int], ids: list[int], texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """gram, context, check, none, id, place, cores, before, after of the anchors; long texts go piece by piece.

    Pieces overlap. ``none`` is 1 for rows without an id, whose ``id`` is a hash of their text.
    """
    found: list[tuple[np.ndarray, ...]] = []
    batch: list[tuple[int, int, bytes, int, int, int]] = []

    def flush() -> None:
        lengths = np.array([len(b[2]) for b in batch])
        data = np.frombuffer(b"".join(b[2] for b in batch), np.uint8)
        first = np.cumsum(lengths) - lengths
        starts, ends = np.repeat(first, lengths), np.repeat(first + lengths, lengths)
        place, gram, context, check, cores, before, after = anchors(data, starts, ends)
        owner = np.searchsorted(first, place, side="right") - 1
        at = place - first[owner] + np.array([b[1] for b in batch])[owner]
        # a piece of a long text is only trusted where all windows of an anchor lie within it
        low, high = (np.array([b[i] for b in batch])[owner] for i in (3, 4))
        inside = (at >= low) & (at < high)
        sides = before.astype(np.uint8), after.astype(np.uint8)
        whose = np.array([b[5] for b in batch], np.int8)[owner], np.array([b[0] for b in batch], np.int64)[owner]
        found.append(tuple(x[inside] for x in (gram, context, check, *whose, at, cores, *sides)))

    held = 0
    for no_id, number, text in zip(none, ids, texts):
        if len(text) < LEAST:
            continue
        for start in range(0, len(text), PIECE):
            low, high = max(0, start - 2 * LEAST), min(len(text), start + PIECE + 2 * LEAST)
            if held and held + high - low > PIECE + 4 * LEAST:
                flush()
                batch, held = [], 0
            batch.append((number, low, text[low:high], start, start + PIECE, no_id))
            held += high - low
    if batch:
        flush()
    empty = [np.zeros(0, np.uint64)] * 3 + [np.zeros(0, np.int8)] + [np.zeros(0, np.int64)] * 2
    empty += [np.zeros((0, PARTS), np.uint32)]
    empty += [np.zeros(0, np.uint8)] * 2
    return tuple(np.concatenate([e, *(f[i] for f in found)]) for i, e in enumerate(empty))


def collapse(keys, none, doc, place) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of (keys, none, doc, place) without repeats, and which are the first of their keys."""
    order = np.lexsort((place, doc, none, *reversed(keys)))
    n, d, p = none[order], doc[order], place[order]
    same = np.logical_and.reduce([k[order[1:]] == k[order[:-1]] for k in keys])
    first = np.append(True, ~same)
    repeat = np.append(False, same & (n[1:] == n[:-1]) & (d[1:] == d[:-1]) & (p[1:] == p[:-1]))
    return order[~repeat], first[~repeat]


def united(none: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans with overlapping and touching ones of a document merged."""
    if not len(doc):
        return none, doc, start, end
    order = np.lexsort((start, doc, none))
    none, doc, start, end = none[order], doc[order], start[order], end[order]
    group = np.cumsum(np.append(True, (doc[1:] != doc[:-1]) | (none[1:] != none[:-1])))
    shift = group.astype(np.int64) << 34  # texts are shorter than 2**31 bytes
    reach = np.maximum.accumulate(end + shift)
    new = np.append(True, (start + shift)[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return none[at], doc[at], start[at], np.maximum.reduceat(end, at)


def _rows(rows: list[tuple[str, int, list[np.ndarray]]]) -> pa.Table:
    return pa.Table.from_pylist(
        [{"kind": k, "bucket": b, "arrays": [packed(a) for a in arrays]} for k, b, arrays in rows], FOUND_SCHEMA
    )


def covered(none, doc, place, before, after) -> list[np.ndarray]:
    """United spans of the contexts of anchors."""
    place = place.astype(np.int64)
    return list(united(none, doc, place - before, place + after))


def by_owner(owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each number that occurs, by number: work goes by what is there, not by how many buckets there are."""
    order = np.argsort(owner, kind="stable")
    if len(order):
        starts = np.flatnonzero(np.append(True, owner[order[1:]] != owner[order[:-1]]))
        for some in np.split(order, starts[1:]):
            yield int(owner[some[0]]), some


def _task_rows(parts: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[pa.RecordBatch]:
    columns = [np.concatenate(p) for p in zip(*parts)]
    order, first = collapse(columns[:3], *columns[3:6])
    spans = covered(*(c[order[~first]] for c in (*columns[3:6], *columns[7:9])))
    gram, context, check, none, doc, place, cores, before, after = (c[order[first]] for c in columns)
    # anchors are minima, so their hashes are small: buckets go by another hash
    owner = (mix(gram * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)
    rows = []
    for bucket, s in by_owner(owner):
        deltas = np.diff(gram[s], prepend=np.uint64(0))
        rest = [place[s].astype(np.int32), cores[s].ravel(), before[s], after[s]]
        rows.append(("anchor", bucket, [deltas, context[s], check[s], none[s], doc[s], *rest]))
    if len(spans[0]):
        rows.append(("span", int(spans[1][0]) % buckets, spans))
    yield from _rows(rows).to_batches()


def anchor_rows(buckets: int):
    @frees_memory
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for some in slices(batch, "text"):
                none, ids = (some.column(c).to_pylist() for c in ("no_id", "doc_id"))
                parts.append(text_anchors(none, ids, [t.encode() for t in texts_of(some)]))
                held += len(parts[-1][0])
                if held >= HELD:
                    yield from _task_rows(parts, buckets)
                    parts, held = [], 0
        if held:
            yield from _task_rows(parts, buckets)

    return work


def shared_core(gram: np.ndarray, cores: np.ndarray) -> np.ndarray:
    """Which parts of contexts have a core that another context of the same gram has too."""
    found = np.zeros(cores.shape, bool)
    for part, core in enumerate(cores.T):
        order = np.lexsort((core, gram))
        same = (gram[order[1:]] == gram[order[:-1]]) & (core[order[1:]] == core[order[:-1]]) & (core[order[1:]] > 0)
        found[order[1:][same], part] = True
        found[order[:-1][same], part] = True
    return found


def shared_parts(shared: np.ndarray, none, doc, place, before, after) -> list[np.ndarray]:
    """United bytes of those parts of contexts that ``shared`` marks."""
    row, part = np.nonzero(shared)
    place = place.astype(np.int64)
    low = np.maximum(place - before, 0)[row]
    low = np.maximum(low, place[row] - (part + 1) * BEFORE // PARTS)
    high = np.minimum((place + after)[row], place[row] - part * BEFORE // PARTS + LEAST)
    return list(united(none[row], doc[row], low, high))


def meet(table: pa.Table, hot: int = HOT) -> pa.Table:
    """Anchors of a bucket: spans of later equal contexts, and the spans of contexts that must be looked at."""
    release_memory()
    rows = table.to_pylist()
    bucket = rows[0]["bucket"]
    out = [("span", bucket, [unpacked(a) for a in r["arrays"]]) for r in rows if r["kind"] == "span"]
    parts = [[unpacked(a) for a in r["arrays"]] for r in rows if r["kind"] == "anchor"]
    if parts:
        gram = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        context, check, none, doc, place, cores, before, after = (
            np.concatenate([p[i] for p in parts]) for i in range(1, 9)
        )
        order, first = collapse((gram, context, check), none, doc, place)
        later, once = order[~first], order[first]
        if len(later):
            out.append(("span", bucket, covered(none[later], doc[later], place[later], before[later], after[later])))
        same = gram[once[1:]] == gram[once[:-1]]
        once = once[np.append(same, False) | np.append(False, same)]
        shared = shared_core(gram[once], cores.reshape(-1, PARTS)[once])
        once, shared = once[shared.any(1)], shared[shared.any(1)]
        _, which, counts = np.unique(gram[once], return_inverse=True, return_counts=True)
        many = counts[which] > hot
        few = once[~many]
        if len(few):
            out.append(("ask", bucket, covered(none[few], doc[few], place[few], before[few], after[few])))
        if many.any():
            columns = (c[once[many]] for c in (none, doc, place, before, after))
            out.append(("hot", bucket, shared_parts(shared[many], *columns)))
    return _rows(out)


@frees_memory
def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans as rows: no_id, doc_id, start, end."""
    for batch in batches:
        for arrays in batch.column("arrays").to_pylist():
            yield pa.record_batch([pa.array(unpacked(a)) for a in arrays], names=["no_id", "doc_id", "start", "end"])


@frees_memory
def asks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts to be looked at as rows: no_id, doc_id, bucket, start, end."""
    for batch in batches:
        for bucket, arrays in zip(batch.column("bucket").to_pylist(), batch.column("arrays").to_pylist()):
            none, doc, start, end = map(unpacked, arrays)
            columns = [none, doc, np.full(len(doc), bucket, np.int32), start, end]
            yield pa.record_batch([pa.array(c) for c in columns], names=["no_id", "doc_id", "bucket", "start", "end"])


@frees_memory
def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes asked for: bucket, no_id, doc_id, start, part."""
    for batch in batches:
        for some in slices(batch, "text"):
            rows = []
            for none, doc, text, asked in zip(*(some.column(c).to_pylist() for c in ("no_id", "doc_id", "text", "asked"))):
                data = (text or "").encode()
                rows += [(a["bucket"], none, doc, a["start"], data[a["start"] : a["end"]]) for a in asked]
            kinds = [pa.int32(), pa.int8(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.record_batch(columns, names=["bucket", "no_id", "doc_id", "start", "part"])


def _string_rows(parts: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    hashes = np.frombuffer(b"".join(p[0] for p in parts), "<u8").reshape(-1, 2)
    columns = [hashes[:, 0], hashes[:, 1], *(np.concatenate([p[i] for p in parts]) for i in range(1, 4))]
    order, first = collapse(columns[:2], *columns[2:])
    once = [c[order[first]] for c in columns]
    owner = (once[0] % np.uint64(buckets)).astype(np.int64)
    rows = [("string", bucket, [c[some] for c in once]) for bucket, some in by_owner(owner)]
    spans = string_spans(*(c[order[~first]] for c in columns[2:]))
    if len(spans[0]):
        rows.append(("span", int(spans[1][0]) % buckets, spans))
    yield from _rows(rows).to_batches()


def string_spans(none, doc, place) -> list[np.ndarray]:
    return list(united(none, doc, place, place + LEAST))


def fetch_strings(buckets: int):
    """The strings of the bytes asked for: the first place of each that a task has, and spans of its later places."""

    @frees_memory
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for some in slices(batch, "text"):
                for none, doc, text, asked in zip(*(some.column(c).to_pylist() for c in ("no_id", "doc_id", "text", "asked"))):
                    data = (text or "").encode()
                    for a in asked:
                        places = range(a["start"], min(a["end"], len(data)) - LEAST + 1)
                        hashes = [hashlib.blake2b(data[p : p + LEAST], digest_size=16).digest() for p in places]
                        same = np.full(len(places), none, np.int8), np.full(len(places), doc, np.int64)
                        parts.append((b"".join(hashes), *same, np.array(places, np.int64)))
                        held += len(places)
                    if held >= HELD:
                        yield from _string_rows(parts, buckets)
                        parts, held = [], 0
        if held:
            yield from _string_rows(parts, buckets)

    return work


def meet_strings(table: pa.Table) -> pa.Table:
    """Spans of all places of a bucket's strings but the first of each."""
    release_memory()
    rows = [(r["kind"], [unpacked(a) for a in r["arrays"]]) for r in table.to_pylist()]
    found = [arrays for kind, arrays in rows if kind == "span"]
    parts = [arrays for kind, arrays in rows if kind == "string"]
    if parts:
        columns = [np.concatenate(c) for c in zip(*parts)]
        order, first = collapse(columns[:2], *columns[2:])
        found.append(string_spans(*(c[order[~first]] for c in columns[2:])))
    columns = united(*(np.concatenate(c) for c in zip(*found)))
    return pa.table([pa.array(c) for c in columns], names=["no_id", "doc_id", "start", "end"])


def suffix_runs(data: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in suffix order (by their first LEAST bytes, then by position), and the run each belongs to.

    Sorted eight bytes at a time. A suffix that is alone with what it has shown
    so far shares fewer than LEAST bytes with any other and is left out.
    """
    if not len(suffixes):
        return suffixes, suffixes
    words = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(8, np.uint8)), 8)

    def words_at(depth: int) -> np.ndarray:
        return np.ascontiguousarray(words[suffixes + depth]).view(">u8")[:, 0].astype(np.uint64)

    word = words_at(0)
    order = np.argsort(word, kind="stable")
    suffixes, word = suffixes[order], word[order]
    run = np.cumsum(np.append(True, word[1:] != word[:-1]))
    for depth in [0, *range(8, LEAST - 8, 8), LEAST - 8]:
        if depth:
            word = words_at(depth)
            starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            odd = word != np.repeat(word[starts], np.diff(np.append(starts, len(run))))
            mixed = np.flatnonzero(np.repeat(np.logical_or.reduceat(odd, starts), np.diff(np.append(starts, len(run)))))
            order = mixed[np.lexsort((word[mixed], run[mixed]))]
            suffixes[mixed], word[mixed] = suffixes[order], word[order]
            run = np.cumsum(np.append(True, (word[1:] != word[:-1]) | (run[1:] != run[:-1])))
        new = np.append(True, run[1:] != run[:-1])
        alone = new & np.append(new[1:], True)
        suffixes, run = suffixes[~alone], run[~alone]
        if not len(suffixes):
            break
    return suffixes, run


def earlier_matches(suffixes: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Suffixes whose previous or next smaller position in suffix order shares LEAST bytes: their LPF is that long."""
    if not len(suffixes):
        return suffixes
    shift = np.int64(1) << 40
    before = np.minimum.accumulate(suffixes - run * shift)
    previous = np.append(shift, before[:-1])
    has_previous = np.append(False, run[1:] == run[:-1]) & (previous < suffixes - run * shift)
    after = np.minimum.accumulate((suffixes + run * shift)[::-1])[::-1]
    following = np.append(after[1:], shift)
    has_next = np.append(run[1:] == run[:-1], False) & (following < suffixes + run * shift)
    return suffixes[has_previous | has_next]


def sort_contexts(table: pa.Table) -> pa.Table:
    """Spans of a bucket's contexts that have an earlier match."""
    release_memory()
    none, doc, start = (table[c].to_numpy() for c in ("no_id", "doc_id", "start"))
    parts = table["part"].to_pylist()
    order = np.lexsort((start, doc, none))
    keep = np.append(True, np.logical_or.reduce([c[order[1:]] != c[order[:-1]] for c in (none, doc, start)]))  # repeated rows
    order = order[keep]
    none, doc, start, parts = none[order], doc[order], start[order], [parts[i] for i in order]
    length = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    first = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(parts)), length)
    place = np.arange(len(data))
    suffixes = place[place + LEAST <= (first + length)[owner]]
    found = np.sort(earlier_matches(*suffix_runs(data, suffixes)))
    at = start[owner[found]] + found - first[owner[found]]
    columns = united(none[owner[found]], doc[owner[found]], at, at + LEAST)
    return pa.table([pa.array(c) for c in columns], names=["no_id", "doc_id", "start", "end"])


SPANS = "no_id byte, doc_id long, start long, end long"
KEY = ["no_id", "doc_id"]


def key_columns() -> list[Column]:
    """What a row is known by: 0 and its id, or 1 and a hash of its text."""
    number, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [number.isNull().cast("byte").alias("no_id"), F.coalesce(number, F.xxhash64(text)).alias("doc_id")]


def removed_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``KEY`` and spans (array of start, end) to be removed."""
    rows = docs.select(*key_columns(), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(8, size // BUCKET_BYTES))
    met = stored(
        rows.mapInArrow(anchor_rows(buckets), FOUND).groupBy("bucket").applyInArrow(lambda t: meet(t, hot), FOUND),
        "anchors",
    )

    def asked(kind: str) -> DataFrame:
        return stored(
            met.where(F.col("kind") == kind)
            .select("bucket", "arrays")
            .mapInArrow(asks_of, "no_id byte, doc_id long, bucket int, start long, end long")
            .groupBy(*KEY)
            .agg(F.collect_list(F.struct("bucket", "start", "end")).alias("asked")),
            "asked",
        )

    contexts = join_measured(rows, asked("ask"), KEY, "inner").select(*KEY, "text", "asked")
    sorted_spans = (
        contexts.mapInArrow(fetch, "bucket int, no_id byte, doc_id long, start long, part binary")
        .groupBy("bucket")
        .applyInArrow(sort_contexts, SPANS)
    )
    if not met.where("kind = 'hot'").isEmpty():
        contexts = join_measured(rows, asked("hot"), KEY, "inner").select(*KEY, "text", "asked")
        dealt = contexts.mapInArrow(fetch_strings(buckets), FOUND).groupBy("bucket").applyInArrow(meet_strings, SPANS)
        sorted_spans = sorted_spans.unionByName(dealt)
    spans = met.where("kind = 'span'").select("arrays").mapInArrow(spans_of, SPANS).unionByName(sorted_spans)
    gathered = spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return stored(gathered.mapInArrow(unite_spans, gathered.schema), "spans")


@frees_memory
def unite_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            start = np.array([s["start"] for s in spans], np.int64)
            end = np.array([s["end"] for s in spans], np.int64)
            same = np.zeros(len(start), np.int64)
            _, _, start, end = united(same, same, start, end)
            out.append([{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist())])
        columns = [*(batch.column(c) for c in KEY), pa.array(out, batch.schema.field("spans").type)]
        yield pa.record_batch(columns, names=[*KEY, "spans"])


@frees_memory
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, "text"):
            sizes, removed, counts, kept = [], [], [], []
            for text, spans in zip(texts_of(some), some.column("spans").to_pylist()):
                data, at, left, gone = text.encode(), 0, [], 0
                for span in spans or ():
                    left.append(data[at : span["start"]])
                    gone += min(span["end"], len(data)) - span["start"]
                    at = span["end"]
                left.append(data[at:])
                sizes.append(len(data))
                removed.append(gone)
                counts.append(len(spans or ()))
                kept.append(b"".join(left))
            columns = [pa.array(c, pa.int64()) for c in (sizes, removed, counts)]
            yield pa.record_batch(
                [some.column("row"), *columns, pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def cut(docs: DataFrame, keep: list[str] | None = None, hot: int = HOT) -> DataFrame:
    """``row`` (the columns named in ``keep``, by default all), n_bytes, n_removed, n_spans and kept (binary)."""
    spans = removed_spans(docs, hot)
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    packed_rows = docs.select(row, F.col("text").cast("string").alias("text"), *key_columns())
    joined = join_measured(packed_rows, spans, KEY, "left").select("row", "text", "spans")
    added = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    return joined.mapInArrow(_cut, T.StructType([joined.schema["row"], *added, T.StructField("kept", T.BinaryType())]))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with repeats cut out of ``text`` and ``n_chars`` (if there) counted anew."""
    found = cut(docs)
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(_readable(F.col("kept")))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias("text"))
        elif name == "n_chars":
            columns.append(F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length(text)).cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"row.`{name}`").alias(name))
    return found.select(*columns)


@F.pandas_udf(T.StringType())
def _readable(kept: pd.Series) -> pd.Series:
    """Bytes as text; a character that was cut in part is left out."""
    return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))
