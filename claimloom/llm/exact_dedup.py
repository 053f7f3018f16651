"""Exact dedup by a tree-merge of sorted digest runs.

Every scan partition turns its rows into a sorted run of digests, one entry
per distinct text. Runs are then exchanged in rounds, ``FAN_IN`` partners at a
time (a binomial exchange when that is two): in round r the partners of a
group deal their entries to each other by digit r of the digest and merge what
they receive, keeping the largest and smallest id and the number of rows of
each text. After the last round each node holds all entries of its share of
the digests. No node ever holds a whole corpus, and a text that a third of all
rows share is one entry per run after the first step.

Entries are merged only if the SHA-256 digest and the length of the normalised
text agree. Results travel back by the list of runs an entry came from, so the
final join is on (run, digest) and no hot text meets in one task.

Defined results
---------------
null text: same as the empty text. Empty texts form a group like any other.
Row of a null id: counted; it is kept only if its whole group has null ids.
Repeated rows (same id and text): all counted in ``group_size``; they are one
document, so each of them says the same. Empty table: no rows. Other columns of
the input are ignored by ``resolve`` and passed on by ``deduplicate``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import as_row, frees_memory, join_measured, stored

#: Partners that exchange runs in one round.
FAN_IN = 8
#: Entries that one node of the last round is meant to hold.
ENTRIES_PER_NODE = 500_000
#: Rows sorted at once when a run is made.
RUN_ROWS = 200_000
NO_ID = np.iinfo(np.int64).min

DIGESTS = "doc_id long, digest binary, n_bytes long"
ENTRIES = "run long, digest binary, n_bytes long, keep_id long, first_id long, rows long, runs array<long>"


def _normalised(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.binary())


def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t).digest() for t in texts.to_pylist()], pa.binary())


@frees_memory
def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each text, A-Z lower-cased."""
    for batch in batches:
        texts = _normalised(batch.column("text"))
        yield pa.record_batch(
            [batch.column("doc_id"), _digests(texts), pc.binary_length(texts).cast(pa.int64())],
            names=["doc_id", "digest", "n_bytes"],
        )


def _fixed(column: pa.Array) -> np.ndarray:
    """Digests as an array of 32-byte values that sort as bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u8").reshape(-1, 4)


def _ids(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, int(NO_ID)).to_numpy(zero_copy_only=False)


@frees_memory
def make_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of a partition: one entry per distinct (run, digest) among ``RUN_ROWS`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= RUN_ROWS:
            yield _sorted_run(held)
            held = []
    if held and sum(b.num_rows for b in held):
        yield _sorted_run(held)


def _sorted_run(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    digest, run, size = _fixed(rows["digest"]), rows["run"].to_numpy(), rows["n_bytes"].to_numpy()
    order = np.lexsort((size, *digest.T[::-1], run))
    digest, run, size = digest[order], run[order], size[order]
    ids = _ids(rows["doc_id"].combine_chunks())[order]
    new = np.ones(len(run), bool)
    new[1:] = (digest[1:] != digest[:-1]).any(1) | (run[1:] != run[:-1]) | (size[1:] != size[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(run)))
    return _entries(
        run[starts],
        pa.array([d.tobytes() for d in digest[starts]], pa.binary()),
        size[starts],
        np.maximum.reduceat(ids, starts),
        np.minimum.reduceat(np.where(ids == NO_ID, np.iinfo(np.int64).max, ids), starts),
        counts,
        np.arange(len(starts) + 1),
        run[starts],
    )


def _entries(run, digest, size, keep, first, rows, offsets, runs) -> pa.RecordBatch:
    keep = pa.array(keep, pa.int64(), mask=keep == NO_ID)
    first = pa.array(first, pa.int64(), mask=first == np.iinfo(np.int64).max)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(runs, pa.int64()))
    columns = [pa.array(run, pa.int64()), digest, pa.array(size, pa.int64()), keep, first]
    return pa.record_batch(
        [*columns, pa.array(rows, pa.int64()), lists],
        names=["run", "digest", "n_bytes", "keep_id", "first_id", "rows", "runs"],
    )


@frees_memory
def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge neighbours of a sorted stream of entries that have one group, digest and length.

    The last text of a batch is held back, as the next batch may go on with it.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch])
        batch = table.combine_chunks().to_batches()[0]
        starts = _starts(batch)
        held = batch.slice(int(starts[-1]))
        if len(starts) > 1:
            yield _collapsed(batch.slice(0, int(starts[-1])), starts[:-1])
    if held is not None:
        yield _collapsed(held, np.zeros(1, np.int64))


def _starts(batch: pa.RecordBatch) -> np.ndarray:
    digest, run, size = _fixed(batch["digest"]), batch["run"].to_numpy(), batch["n_bytes"].to_numpy()
    new = np.ones(len(run), bool)
    new[1:] = (digest[1:] != digest[:-1]).any(1) | (run[1:] != run[:-1]) | (size[1:] != size[:-1])
    return np.flatnonzero(new)


def _collapsed(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    lists = batch["runs"]
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    first = pc.fill_null(batch["first_id"], int(np.iinfo(np.int64).max)).to_numpy(zero_copy_only=False)
    return _entries(
        batch["run"].to_numpy()[starts],
        batch["digest"].take(pa.array(starts)),
        batch["n_bytes"].to_numpy()[starts],
        np.maximum.reduceat(_ids(batch["keep_id"]), starts),
        np.minimum.reduceat(first, starts),
        np.add.reduceat(batch["rows"].to_numpy(), starts),
        np.append(offsets[starts], offsets[-1]),
        lists.flatten(),
    )


def tree_merge(runs: DataFrame, rounds: int, fan_in: int) -> DataFrame:
    """Exchange and merge sorted runs for ``rounds`` rounds.

    ``run`` is a node number in base ``fan_in``. Round r drops its last digit
    (the partners) and adds digit r of the digest, so the number of nodes stays
    the same in every round and a round's exchange stays within one group.
    """
    nodes = fan_in**rounds
    share = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("bigint")
    level = runs
    for step in range(1, rounds + 1):
        here = F.lit(fan_in**step)
        level = (
            level.withColumn("run", F.floor(F.col("run") / here) * here + share % here)
            .repartition(nodes, "run")
            .sortWithinPartitions("run", "digest", "n_bytes")
            .mapInArrow(merge_runs, ENTRIES)
        )
    return level


def resolve(docs: DataFrame, fan_in: int = FAN_IN, per_node: int = ENTRIES_PER_NODE) -> DataFrame:
    """Per row: doc_id, digest, n_bytes, keep_id (largest of its group), first_id (smallest), group_size."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    digests = stored(
        rows.mapInArrow(digest_rows, DIGESTS).withColumn("run", F.spark_partition_id().cast("long")),
        "digests",
    )
    total, runs = digests.agg(F.count(F.lit(1)), F.max("run")).first()
    wanted = max((runs or 0) + 1, total / per_node, 2)
    rounds = max(1, math.ceil(math.log(wanted, fan_in) - 1e-9))
    merged = tree_merge(digests.mapInArrow(make_runs, ENTRIES), rounds, fan_in)
    groups = (
        merged.where("rows > 1")
        .select(
            F.explode(F.array_distinct("runs")).alias("run"),
            *["digest", "n_bytes", "keep_id", "first_id", "rows"],
        )
    )
    groups = stored(groups, "groups")
    single = F.col("rows").isNull()
    return join_measured(digests, groups, ["run", "digest", "n_bytes"], "left").select(
        "doc_id",
        "digest",
        "n_bytes",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(single, F.col("doc_id")).otherwise(F.col("first_id")).alias("first_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
    )


@F.arrow_udf(T.BinaryType())
def _digest(texts: pa.Array) -> pa.Array:
    return _digests(_normalised(texts))


def deduplicate(docs: DataFrame, keep: str = "keep_id") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: ``keep_id`` keeps largest ids, ``first_id`` smallest.

    Repeated rows of one document (same id and text) both stay. Rows go by id
    and text, so others of the same id, or of a null one, stay.
    """
    key = ["doc_id", "digest", "n_bytes"]
    dropped = stored(
        resolve(docs).where(~F.col("doc_id").eqNullSafe(F.col(keep))).select(*key).distinct(), "dropped"
    )
    text = F.col("row.text").cast("string")
    packed = as_row(docs).select(
        "row",
        F.col("row.doc_id").cast("long").alias("doc_id"),
        _digest(text).alias("digest"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return join_measured(packed, dropped, key, "left_anti").select("row.*")
