"""What the operators share: stored intermediate tables, measured joins, Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator, Sequence
from functools import cache, reduce, wraps
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.session import shared_folder

#: A side that was measured to be no larger than this is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024
#: What a row takes in memory besides its texts, binaries and arrays.
ROW_BYTES, VALUE_BYTES = 32, 8
#: Bytes of rows that go to a Python worker at once, and text handled at once inside a task.
BATCH_BYTES = 8 * 1024 * 1024
SLICE_BYTES = 2 * 1024 * 1024


def prepare(spark: SparkSession) -> None:
    """Settings that tasks of this subpackage rely on.

    Rows go to Python in small batches, as several copies of a batch exist at
    once; and workers find this package where the driver runs elsewhere.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}" if known else root


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: a lost executor costs later steps nothing that was
    written. Each call has a folder of its own.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored frames with an owner, who clears those that no later step reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, *names: str) -> None:
        """Delete stored frames. What was made of them and is still read must be stored itself."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def as_row(df: DataFrame) -> DataFrame:
    """All columns packed as ``row``, so that an operator's own names cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, by one pass that brings one number to the driver."""
    size = F.lit(ROW_BYTES + VALUE_BYTES * len(df.columns)).cast("bigint")
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            size = size + 40 * F.greatest(F.size(name), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def fits(df: DataFrame) -> bool:
    return measured_bytes(df) <= BROADCAST_BYTES


def join_measured(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    broadcast: bool | None = None,
) -> DataFrame:
    """Equi-join on ``keys``, nulls matching nulls. ``right`` is stored and is measured now.

    A small right side is broadcast, so the left rows (with their texts) stay
    where they are; otherwise both sides are shuffled by the keys.
    """
    small = fits(right) if broadcast is None else broadcast
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    matches = reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    )
    joined = left.join(F.broadcast(renamed) if small else renamed, matches, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


@cache
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def release_memory() -> None:
    """Give freed memory back to the system.

    Python workers outlive their tasks, and what allocators keep for reuse
    would count against every later task of the executor.
    """
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if libc is not None and hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def frees_memory(work):
    """For a function over the batches of a task: release memory when the task is done."""

    @wraps(work)
    def run(batches, *args, **kwargs):
        try:
            yield from work(batches, *args, **kwargs)
        finally:
            release_memory()

    return run


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of ``column``; a longer value is a piece of its own."""
    start = held = 0
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    for row, size in enumerate(sizes):
        if row > start and held + (size or 0) > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
