"""Session settings this package relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from threading import Lock
from uuid import uuid4

from pyspark.sql import SparkSession

#: Settings for sessions started by this package. A cluster's own session is
#: used as it is; nothing here is needed for right results.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # With more than 2,000 reducers, map outputs report average block sizes
    # unless a block stands out; without this AQE cannot see a skewed reducer
    # that is fed by many small blocks.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run meanwhile."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: With it a statement deletes its shuffle files when it ends, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing, _writers = Lock(), {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files. Threads may be in it side by side."""
    with _freeing:
        count, before = _writers.get(spark, (0, spark.conf.get(FREE_SHUFFLES, None)))
        _writers[spark] = count + 1, before
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing:
            count, before = _writers[spark]
            _writers[spark] = count - 1, before
            if count == 1:
                del _writers[spark]
                spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


@lru_cache(maxsize=8)
def _reached_by_all(spark: SparkSession, application: str, folder: str) -> bool:
    """Whether the driver and the executors find what each of them writes below a folder."""
    probe, slots = f"{folder}/claimloom/probe-{uuid4().hex}", spark.sparkContext.defaultParallelism
    path = spark._jvm.org.apache.hadoop.fs.Path(probe)
    try:
        # a task for each slot; other machines' files are never merged, or missing on reading
        spark.range(0, slots, 1, slots).write.parquet(probe)
        read = spark.read.schema("id bigint").option("ignoreMissingFiles", True).parquet(probe)
        return read.count() == slots
    finally:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Staged tables go below it, so they outlive any executor. A local path may
    be a mount that all machines have, or a folder of each: on a cluster it is
    tried once, with the executors that are there. Only a local session may
    fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.master.startswith("local") and (named.startswith("file:") or ":" not in named.split("/")[0]):
            default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            if named.startswith("file:") or default.startswith("file:"):
                refused = f"spark.checkpoint.dir names a folder of one machine ({named}); name one all executors can reach"
                try:
                    reached = _reached_by_all(spark, context.applicationId, named)
                except Exception as error:  # it cannot be made, written or read somewhere
                    raise ValueError(refused) from error
                if not reached:
                    raise ValueError(refused)
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="claimloom-"))
    return context.getCheckpointDir()
