"""Surrogate keys 1..n in key order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` keeps the row number below, the task above.
ROW_BITS = 33

Store = Callable[[DataFrame], DataFrame]


def with_dense_key(df: DataFrame, key: str, name: str, store: Store) -> DataFrame:
    """Add ``name``: the position of ``key`` in ascending order, from 1; nulls last.

    Equals ``row_number() over (order by key)``, whose window would move all
    rows to one task. Here a distributed sort gives every row its task and its
    row in that task, and each task starts after the rows of those before it.
    Only one count per sort task ever meets in one place, and only these
    counts are broadcast.

    ``store`` writes the sorted rows where they outlive executors and reads
    them back: sort ranges are sampled, so counts and rows must come from one
    and the same sort.
    """
    ordered = df.orderBy(F.asc_nulls_last(key)).withColumn("_id", F.monotonically_increasing_id())
    task = F.shiftright("_id", ROW_BITS).alias("_task")
    row = F.col("_id").bitwiseAND(2**ROW_BITS - 1)
    placed = store(ordered).select("*", task, row.alias("_row"))

    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    position = (F.col("_start") + F.col("_row") + 1).alias(name)
    return placed.join(F.broadcast(starts), "_task").select(*df.columns, position)
