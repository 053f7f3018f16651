"""Checked datasets on disk: silver, quarantine and report from one write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimloom.operators.quality import REASONS, RuleOutcome
from claimloom.session import setting, shuffles_freed
from claimloom.sources.tables import COMPRESSION, Folder

#: Partition column of a checked dataset on disk, and its values.
VERDICT, CLEAN, QUARANTINE = "_dq_verdict", "clean", "quarantine"
#: A quarantined row as it was read.
RAW = "_raw"


@dataclass(frozen=True)
class Checked:
    """A checked dataset on disk: clean rows in silver form, quarantined rows as they were, the report."""

    folder: str
    clean: DataFrame
    quarantined: DataFrame
    report: DataFrame
    clean_rows: int


def write_checked(outcome: RuleOutcome, columns: dict[str, Column], intact: Column, folder: str) -> Checked:
    """Clean and quarantined rows in one write, the counts of the report taken on the way.

    ``columns`` make the silver form and ``intact`` must hold; both are only
    evaluated on clean rows, so what they complain about stops the run. The
    parts are told apart by a partition column; two files per task are open at
    once, so rows need not be sorted for it.
    """
    spark, checked = outcome.checked.sparkSession, outcome.checked
    clean = F.col(REASONS) == ""
    counted = Observation()
    raw = F.struct(*[F.col(f"`{c}`") for c in outcome.data_columns])
    rows = checked.observe(counted, *outcome.counts, F.count_if(clean).alias("clean_rows")).select(
        *[F.when(clean, column).alias(c) for c, column in columns.items()],
        F.when(~clean, raw).alias(RAW),
        REASONS,
        F.when(~clean, QUARANTINE).when(intact, CLEAN).alias(VERDICT),
    )
    for verdict in (CLEAN, QUARANTINE):
        Folder(spark, f"{folder}/{VERDICT}={verdict}").make()
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"), shuffles_freed(spark):
        rows.write.mode("append").option("compression", COMPRESSION).partitionBy(VERDICT).parquet(folder)

    def part(verdict: str, names: Sequence[str]) -> DataFrame:
        schema = StructType([rows.schema[n] for n in names])
        return spark.read.schema(schema).parquet(f"{folder}/{VERDICT}={verdict}")

    found = counted.get
    counts = {k: v for k, v in found.items() if k != "clean_rows"}
    report = outcome.report_of(spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts)))
    quarantined = part(QUARANTINE, [RAW, REASONS]).select(f"{RAW}.*", REASONS)
    return Checked(folder, part(CLEAN, list(columns)), quarantined, report, found["clean_rows"])
