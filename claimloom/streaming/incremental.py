"""Loading one dataset in batches as its files arrive.

The same rules as a full run, batch by batch: a row is checked once, against
the keys its references have by then, and counts as a copy of any row before
it. Every batch owns a ``batch_id`` folder in each layer and replaces it when
the batch is tried again, so a restart adds nothing twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimloom.operators.quality import apply_rules
from claimloom.plans.conform import conform
from claimloom.sources.config import Dataset
from claimloom.sources.extracts import ROW_ORDER, bronze_rows, row_of_extract
from claimloom.session import shuffles_freed
from claimloom.sources.tables import COMPRESSION, Folder
from claimloom.streaming.key_log import FAN, KeyLog

References = Callable[[], Mapping[str, DataFrame]]


@dataclass(frozen=True)
class IncrementalLoad:
    """Where a dataset is loaded to, and how to get its references' keys."""

    dataset: Dataset
    folder: str
    references: References = dict
    #: Runs of seen keys that are merged at a time.
    fan: int = FAN

    def _layer(self, layer: str) -> str:
        return f"{self.folder}/{layer}/{self.dataset.name}"

    def rows(self, spark: SparkSession, layer: str) -> DataFrame:
        """All rows of ``bronze``, ``checked``, ``silver`` or ``quarantine`` so far."""
        return spark.read.parquet(self._layer(layer))

    def _replace(self, df: DataFrame, layer: str, batch_id: int) -> DataFrame:
        path = f"{self._layer(layer)}/batch_id={batch_id}"
        with shuffles_freed(df.sparkSession):
            df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def load_batch(self, lines: DataFrame, batch_id: int) -> None:
        """Take in the lines of one batch; safe to repeat."""
        spark, ds = lines.sparkSession, self.dataset
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        bronze = bronze_rows(lines, now, {*ds.rule_columns, *ds.kinds})
        batch = self._replace(bronze, "bronze", batch_id)
        earlier = self._log(batch).seen(batch, batch_id) if self._unique_column else None
        work: list[str] = []

        def store(name: str, df: DataFrame) -> DataFrame:
            work.append(name)
            return self._replace(df, f"work-{name}", batch_id)

        outcome = apply_rules(
            batch, ds.name, ds.rules, self.references(), ROW_ORDER,
            earlier=earlier, store=store, row_id=row_of_extract(),
        )
        outcome = outcome.on(self._replace(outcome.checked, "checked", batch_id))
        self._replace(outcome.quarantined, "quarantine", batch_id)
        self._replace(conform(ds.name, outcome.clean, ds.kinds), "silver", batch_id)
        if self._unique_column:
            self._log(batch).add(batch, batch_id)
        # Only this batch has read them.
        for name in work:
            Folder(spark, self._layer(f"work-{name}")).delete(f"batch_id={batch_id}")

    @property
    def _unique_column(self) -> str | None:
        names = {r.columns[0] for r in self.dataset.rules if r.type == "unique"}
        if len(names) > 1:
            raise ValueError("a dataset loaded in batches can be unique by one column only")
        return next(iter(names), None)

    def _log(self, batch: DataFrame) -> KeyLog:
        return KeyLog(batch.sparkSession, self._layer("keys"), batch.schema[self._unique_column], self.fan)

    def start(self, lines: DataFrame) -> StreamingQuery:
        """Load all files that are there and not yet loaded, then stop."""
        return (
            lines.writeStream.foreachBatch(self.load_batch)
            .option("checkpointLocation", f"{self._layer('progress')}")
            .trigger(availableNow=True)
            .start()
        )
