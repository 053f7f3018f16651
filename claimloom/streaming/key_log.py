"""Keys seen so far, kept in sorted runs that are merged by size.

Each batch adds one run of its distinct keys, sorted by hash part and key. As
soon as ``FAN`` runs stand on a level they are merged into one on the next, so
there are no more than ``FAN`` runs per level and one level per power of
``FAN``, and a key is rewritten once per level. Large runs have several files,
each with a range of parts.

A run also has a bitmap of key hashes for each part. A batch looks up the bits
of its own keys first and then reads only the parts of the runs that have one of
them; the sorted files let the scan skip the rest.

The state after each batch is one manifest, written last and whole. A batch
that is tried again starts from the manifest before it and replaces its own.
Runs stay while the last two manifests name them.

Nulls are one key. Keys of any type that can be hashed and sorted will do.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from claimloom.session import shuffles_freed
from claimloom.sources.tables import COMPRESSION, Folder

#: Hash parts of a run, and bits of the bitmap of a part (one binary of 4 KB).
PARTS, BITS = 256, 32_768
#: Runs of a level that are merged into one of the next.
FAN = 8
#: Keys per file of a run.
FILE_KEYS = 4_000_000
MANIFESTS_KEPT = 2


def _part(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(BITS)).cast("bigint")


class KeyLog:
    """The keys of one column, below one folder."""

    def __init__(self, spark: SparkSession, folder: str, field: StructField, fan: int = FAN, file_keys: int = FILE_KEYS):
        self.spark, self.folder, self.key = spark, folder, field.name
        self.fan, self.file_keys = fan, file_keys
        self._schema = StructType([field, StructField("part", IntegerType())])
        self._manifests = Folder(spark, f"{folder}/manifests")
        self._runs = Folder(spark, f"{folder}/runs")

    # --- state ---

    def _batches(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._manifests.names() if n[0] != ".")

    def runs(self, before: int | None = None) -> list[dict]:
        """Live runs after the last batch, or after the last one before ``before``: name, level, keys."""
        known = [b for b in self._batches() if before is None or b < before]
        return json.loads(self._manifests.read_text(f"{known[-1]:010d}.json")) if known else []

    # --- reading ---

    def seen(self, keys: DataFrame, before: int) -> DataFrame | None:
        """Of the keys known before batch ``before`` at least all that are among ``keys``; None if there are none."""
        runs = self.runs(before)
        if not runs:
            return None
        wanted = keys.select(_part(self.key).alias("part"), _bit(self.key).alias("bit")).distinct()
        bitmaps = self.spark.read.schema("part int, bits binary, run string").parquet(
            *[f"{self.folder}/runs/{run['name']}/bitmaps" for run in runs]
        )
        byte = F.conv(F.hex(F.substring("bits", F.shiftright("bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.expr("shiftright(byte, cast(bit % 8 as int)) & 1") == 1
        # At most one row per run and part.
        hits = bitmaps.join(wanted, "part").withColumn("byte", byte).where(is_set)
        parts: dict[str, list[int]] = {}
        for name, part in hits.select("run", "part").distinct().collect():
            parts.setdefault(name, []).append(part)
        found = None
        for name, some in sorted(parts.items()):
            run = self._read(name).where(F.col("part").isin(some)).select(self.key)
            found = run if found is None else found.unionByName(run)
        return found

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(f"{self.folder}/runs/{name}/keys")

    # --- writing ---

    def add(self, keys: DataFrame, batch: int) -> None:
        """Take in the keys of a batch; safe to repeat."""
        runs = self.runs(batch)
        runs.append(self._write(keys.select(self.key).distinct().withColumn("part", _part(self.key)), 0, batch))
        level = 0
        while len(full := [r for r in runs if r["level"] == level]) >= self.fan:
            merged = self._read(full[0]["name"])
            for run in full[1:]:
                merged = merged.unionByName(self._read(run["name"]))
            runs = [r for r in runs if r["level"] != level]
            level += 1
            runs.append(self._write(merged.distinct(), level, batch, sum(r["keys"] for r in full)))
        self._manifests.make()
        name = f"{batch:010d}.json"
        self._manifests.delete(name)
        self._manifests.write_text(name, json.dumps(runs))
        self._clean()

    def _write(self, keys: DataFrame, level: int, batch: int, at_most: int | None = None) -> dict:
        """A run of distinct keys with parts."""
        name = f"{batch:010d}-{level}-{uuid4().hex[:8]}"
        path = f"{self.folder}/runs/{name}"
        if at_most is None:
            at_most = keys.count()
        files = max(1, -(-at_most // self.file_keys))
        dealt = keys.coalesce(1) if files == 1 else keys.repartitionByRange(files, "part", self.key)
        with shuffles_freed(self.spark):
            dealt.sortWithinPartitions("part", self.key).write.option("compression", COMPRESSION).parquet(f"{path}/keys")
            bits = self._read(name).groupBy("part").agg(F.bitmap_construct_agg(_bit(self.key)).alias("bits"))
            bits.withColumn("run", F.lit(name)).coalesce(1).write.parquet(f"{path}/bitmaps")
        return {"name": name, "level": level, "keys": at_most}

    def _clean(self) -> None:
        """Delete manifests but the last ones, and runs that none of those names."""
        batches = self._batches()
        for old in batches[:-MANIFESTS_KEPT]:
            self._manifests.delete(f"{old:010d}.json")
        live = {
            run["name"] for b in batches[-MANIFESTS_KEPT:] for run in json.loads(self._manifests.read_text(f"{b:010d}.json"))
        }
        for name in set(self._runs.names()) - live:
            self._runs.delete(name)
