"""Full-refresh sinks: versioned catalog tables, staged tables, CSV folders."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimloom.session import shared_folder, shuffles_freed

#: Versions of a table that are kept, and seconds for which an older one stays in any case.
KEPT_VERSIONS, KEPT_SECONDS = 2, 3600.0
MANIFESTS = "_manifests"
#: Of the Parquet files that are written here.
COMPRESSION = "zstd"
CATALOG = (
    "database string, table string, version string, location string, rows bigint, bytes bigint, files bigint, "
    "fingerprint string, written_at double, versions bigint"
)


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


# --- files -------------------------------------------------------------------


class Folder:
    """A folder that all machines reach."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path
        self._here = self._path(path)
        self._system = self._here.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def make(self) -> None:
        self._system.mkdirs(self._here)

    def names(self) -> list[str]:
        if not self._system.exists(self._here):
            return []
        return sorted(status.getPath().getName() for status in self._system.listStatus(self._here))

    def delete(self, name: str) -> None:
        self._system.delete(self._path(f"{self.path}/{name}"), True)

    def size(self) -> tuple[int, int]:
        """Bytes and number of the data files."""
        found, total, files = self._system.listFiles(self._here, True), 0, 0
        while found.hasNext():
            status = found.next()
            if status.getPath().getName()[0] not in "._":
                total, files = total + status.getLen(), files + 1
        return total, files

    def write_text(self, name: str, text: str) -> None:
        """Whole or not at all: readers never see half a file."""
        hidden = self._path(f"{self.path}/.{name}-{uuid4().hex}")
        out = self._system.create(hidden)
        out.write(bytearray(text.encode()))
        out.close()
        self._system.rename(hidden, self._path(f"{self.path}/{name}"))

    def read_text(self, name: str) -> str:
        opened = self._system.open(self._path(f"{self.path}/{name}"))
        try:
            return bytes(opened.readAllBytes()).decode()
        finally:
            opened.close()


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Paths, sizes and times of a file, or of all files of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


# --- versioned tables --------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """What a version of a table is: where, how large, and made of what."""

    database: str
    table: str
    version: str
    location: str
    rows: int
    bytes: int
    files: int
    fingerprint: str
    written_at: float


class VersionedTable:
    """A catalog table whose versions lie side by side below its home folder.

    A version is written whole before the table points to it, so a run that
    fails leaves the old one. The versions before it stay for a while: whoever
    opened the table earlier reads on to the end. A manifest per version says
    what it holds; the newest is the table.
    """

    def __init__(self, spark: SparkSession, database: str, table: str, warehouse: str):
        self.spark, self.database, self.table = spark, database, table
        self.name = f"`{database}`.`{table}`"
        self.home = f"{warehouse}/{database}/{table}"
        self._manifests = Folder(spark, f"{self.home}/{MANIFESTS}")

    def manifests(self) -> list[Manifest]:
        """Of all versions that are still there, oldest first."""
        names = [n for n in self._manifests.names() if n.endswith(".json") and not n.startswith(".")]
        found = [Manifest(**json.loads(self._manifests.read_text(n))) for n in names]
        return sorted(found, key=lambda m: (m.written_at, m.version))

    def current(self, fingerprint: str) -> DataFrame | None:
        """The table, if its newest version was made of what ``fingerprint`` stands for."""
        manifests = self.manifests()
        if not fingerprint or not manifests or manifests[-1].fingerprint != fingerprint:
            return None
        return self.spark.table(self.name) if self.spark.catalog.tableExists(self.name) else None

    def new_version(self) -> str:
        return f"{self.home}/run-{uuid4().hex}"

    def publish(
        self,
        version: str,
        schema: StructType,
        rows: int,
        fingerprint: str = "",
        part: str = "",
        keep: int = KEPT_VERSIONS,
        seconds: float = KEPT_SECONDS,
    ) -> DataFrame:
        """Point the table at ``part`` of a version that has been written, and let old ones go."""
        location = f"{version}/{part}" if part else version
        size, files = Folder(self.spark, location).size()
        known = Manifest(
            self.database, self.table, version.rsplit("/", 1)[1], location, rows, size, files, fingerprint, time.time()
        )
        if self.spark.catalog.tableExists(self.name) and self.spark.table(self.name).schema == schema:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(self.name)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            self.spark.catalog.createTable(self.name, path=location, source="parquet", schema=schema)
        self._manifests.make()
        self._manifests.write_text(f"{known.version}.json", json.dumps(asdict(known)))
        self.clean(keep, seconds)
        return self.spark.table(self.name)

    def clean(self, keep: int = KEPT_VERSIONS, seconds: float = KEPT_SECONDS) -> None:
        """Delete versions beyond the last ``keep`` that were replaced more than ``seconds`` ago."""
        manifests, now = self.manifests(), time.time()
        home = Folder(self.spark, self.home)
        for known, follower in zip(manifests, manifests[1:]):
            if known in manifests[: -max(1, keep)] and now - follower.written_at > seconds:
                home.delete(known.version)
                self._manifests.delete(f"{known.version}.json")


def replace_table(
    df: DataFrame, database: str, table: str, warehouse: str, fingerprint: str = "", **kept: float
) -> DataFrame:
    """Write ``df`` as the next version of a parquet table and read it back."""
    versioned = VersionedTable(df.sparkSession, database, table, warehouse)
    version, counted = versioned.new_version(), Observation()
    with shuffles_freed(df.sparkSession):
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.option("compression", COMPRESSION).parquet(version)
    return versioned.publish(version, df.schema, counted.get["rows"], fingerprint, **kept)


def listing(spark: SparkSession, warehouse: str, databases: Sequence[str]) -> DataFrame:
    """One row per table written below ``warehouse``: its newest manifest, and how many versions are kept."""
    rows = []
    for database in databases:
        for table in Folder(spark, f"{warehouse}/{database}").names():
            manifests = VersionedTable(spark, database, table, warehouse).manifests()
            rows += [(*asdict(m).values(), len(manifests)) for m in manifests[-1:]]
    return spark.createDataFrame(rows, CATALOG)


# --- staged frames and CSV ---------------------------------------------------


def row_in_file() -> Column:
    """File and row of each row of a frame read from Parquet files, however they are split into tasks."""
    return F.struct("_metadata.file_path", "_metadata.row_index")


class Staging:
    """Frames written below the shared folder, each under a name of its own.

    Reading a staged frame back cuts its lineage: a lost executor costs the
    steps that use it next nothing that is already written.
    """

    def __init__(self, spark: SparkSession, place: str):
        self.spark = spark
        self._folder = f"{shared_folder(spark)}/claimloom/{place}"
        self._names: list[str] = []

    def store(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self._folder}/{name}"
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        self._names.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str, schema: StructType) -> DataFrame:
        """Some columns of a stored frame, or all frames stored below a name."""
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self._folder}/{name}")

    def delete(self, name: str) -> None:
        """Delete a frame that nothing reads any more."""
        Folder(self.spark, self._folder).delete(name)

    def clear(self) -> None:
        """Delete what was stored, once nothing reads it any more."""
        folder = Folder(self.spark, self._folder)
        for name in self._names:
            folder.delete(name)


def replace_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as a folder of CSV files with header, replacing the last run's."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
