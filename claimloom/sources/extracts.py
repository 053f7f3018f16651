"""Raw CSV extracts as bronze frames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.session import shuffles_freed
from claimloom.sources import multiline
from claimloom.sources.config import CORRUPT_LINE
from claimloom.sources.tables import Staging

#: Columns that put rows in input order; kept in bronze, dropped in silver.
ROW_ORDER = ("_order_file", "_order_block", "_order_row")

# Texts that stand for a missing value in a CSV cell.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def row_of_extract() -> Column:
    """What tells a row of bronze from all others; it is written with the row."""
    return F.struct(*ROW_ORDER)


def _cell(name: str) -> Column:
    quoted = F.col(f"`{name}`")
    return F.when(~quoted.isin(*NULL_TOKENS), quoted).alias(name)


# Quotes inside quoted text are doubled; header names are checked per file. All
# cells are parsed even if few are asked for, as only then a ragged line shows.
CSV_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_LINE,
    "columnPruning": False,
}


def bronze_rows(
    lines: DataFrame, batch_ts: str, needed: Iterable[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Cells of CSV ``lines``, all text, with load metadata and row order.

    ``lines`` has the text columns of the file, the corrupt line and
    ``_metadata``. ``needed`` columns must be there. ``order`` are the file, the
    block and the row of a line, if not those of the scan.
    """
    columns = [c for c in lines.columns if c not in ("_metadata", CORRUPT_LINE, *multiline.PLACE)]
    missing = set(needed) - set(columns)
    if missing:
        raise ValueError(f"extract has no column {', '.join(sorted(missing))}")
    # A file block is read by one task from front to back, so the row id is in
    # line order within a block, though not across blocks.
    order = order or (
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    name = F.col("_metadata.file_name") if "_metadata" in lines.columns else F.substring_index(order[0], "/", -1)
    return lines.select(
        *[_cell(c) for c in columns],
        CORRUPT_LINE,
        F.lit(batch_ts).alias("_loaded_at"),
        name.alias("_source_file"),
        *[column.alias(name) for column, name in zip(order, ROW_ORDER)],
    )


def _schema(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` string" for c in (*columns, CORRUPT_LINE))


def read_extract(
    spark: SparkSession,
    path: str,
    batch_ts: str,
    needed: Iterable[str] = (),
    multi_line: bool = False,
    staging: Staging | None = None,
) -> DataFrame:
    """A CSV file or folder with header, as it is, plus load metadata.

    Columns go by header name. Every cell stays text, so rules see it as it
    was written, and a line with more or fewer cells than the header is kept
    whole in ``_corrupt_line`` besides the cells it has. ``multi_line`` allows
    line breaks inside quotes; files are split all the same, and the records are
    written below the shared folder first, to ``staging`` if its owner clears it.
    """
    header = spark.read.options(header=True, escape='"', multiLine=multi_line).csv(path).columns
    if not multi_line:
        lines = spark.read.options(**CSV_OPTIONS).schema(_schema(header)).csv(path)
        return bronze_rows(lines.select("*", "_metadata"), batch_ts, needed)
    staging = staging or Staging(spark, f"multi-line-{uuid4().hex}")
    records = multiline.records_of(spark, path, staging.store)
    lines = multiline.parsed(records, header, _schema(header), CSV_OPTIONS)
    return bronze_rows(lines, batch_ts, needed, [F.col(c) for c in multiline.PLACE])


def read_lines(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Lines of CSV files that are there, for ``bronze_rows``."""
    return spark.read.schema(_schema(columns)).options(**CSV_OPTIONS).csv(path).select("*", "_metadata")


def stream_extract(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Lines of CSV files as they arrive in a folder, for ``bronze_rows``."""
    lines = spark.readStream.schema(_schema(columns)).options(**CSV_OPTIONS).csv(path)
    return lines.select("*", "_metadata")


def write_lines(lines: DataFrame, path: str, header: Sequence[str]) -> None:
    """Write one text column as CSV lines, as they are, each file with the header."""
    (name,) = lines.columns
    lines = lines.select(F.explode(F.split(name, "\n", -1)))  # line breaks end lines as in any file
    # neither sign occurs in the lines, so nothing is quoted or escaped
    options = {"header": True, "sep": "\x01", "quote": "\x02", "emptyValue": "", "ignoreLeadingWhiteSpace": False}
    with shuffles_freed(lines.sparkSession):
        lines.toDF(",".join(header)).write.options(**options, ignoreTrailingWhiteSpace=False).csv(path)
