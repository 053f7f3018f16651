"""CSV with line breaks inside quotes, read by many tasks.

A line break ends a record only where the quotes before it in the file are even
in number. So each block of a file needs one bit, the parity of the quotes in
all blocks before it: one pass counts quotes per block, a running XOR over the
blocks of each file (one row a block) gives the bits, and a second pass puts
the records together. A record that goes on in the next block is cut there; the
pieces of such records, no more than two a block, meet by the block the record
began in.

Quotes stand only around cells and, doubled, inside of them. A file whose quotes
do not add up is read to its end as one record, as any reader would that keeps
line breaks; its cells show it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns that tell where a record is.
PLACE = ("_file", "_block", "_row")
#: ``piece``: null for a whole record, else where in a cut record this is: it begins, goes on, or ends here.
WHOLE, BEGINS, GOES_ON, ENDS = None, 0, 1, 2
RECORDS = "_file string, _block bigint, _row bigint, _record string, piece int"
RECORD_SCHEMA = pa.schema(
    [("_file", pa.string()), ("_block", pa.int64()), ("_row", pa.int64()), ("_record", pa.string()), ("piece", pa.int32())]
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they are, with the block they are in. A line belongs to the block it begins in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def open_blocks(lines: DataFrame) -> DataFrame:
    """file, block, and whether the block begins inside of quotes."""
    parity = lines.groupBy("_file", "_block").agg((F.sum(quotes(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return parity.select("_file", "_block", inside.alias("inside"))


def cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines of a task, which come block by block and in order."""
    at = None
    row, inside, piece, held = 0, False, WHOLE, []
    out: list[tuple] = []

    def close() -> None:
        """What the block leaves open goes on elsewhere."""
        if held:
            out.append((*at, row, "\n".join(held), GOES_ON if piece == ENDS else BEGINS))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(RECORD_SCHEMA)
        return pa.record_batch([pa.array(c, k.type) for c, k in zip(columns, RECORD_SCHEMA)], schema=RECORD_SCHEMA)

    for lines in batches:
        for file, block, began_inside, text in zip(*(lines.column(c).to_pylist() for c in ("_file", "_block", "inside", "value"))):
            if (file, block) != at:
                close()
                at, row, inside, held = (file, block), 0, began_inside, []
                piece = ENDS if inside else WHOLE
            held.append(text)
            inside ^= text.count('"') % 2 == 1
            if not inside:
                out.append((*at, row, "\n".join(held), piece))
                row, piece, held = row + 1, WHOLE, []
        if len(out) > 10_000:
            yield batch()
            out = []
    close()
    yield batch()


def joined(pieces: DataFrame) -> DataFrame:
    """Records made of pieces, each where it begins."""
    in_file = Window.partitionBy("_file").orderBy("_block", "_row")
    began = F.when(F.col("piece") == BEGINS, F.struct("_block", "_row"))
    owner = F.last(began, ignorenulls=True).over(in_file)
    parts = F.array_sort(F.collect_list(F.struct("_block", "_row", "_record")))
    return (
        pieces.withColumn("owner", owner)
        .groupBy("_file", "owner")
        .agg(F.array_join(F.transform(parts, lambda p: p["_record"]), "\n").alias("_record"))
        .select("_file", "owner._block", "owner._row", "_record")
    )


def records_of(spark: SparkSession, path: str, store) -> DataFrame:
    """file, block, row and text of each record that is not empty. ``store`` writes the cut records."""
    lines = _lines(spark, path)
    starts = open_blocks(lines)
    # One row per block on the right; blocks are as large as a task reads at a time.
    known = lines.join(F.broadcast(starts), ["_file", "_block"])
    found = store("records", known.select("_file", "_block", "inside", "value").mapInArrow(cut_records, RECORDS))
    whole = found.where("piece IS NULL").select("_file", "_block", "_row", "_record")
    records = whole.unionByName(joined(found.where("piece IS NOT NULL")))
    text = F.regexp_replace("_record", r"\r\z", "")
    return records.withColumn("_record", text).where(F.col("_record") != "")


def parsed(records: DataFrame, header: Sequence[str], schema: str, options: dict) -> DataFrame:
    """Columns of the header from ``records``; the first record of each file must be that header."""
    first = (F.col("_block") == 0) & (F.col("_row") == 0)
    own = {k: v for k, v in options.items() if k in ("escape", "mode", "columnNameOfCorruptRecord")}
    cells = F.from_csv("_record", schema, own)
    same = F.array(*[F.coalesce(F.col(f"_cells.`{c}`") == c, F.lit(False)) for c in header])
    complaint = F.concat(F.lit("not the header of the first file: "), F.col("_record"))
    is_line = F.when(~first, True).when(F.forall(same, lambda x: x), False).otherwise(F.raise_error(complaint).cast("boolean"))
    return records.withColumn("_cells", cells).where(is_line).select("_cells.*", "_file", "_block", "_row")
