"""Joins to a keyed table that stay even when few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 1_000_000
#: A key with no more than 1/HOT_KEYS of all rows is not spread either. So there
#: are fewer than HOT_KEYS hot keys, whatever the data, and their list is small.
HOT_KEYS = 65_536
#: A table measured to be no larger than this is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
#: What a broadcast row takes besides its texts, and a value that is no text.
ROW_BYTES, VALUE_BYTES = 48, 16
#: Bits of a filter for each of its hashes, of a piece of it, and of all of it at most (8 MB), as it goes to every task.
BITS_PER_HASH, PIECE_BITS, FILTER_BITS = 32, 32_768, 1 << 26


def parts_of_hot(sizes: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """``hash`` and ``parts`` of the hot keys, given the rows ``n`` of each key.

    Bounded by the threshold itself. A hash collision only spreads a key that
    did not need it.
    """
    share = sizes.agg(F.sum("n") / HOT_KEYS).scalar()
    return (
        sizes.where((F.col("n") > rows_per_task) & (F.col("n") > share))
        .groupBy(F.xxhash64(key).alias("hash"))
        .agg(F.ceil(F.max("n") / rows_per_task).cast("int").alias("parts"))
    )


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Parts of the hot keys of ``df``: reads one column, combines before it shuffles."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return parts_of_hot(sizes, key, rows_per_task)


def _with_parts(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Adds ``_parts``: in how many parts the row's key is dealt."""
    listed = F.broadcast(hot.select(F.col("hash").alias("_hot"), F.col("parts").alias("_hot_parts")))
    joined = df.join(listed, F.xxhash64(key) == F.col("_hot"), "left")
    return joined.withColumn("_parts", F.coalesce("_hot_parts", F.lit(1))).drop("_hot", "_hot_parts")


def salted_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Shuffle join of ``rows`` to ``table``, which has one row per ``key``.

    Rows of a hot key are dealt to several parts by the hash of ``spread_by``
    (columns that differ between the rows of one key), and the key's single
    table row is repeated once per part. Every other row has part 0. Nulls
    count as a key and match each other. Both sides must have the key in one
    type, as they are dealt by its hash.
    """
    kinds = rows.schema[key].dataType, table.schema[key].dataType
    if kinds[0] != kinds[1]:
        raise TypeError(f"{key} is {kinds[0].simpleString()} here, {kinds[1].simpleString()} there")
    part = F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int")
    dealt = _with_parts(rows, key, hot).withColumn("_part", part).drop("_parts")
    copies = _with_parts(table, key, hot).select(
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_table_part"),
        F.col(key).alias("_table_key"),
        *[c for c in table.columns if c != key],
    )
    matches = F.col(key).eqNullSafe(F.col("_table_key")) & (F.col("_part") == F.col("_table_part"))
    return dealt.join(copies, matches, how).drop("_part", "_table_part", "_table_key")


def broadcast_lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """The same join without a shuffle, for a table known to be small."""
    renamed = table.withColumnRenamed(key, "_table_key")
    matches = F.col(key).eqNullSafe(F.col("_table_key"))
    return rows.join(F.broadcast(renamed), matches, how).drop("_table_key")


def measured_bytes(table: DataFrame) -> int:
    """Size of all rows when broadcast, by one pass over the table."""
    texts = {c for c, kind in table.dtypes if kind == "string"}
    row = F.lit(ROW_BYTES + VALUE_BYTES * (len(table.columns) - len(texts))).cast("bigint")
    for name in sorted(texts):
        row = row + F.coalesce(F.octet_length(name), F.lit(0))
    return table.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def may_have(found: Column, hashes: DataFrame, column: str) -> Column:
    """Whether the hash ``found`` may be in ``column`` of ``hashes``, a stored frame: false only if it is not.

    A bitmap of no more than ``FILTER_BITS``. The more hashes, the more others pass: then less is saved by it.
    """
    bits = min(FILTER_BITS, max(PIECE_BITS, 1 << (BITS_PER_HASH * hashes.count()).bit_length()))

    def place(value: Column) -> tuple[Column, Column]:
        at = F.pmod(value, F.lit(bits)).cast("bigint")
        return F.shiftright(at, PIECE_BITS.bit_length() - 1), at % PIECE_BITS

    piece, bit = place(F.col(column))
    marks = hashes.select(piece.alias("piece"), bit.alias("bit"))
    all_pieces = hashes.sparkSession.range(bits // PIECE_BITS)
    marks = marks.unionByName(all_pieces.select(F.col("id").alias("piece"), F.lit(None).cast("bigint").alias("bit")))
    pieces = marks.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("piece", "bits")))["bits"]
    piece, bit = place(found)
    own = F.element_at(pieces.agg(in_order.alias("bitmap")).scalar(), piece.cast("int") + 1)
    byte = F.substring(own, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1


@dataclass(frozen=True)
class Exceptions:
    """Keys that few rows have, too many to be broadcast, to be looked up later.

    ``keys`` is stored and has one row per key with the rows ``n`` of it. Only
    rows that may have one of its keys are shuffled for it.
    """

    keys: DataFrame
    key: str
    spread_by: tuple[str, ...]
    rows_per_task: int

    def may_concern(self) -> Column:
        return may_have(F.xxhash64(self.key), self.keys.select(F.xxhash64(self.key).alias("hash")), "hash")

    def table(self) -> DataFrame:
        return self.keys.drop("n")

    def looked_up(self, rows: DataFrame) -> DataFrame:
        hot = parts_of_hot(self.keys, self.key, self.rows_per_task)
        return salted_lookup(rows, self.table(), self.key, hot, list(self.spread_by))


def with_exceptions(rows: DataFrame, exceptions: Sequence[Exceptions]) -> DataFrame:
    """``rows`` with the columns of all ``exceptions``, null where the key is none of theirs.

    The rows are read twice, so that those without an exception stay where they are.
    """
    if not exceptions:
        return rows
    concerned = reduce(Column.__or__, [e.may_concern() for e in exceptions])
    few, rest = rows.where(concerned), rows.where(~concerned)
    for e in exceptions:
        few = e.looked_up(few)
        kinds = {f.name: f.dataType for f in e.table().schema if f.name != e.key}
        rest = rest.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()})
    return few.unionByName(rest)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "left",
    *,
    measured: DataFrame | None = None,
    counted_on: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` to ``table`` in the way its size calls for.

    The table, or a stored frame no smaller than it given as ``measured``, is
    measured now. A small one is broadcast and nothing is shuffled; a larger
    one is joined by shuffle with the hot keys spread. ``counted_on`` is a
    cheaper frame to find the hot keys in, with the keys of ``rows`` or more.
    """
    if measured_bytes(table if measured is None else measured) <= broadcast_bytes:
        return broadcast_lookup(rows, table, key, how)
    hot = hot_keys(rows if counted_on is None else counted_on, key, rows_per_task)
    return salted_lookup(rows, table, key, hot, spread_by, how)
