"""Columns of dates in one of several declared formats.

Which format a column is written in is told by all its cells: one aggregate
counts, per column and format, how many cells the format reads. The format that
reads most wins, ties by the declared order; the column is read by the winner
alone, and the cells it does not read are misses like any other bad date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.exprs import parse_timestamp, strict_timestamp

#: ISO 8601 dates and timestamps, as a cast reads them.
ISO = "iso"
#: Letters of a pattern that tell a time of day.
TIME_LETTERS = set("HhKkmsSaAnN")


def parse_by(text: Column, fmt: str = ISO) -> Column:
    """Wall-clock timestamp of a text in ``fmt``, null where it is none.

    ``fmt`` is ISO or a Spark datetime pattern. White space around is ignored.
    """
    if fmt == ISO:
        return parse_timestamp(text)
    letters = {c for k, part in enumerate(fmt.split("'")) if k % 2 == 0 for c in part}
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    if not letters & TIME_LETTERS:
        return F.try_to_date(trimmed, fmt).cast("timestamp_ntz")
    return F.try_to_timestamp(trimmed, F.lit(fmt)).cast("timestamp_ntz")


def strict_by(text: Column, fmt: str = ISO) -> Column:
    """Wall-clock timestamp; fails the job on text that is none in ``fmt``."""
    return strict_timestamp(text, parse_by(text, fmt))


def check_format(fmt: str) -> None:
    """Refuse what is no pattern of a date; found before a job starts as far as the driver can tell."""
    if fmt == ISO:
        return
    if not isinstance(fmt, str) or not fmt.strip():
        raise ValueError(f"date format is no text: {fmt!r}")
    if fmt.count("'") % 2:
        raise ValueError(f"date format {fmt!r} has an open quote")
    letters = {c for k, part in enumerate(fmt.split("'")) if k % 2 == 0 for c in part if c.isalpha()}
    known = set("GyYuUQqMLdDeEFcHhKkmsSaAnNVvzOXxZB")
    if letters - known:
        raise ValueError(f"date format {fmt!r} has unknown letters: {', '.join(sorted(letters - known))}")
    if not letters & set("yu") or not letters & set("MLD"):
        raise ValueError(f"date format {fmt!r} lacks a year or a month")


def format_counts(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """column, place (of the format in the list), format, cells (not null) and how many of them it reads."""
    counts = df.agg(
        *[F.count(c).alias(f"cells_{i}") for i, c in enumerate(columns)],
        *[F.count(parse_by(F.col(c), f)).alias(f"read_{i}_{j}") for i, c in enumerate(columns) for j, f in enumerate(formats)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(j).alias("place"), F.lit(f).alias("format"),
            F.col(f"cells_{i}").alias("cells"), F.col(f"read_{i}_{j}").alias("read"),
        )
        for i, c in enumerate(columns)
        for j, f in enumerate(formats)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def best_formats(counts: DataFrame) -> dict[str, str]:
    """The winner of each column. ``counts`` has one row per column and format."""
    best: dict[str, tuple] = {}
    for row in counts.collect():
        score = (-row["read"], row["place"])
        if row["column"] not in best or score < best[row["column"]][0]:
            best[row["column"]] = score, row["format"]
    return {column: fmt for column, (_, fmt) in best.items()}


def chosen_formats(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> dict[str, str]:
    """The format of each column, by one pass over them; the first declared one for a column without dates."""
    if not columns:
        return {}
    if len(formats) == 1:
        return dict.fromkeys(columns, formats[0])
    return best_formats(format_counts(df, columns, formats))


def misses(df: DataFrame, chosen: Mapping[str, str]) -> DataFrame:
    """column, format, cells, read and missed of each column as it is read."""
    rows = None
    for column, fmt in chosen.items():
        one = format_counts(df, [column], [fmt])
        rows = one if rows is None else rows.unionByName(one)
    return rows.select("column", "format", "cells", "read", (F.col("cells") - F.col("read")).alias("missed"))
