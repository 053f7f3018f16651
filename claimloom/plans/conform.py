"""Silver form of clean rows: casing, numbers and dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.dates import ISO, strict_by
from claimloom.functions.exprs import strict_number, title_case
from claimloom.sources.config import CORRUPT_LINE

#: Text columns that are written in title case.
TITLES = {"members": ("plan_type",)}


def _typed(df: DataFrame, name: str, kind: str) -> Column:
    what, _, fmt = kind.partition(":")
    if what == "timestamp":
        return strict_by(F.col(name), fmt or ISO)
    return strict_number(F.col(name)) if dict(df.dtypes)[name] == "string" else F.col(name).cast(kind)


def silver_columns(dataset: str, rows: DataFrame, kinds: Mapping[str, str]) -> dict[str, Column]:
    """Columns of the silver table over the cells of ``rows``, in their order."""
    columns = {c: F.col(c) for c in rows.columns if c != CORRUPT_LINE}
    columns |= {c: title_case(F.col(c)) for c in TITLES.get(dataset, ())}
    return columns | {c: _typed(rows, c, kind) for c, kind in kinds.items() if c in columns}


def whole(rows: DataFrame) -> Column:
    """True, but stops the run at a line with the wrong number of cells."""
    if CORRUPT_LINE not in rows.columns:
        return F.lit(True)
    complaint = F.concat(F.lit("a line has the wrong number of cells: "), CORRUPT_LINE)
    return F.when(F.col(CORRUPT_LINE).isNull(), True).otherwise(F.raise_error(complaint).cast("boolean"))


def conform(dataset: str, clean: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cells get their types. What no rule caught and cannot be read stops the run here.

    So does a line with the wrong number of cells. Datasets without types and
    titles go to silver as they are.
    """
    columns = silver_columns(dataset, clean, kinds)
    if CORRUPT_LINE in clean.columns:
        clean = clean.where(whole(clean))
    return clean.select(*[column.alias(c) for c, column in columns.items()])
