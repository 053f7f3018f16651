"""Column expressions whose results differ from Spark's nearest built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

#: Amounts are added up in this type: exact, so a total does not depend on the
#: order in which tasks finish. Its sum has room for 10^24.
MONEY = "decimal(18,4)"


def round_half(value: Column, digits: int) -> Column:
    """Round the scaled value, then scale back: 1.005 to 2 digits is 1.0.

    ``F.round`` works on the shortest decimal text and would give 1.01.
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def money_sum(amount: Column) -> Column:
    """Sum of a money column as an exact decimal."""
    return F.sum(amount.cast(MONEY))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` in doubles; null where the bottom is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share of ``whole`` in percent, rounded; null where the whole is zero."""
    scaled = F.lit(100.0) * part.cast("double")
    return round_half(scaled / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def calendar_years(start: Column, end: Column) -> Column:
    """Year boundaries crossed, not whole years lived through."""
    return (F.year(end) - F.year(start)).cast("bigint")


def calendar_days(start: Column, end: Column) -> Column:
    """Midnights crossed between two dates or timestamps."""
    return F.datediff(end, start).cast("bigint")


def date_key(day: Column) -> Column:
    """A day as the integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def weekday_from_sunday(day: Column) -> Column:
    """Day of week with Sunday = 0."""
    return (F.dayofweek(day) - 1).cast("bigint")


def title_case(text: Column) -> Column:
    """Capital after every non-letter, so ``o'brien co-op`` is ``O'Brien Co-Op``.

    ``initcap`` alone only starts a new word at a blank.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def parse_timestamp(text: Column) -> Column:
    """Wall-clock timestamp; null where the text is none."""
    return text.try_cast("timestamp_ntz")


# Texts that are a number: no type suffix, no grouping; what Java alone reads is none.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"


def lenient_number(value: Column, kind: DataType | None = None) -> Column:
    """A double; null where a text is no number."""
    if kind is not None and not isinstance(kind, StringType):
        return value.try_cast("double")
    return F.when(value.rlike(NUMBER), F.trim(value).try_cast("double"))


def strict_number(text: Column) -> Column:
    """A double; fails the job on text that is no number."""
    complaint = F.concat(F.lit("not a number: "), text)
    parsed = F.coalesce(lenient_number(text), F.raise_error(complaint).cast("double"))
    return F.when(text.isNotNull(), parsed)


def plain_text(value: Column, kind: DataType) -> Column:
    """Text of a value; doubles from 0.0001 to 10^16 without exponent: 1e7 is 10000000.0."""
    text = value.cast("string")
    if not isinstance(kind, (DoubleType, FloatType)):
        return text
    digits = F.rtrim(value.cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    size = F.abs(value)
    return F.when(text.contains("E") & (size >= 1e-4) & (size < 1e16), plain).otherwise(text)


def strict_timestamp(text: Column, parsed: Column | None = None) -> Column:
    """Wall-clock timestamp; fails the job on text that is none. ``parsed`` is it, null where there is none.

    Does so whatever the session says about ANSI casts.
    """
    complaint = F.concat(F.lit("not a date: "), text.cast("string"))
    found = parse_timestamp(text) if parsed is None else parsed
    return F.when(text.isNotNull(), F.coalesce(found, F.raise_error(complaint).cast("timestamp_ntz")))
