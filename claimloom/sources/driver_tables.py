"""The three claims datasets, derived from order and customer tables.

Faults are put in by arithmetic on the row's own keys, so every row is made
by a projection of one table: no window, no sort, no join.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Input order of the rows, for "first occurrence". Unique per key.
ORDER = "_ord"


def _padded(number: Column, width: int) -> Column:
    """At least ``width`` digits; longer numbers are kept whole."""
    text = number.cast("string")
    return F.when(number < 10**width, F.lpad(text, width, "0")).otherwise(text)


def _day(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset.cast("int")).cast("string")


def _with_copies(df: DataFrame, repeated: Column, tied: Column) -> DataFrame:
    """Every row as copy 0, the ``repeated`` ones a second time as copy 1, the ``tied`` ones as copy 0."""
    once = F.array(F.lit(0))
    copies = F.when(repeated, F.array(F.lit(0), F.lit(1))).when(tied, F.array(F.lit(0), F.lit(0))).otherwise(once)
    return df.withColumn("copy_no", F.explode(copies))


def members(spark: SparkSession, folder: str) -> DataFrame:
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    proper = F.concat(F.upper(F.substring(segment, 1, 1)), F.lower(F.substr(segment, F.lit(2))))
    rows = _with_copies(customer, key % 50 == 0, key % 59 == 1)
    return rows.select(
        F.concat(F.when(key % 401 == 7, "MBX").otherwise("MBR"), _padded(key, 6)).alias("member_id"),
        F.col("c_name").alias("first_name"),
        segment.alias("last_name"),
        F.when(key % 61 != 9, _day("1945-01-01", key * 37 % 22279)).alias("date_of_birth"),
        F.when(key % 67 != 0, F.concat(F.lit("County "), F.col("c_nationkey"))).alias("county"),
        F.when(key % 20 == 3, F.lower(segment)).otherwise(proper).alias("plan_type"),
        _day("2018-01-01", key * 11 % 2738).alias("enrolment_date"),
        F.when(key % 53 == 2, 0.0)
        .when(key % 71 != 4, ((4500 + key * 7919 % 27500) * 150).cast("double") / 100)
        .alias("monthly_premium_eur"),
        (key * 2 + F.col("copy_no")).alias(ORDER),
    )


def providers(spark: SparkSession, folder: str) -> DataFrame:
    supplier = spark.read.parquet(f"{folder}/supplier.parquet")
    key = F.col("s_suppkey")
    rows = _with_copies(supplier, key % 40 == 1, key % 37 == 2)
    return rows.select(
        F.concat(F.lit("PRV"), _padded(key, 4)).alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.when(key % 33 != 0, F.concat(F.lit("SPEC_"), key % 10)).alias("specialty"),
        F.concat(F.lit("County "), F.col("s_nationkey")).alias("county"),
        F.when((key % 7).isin(1, 4) & (key % 10 != 9), "OUT_OF_NETWORK")
        .otherwise("IN_NETWORK")
        .alias("network_status"),
        (key * 2 + F.col("copy_no")).alias(ORDER),
    )


def claims(spark: SparkSession, folder: str, dealt: bool = True, piece: int = 0, pieces: int = 1) -> DataFrame:
    """``dealt``: to all tasks, however few the table's parts are. ``piece`` of ``pieces``: by a hash of the keys."""
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    if pieces > 1:
        lineitem = lineitem.where(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(pieces)) == piece)
    if dealt:
        # as the extract of many files that it stands for would be
        lineitem = lineitem.repartition("l_orderkey", "l_linenumber")
    customers = (
        spark.read.parquet(f"{folder}/customer.parquet").agg(F.max("c_custkey") + 1).scalar()
    )
    order, line, part, supplier = (
        F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity").cast("bigint")
    mix = F.col("mix")
    cents = F.round(price * 100).cast("bigint")
    paid = cents * (100 - mix % 51)
    member = (order * 31 + line * 7) % customers
    # some services lie after the calendar
    day = mix % 912 + F.when(mix % 109 == 17, 1000).otherwise(0)
    lag = F.when(mix % 333 == 9, -10).otherwise(quantity % 46)
    status = (
        F.when(mix % 500 == 13, "APRVD")
        .when(mix % 211 == 5, None)
        .when((member % 17 == 5) & (mix % 50 < 34), "REJECTED")
        .when(mix % 50 < 34, "APPROVED")
        .when(mix % 50 < 41, "REJECTED")
        .when(mix % 50 < 46, "PENDING")
        .otherwise("UNDER_REVIEW")
    )
    mixed = lineitem.withColumn("mix", order * 31 + line * 1009 + part * 17 + supplier * 7)
    rows = _with_copies(mixed, mix % 100 == 7, mix % 103 == 9)
    return rows.select(
        F.when(
            mix % 1201 != 8, F.concat_ws("-", F.concat(F.lit("CLM"), order), line, part, supplier)
        ).alias("claim_id"),
        F.when(mix % 167 == 5, "MBR-NONE")
        .when(mix % 223 == 6, None)
        .otherwise(F.concat(F.lit("MBR"), _padded(member, 6)))
        .alias("member_id"),
        F.concat(F.lit("PRV"), _padded(supplier, 4)).alias("provider_id"),
        F.when(mix % 1999 == 3, "PRC9999")
        .otherwise(F.concat(F.lit("PRC"), _padded(part % 120 + 1, 4)))
        .alias("procedure_code"),
        F.when(mix % 227 != 7, _day("2024-01-01", day)).alias("service_date"),
        F.when(mix % 229 != 8, _day("2024-01-01", day + lag)).alias("submitted_date"),
        F.when(mix % 250 == 11, -price).when(mix % 233 != 9, price).alias("billed_amount_eur"),
        F.when(mix % 239 == 10, None)
        .when((mix % 50 < 34) & (member % 17 != 5), (paid - paid % 100).cast("double") / 10000)
        .otherwise(0.0)
        .alias("approved_amount_eur"),
        status.alias("claim_status"),
        ((cents * 64 + quantity) * 2 + F.col("copy_no")).alias(ORDER),
    )


def extracts(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    return {
        "members": partial(members, spark, folder),
        "providers": partial(providers, spark, folder),
        "claims": partial(claims, spark, folder),
    }


#: Columns of the claims extract as lines of text.
CLAIM_COLUMNS = (
    "claim_id", "member_id", "provider_id", "procedure_code", "service_date", "submitted_date",
    "billed_amount_eur", "approved_amount_eur", "claim_status",
)


def claim_lines(claims: DataFrame) -> DataFrame:
    """The claims as CSV lines, some of them with cells that cannot be read or that are too many or too few.

    Which ones goes by the position, so by the keys of the row.
    """
    turn = F.floor(F.col(ORDER) / 2) % 97
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CLAIM_COLUMNS}
    cells["billed_amount_eur"] = F.when(turn == 1, '"1,200.50"').otherwise(cells["billed_amount_eur"])
    cells["approved_amount_eur"] = F.when(turn == 2, "7d").otherwise(cells["approved_amount_eur"])
    cells["service_date"] = F.when(turn == 3, "soon").otherwise(cells["service_date"])
    whole = F.concat_ws(",", *cells.values())
    short = F.concat_ws(",", *list(cells.values())[:-1])
    return claims.select(
        F.when(turn == 4, F.concat(whole, F.lit(",more,cells"))).when(turn == 5, short).otherwise(whole).alias("line")
    )


def broken_lines(claims: DataFrame) -> DataFrame:
    """The claims as CSV lines, some of them with line breaks, commas and doubled quotes inside of a cell."""
    turn = F.floor(F.col(ORDER) / 2) % 13
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CLAIM_COLUMNS}
    code = cells["procedure_code"]
    cells["procedure_code"] = (
        F.when(turn == 1, F.concat(F.lit('"'), code, F.lit('\nsecond, "quoted"" line"')))
        .when(turn == 2, F.concat(F.lit('"\n \n'), code, F.lit('"')))
        .when(turn == 3, F.concat(F.lit('"""'), code, F.lit('"""')))
        .otherwise(code)
    )
    cells["procedure_code"] = F.replace(cells["procedure_code"], F.lit('"quoted""'), F.lit('""quoted""'))
    return claims.select(F.concat_ws(",", *cells.values()).alias("line"))


#: Formats that the dates of the registered query may be written in.
DATE_FORMATS = ("iso", "dd/MM/yyyy", "MM/dd/yyyy", "MMM d, yyyy")


def odd_dates(claims: DataFrame) -> DataFrame:
    """claim_id and both dates of the claims, written day first and month first, some in another format."""
    turn = F.floor(F.col(ORDER) / 2) % 41
    day, sent = (F.col(c).cast("date") for c in ("service_date", "submitted_date"))
    return claims.select(
        "claim_id",
        F.when(turn == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(turn == 2, "soon")
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
        .alias("service_date"),
        F.when(turn == 3, F.date_format(sent, "MMM d, yyyy"))
        .otherwise(F.date_format(sent, " MM/dd/yyyy"))
        .alias("submitted_date"),
    )
