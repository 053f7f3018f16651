"""Star schema and marts over silver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.exprs import (
    calendar_days,
    calendar_years,
    date_key,
    money_sum,
    percent,
    round_half,
    safe_ratio,
    weekday_from_sunday,
)
from claimloom.operators.dense_key import Store, with_dense_key
from claimloom.operators.lookup import BROADCAST_BYTES, ROWS_PER_TASK, lookup
from claimloom.sources.config import CALENDAR_END, CALENDAR_START

# Lower age limit of each band but the first.
AGE_BANDS = ((30, "18-29"), (45, "30-44"), (60, "45-59"))
OLDEST_BAND = "60+"

APPROVED = "APPROVED"


def age_band(age: Column) -> Column:
    """First band whose upper limit exceeds the age; unknown ages are oldest."""
    band = F.lit(OLDEST_BAND)
    for limit, name in reversed(AGE_BANDS):
        band = F.when(age < limit, name).otherwise(band)
    return band


def dim_member(
    members: DataFrame, store: Store, as_of: Column | dt.date | None = None
) -> DataFrame:
    """Members with key, age and age band on the day ``as_of``, today if none."""
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, dt.date):
        as_of = F.lit(as_of)
    aged = members.withColumn("age", calendar_years(F.col("date_of_birth"), as_of))
    return with_dense_key(aged, "member_id", "member_key", store).select(
        "member_key",
        "member_id",
        "first_name",
        "last_name",
        "date_of_birth",
        "age",
        age_band(F.col("age")).alias("age_band"),
        "county",
        "plan_type",
        "enrolment_date",
        "monthly_premium_eur",
    )


def dim_provider(providers: DataFrame, store: Store) -> DataFrame:
    return with_dense_key(providers, "provider_id", "provider_key", store).select(
        "provider_key",
        "provider_id",
        "provider_name",
        "specialty",
        "county",
        "network_status",
    )


def _calendar_row(day: Column) -> list[Column]:
    weekday = weekday_from_sunday(day)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month_num"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
    ]


def _calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.select(*_calendar_row(F.col("day")))


def dim_date(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return _calendar(bounds)


def days_with_facts(dates: DataFrame, fact: DataFrame) -> DataFrame:
    """Each day of the calendar with the number of claims served on it."""
    per_day = fact.groupBy(F.col("service_date_key").alias("date_key")).agg(F.count(F.lit(1)).alias("facts"))
    return dates.join(per_day, "date_key", "left").withColumn("facts", F.coalesce("facts", F.lit(0)))


def dim_date_of(claims: DataFrame) -> DataFrame:
    """Calendar of all years in which the claims have services."""
    service = F.col("service_date").cast("date")
    last_year = F.trunc(F.max(service), "year")
    bounds = claims.agg(
        F.trunc(F.min(service), "year").alias("first"),
        F.date_sub(F.add_months(last_year, 12), 1).alias("last"),
    )
    return _calendar(bounds)


def fact_claims(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per silver claim, of any status, with the keys of its dimensions.

    Silver claims are unique by id, which is what spreads a hot dimension key.
    The dimensions are measured here, so they should be stored.
    """
    keyed = claims
    for table, key, surrogate in (
        (members, "member_id", "member_key"),
        (providers, "provider_id", "provider_key"),
    ):
        keys = table.where(F.col(key).isNotNull()).select(key, surrogate)
        keyed = lookup(
            keyed,
            keys,
            key,
            ["claim_id"],
            "inner",
            counted_on=claims,
            rows_per_task=rows_per_task,
            broadcast_bytes=broadcast_bytes,
        )
    service, submitted = F.col("service_date"), F.col("submitted_date")
    return keyed.select(
        "claim_id",
        "member_key",
        "provider_key",
        date_key(service).alias("service_date_key"),
        date_key(submitted).alias("submitted_date_key"),
        "procedure_code",
        "claim_status",
        "billed_amount_eur",
        "approved_amount_eur",
        (F.col("billed_amount_eur") - F.col("approved_amount_eur")).alias("disallowed_amount_eur"),
        calendar_days(service, submitted).alias("submission_lag_days"),
    )


def outside_calendar(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """How many facts the monthly figures leave out: by year of service, null where there is no day."""
    days = dates.select(F.col("date_key").alias("service_date_key"))
    left_out = fact.join(F.broadcast(days), "service_date_key", "left_anti")
    year = F.floor(F.col("service_date_key") / 10000).cast("int")
    return left_out.groupBy(year.alias("service_year")).agg(F.count(F.lit(1)).alias("facts"))


def in_calendar(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts whose service day is in the calendar, with its month.

    The calendar is broadcast: it has one row per day of a span that is fixed
    or comes from a minimum and a maximum, so it does not grow with the facts.
    """
    days = dates.select(F.col("date_key").alias("service_date_key"), F.col("year_month").alias("month"))
    return fact.join(F.broadcast(days), "service_date_key")


def mart_monthly_kpis(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Volume, amounts, approval rate, mean lag and payout ratio by service month."""
    billed, approved = F.col("billed"), F.col("approved")
    sums = (
        in_calendar(fact, dates)
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            money_sum(F.col("billed_amount_eur")).alias("billed"),
            money_sum(F.col("approved_amount_eur")).alias("approved"),
            F.count_if(F.col("claim_status") == APPROVED).alias("approved_claims"),
            F.avg("submission_lag_days").alias("lag"),
        )
    )
    return sums.select(
        "month",
        "total_claims",
        round_half(billed.cast("double"), 2).alias("total_billed_eur"),
        round_half(approved.cast("double"), 2).alias("total_approved_eur"),
        percent(F.col("approved_claims"), F.col("total_claims"), 2).alias("approval_rate_pct"),
        round_half(F.col("lag"), 1).alias("avg_submission_lag_days"),
        percent(approved, billed, 2).alias("payout_ratio_pct"),
    )


def _approved_by(fact: DataFrame, key: str) -> DataFrame:
    """Approved claims and spend per dimension key, ahead of any join.

    Facts are combined where they are read, so a join to the dimension moves
    one row per key however large the dimension and however hot a key.
    """
    return (
        fact.where(F.col("claim_status") == APPROVED)
        .groupBy(key)
        .agg(
            F.count("claim_id").alias("named_claims"),
            F.count(F.lit(1)).alias("claims"),
            F.count("approved_amount_eur").alias("amounts"),
            money_sum(F.col("approved_amount_eur")).alias("approved"),
        )
    )


def mart_specialty_costs(fact: DataFrame, providers: DataFrame) -> DataFrame:
    """Approved claims by specialty and network status."""
    sums = (
        _approved_by(fact, "provider_key")
        .join(providers, "provider_key")
        .groupBy("specialty", "network_status")
        .agg(
            F.sum("claims").alias("claim_count"),
            F.sum("amounts").alias("amounts"),
            F.sum("approved").cast("double").alias("approved"),
        )
    )
    return sums.select(
        "specialty",
        "network_status",
        "claim_count",
        round_half(F.col("approved"), 2).alias("total_approved_eur"),
        round_half(safe_ratio(F.col("approved"), F.col("amounts")), 2).alias("avg_claim_cost_eur"),
    )


def mart_member_utilisation(fact: DataFrame, members: DataFrame) -> DataFrame:
    """Approved spend of every member against a year of premium."""
    spend = F.coalesce(F.col("approved").cast("double"), F.lit(0.0))
    premium = F.col("monthly_premium_eur") * 12
    return members.join(_approved_by(fact, "member_key"), "member_key", "left").select(
        "member_key",
        "plan_type",
        "age_band",
        "county",
        F.coalesce("named_claims", F.lit(0)).cast("bigint").alias("claims_count"),
        round_half(spend, 2).alias("total_claimed_eur"),
        round_half(premium, 2).alias("annualised_premium_eur"),
        round_half(safe_ratio(spend, premium), 2).alias("utilisation_ratio"),
    )
