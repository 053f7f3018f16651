"""Analyst reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.exprs import money_sum, percent, round_half, safe_ratio
from claimloom.plans.gold import APPROVED, in_calendar

# Fixed values of the reports.
MIN_CLAIMS_PER_PROCEDURE = 50
TOP_PROCEDURES = 10
PREMIUM_MULTIPLE = 3
SLA_DAYS = 30
LATEST_MONTHS = 6


def mom_growth(kpis: DataFrame) -> DataFrame:
    """Change of approved spend against the month before, in percent.

    The window has no partition key: its input is one row per month.
    """
    previous = F.lag("total_approved_eur").over(Window.orderBy(F.asc_nulls_last("month")))
    current = F.col("total_approved_eur")
    return (
        kpis.withColumn("previous", previous)
        .select(
            "month",
            "total_claims",
            "total_approved_eur",
            percent(current - F.col("previous"), F.col("previous"), 1).alias("mom_growth_pct"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def top_procedures(fact: DataFrame) -> DataFrame:
    """Procedures with the highest mean approved cost; ties go by code."""
    total = F.col("approved").cast("double")
    return (
        fact.where(F.col("claim_status") == APPROVED)
        .groupBy("procedure_code")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.count("approved_amount_eur").alias("amounts"),
            money_sum(F.col("approved_amount_eur")).alias("approved"),
        )
        .where(F.col("claim_count") >= MIN_CLAIMS_PER_PROCEDURE)
        .select(
            "procedure_code",
            "claim_count",
            round_half(safe_ratio(total, F.col("amounts")), 2).alias("avg_cost_eur"),
            round_half(total, 2).alias("total_cost_eur"),
        )
        .orderBy(F.desc_nulls_last("avg_cost_eur"), F.asc_nulls_last("procedure_code"))
        .limit(TOP_PROCEDURES)
    )


def over_premium(utilisation: DataFrame) -> DataFrame:
    """Members whose approved spend exceeds a multiple of their premium."""
    return (
        utilisation.where(F.col("utilisation_ratio") > PREMIUM_MULTIPLE)
        .groupBy("plan_type", "age_band")
        .agg(F.count(F.lit(1)).alias("members_over_3x"))
        .orderBy(F.desc_nulls_last("members_over_3x"))
    )


def out_of_network_premium(costs: DataFrame) -> DataFrame:
    """How much more a claim costs outside the network, by specialty."""

    def mean_cost(status: str):
        return F.avg(F.when(F.col("network_status") == status, F.col("avg_claim_cost_eur")))

    gap = mean_cost("OUT_OF_NETWORK") - mean_cost("IN_NETWORK")
    return (
        costs.groupBy("specialty")
        .agg(round_half(gap, 2).alias("oon_cost_premium_eur"))
        .orderBy(F.desc_nulls_last("oon_cost_premium_eur"))
    )


def sla_breaches(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Share of claims submitted too long after the service, by month."""
    return (
        in_calendar(fact, dates)
        .groupBy("month")
        .agg(
            F.count_if(F.col("submission_lag_days") > SLA_DAYS).alias("late"),
            F.count(F.lit(1)).alias("claims"),
        )
        .select("month", percent(F.col("late"), F.col("claims"), 2).alias("sla_breach_pct"))
        .orderBy(F.asc_nulls_last("month"))
    )


def latest_kpis(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy(F.desc_nulls_last("month")).limit(LATEST_MONTHS)
