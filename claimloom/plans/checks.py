"""Invariants of the finished tables, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def duplicate_keys(silver_claims: DataFrame) -> DataFrame:
    repeated = silver_claims.groupBy("claim_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_keys"))


def negative_amounts(silver_claims: DataFrame) -> DataFrame:
    return silver_claims.agg(F.count_if(F.col("billed_amount_eur") < 0).alias("negative_amounts"))


def orphan_facts(fact: DataFrame, members: DataFrame) -> DataFrame:
    """Facts without a member. Counted per key first, so no fact is moved."""
    per_member = fact.groupBy("member_key").agg(F.count(F.lit(1)).alias("n"))
    orphans = per_member.join(members, "member_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_facts"))


def failures_recorded(report: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("rows_failed"), F.lit(0))
    return report.agg(total.alias("rows_failed"), (total > 0).alias("any_recorded"))


def rate_bounds(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.min("approval_rate_pct").alias("lowest_rate"),
        F.max("approval_rate_pct").alias("highest_rate"),
    )


def layer_tables(spark: SparkSession, databases: list[str]) -> set[str]:
    """Qualified names of the tables in the given databases."""
    return {
        f"{database}.{table.name}"
        for database in databases
        if spark.catalog.databaseExists(database)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
    }
