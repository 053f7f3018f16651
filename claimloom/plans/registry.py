"""All registered queries by name, each a function of session and table folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.dates import chosen_formats, misses, parse_by
from claimloom.functions.patterns import java_pattern
from claimloom.operators.quality import (
    REASONS,
    RuleOutcome,
    reason_counts,
    total_failures,
    union_reports,
)
from claimloom.plans import analytics, checks, gold
from claimloom.plans.layers import AS_OF, Layers, layers
from claimloom.plans.refresh import Build, build_gold
from claimloom.session import shared_folder
from claimloom.sources.config import Config
from claimloom.sources.driver_tables import CLAIM_COLUMNS, DATE_FORMATS, ORDER
from claimloom.sources.tables import ensure_database, listing, replace_csv, replace_table

#: Databases of a warehouse.
LAYERS = ("bronze", "silver", "audit", "gold")

DATE_COLUMNS = ("service_date", "submitted_date")

Query = Callable[[SparkSession, str], DataFrame]


def _failing_rows(built: Layers, rule_type: str) -> DataFrame:
    """Rows failing any rule of one type: dataset, rule label, key, position."""
    found = []
    for name in built.config.order:
        ds = built.config.datasets[name]
        for i, rule in enumerate(ds.rules):
            if rule.type == rule_type:
                failing = built.outcome(name, i).failing(0)
                found.append(
                    failing.select(
                        F.lit(name).alias("dataset"),
                        F.lit(rule.label).alias("rule_column"),
                        F.col(ds.key).alias("row_key"),
                        F.col(ORDER).alias("row_order"),
                    )
                )
    return reduce(DataFrame.unionByName, found)


def _report(built: Layers) -> DataFrame:
    return union_reports([built.outcome(name) for name in built.config.order])


def _quarantines(built: Layers) -> DataFrame:
    """Reasons of all quarantined rows, with their dataset."""
    found = [
        built.stored_outcome(name).quarantined.select(F.lit(name).alias("dataset"), REASONS)
        for name in built.config.order
    ]
    return reduce(DataFrame.unionByName, found)


def _claim_reasons(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("claim_id", REASONS).agg(F.count(F.lit(1)).alias("lines"))


def _line_counts(outcome: RuleOutcome) -> DataFrame:
    """Lines read, how many of them are clean and quarantined, and what their load metadata says."""
    clean = F.col(REASONS) == ""
    named = F.col("_source_file").endswith(".csv")
    return outcome.checked.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(clean).alias("clean"),
        F.count_if(~clean).alias("quarantined"),
        F.max("_loaded_at").alias("loaded_at"),
        F.countDistinct("_loaded_at").alias("loads"),
        F.count_if(~F.coalesce(named, F.lit(False))).alias("without_source"),
    )


@contextmanager
def _own_catalog(built: Layers) -> Iterator[Config]:
    """The config with a warehouse and databases of its own; the databases go afterwards, the files stay to be read."""
    folder = f"{shared_folder(built.spark)}/claimloom/warehouse-{uuid4().hex}"
    config = replace(built.config, warehouse=folder, database_prefix=f"own_{uuid4().hex}_")
    databases = [config.database(layer) for layer in LAYERS]
    for database in databases:
        ensure_database(built.spark, database)
    try:
        yield config
    finally:
        for database in databases:
            built.spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def _table_round_trip(built: Layers) -> DataFrame:
    """Silver members as a catalog table in a database of its own: written, replaced, read by name."""
    with _own_catalog(built) as config:
        for _ in range(2):
            written = replace_table(built.silver("members"), config.database("silver"), "members", config.warehouse)
        return written


def _listed(built: Layers, config: Config) -> DataFrame:
    """Tables of a catalog by layer, with the rows of their newest version and the versions that are kept."""
    found = listing(built.spark, config.warehouse, [config.database(layer) for layer in LAYERS])
    return found.select(
        F.substring_index("database", "_", -1).alias("layer"),
        F.col("table").alias("table_name"),
        "rows",
        "versions",
        ((F.col("bytes") > 0) & (F.col("files") > 0)).alias("has_files"),
    )


def _catalog_listing(built: Layers) -> DataFrame:
    """Bronze, silver and audit tables as the catalog knows them; a resumed second pass writes nothing."""
    with _own_catalog(built) as config:
        build = Build(built.spark, config, resume=True)
        tables = {f"bronze.{n}": partial(built.bronze, n) for n in config.order}
        tables |= {f"silver.{n}": partial(built.silver, n) for n in config.order}
        tables["audit.dq_report"] = partial(_stored_report, built)
        for _ in range(2):
            for name, make in tables.items():
                build.made_of(name, name)
                build.keep(*name.split("."), make)
        return _listed(built, config)


def _build_ledger(built: Layers) -> DataFrame:
    """Gold tables built, then resumed with another day for ages: only what depends on it has a second version.

    Joined to the rows of the given table each is made of.
    """
    with _own_catalog(built) as config:
        own = built.own()
        for day in (AS_OF - dt.timedelta(days=366), AS_OF):
            build = Build(built.spark, config, resume=True)
            for name in config.order:
                build.made_of(f"silver.{name}", name)
                build.keep("silver", name, partial(own.silver, name))
            own.clear()  # silver is written now
            build_gold(built.spark, config, day, build)
        listed = _listed(built, config).where("layer = 'gold'").drop("has_files", "layer")
    given = {"dim_member": "customer", "dim_provider": "supplier"}
    sources = reduce(
        DataFrame.unionByName,
        [
            built.spark.read.parquet(f"{built.folder}/{t}.parquet").agg(F.count(F.lit(1)).alias("source_rows"), F.lit(t).alias("source_table"))
            for t in ("customer", "supplier", "lineitem")
        ],
    )
    named = [F.when(F.col("table_name") == k, v) for k, v in given.items()]
    return listed.withColumn("source_table", F.coalesce(*named, F.lit("lineitem"))).join(F.broadcast(sources), "source_table")


def _dates_by_format(built: Layers) -> DataFrame:
    """Both dates of the claims, each column read in the format that reads most of it."""
    rows = built.stored_odd_dates()
    chosen = chosen_formats(rows, DATE_COLUMNS, DATE_FORMATS)
    dates = [parse_by(F.col(c), chosen[c]).cast("date").alias(c) for c in DATE_COLUMNS]
    return rows.select("claim_id", *dates)


def _date_format_misses(built: Layers) -> DataFrame:
    """The format found for each date column, and the cells it does not read."""
    rows = built.stored_odd_dates()
    return misses(rows, chosen_formats(rows, DATE_COLUMNS, DATE_FORMATS))


#: Patterns in Python's dialect, and what they are matched with from the start.
PATTERNS = {
    "named": (r"(?P<kind>MBR|CLM)(?P<number>\d+)\Z", "member_id"),
    "line_end": (r"PRV\d{4}$", "provider_id"),
    "word_edge": (r"PRC0*\b(?!9)", "procedure_code"),
    "any_case": (r"(?i:approved|p\w+g)", "claim_status"),
    "no_digit": (r"[^\D1-4]|CLM\d*[0-4]-", "claim_id"),
}


def _pattern_matches(built: Layers) -> DataFrame:
    """Claims that match each of PATTERNS."""
    counts = [
        F.count_if(F.col(column).rlike(rf"\A(?:{java_pattern(pattern)})")).alias(name)
        for name, (pattern, column) in PATTERNS.items()
    ]
    return built.bronze("claims").agg(*counts)


def _csv_round_trip(built: Layers, df: DataFrame) -> DataFrame:
    path = f"{shared_folder(built.spark)}/claimloom/csv-{uuid4().hex}"
    replace_csv(df, path)
    return built.spark.read.schema(df.schema).options(header=True, escape='"').csv(path)


def _quarantine_round_trip(built: Layers) -> DataFrame:
    """The members' quarantine as CSV files, read back."""
    return _csv_round_trip(built, built.stored_outcome("members").quarantined)


def _report_round_trip(built: Layers) -> DataFrame:
    """The audit report as a CSV file, read back."""
    return _csv_round_trip(built, _stored_report(built).coalesce(1))


def _stored_report(built: Layers) -> DataFrame:
    return union_reports([built.stored_outcome(name) for name in built.config.order])


BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {
    "rule_not_null": lambda b: _failing_rows(b, "not_null"),
    "rule_unique": lambda b: _failing_rows(b, "unique"),
    "rule_allowed_values": lambda b: _failing_rows(b, "allowed_values"),
    "rule_min_value": lambda b: _failing_rows(b, "min_value"),
    "rule_regex_match": lambda b: _failing_rows(b, "regex_match"),
    "rule_date_order": lambda b: _failing_rows(b, "date_order"),
    "rule_referential": lambda b: _failing_rows(b, "referential"),
    "members_clean": lambda b: b.outcome("members").clean,
    "providers_clean": lambda b: b.outcome("providers").clean,
    "claims_clean": lambda b: b.outcome("claims").clean,
    "members_quarantine": lambda b: b.outcome("members").quarantined,
    "providers_quarantine": lambda b: b.outcome("providers").quarantined,
    "claims_quarantine": lambda b: b.outcome("claims").quarantined,
    "quarantine_reasons": lambda b: reason_counts(_quarantines(b), "dataset"),
    "csv_report": lambda b: b.line_outcome().report,
    "csv_quarantine": lambda b: _claim_reasons(b.line_outcome().quarantined),
    "incremental_quarantine": lambda b: _claim_reasons(b.incremental_quarantine()),
    "csv_multi_line": lambda b: b.broken_lines().select(*CLAIM_COLUMNS),
    "dates_by_format": _dates_by_format,
    "date_format_misses": _date_format_misses,
    "pattern_matches": _pattern_matches,
    "csv_lines": lambda b: _line_counts(b.line_outcome()),
    "dq_report": _report,
    "table_round_trip": _table_round_trip,
    "catalog_listing": _catalog_listing,
    "build_ledger": _build_ledger,
    "quarantine_round_trip": _quarantine_round_trip,
    "report_round_trip": _report_round_trip,
    "dq_total_failures": lambda b: total_failures(_stored_report(b)),
    "conform_members": lambda b: b.silver("members"),
    "conform_claims": lambda b: b.silver("claims"),
    "dim_member": Layers.dim_member,
    "dim_provider": Layers.dim_provider,
    "dim_date": lambda b: gold.days_with_facts(b.dim_date(), b.stored_fact()),
    "dim_date_of_claims": lambda b: gold.dim_date_of(b.silver("claims")),
    "facts_outside_calendar": lambda b: gold.outside_calendar(b.stored_fact(), b.dim_date()),
    "fact_claims": Layers.fact,
    "mart_monthly_kpis": Layers.monthly_kpis,
    "mart_specialty_costs": Layers.specialty_costs,
    "mart_member_utilisation": Layers.member_utilisation,
    "q_mom_growth": lambda b: analytics.mom_growth(b.stored_monthly_kpis()),
    "q_top_procedures": lambda b: analytics.top_procedures(b.stored_fact()),
    "q_over_3x_premium": lambda b: analytics.over_premium(b.stored_member_utilisation()),
    "q_oon_premium": lambda b: analytics.out_of_network_premium(b.stored_specialty_costs()),
    "q_sla_breach": lambda b: analytics.sla_breaches(b.stored_fact(), b.dim_date()),
    "q_latest_kpis": lambda b: analytics.latest_kpis(b.stored_monthly_kpis()),
    "check_duplicate_keys": lambda b: checks.duplicate_keys(b.silver("claims")),
    "check_negative_amounts": lambda b: checks.negative_amounts(b.silver("claims")),
    "check_orphan_facts": lambda b: checks.orphan_facts(b.stored_fact(), b.stored_dim_member()),
    "check_failures_recorded": lambda b: checks.failures_recorded(_stored_report(b)),
    "check_rate_bounds": lambda b: checks.rate_bounds(b.stored_monthly_kpis()),
}


def _query(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, folder: build(layers(spark, folder))


QUERIES: dict[str, Query] = {name: _query(build) for name, build in BUILDERS.items()}
