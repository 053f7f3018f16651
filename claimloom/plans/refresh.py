"""A full run: raw extracts to bronze, silver, audit and gold tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce
from hashlib import sha256
from typing import TypeVar
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.dates import ISO, chosen_formats
from claimloom.operators.quality import apply_rules
from claimloom.plans import analytics, gold
from claimloom.plans.conform import silver_columns, whole
from claimloom.sources.checked import CLEAN, VERDICT, Checked, write_checked
from claimloom.sources.config import Config
from claimloom.sources.extracts import ROW_ORDER, read_extract, row_of_extract
from claimloom.sources.tables import (
    Staging,
    VersionedTable,
    ensure_database,
    fingerprint,
    replace_csv,
    replace_table,
)

CLEAN_PART = f"{VERDICT}={CLEAN}"

Result = TypeVar("Result")


def _together(
    spark: SparkSession, steps: Mapping[str, Callable[[], Result]]
) -> dict[str, Result]:
    """Run steps that do not need each other at once, as Spark jobs side by side."""
    as_job = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        running = {name: pool.submit(as_job(step)) for name, step in steps.items()}
        return {name: step.result() for name, step in running.items()}


def _staging(spark: SparkSession, config: Config, step: str) -> Staging:
    """A place of this run alone."""
    warehouse = sha256(f"{config.warehouse}/{config.database_prefix}".encode()).hexdigest()[:16]
    return Staging(spark, f"{warehouse}/{uuid4().hex}/{step}")


def _digest(*parts: object) -> str:
    return sha256(json.dumps(parts, default=str, sort_keys=True).encode()).hexdigest()


@dataclass
class Build:
    """One run over a config, and what it is made of.

    Each table has a fingerprint: of the files and settings it is made of, by
    way of the fingerprints of the tables it reads. It is written with the
    table. With ``resume`` a table whose newest version has the same
    fingerprint is taken as it is, so a run that died goes on where it
    stopped. The code is no part of it: resume with the code of the first run.
    """

    spark: SparkSession
    config: Config
    resume: bool = False
    fingerprints: dict[str, str] = field(default_factory=dict)
    #: Tables that were written, not taken as they were.
    written: list[str] = field(default_factory=list)

    def made_of(self, table: str, *parts: object, tables: Iterable[str] = ()) -> str:
        """Sets and returns the fingerprint of ``table``, of ``parts`` and the ``tables`` it reads."""
        self.fingerprints[table] = _digest(*parts, [self.fingerprints.get(t, uuid4().hex) for t in sorted(tables)])
        return self.fingerprints[table]

    def versioned(self, layer: str, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.config.database(layer), name, self.config.warehouse)

    def finished(self, layer: str, name: str) -> DataFrame | None:
        """The table, if this run need not write it."""
        fingerprint = self.fingerprints.get(f"{layer}.{name}", "")
        return self.versioned(layer, name).current(fingerprint) if self.resume else None

    def keep(self, layer: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table as it is, or written anew."""
        found = self.finished(layer, name)
        if found is None:
            fingerprint = self.fingerprints.get(f"{layer}.{name}", "")
            found = replace_table(make(), self.config.database(layer), name, self.config.warehouse, fingerprint)
            self.written.append(f"{layer}.{name}")
        return found


def load_bronze(
    spark: SparkSession, config: Config, batch_ts: str, build: Build | None = None
) -> dict[str, DataFrame]:
    """Raw extracts with load metadata, as tables."""
    build = build or Build(spark, config)
    ensure_database(spark, config.database("bronze"))

    def load(name: str) -> DataFrame:
        ds = config.datasets[name]
        path = f"{config.raw_zone}/{ds.file}"
        needed = sorted({*ds.rule_columns, *ds.kinds})
        build.made_of(f"bronze.{name}", fingerprint(spark, path), needed, ds.multi_line)
        return build.keep("bronze", name, lambda: read_extract(spark, path, batch_ts, needed, ds.multi_line))

    return _together(spark, {name: partial(load, name) for name in config.datasets})


def build_silver(
    spark: SparkSession, config: Config, bronze: dict[str, DataFrame], build: Build | None = None
) -> DataFrame:
    """Check all datasets, write clean and quarantined rows, return the report.

    A dataset is checked against the clean keys of those it refers to, so a
    row falls with the row it needs. Nothing is switched before all is written.
    """
    build = build or Build(spark, config)
    for layer in ("silver", "audit"):
        ensure_database(spark, config.database(layer))
    staging = _staging(spark, config, "checked")
    try:
        return _check_and_write(build, bronze, staging)
    finally:
        staging.clear()


def _check_and_write(build: Build, bronze: dict[str, DataFrame], staging: Staging) -> DataFrame:
    spark, config = build.spark, build.config
    done: dict[str, Checked] = {}
    taken: dict[str, DataFrame] = {}

    def check(name: str) -> None:
        ds = config.datasets[name]
        sources = [f"bronze.{name}", *(f"silver.{other}" for other in ds.references)]
        build.made_of(f"silver.{name}", [repr(r) for r in ds.rules], ds.kinds, ds.date_formats, tables=sources)
        table = build.finished("silver", name)
        if table is not None:
            taken[name] = table
            return
        if ds.date_formats != (ISO,):
            present = [c for c in ds.date_columns if c in bronze[name].columns]
            ds = ds.in_formats(chosen_formats(bronze[name], present, ds.date_formats))
        keys = {
            other: (taken[other] if other in taken else done[other].clean).select(config.datasets[other].key)
            for other in ds.references
        }
        store = lambda part, df: staging.store(f"{name}-{part}", df)
        outcome = apply_rules(bronze[name], name, ds.rules, keys, ROW_ORDER, store=store, row_id=row_of_extract())
        rows = bronze[name].select(*outcome.data_columns)
        folder = build.versioned("silver", name).new_version()
        done[name] = write_checked(outcome, silver_columns(name, rows, ds.kinds), whole(rows), folder)

    for names in config.stages:
        _together(spark, {name: partial(check, name) for name in names})

    audit = config.database("audit")
    earlier = spark.table(f"`{audit}`.`dq_report`") if taken else None
    reports = [
        done[name].report if name in done else earlier.where(F.col("dataset") == name) for name in config.order
    ]

    def publish(name: str) -> DataFrame:
        checked = done[name]
        build.written.append(f"silver.{name}")
        return build.versioned("silver", name).publish(
            checked.folder, checked.clean.schema, checked.clean_rows, build.fingerprints[f"silver.{name}"], CLEAN_PART
        )

    def keep_quarantined(name: str) -> None:
        replace_csv(done[name].quarantined, f"{config.quarantine_zone}/{name}_quarantine.csv")

    def keep_report() -> DataFrame:
        build.made_of("audit.dq_report", tables=[f"silver.{name}" for name in config.order])
        stored = build.keep("audit", "dq_report", lambda: reduce(DataFrame.unionByName, reports).coalesce(1))
        replace_csv(stored.coalesce(1), f"{config.reports}/dq_report.csv")
        return stored

    kept = _together(
        spark,
        {
            **{f"clean {name}": partial(publish, name) for name in done},
            **{f"quarantined {name}": partial(keep_quarantined, name) for name in done},
            "report": keep_report,
        },
    )
    return kept["report"]


def build_gold(
    spark: SparkSession, config: Config, as_of: dt.date | None = None, build: Build | None = None
) -> dict[str, DataFrame]:
    """Dimensions, then the fact, then the marts; each from written tables."""
    build = build or Build(spark, config)
    ensure_database(spark, config.database("gold"))
    staging = _staging(spark, config, "sorted")
    try:
        return _build_gold(build, as_of, staging)
    finally:
        staging.clear()


def _build_gold(build: Build, as_of: dt.date | None, staging: Staging) -> dict[str, DataFrame]:
    spark, config = build.spark, build.config
    built: dict[str, DataFrame] = {}

    def source(name: str) -> DataFrame:
        return spark.table(f"`{config.database('silver')}`.`{name}`")

    def write(steps: Mapping[str, tuple[Callable[[], DataFrame], list, list]]) -> None:
        def one(name: str) -> DataFrame:
            make, parts, tables = steps[name]
            build.made_of(f"gold.{name}", *parts, tables=tables)
            return build.keep("gold", name, make)

        built.update(_together(spark, {name: partial(one, name) for name in steps}))

    def sorted_(name: str) -> Callable[[DataFrame], DataFrame]:
        return partial(staging.store, name)

    day = as_of or dt.date.today()
    write(
        {
            "dim_member": (
                lambda: gold.dim_member(source("members"), sorted_("members"), as_of), [day], ["silver.members"]
            ),
            "dim_provider": (
                lambda: gold.dim_provider(source("providers"), sorted_("providers")), [], ["silver.providers"]
            ),
            "dim_date": (lambda: gold.dim_date(spark, *config.calendar), [config.calendar], []),
        }
    )
    members, providers, dates = (built[n] for n in ("dim_member", "dim_provider", "dim_date"))
    write(
        {
            "fact_claims": (
                lambda: gold.fact_claims(source("claims"), members, providers),
                [],
                ["silver.claims", "gold.dim_member", "gold.dim_provider"],
            )
        }
    )
    fact = built["fact_claims"]
    write(
        {
            "mart_monthly_kpis": (
                lambda: gold.mart_monthly_kpis(fact, dates), [], ["gold.fact_claims", "gold.dim_date"]
            ),
            "mart_specialty_costs": (
                lambda: gold.mart_specialty_costs(fact, providers), [], ["gold.fact_claims", "gold.dim_provider"]
            ),
            "mart_member_utilisation": (
                lambda: gold.mart_member_utilisation(fact, members), [], ["gold.fact_claims", "gold.dim_member"]
            ),
        }
    )
    return built


def run_pipeline(
    spark: SparkSession,
    config: Config,
    as_of: dt.date | None = None,
    batch_ts: str | None = None,
    resume: bool = False,
) -> DataFrame:
    """Run everything; returns the KPIs of the latest months.

    ``resume`` takes tables that are already made of the same files and settings as they are.
    """
    if batch_ts is None:
        batch_ts = dt.datetime.now(dt.timezone.utc).isoformat()
    build = Build(spark, config, resume)
    bronze = load_bronze(spark, config, batch_ts, build)
    build_silver(spark, config, bronze, build)
    built = build_gold(spark, config, as_of, build)
    return analytics.latest_kpis(built["mart_monthly_kpis"])
