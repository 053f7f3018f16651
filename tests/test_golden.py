"""The rules on the fixtures of FIXTURES.md part B, against its counts.

The counts there were taken with other SQL, before this code was written.
"""

import re
from pathlib import Path

import pytest
from conftest import TABLES, TESTDATA
from pyspark.sql import functions as F

from claimloom.operators.quality import apply_rules
from claimloom.plans import analytics, gold
from claimloom.plans.conform import conform
from claimloom.plans.layers import AS_OF, CONFIG
from claimloom.sources.config import load_config
from claimloom.sources.tables import Staging


@pytest.fixture(scope="module")
def staging(spark):
    return Staging(spark, "golden")


@pytest.fixture(scope="module")
def outcomes(spark, staging):
    text = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
    sql = dict(re.findall(r"\*\*fx_(\w+)\*\*\s+```sql\n(.*?)```", text, re.S))
    for name in TABLES:
        spark.read.parquet(f"{TESTDATA}/sf0.01/{name}.parquet").createOrReplaceTempView(name)
    config = load_config(CONFIG)
    done = {}
    for name in config.order:
        ds = config.datasets[name]
        keys = {o: done[o].clean.select(config.datasets[o].key) for o in ds.references}
        outcome = apply_rules(spark.sql(sql[name]), name, ds.rules, keys, ["_ord"])
        done[name] = outcome.on(staging.store(name, outcome.checked))
    return done


def counts(outcome):
    report = outcome.report.collect()
    return report[0].rows_checked, [r.rows_failed for r in report], outcome.quarantined.count()


def test_failures(outcomes):
    assert counts(outcomes["members"]) == (1530, [30, 24, 4], 57)
    assert counts(outcomes["providers"]) == (103, [3, 4], 7)
    assert counts(outcomes["claims"]) == (60600, [600, 240, 120, 183, 1345, 2358], 4719)


def test_rows_with_several_reasons(outcomes):
    several = outcomes["claims"].quarantined.where(F.size(F.split("_dq_failures", ";")) > 2)
    assert several.count() == 126


def test_gold(spark, staging, outcomes):
    def stored(name, df):
        return staging.store(name, df)

    kinds = {name: ds.kinds for name, ds in load_config(CONFIG).datasets.items()}

    members = conform("members", outcomes["members"].clean, kinds["members"])
    members = stored("dim_m", gold.dim_member(members, lambda df: stored("sorted_m", df), AS_OF))
    providers = outcomes["providers"].clean
    providers = stored("dim_p", gold.dim_provider(providers, lambda df: stored("sorted_p", df)))
    assert (members.count(), providers.count()) == (1473, 96)
    claims = conform("claims", outcomes["claims"].clean, kinds["claims"])
    fact = stored("fact", gold.fact_claims(claims, members, providers))
    assert fact.count() == 55881
    assert fact.where("claim_status = 'APPROVED'").count() == 37824
    kpis = gold.mart_monthly_kpis(fact, gold.dim_date(spark)).collect()
    assert len(kpis) == 30
    assert {r.month: r for r in kpis}["2026-06"] == (
        "2026-06", 1801, 96496261.60, 49739467.25, 68.02, 21.1, round(100 * 49739467.25 / 96496261.60, 2),
    )
    assert round(sum(r.total_billed_eur for r in kpis), 2) == 2965286397.64
    assert round(sum(r.total_approved_eur for r in kpis), 2) == 1507092925.28
    costs = gold.mart_specialty_costs(fact, providers)
    assert costs.count() == 20
    use = gold.mart_member_utilisation(fact, members)
    assert use.count() == 1473
    assert analytics.over_premium(use).agg(F.sum("members_over_3x")).first()[0] == 753
