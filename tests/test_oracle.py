import os

import pytest
from compare import duck, duck_bag, spark_bag
from conftest import TABLES, TESTDATA

from pyspark.sql import functions as F

from claimloom.plans import gold
from claimloom.plans.layers import layers
from claimloom.plans.registry import QUERIES
from claimloom.oracle import SQL

SF = os.environ.get("TEST_SF", "0.01")
FOLDER = TESTDATA / f"sf{SF}"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER, TABLES)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, con, name):
    columns, rows = spark_bag(QUERIES[name](spark, str(FOLDER)))
    expected_columns, expected = duck_bag(con, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_the_fixture_has_every_hard_case(spark):
    """What the rules and reports must cope with occurs in the smallest tables already."""
    built = layers(spark, str(TESTDATA / "sf0.001"))
    claims, members, fact = built.bronze("claims"), built.bronze("members"), built.stored_fact()
    for name in ("claim_id", "member_id", "service_date", "submitted_date", "billed_amount_eur", "claim_status"):
        assert claims.where(F.col(name).isNull()).count(), name
    for name in ("date_of_birth", "monthly_premium_eur", "county"):
        assert members.where(F.col(name).isNull()).count(), name
    assert members.where("monthly_premium_eur = 0").count()
    for rows, key in ((claims, "claim_id"), (members, "member_id")):
        assert rows.groupBy(key, "_ord").count().where("count > 1").count(), key
    assert gold.outside_calendar(fact, built.dim_date()).where("service_year IS NOT NULL").count()
    use, costs = built.stored_member_utilisation(), built.stored_specialty_costs()
    assert use.where("claims_count = 0").count()
    assert use.where("utilisation_ratio IS NULL").count()
    assert costs.groupBy("specialty").count().where("count = 1").count()
    assert fact.where("submission_lag_days IS NULL").count()
