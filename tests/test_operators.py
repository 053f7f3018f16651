"""Lookups, dense keys and single expressions."""

import datetime as dt
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from claimloom.functions.exprs import (
    calendar_days,
    calendar_years,
    date_key,
    money_sum,
    percent,
    round_half,
    safe_ratio,
    strict_timestamp,
    title_case,
    weekday_from_sunday,
)
from claimloom.operators.dense_key import with_dense_key
from claimloom.operators import lookup as lookup_module
from claimloom.operators.lookup import (
    broadcast_lookup,
    hot_keys,
    lookup,
    measured_bytes,
    salted_lookup,
)
from claimloom.plans.gold import age_band
from claimloom.sources.tables import Staging


@pytest.fixture
def skewed(spark):
    """Key 0 has a third of the rows, null another third."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id") % 50)
    return spark.range(3000).select(key.alias("k"), "id").repartition(6)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hot_keys_are_the_large_ones(spark, skewed):
    found = dict(hot_keys(skewed, "k", 100).collect())
    hashes = skewed.select("k", F.xxhash64("k").alias("h")).distinct().collect()
    by_hash = {r.h: r.k for r in hashes}
    # 1,000 even-third rows and 20 of the spread-out third are key 0.
    assert {by_hash[h]: n for h, n in found.items()} == {0: 11, None: 10}


def test_all_of_many_hot_keys_are_spread(spark):
    df = spark.range(1200).select((F.col("id") % 400).alias("k"))
    found = dict(hot_keys(df, "k", 1).collect())
    assert len(found) == 400
    assert set(found.values()) == {3}


def test_the_list_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "HOT_KEYS", 50)
    df = spark.range(1200).select(F.when(F.col("id") < 300, F.col("id") % 5).otherwise(F.col("id")).alias("k"))
    assert sorted(r.parts for r in hot_keys(df, "k", 1).collect()) == [60] * 5


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows_per_task", [1, 50, 10_000])
def test_salted_lookup_equals_plain_join(spark, skewed, how, rows_per_task):
    table = spark.createDataFrame([(0, "zero"), (7, "seven"), (None, "none"), (999, "x")], "k long, v string")
    hot = hot_keys(skewed, "k", rows_per_task)
    found = salted_lookup(skewed, table, "k", hot, ["id"], how)
    named = {0: "zero", 7: "seven", None: "none"}
    expected = [
        (r.k, r.id, named.get(r.k))
        for r in skewed.collect()
        if how == "left" or r.k in named
    ]
    assert rows(found) == sorted(expected, key=repr)
    assert rows(broadcast_lookup(skewed, table, "k", how)) == rows(found)


def test_salted_lookup_refuses_keys_of_two_types(spark, skewed):
    table = spark.createDataFrame([(0, "zero")], "k int, v string")
    with pytest.raises(TypeError, match="k is bigint here, int there"):
        salted_lookup(skewed, table, "k", hot_keys(skewed, "k"), ["id"])


def test_salted_lookup_deals_a_hot_key_to_many_tasks(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spark.createDataFrame([(0, "zero")], "k long, v string")
        found = salted_lookup(skewed, table, "k", hot_keys(skewed, "k", 50), ["id"])
        per_task = (
            found.where("k = 0").groupBy(F.spark_partition_id()).count().select("count").collect()
        )
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) >= 6
    assert max(r[0] for r in per_task) < 500


def test_only_a_table_measured_small_is_broadcast(spark, skewed):
    table = spark.createDataFrame([(i, "x" * 100) for i in range(10)], "k long, v string")
    assert measured_bytes(table) == 10 * (48 + 16 + 100)
    assert measured_bytes(table.limit(0)) == 0
    for limit, join in ((1640, "BroadcastHashJoin"), (1639, "_part")):
        found = lookup(skewed, table, "k", ["id"], broadcast_bytes=limit)
        assert join in found._jdf.queryExecution().executedPlan().toString()
        assert found.where("v is not null").count() == 1200


@pytest.mark.parametrize("n", [0, 1, 5, 4000])
def test_dense_key_is_the_sorted_position(spark, n):
    scattered = F.format_string("K%05d", F.col("id") * 7919 % max(n, 1))
    df = spark.range(n).select(scattered.alias("k"), "id").repartition(7)
    found = with_dense_key(df, "k", "pos", lambda d: Staging(spark, str(uuid4())).store("sorted", d))
    assert found.columns == ["k", "id", "pos"]
    keyed = {r.k: r.pos for r in found.collect()}
    assert keyed == {k: i for i, k in enumerate(sorted(keyed), 1)}
    assert len(keyed) == n


def test_dense_key_puts_null_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    found = with_dense_key(df, "k", "pos", lambda d: Staging(spark, str(uuid4())).store("sorted", d))
    assert {r.k: r.pos for r in found.collect()} == {"a": 1, "b": 2, None: 3}


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "x,digits,expected", [(1.005, 2, 1.0), (2.675, 2, 2.68), (-1.25, 1, -1.3), (7.0, 2, 7.0), (None, 2, None)]
)
def test_round_half(spark, x, digits, expected):
    assert value(spark, round_half(F.lit(x).cast("double"), digits)) == expected


def test_ratios_are_null_on_zero(spark):
    assert value(spark, safe_ratio(F.lit(1.0), F.lit(0.0))) is None
    assert value(spark, percent(F.lit(1), F.lit(0), 2)) is None
    assert value(spark, percent(F.lit(1), F.lit(3), 2)) == 33.33
    assert value(spark, percent(F.lit(None).cast("double"), F.lit(3), 2)) is None


def test_money_sum_is_exact_in_any_order(spark):
    amounts = [0.1, 1e13, 0.2, -1e13, 0.3] * 50
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    totals = {
        float(df.repartition(n).agg(money_sum(F.col("x")).alias("s")).first().s) for n in (1, 3, 16)
    }
    assert totals == {30.0}


def test_calendar_differences(spark):
    d = lambda text: F.lit(text).cast("timestamp_ntz")
    assert value(spark, calendar_years(d("2000-12-31"), d("2001-01-01"))) == 1
    assert value(spark, calendar_days(d("2025-01-01 23:00:00"), d("2025-01-02 01:00:00"))) == 1
    assert value(spark, calendar_days(d("2025-01-05"), d("2025-01-01"))) == -4
    assert value(spark, date_key(d("2025-03-09 10:00:00"))) == 20250309
    assert value(spark, date_key(F.lit(None).cast("date"))) is None


def test_weekday_starts_on_sunday(spark):
    days = [dt.date(2024, 9, 1) + dt.timedelta(i) for i in range(7)]
    assert [value(spark, weekday_from_sunday(F.lit(d))) for d in days] == list(range(7))


@pytest.mark.parametrize(
    "text",
    ["essential", "o'brien co-op", "PREMIUM plus", "two  blanks", "a1b2", "", "éire gold", "x_y.z"],
)
def test_title_case_equals_pythons(spark, text):
    assert value(spark, title_case(F.lit(text))) == text.title()


def test_strict_timestamp(spark):
    assert value(spark, strict_timestamp(F.lit("2025-01-02"))) == dt.datetime(2025, 1, 2)
    assert value(spark, strict_timestamp(F.lit(None).cast("string"))) is None
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="not a date: soon"):
                value(spark, strict_timestamp(F.lit("soon")))
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_age_bands(spark):
    ages = [5, 29, 30, 44, 45, 59, 60, 99, None]
    found = [value(spark, age_band(F.lit(a).cast("long"))) for a in ages]
    assert found == [
        "18-29", "18-29", "30-44", "30-44", "45-59", "45-59", "60+", "60+", "60+",
    ]
