"""Versions of a table, runs that go on where they stopped, and checked datasets from one write."""

import datetime as dt

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_refresh import STAMP, config_for, quarantine, small_run, table, write_csv

from claimloom.plans import gold, refresh
from claimloom.plans.refresh import Build, build_silver, load_bronze, run_pipeline
from claimloom.sources import driver_tables
from claimloom.sources.tables import MANIFESTS, VersionedTable, fingerprint, listing, replace_table

GOLD = ["dim_date", "dim_member", "dim_provider", "fact_claims", "mart_member_utilisation", "mart_monthly_kpis", "mart_specialty_costs"]


def versions(folder):
    return sorted(p.name for p in folder.glob("run-*"))


def test_a_reader_ends_with_the_rows_it_opened(spark, tmp_path):
    home = tmp_path / "default/readers"
    before = replace_table(spark.range(100), "default", "readers", str(tmp_path))
    opened = spark.table("default.readers")
    replace_table(spark.range(7), "default", "readers", str(tmp_path))
    assert opened.agg(F.sum("id")).first()[0] == before.agg(F.sum("id")).first()[0] == 4950
    assert spark.table("default.readers").count() == 7
    # by number and age: recently replaced versions stay, however many
    for n in range(3):
        replace_table(spark.range(n), "default", "readers", str(tmp_path))
    assert len(versions(home)) == 5 == len(list((home / MANIFESTS).glob("[!.]*.json")))
    replace_table(spark.range(3), "default", "readers", str(tmp_path), keep=2, seconds=0)
    assert len(versions(home)) == 2 and spark.table("default.readers").count() == 3
    (row,) = listing(spark, str(tmp_path), ["default"]).collect()
    assert (row["table"], row["rows"], row["files"] > 0, row["bytes"] > 0, row["versions"]) == ("readers", 3, True, True, 2)
    spark.sql("DROP TABLE default.readers")


def test_a_failed_write_is_no_version(spark, tmp_path):
    replace_table(spark.range(5), "default", "fails", str(tmp_path))
    with pytest.raises(Exception, match="stop here"):
        replace_table(spark.range(5).select(F.raise_error(F.lit("stop here")).alias("id")), "default", "fails", str(tmp_path))
    assert spark.table("default.fails").count() == 5
    assert len(VersionedTable(spark, "default", "fails", str(tmp_path)).manifests()) == 1
    spark.sql("DROP TABLE default.fails")


def test_a_table_with_other_columns_is_made_anew(spark, tmp_path):
    replace_table(spark.range(5), "default", "columns", str(tmp_path))
    assert replace_table(spark.range(2).selectExpr("id AS k"), "default", "columns", str(tmp_path)).columns == ["k"]
    spark.sql("DROP TABLE default.columns")


@pytest.fixture(scope="module")
def extracts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("resume")
    config = config_for(folder, "resume_")
    for name, extract in driver_tables.extracts(spark, str(TESTDATA / "sf0.001")).items():
        df = extract().drop(driver_tables.ORDER)
        write_csv(folder / "raw_zone" / config.datasets[name].file, df.columns, [tuple(r) for r in df.collect()])
    return folder, config


def run(spark, config, **more):
    """The tables a resumed run writes."""
    build = Build(spark, config, resume=True)
    bronze = load_bronze(spark, config, STAMP, build)
    build_silver(spark, config, bronze, build)
    refresh.build_gold(spark, config, more.get("as_of", dt.date(2026, 7, 1)), build)
    return sorted(build.written)


def test_a_run_goes_on_where_it_stopped(spark, extracts, monkeypatch):
    folder, config = extracts
    make = gold.mart_specialty_costs
    monkeypatch.setattr(gold, "mart_specialty_costs", lambda *_: (_ for _ in ()).throw(RuntimeError("out of luck")))
    with pytest.raises(RuntimeError, match="out of luck"):
        run(spark, config)
    monkeypatch.setattr(gold, "mart_specialty_costs", make)
    assert run(spark, config) == ["gold.mart_specialty_costs"]
    assert run(spark, config) == []
    # another day for ages: the dimension, and all that reads it
    marts = [f"gold.{n}" for n in GOLD if n.startswith("mart")]
    assert run(spark, config, as_of=dt.date(2026, 8, 1)) == ["gold.dim_member", "gold.fact_claims", *marts]
    # another extract of providers: claims are checked against it, members are not
    providers = folder / "raw_zone" / "providers.csv"
    providers.write_text(providers.read_text() + "PRV9999,New,SPEC_1,Cork,IN_NETWORK\n")
    report = {tuple(r) for r in table(spark, config, "audit", "dq_report").where("dataset = 'members'").collect()}
    assert run(spark, config, as_of=dt.date(2026, 8, 1)) == sorted(
        ["audit.dq_report", "bronze.providers", "gold.dim_provider", "gold.fact_claims", *marts, "silver.claims", "silver.providers"]
    )
    assert report == {tuple(r) for r in table(spark, config, "audit", "dq_report").where("dataset = 'members'").collect()}
    assert table(spark, config, "silver", "providers").where("provider_id = 'PRV9999'").count() == 1
    kpis = run_pipeline(spark, config, as_of=dt.date(2026, 8, 1), resume=True)
    full = run_pipeline(spark, config, as_of=dt.date(2026, 8, 1))
    assert sorted(map(tuple, kpis.collect())) == sorted(map(tuple, full.collect()))


def test_fingerprints(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    before = fingerprint(spark, str(tmp_path / "a.csv"))
    assert before == fingerprint(spark, str(tmp_path / "a.csv"))
    (tmp_path / "a.csv").write_text("xy")
    assert before != fingerprint(spark, str(tmp_path / "a.csv"))


def test_clean_and_quarantined_come_from_one_write(spark, tmp_path, monkeypatch):
    """Bronze is read once besides counting keys, and no row is sorted to be told apart."""
    config = small_run(tmp_path, "one_write_", on_bad_value="quarantine")
    bronze = load_bronze(spark, config, STAMP)
    plans = []
    checked = refresh.write_checked

    def seen(outcome, *rest):
        plans.append(outcome.checked._jdf.queryExecution().executedPlan().toString())
        return checked(outcome, *rest)

    monkeypatch.setattr(refresh, "write_checked", seen)
    report = build_silver(spark, config, bronze)
    (plan,) = plans
    assert plan.count("FileScan parquet") <= 2 and "Sort [" not in plan
    assert report.agg(F.sum("rows_failed"), F.max("rows_checked")).first()[:] == (4, 5)
    home = tmp_path / "warehouse" / "one_write_silver" / "members"
    (version,) = home.glob("run-*")
    assert sorted(p.name for p in version.iterdir() if "=" in p.name) == ["_dq_verdict=clean", "_dq_verdict=quarantine"]
    assert quarantine(spark, config, "members").columns[-1] == "_dq_failures"
    assert table(spark, config, "silver", "members").columns == [
        c for c in bronze["members"].columns if not c.startswith(("_order", "_corrupt"))
    ]


def test_all_rows_clean_and_none_at_all(spark, tmp_path):
    for n, rows in enumerate(([("a", "1")], [])):
        config = config_for(tmp_path / str(n), f"edge{n}_", datasets={"things": {"file": "t.csv", "key": "k", "rules": [{"type": "unique", "column": "k"}]}})
        write_csv(tmp_path / str(n) / "raw_zone/t.csv", ["k", "v"], rows)
        report = build_silver(spark, config, load_bronze(spark, config, STAMP))
        assert [r["rows_checked"] for r in report.collect()] == [len(rows)]
        assert table(spark, config, "silver", "things").count() == len(rows)
        assert table(spark, config, "silver", "things").columns[:2] == ["k", "v"]
