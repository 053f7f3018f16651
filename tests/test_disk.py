"""What a query leaves on disk, and that it gives the same rows with less of it."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from compare import bag
from conftest import TESTDATA
from pyspark.sql import functions as F

from claimloom.operators.quality import apply_rules
from claimloom.operators.lookup import may_have
from claimloom.operators.rules import rule_from_dict
from claimloom.plans.layers import CONFIG, Layers
from claimloom.plans.registry import BUILDERS
from claimloom.session import FREE_SHUFFLES, shared_folder, shuffles_freed
from claimloom.sources import driver_tables
from claimloom.sources.config import load_config
from claimloom.sources.tables import Staging, row_in_file

FOLDER = str(TESTDATA / "sf0.001")
RULES = tuple(rule_from_dict(r) for r in ({"type": "unique", "column": "k"}, {"type": "referential", "column": "m", "reference": "others"}))


def rows_of(df):
    return bag(tuple(r) for r in df.collect())


def folders(spark):
    top = f"{shared_folder(spark)}/claimloom".removeprefix("file:")
    return {os.path.join(d, f) for d, _, files in os.walk(top) for f in files if not f.startswith((".", "_"))}


def test_stored_frames_leave_no_shuffle_files(spark, tmp_path):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = files()
    Staging(spark, f"shuffles-{tmp_path.name}").store("rows", spark.range(5000).repartition(5, "id"))
    assert files() <= before


def test_settings_come_back_after_writers_side_by_side(spark):
    before = spark.conf.get(FREE_SHUFFLES, None)

    def write(_):
        with shuffles_freed(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(200)))
    assert spark.conf.get(FREE_SHUFFLES, None) == before


def test_a_filter_of_hashes_lets_all_of_them_pass(spark, tmp_path):
    Staging(spark, f"filter-{tmp_path.name}").store("h", spark.range(0, 9000, 9).select(F.xxhash64("id").alias("h")))
    hashes = Staging(spark, f"filter-{tmp_path.name}").store("h", spark.range(0, 9000, 9).select(F.xxhash64("id").alias("h")))
    passed = [r[0] for r in spark.range(9000).where(may_have(F.xxhash64("id"), hashes, "h")).collect()]
    assert {i for i in range(0, 9000, 9)} <= set(passed)
    assert len(passed) < 2000


@pytest.fixture
def copies(spark, tmp_path):
    """Many rows, a few of them with a key that comes twice or a reference that is missing; null keys and references."""
    n = F.col("id")
    rows = spark.range(20_000).select(
        F.when(n % 997 != 5, F.concat(F.lit("k"), F.when(n % 500 == 3, n - 1).otherwise(n))).alias("k"),
        F.when(n % 331 != 7, F.when(n % 401 == 9, F.lit("none")).otherwise(F.concat(F.lit("m"), n % 3000))).alias("m"),
        (n * 7919 % 20_011).alias("place"),
    )
    rows.repartition(4, "place").write.parquet(str(tmp_path / "rows"))
    others = spark.range(3000).select(F.concat(F.lit("m"), "id").alias("m"))
    return spark.read.parquet(str(tmp_path / "rows")), {"others": others}


def test_only_rows_with_exceptions_are_shuffled(spark, tmp_path, copies):
    df, others = copies
    store = Staging(spark, f"few-{tmp_path.name}").store

    def outcome(**more):
        return apply_rules(df, "rows", RULES, others, ["place"], row_id=row_in_file(), **more)

    few = outcome(store=store, broadcast_bytes=-1)
    assert rows_of(few.checked) == rows_of(outcome().checked)
    assert 0 < few.quarantined.count() < 1000
    text = few.checked._jdf.queryExecution().executedPlan().toString()
    assert "Union" in text
    # each row is either sent to the joins or passed on, and few are sent
    sizes = store("sent", few.checked.where("_dq_failures <> ''"))
    assert sizes.count() == few.quarantined.count()


@pytest.fixture(scope="module")
def pieces(spark):
    return Layers(spark, FOLDER, load_config(CONFIG), piece_lines=2000)


@pytest.mark.parametrize("name", ["csv_quarantine", "csv_lines", "csv_multi_line"])
def test_csv_in_pieces_gives_the_same_rows_and_leaves_no_files(spark, pieces, name):
    drop = ["loaded_at"] if name == "csv_lines" else []
    assert pieces._pieces() > 1
    before = folders(spark)
    found = rows_of(BUILDERS[name](pieces).drop(*drop))
    assert not [f for f in folders(spark) - before if f.endswith(".csv") or "/records/" in f]
    assert found == rows_of(BUILDERS[name](Layers(spark, FOLDER, load_config(CONFIG))).drop(*drop))


def test_pieces_by_order_hold_every_row_once(spark, pieces, tmp_path):
    for name in ("customer", "supplier", "lineitem"):
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        if name == "lineitem":
            rows = rows.withColumn("l_extendedprice", F.when(F.col("l_orderkey") % 5 != 1, F.col("l_extendedprice")))
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    built = Layers(spark, str(tmp_path), load_config(CONFIG))
    parts = built._by_order(3)
    places = [[r[0] for r in p.select(driver_tables.ORDER).collect()] for p in parts]
    whole = driver_tables.claims(spark, str(tmp_path))
    assert sum(map(len, places)) == whole.count()
    assert None in places[0] and max(p for p in places[0] if p is not None) < min(places[1]) < max(places[1]) < min(places[2])


def test_checked_rows_are_the_only_copy(spark):
    built = Layers(spark, FOLDER, load_config(CONFIG))
    before = folders(spark)
    built.stored_outcome("claims")
    new = folders(spark) - before
    assert any("/checked/claims/" in f for f in new) and not any("/bronze/claims/" in f for f in new)
    assert rows_of(built.bronze("claims")) == rows_of(driver_tables.claims(spark, FOLDER))
    # bronze that was given to somebody stays
    given = Layers(spark, FOLDER, load_config(CONFIG))
    bronze = given.bronze("members")
    given.stored_outcome("members")
    assert bronze.count() == driver_tables.members(spark, FOLDER).count()


def test_kpis_alone_store_no_fact(spark):
    built = Layers(spark, FOLDER, load_config(CONFIG))
    before = folders(spark)
    kpis = rows_of(BUILDERS["q_latest_kpis"](built))
    assert not any("/fact_claims/" in f for f in folders(spark) - before)
    built.stored_fact()
    assert kpis == rows_of(BUILDERS["q_latest_kpis"](Layers(spark, FOLDER, load_config(CONFIG))))


def test_the_ledger_leaves_no_staged_copies(spark):
    built = Layers(spark, FOLDER, load_config(CONFIG))
    before = folders(spark)
    assert BUILDERS["build_ledger"](built).count() > 0
    assert not any("/checked/" in f or "/bronze/" in f for f in folders(spark) - before)
