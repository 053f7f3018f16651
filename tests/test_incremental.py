"""Files loaded in batches give what one full run over all of them gives."""

import re

import pytest
from pyspark.sql import functions as F
from compare import bag
from conftest import TESTDATA
from test_refresh import STAMP, write_csv

from claimloom.operators.quality import apply_rules
from claimloom.plans.conform import conform
from claimloom.plans.layers import CONFIG
from claimloom.sources import driver_tables
from claimloom.operators.rules import rule_from_dict
from claimloom.sources.config import CORRUPT_LINE, Dataset, load_config
from claimloom.sources.extracts import ROW_ORDER, read_extract, stream_extract
from claimloom.streaming.incremental import IncrementalLoad


@pytest.fixture
def claims(spark):
    df = driver_tables.claims(spark, str(TESTDATA / "sf0.001"))
    # Copies come at the end, so many have their first row in another file.
    rows = df.orderBy(df[driver_tables.ORDER] % 2, driver_tables.ORDER).drop(driver_tables.ORDER)
    return rows.columns, [tuple(r) for r in rows.collect()]


def test_batches_equal_a_full_run(spark, tmp_path, claims):
    columns, rows = claims
    dataset = load_config(CONFIG).datasets["claims"]
    keys = {
        "members": spark.createDataFrame([(r[1],) for r in rows if r[1] and r[1][-1] in "13579"], "member_id string"),
        "providers": spark.createDataFrame([(f"PRV000{i}",) for i in range(8)], "provider_id string"),
    }
    raw = tmp_path / "raw"
    load = IncrementalLoad(dataset, str(tmp_path / "out"), lambda: keys)

    def arrive(part, lines):
        write_csv(raw / f"part{part}.csv", columns, lines)

    def run():
        query = load.start(stream_extract(spark, str(raw), columns))
        query.awaitTermination()

    arrive(0, rows[:2500])
    run()
    arrive(1, rows[2500:5000])
    run()
    run()  # nothing new
    arrive(2, rows[5000:])
    run()

    extract = read_extract(spark, str(raw), STAMP)
    full = apply_rules(extract, "claims", dataset.rules, keys, ROW_ORDER)

    def values(df):
        return bag(tuple(r) for r in df.drop("batch_id", "_loaded_at", "_source_file").collect())

    assert values(load.rows(spark, "silver")) == values(conform("claims", full.clean, dataset.kinds))
    assert values(load.rows(spark, "quarantine")) == values(full.quarantined)

    # A batch that is tried again replaces what it left before.
    before = values(load.rows(spark, "silver")), values(load.rows(spark, "quarantine"))
    lines = spark.read.options(header=True).csv(str(raw / "part2.csv"))
    load.load_batch(lines.select("*", F.lit(None).cast("string").alias(CORRUPT_LINE), "_metadata"), 2)
    assert (values(load.rows(spark, "silver")), values(load.rows(spark, "quarantine"))) == before


def test_a_batch_reads_only_the_parts_its_keys_fall_into(spark, tmp_path):
    dataset = Dataset("things", "x", "thing_id", (rule_from_dict({"type": "unique", "column": "thing_id"}),))
    load = IncrementalLoad(dataset, str(tmp_path / "out"))

    def lines(*ids):
        rows = [(i, None) for i in ids]
        df = spark.createDataFrame(rows, f"thing_id string, {CORRUPT_LINE} string")
        meta = "named_struct('file_path', 'f', 'file_name', 'f', 'file_block_start', 0L)"
        return df.selectExpr("*", f"{meta} AS _metadata")

    load.load_batch(lines(*(f"k{i}" for i in range(400))), 0)
    batch = spark.createDataFrame([("k7",), ("new",)], "thing_id string")
    seen = load._log(batch).seen(batch, 1)
    text = seen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[.*(In|EqualTo)\(part", text)
    assert 0 < seen.count() <= 20
    load.load_batch(lines("k7", "new", "new", None), 1)
    load.load_batch(lines(None, "newer"), 2)
    assert sorted(r[0] or "" for r in load.rows(spark, "quarantine").select("thing_id").collect()) == ["", "k7", "new"]
    stamps = {r[0] for r in load.rows(spark, "bronze").select("_loaded_at").collect()}
    assert len(stamps) == 3 and all(s.startswith("20") for s in stamps)
