"""CSV records with line breaks: the same whatever the blocks, and as a reader of whole files has them."""

import random

import pytest
from compare import bag
from test_refresh import STAMP, config_for, table, write_csv

from claimloom.plans.refresh import build_silver, load_bronze
from claimloom.sources.extracts import ROW_ORDER, read_extract

HEADER = ["a", "b", "c"]


def cell(pick):
    return pick.choice(["x", "two words", "", "one\nbreak", "\n", "\n\n\n" * 30, 'say "hi"', "a,b", '"', "\n,\n", "é\n日", "ends,\n"])


def files(folder, seed):
    """The rows of three files."""
    pick, written = random.Random(seed), []
    for f in range(3):
        rows = [[str(n), cell(pick), cell(pick)] for n in range(f * 1000, f * 1000 + pick.choice([1, 40, 400]))]
        rows[0][1] = "long\n" * 2000  # over many blocks
        write_csv(folder / f"part{f}.csv", HEADER, rows)
        written += [tuple(c or None for c in row) for row in rows]
    return written


@pytest.fixture
def split(spark):
    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield to
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("seed", [1, 2])
def test_same_records_at_any_split(spark, tmp_path, split, seed):
    expected, path = files(tmp_path / "x", seed), str(tmp_path / "x")
    for size in (10_000_000, 1500, 97):
        split(size)
        df = read_extract(spark, path, STAMP, HEADER, multi_line=True)
        found = [tuple(r) for r in df.orderBy(*ROW_ORDER).select(*HEADER).collect()]
        assert found == expected, size
        assert df.select(*ROW_ORDER).distinct().count() == len(found)
        assert {r[0] for r in df.select("_source_file").distinct().collect()} == {f"part{f}.csv" for f in range(3)}


def test_ragged_lines_carriage_returns_and_headers(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n\r\n2,3,4\r\n5\r\n')
    df = read_extract(spark, str(tmp_path / "x.csv"), STAMP, multi_line=True)
    rows = {r.a: (r.b, r._corrupt_line) for r in df.collect()}
    assert rows == {"1": ("x\r\ny", None), "2": ("3", "2,3,4"), "5": (None, "5")}
    write_csv(tmp_path / "y/one.csv", ["a", "b"], [("1", "2")])
    write_csv(tmp_path / "y/two.csv", ["b", "a"], [("1", "2")])
    with pytest.raises(Exception, match="not the header"):
        read_extract(spark, str(tmp_path / "y"), STAMP, multi_line=True).collect()


def test_quotes_that_do_not_add_up_end_with_the_file(spark, tmp_path, split):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/one.csv").write_text("a,b\n1,2\n3,\"open\n5,6\n7,8\n")
    (tmp_path / "x/two.csv").write_text("a,b\n9,10\n")
    split(7)
    df = read_extract(spark, str(tmp_path / "x"), STAMP, multi_line=True)
    assert bag(tuple(r) for r in df.select("a").collect()) == bag([("1",), ("3",), ("9",)])


def test_a_full_run_with_line_breaks(spark, tmp_path):
    things = {"file": "t.csv", "key": "k", "multi_line": True, "rules": [{"type": "unique", "column": "k"}]}
    config = config_for(tmp_path, "breaks_", datasets={"things": things})
    write_csv(tmp_path / "raw_zone/t.csv", ["k", "v"], [("1", "a\nb"), ("2", "c"), ("1", "d\ne")])
    build_silver(spark, config, load_bronze(spark, config, STAMP))
    assert {(r.k, r.v) for r in table(spark, config, "silver", "things").collect()} == {("1", "a\nb"), ("2", "c")}
