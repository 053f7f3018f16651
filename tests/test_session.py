"""The shared folder on a cluster; a local session stands in for it under another master's name."""

import pytest

from claimloom import session
from claimloom.plans.layers import CONFIG, Layers
from claimloom.plans.registry import BUILDERS
from claimloom.sources.config import load_config

#: One query of each way to the shared folder: staged rows, lines of CSV, tables.
QUERIES = ("conform_members", "check_rate_bounds", "csv_lines", "catalog_listing")


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    return spark


@pytest.fixture
def tables(spark, tmp_path):
    folder = f"{tmp_path}/tables"
    rows = {
        "customer": "id c_custkey, concat('C', id) c_name, int(id % 25) c_nationkey, 'BUILDING' c_mktsegment",
        "supplier": "id s_suppkey, concat('S', id) s_name, int(id % 25) s_nationkey",
        "lineitem": "id l_orderkey, id l_partkey, id % 40 l_suppkey, int(id % 7) l_linenumber, "
        "double(1 + id % 50) l_quantity, double(id + 100) l_extendedprice",
    }
    for name, columns in rows.items():
        made = spark.range(40 if name == "supplier" else 300).selectExpr(f"struct({columns}) r").select("r.*")
        made.write.parquet(f"{folder}/{name}.parquet")
    return folder


def named(spark, monkeypatch, folder):
    get = spark.conf.get
    monkeypatch.setattr(spark.conf, "get", lambda k, *a: folder if k == "spark.checkpoint.dir" else get(k, *a), raising=False)


@pytest.mark.parametrize("scheme", ["file:", "file://", ""])
def test_a_mounted_folder_is_taken_on_a_cluster(cluster, monkeypatch, tmp_path, scheme):
    named(cluster, monkeypatch, f"{scheme}{tmp_path}/mounted")
    assert session.shared_folder(cluster) == f"{scheme}{tmp_path}/mounted"
    assert not list(tmp_path.rglob("probe-*"))


def test_a_folder_is_tried_once(cluster, monkeypatch, tmp_path):
    named(cluster, monkeypatch, f"file://{tmp_path}/mounted")
    session.shared_folder(cluster)
    monkeypatch.setattr(type(cluster), "range", None)
    session.shared_folder(cluster)


def test_a_folder_that_cannot_be_made_is_refused_on_a_cluster(cluster, monkeypatch, tmp_path):
    (tmp_path / "file").write_text("")
    named(cluster, monkeypatch, f"file://{tmp_path}/file/below")
    with pytest.raises(ValueError, match="one machine"):
        session.shared_folder(cluster)


def test_a_folder_that_lacks_files_of_others_is_refused_on_a_cluster(cluster, monkeypatch, tmp_path):
    named(cluster, monkeypatch, f"file://{tmp_path}/mounted")
    whole = type(cluster).range
    # as if the machine of the first task kept its file for itself
    monkeypatch.setattr(type(cluster), "range", lambda self, *a: whole(self, *a).where("id > 0"))
    with pytest.raises(ValueError, match="one machine"):
        session.shared_folder(cluster)


@pytest.mark.parametrize("name", QUERIES)
def test_queries_run_on_a_cluster_with_a_mounted_folder(cluster, tables, name):
    assert BUILDERS[name](Layers(cluster, tables, load_config(CONFIG))).count() > 0
