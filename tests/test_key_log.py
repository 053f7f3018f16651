"""The log of seen keys: right after any number of batches, few files, safe to try again."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField

from claimloom.streaming import key_log
from claimloom.streaming.key_log import KeyLog

FIELD = StructField("k", LongType())


def keys(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "k long")


def files(folder):
    return len(list(folder.rglob("*.parquet")))


def test_many_small_batches(spark, tmp_path):
    """Runs and files stay few, and each key is found again, those that were never added are not."""
    log = KeyLog(spark, str(tmp_path), FIELD, fan=3)
    most = 0
    for batch in range(30):
        log.add(keys(spark, [batch, 1000 + batch // 2, None if batch == 4 else 7]), batch)
        most = max(most, len(log.runs()))
        assert all(sum(r["level"] == level for r in log.runs()) < 3 for level in range(5))
    # at most two runs on each of the levels that 30 batches reach
    assert most <= 2 * 4
    assert files(tmp_path) <= 2 * (2 * 4 + 3 + 1)
    found = log.seen(keys(spark, [0, 13, 29, 30, 1000, 1014, 1015, 7, None, 555]), 30).distinct()
    wanted = {0, 13, 29, 1000, 1014, 7, None}
    assert {r[0] for r in found.collect()} & {0, 13, 29, 30, 1000, 1014, 1015, 7, None, 555} == wanted


def test_a_batch_that_is_tried_again_replaces_its_own(spark, tmp_path):
    log = KeyLog(spark, str(tmp_path), FIELD, fan=2)
    for batch in range(3):
        log.add(keys(spark, [batch]), batch)
    log.add(keys(spark, [77]), 3)  # merges
    log.add(keys(spark, [88]), 3)
    everything = keys(spark, [0, 1, 2, 77, 88])
    assert sorted(r[0] for r in log.seen(everything, 4).collect()) == [0, 1, 2, 88]
    # what came before the batch is what it was checked against, also the second time
    assert sorted(r[0] for r in log.seen(everything, 3).collect()) == [0, 1, 2]


def test_a_batch_that_dies_before_its_manifest_leaves_nothing(spark, tmp_path, monkeypatch):
    log = KeyLog(spark, str(tmp_path), FIELD)
    log.add(keys(spark, [1]), 0)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(key_log.Folder, "write_text", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        log.add(keys(spark, [2]), 1)
    assert log.seen(keys(spark, [2]), 2) is None
    log.add(keys(spark, [2]), 1)
    assert [r[0] for r in log.seen(keys(spark, [2]), 2).collect()] == [2]
    assert len(list((tmp_path / "runs").iterdir())) == 2


def test_large_runs_have_several_files_by_part(spark, tmp_path):
    log = KeyLog(spark, str(tmp_path), StructField("k", StringType()), file_keys=300)
    rows = spark.range(1000).selectExpr("concat('key-', id) AS k")
    log.add(rows, 0)
    (run,) = log.runs()
    assert len(list((tmp_path / "runs" / run["name"] / "keys").glob("*.parquet"))) == 4
    assert log.seen(rows.limit(5), 1).count() < 60
    assert log.seen(rows, 1).distinct().count() == 1000
    assert log.seen(spark.range(1000, 1010).selectExpr("concat('none-', id) AS k"), 0) is None
