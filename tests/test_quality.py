"""Clean and quarantined rows, report, and a comparison with plain Python.

Some example values are fixed: the inputs that FIXTURES.md A1 lists.
"""

import random

import pytest

from claimloom.operators.quality import (
    apply_rules,
    reason_counts,
    total_failures,
    union_reports,
)
from claimloom.operators.rules import rule_from_dict

RULES = [
    rule_from_dict(r)
    for r in (
        {"type": "unique", "column": "id", "description": "once"},
        {"type": "min_value", "column": "v", "threshold": 10},
        {"type": "referential", "column": "ref", "reference": "others"},
        {"type": "allowed_values", "column": "id", "values": [f"K{i}" for i in range(30)]},
    )
]


def random_rows(n=600, seed=7):
    """A third of all ids are one id, and a third of all references one key."""
    rng = random.Random(seed)
    rows = []
    for pos in range(n):
        key = "K0" if rng.random() < 0.34 else rng.choice([None, *[f"K{i}" for i in range(40)]])
        ref = "R0" if rng.random() < 0.34 else rng.choice([None, *[f"R{i}" for i in range(9)]])
        rows.append((key, rng.choice([None, 1.0, 10.0, 50.0]), ref, pos))
    return rows


def expected_reasons(rows, known):
    seen, out = set(), {}
    for key, v, ref, pos in sorted(rows, key=lambda r: r[3]):
        text = "unique:id;" if key in seen else ""
        seen.add(key)
        text += "min_value:v;" if v is not None and v < 10 else ""
        text += "referential:ref;" if ref not in known else ""
        allowed = key is not None and int(key[1:]) < 30
        out[pos] = text + ("" if allowed else "allowed_values:id;")
    return out


@pytest.mark.parametrize("broadcast_bytes", [-1, 100_000])
@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_equals_plain_python_on_hot_keys(spark, partitions, broadcast_bytes):
    rows = random_rows()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id string, v double, ref string, pos long")
    known = ["R0", "R3", "R5"]
    others = spark.createDataFrame([(k,) for k in known], "k string")
    outcome = apply_rules(
        df.repartition(partitions),
        "t",
        RULES,
        {"others": others},
        ["pos"],
        rows_per_task=20,
        broadcast_bytes=broadcast_bytes,
    )
    found = {r.pos: r._dq_failures for r in outcome.checked.collect()}
    expected = expected_reasons(rows, known)
    assert found == expected
    assert outcome.clean.columns == ["id", "v", "ref"]
    assert outcome.quarantined.columns == ["id", "v", "ref", "_dq_failures"]
    assert outcome.clean.count() == sum(t == "" for t in expected.values())
    assert outcome.quarantined.count() == sum(t != "" for t in expected.values())
    failed = [r.rows_failed for r in outcome.report.collect()]
    assert failed == [
        sum(rule.reason in t for t in expected.values()) for rule in RULES
    ]


def test_order_by_several_columns(spark):
    rows = [("A", "f2", 1), ("A", "f1", 9), ("B", "f1", 2), ("A", "f1", 3)]
    df = spark.createDataFrame(rows, "id string, file string, line long")
    outcome = apply_rules(df, "t", RULES[:1], order_by=["file", "line"])
    kept = {(r.id, r.file, r.line) for r in outcome.checked.where("not _dq_0").collect()}
    assert kept == {("A", "f1", 3), ("B", "f1", 2)}


def test_report(spark):
    df = spark.createDataFrame([(1.0,), (None,), (None,), (1.0,)], "x double")
    rule = rule_from_dict({"type": "not_null", "column": "x", "description": "needed"})
    report = apply_rules(df, "test", [rule]).report
    assert report.columns == [
        "dataset", "rule_type", "column", "description", "rows_checked", "rows_failed", "pass_rate_pct",
    ]
    assert [tuple(r) for r in report.collect()] == [("test", "not_null", "x", "needed", 4, 2, 50.0)]


@pytest.mark.parametrize("n,bad,rate", [(0, 0, 100.0), (32, 3, 90.62), (32, 1, 96.88), (3, 1, 66.67)])
def test_pass_rate_rounds_halves_to_even(spark, n, bad, rate):
    df = spark.range(n).selectExpr(f"if(id < {bad}, null, id) AS x")
    report = apply_rules(df, "t", [rule_from_dict({"type": "not_null", "column": "x"})]).report
    assert report.first().pass_rate_pct == rate


def test_no_rules_keeps_everything(spark):
    outcome = apply_rules(spark.range(3), "t", [])
    assert outcome.clean.count() == 3
    assert outcome.quarantined.count() == 0
    assert outcome.report.count() == 0


def test_failures_count_per_rule_and_per_reason(spark):
    df = spark.createDataFrame([(None, -1.0), ("a", -1.0), ("b", 1.0)], "id string, v double")
    rules = [
        rule_from_dict({"type": "not_null", "column": "id"}),
        rule_from_dict({"type": "min_value", "column": "v", "threshold": 0}),
    ]
    outcome = apply_rules(df, "t", rules)
    assert total_failures(union_reports([outcome, outcome])).first()[0] == 6
    counts = {r.reason: r["rows"] for r in reason_counts(outcome.quarantined).collect()}
    assert counts == {"not_null:id": 1, "min_value:v": 2}
