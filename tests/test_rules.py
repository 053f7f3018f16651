"""Each rule on good, bad, missing, unreadable and repeated values.

Some example values are fixed: the inputs that FIXTURES.md A1 lists.
"""

import pytest

from claimloom.operators.quality import apply_rules
from claimloom.operators.rules import rule_from_dict


def reasons(spark, rows, schema, *rules, **kw):
    """Reasons text per row, in input order."""
    numbered = [(*row, i) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"{schema}, pos long")
    outcome = apply_rules(df, "t", [rule_from_dict(r) for r in rules], order_by=["pos"], **kw)
    return [r[0] for r in outcome.checked.orderBy("pos").select("_dq_failures").collect()]


def fails(spark, values, kind, rule, **kw):
    rule = {"column": "x", **rule}
    return [text != "" for text in reasons(spark, [(v,) for v in values], f"x {kind}", rule, **kw)]


def keys(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}")


def test_not_null(spark):
    assert fails(spark, ["Dublin", None, "Cork", ""], "string", {"type": "not_null"}) == [
        False, True, False, False,
    ]
    assert fails(spark, [1.0, None, float("nan")], "double", {"type": "not_null"}) == [
        False, True, True,
    ]


def test_unique_keeps_the_first_in_input_order(spark):
    assert fails(spark, ["A", "B", "A", "A"], "string", {"type": "unique"}) == [
        False, False, True, True,
    ]


def test_unique_takes_nulls_as_one_key(spark):
    assert fails(spark, [None, "A", None], "string", {"type": "unique"}) == [False, False, True]


def test_unique_needs_an_order(spark):
    df = keys(spark, ["A"])
    with pytest.raises(ValueError, match="order_by"):
        apply_rules(df, "t", [rule_from_dict({"type": "unique", "column": "k"})])


def test_allowed_values(spark):
    rule = {"type": "allowed_values", "values": ["APPROVED", "PENDING"]}
    values = ["APPROVED", "APRVD", "PENDING", None, "approved"]
    assert fails(spark, values, "string", rule) == [False, True, False, True, True]


def test_allowed_values_of_another_type_never_match(spark):
    rule = {"type": "allowed_values", "values": ["1", 2]}
    assert fails(spark, [1, 2, None], "int", rule) == [True, False, True]
    assert fails(spark, ["1", "2"], "string", rule) == [False, True]


def test_allowed_values_may_contain_null(spark):
    rule = {"type": "allowed_values", "values": ["a", None]}
    assert fails(spark, ["a", "b", None], "string", rule) == [False, True, False]


def test_min_value(spark):
    rule = {"type": "min_value", "threshold": 0}
    assert fails(spark, [100.0, -50.0, 0.0, None, float("nan")], "double", rule) == [
        False, True, False, False, False,
    ]
    assert fails(spark, ["5", "-1", "much", None], "string", rule) == [False, True, False, False]


def test_regex_match_is_anchored_at_the_start_only(spark):
    rule = {"type": "regex_match", "pattern": r"MBR\d{2}"}
    values = ["MBR01", "MBR012", "xMBR01", "MBR1", None, ""]
    assert fails(spark, values, "string", rule) == [False, False, True, True, True, True]


def test_regex_match_anchors_every_alternative(spark):
    rule = {"type": "regex_match", "pattern": "a|b"}
    assert fails(spark, ["ac", "bc", "cb"], "string", rule) == [False, False, True]


def test_date_order(spark):
    rows = [
        ("2025-01-10", "2025-01-05"),
        ("2025-01-10", "2025-01-20"),
        ("2025-01-10", "2025-01-10"),
        (None, "2025-01-10"),
        ("2025-01-10", None),
        ("soon", "2025-01-10"),
        ("2025-01-10 08:00:00", "2025-01-10 07:59:59"),
    ]
    rule = {"type": "date_order", "column_a": "a", "column_b": "b"}
    found = reasons(spark, rows, "a string, b string", rule)
    assert found == ["date_order:a->b;", "", "", "", "", "", "date_order:a->b;"]


@pytest.mark.parametrize("broadcast_bytes", [-1, 100_000])
def test_referential(spark, broadcast_bytes):
    rule = {"type": "referential", "reference": "members"}
    known = {"members": keys(spark, ["M1", "M2", "M1"])}
    values = ["M1", "M9", None, "M1"]
    found = fails(spark, values, "string", rule, references=known, broadcast_bytes=broadcast_bytes)
    assert found == [False, True, True, False]


@pytest.mark.parametrize("broadcast_bytes", [-1, 100_000])
def test_referential_null_is_known_if_the_reference_has_it(spark, broadcast_bytes):
    rule = {"type": "referential", "reference": "members"}
    known = {"members": keys(spark, ["M1", None])}
    found = fails(spark, ["M1", None], "string", rule, references=known, broadcast_bytes=broadcast_bytes)
    assert found == [False, False]


@pytest.mark.parametrize("broadcast_bytes", [-1, 100_000])
def test_referential_to_keys_of_another_type(spark, broadcast_bytes):
    rule = {"type": "referential", "reference": "members"}
    limits = {"broadcast_bytes": broadcast_bytes, "rows_per_task": 2}
    known = {"members": keys(spark, [1, 2], "int")}
    found = fails(spark, [1] * 9 + [3], "bigint", rule, references=known, **limits)
    assert found == [False] * 9 + [True]


def test_referential_to_nothing(spark):
    rule = {"type": "referential", "reference": "members"}
    assert fails(spark, ["M1"], "string", rule, references={"members": keys(spark, [])}) == [True]
    with pytest.raises(ValueError, match="members"):
        fails(spark, ["M1"], "string", rule)


def test_mistakes_are_found_before_a_job():
    with pytest.raises(ValueError, match="unknown rule type"):
        rule_from_dict({"type": "no_such", "column": "x"})
    with pytest.raises(ValueError, match="threshold"):
        rule_from_dict({"type": "min_value", "column": "x"})


def test_reasons_are_in_rule_order_and_rules_see_all_rows(spark):
    rows = [("A", -1.0), ("A", 5.0), ("B", None), ("B", -2.0)]
    rules = [
        {"type": "unique", "column": "id"},
        {"type": "min_value", "column": "v", "threshold": 0},
        {"type": "not_null", "column": "v"},
    ]
    # The second A is a copy though the first A falls for another reason.
    assert reasons(spark, rows, "id string, v double", *rules) == [
        "min_value:v;",
        "unique:id;",
        "not_null:v;",
        "unique:id;min_value:v;",
    ]


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_unique_keeps_one_of_tied_rows(spark, partitions):
    """Equal positions, null positions, and rows that are equal in everything."""
    rows = [("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z"), ("b", None, "z"), ("c", None, "q"), ("c", None, "q")]
    rows += [("d", 5, "same")] * 40 + [(None, 1, "n"), (None, 1, "n"), ("e", 1, "one")]
    df = spark.createDataFrame(rows, "k string, pos long, v string").repartition(partitions)
    outcome = apply_rules(df, "t", [rule_from_dict({"type": "unique", "column": "k"})], order_by=["pos"])
    assert sorted(r.k or "" for r in outcome.clean.collect()) == ["", "a", "b", "c", "d", "e"]
    assert outcome.quarantined.count() == len(rows) - 6


def test_allowed_values_with_null_only(spark):
    rule = {"type": "allowed_values", "values": [None]}
    assert fails(spark, ["a", None], "string", rule) == [True, False]


def test_type_suffixes_are_no_numbers(spark):
    rule = {"type": "min_value", "threshold": 0}
    values = ["-5", "-5f", "-5d", "-1e3", " -2 ", "-0x1", "-inf", "1,5", None]
    assert fails(spark, values, "string", rule) == [True, False, False, True, True, False, True, False, False]


def test_regex_match_sees_plain_doubles(spark):
    rule = {"type": "regex_match", "pattern": r"\d+\.\d+$"}
    assert fails(spark, [10000000.0, 0.001, 12.5, 1e-7], "double", rule) == [False, False, False, True]


def test_readable_and_whole_line(spark):
    number, day = ({"type": "readable", "kind": k} for k in ("double", "timestamp"))
    assert fails(spark, ["1,200.50", "12.5", None, "7d"], "string", number) == [True, False, False, True]
    assert fails(spark, ["2026-02-30", "2026-02-28", None, "soon"], "string", day) == [True, False, False, True]
    assert fails(spark, [None, "a,b"], "string", {"type": "whole_line"}) == [False, True]


@pytest.mark.parametrize("rule, complaint", [
    ({"type": "min_value", "column": "x", "threshold": "much"}, "no number"),
    ({"type": "regex_match", "column": "x", "pattern": "(a"}, "broken pattern"),
    ({"type": "regex_match", "column": "x", "pattern": 5}, "no text"),
])
def test_broken_arguments_are_found_up_front(rule, complaint):
    with pytest.raises(ValueError, match=complaint):
        rule_from_dict(rule)
