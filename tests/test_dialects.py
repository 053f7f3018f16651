"""Patterns in Python's dialect against Python itself, and dates in declared formats."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from test_refresh import STAMP, config_for, quarantine, table, write_csv

from claimloom.functions.dates import best_formats, check_format, chosen_formats, format_counts, misses, parse_by
from claimloom.functions.patterns import java_pattern
from claimloom.operators.rules import rule_from_dict
from claimloom.plans.refresh import build_silver, load_bronze

PATTERNS = [
    r"abc", r"a.c", r"(?s)a.c", r"a$", r"a\Z", r"^a", r"(?m)^b$|c", r"\d+", r"(?a)\d+", r"[\d\s]+x", r"\w+$", r"(?a)\w+$", r"\s", r"\S\s\S",
    r"[^\w]", r"[^\W\d]+", r"[\D]", r"a\b", r"a\B.", r"\bé", r"(?P<x>a)(?P=x)", r"(a)|b\1", r"(?:ab)+?c", r"a{2,3}", r"a{,2}b", r"(?i)straße|Ä",
    r"(?i:A)b", r"(?>a+)b", r"a*+b", r"(?=a)\w", r"(?!a)\w", r"b(?<=b)c", r"b(?<!b)c", r"[a\-z\]^]", r"\x41é", r"a|b|", r"", r"(?x) a  b # c",
    r"\.\*\\", r"[&&a]", r"[a-f&&b]", r"#\{x\}", r"(?:a|b)*c", r"\Aab", r"[^a]b", r"[^\n]\n", r"..", r"(a)?b", "\t", "é+", r"[日-本]",
]
TEXTS = [
    "", "a", "abc", "a\nc", "a\n", "a\r\n", "a\r", "a\x85", "b\nb", "x\nb\nc", "12", "٣٤", "１２x", "5 x", "word", "wörd_9", "x²", "½", "٣", " ", "\xa0y",
    "a b", "a\x1cb", "_", "-", "é", "aé", "aa", "aab", "aaab", "abab", "ababc", "b", "ba", "bb", "bc", "cc", "STRASSE", "straße", "STRAßE", "ä", "Ä", "Ab", "ab",
    "AB", "]", "^", "z", "Aé", ".*\\", "&", "&&a", "e", "#{x}", "ababac", "c", "q\n", "  ", "日", "中", "\U0001f600\U0001f600", "́", "á",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_matches_what_python_matches(spark, pattern):
    java = spark.sparkContext._jvm.java.util.regex.Pattern.compile(rf"\A(?:{java_pattern(pattern)})")
    expected = {t for t in TEXTS if re.match(pattern, t)}
    assert {t for t in TEXTS if java.matcher(t).find()} == expected


def test_long_texts_do_not_exhaust_the_stack(spark):
    text = "ab1 " * 50_000
    for pattern in (r".*z", r"[\w\s]*z", r"\w*\s\w", r"[^z]*$"):
        java = spark.sparkContext._jvm.java.util.regex.Pattern.compile(rf"\A(?:{java_pattern(pattern)})")
        assert java.matcher(text).find() == bool(re.match(pattern, text))


@pytest.mark.parametrize("pattern", [r"(a)?(?(1)b|c)", r"(a", r"[z-a]", r"*", 5, None])
def test_what_has_no_java_form_is_refused_before_a_job(pattern):
    with pytest.raises(ValueError, match="Java form|broken pattern|no text"):
        rule_from_dict({"type": "regex_match", "column": "x", "pattern": pattern})


def test_dialects_are_declared():
    own = rule_from_dict({"type": "regex_match", "column": "x", "pattern": r"\p{Lu}+", "dialect": "java"})
    assert own.args["java"] == r"\p{Lu}+"
    with pytest.raises(ValueError, match="dialect"):
        rule_from_dict({"type": "regex_match", "column": "x", "pattern": "a", "dialect": "perl"})


FORMATS = ("iso", "dd/MM/yyyy", "MM/dd/yyyy", "MMM d, yyyy", "dd.MM.yyyy HH:mm")


def test_the_format_that_reads_most_wins(spark):
    rows = [
        ("01/02/2024", "12/31/2024", "2024-05-06", None, "Jan 3, 2024", "01/02/2024"),
        ("31/12/2024", "01/02/2024", "2024-05-06 10:11:12", None, "May 13, 2024", "03/04/2024"),
        (" 13/01/2024", "soon", "06.05.2024 23:59", None, "13 May", None),
        (None, "11/30/2024", "2024-02-30", None, "", "05/06/2024"),
    ]
    columns = ["day_first", "month_first", "iso_date", "none", "named", "tied"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    chosen = chosen_formats(df, columns, FORMATS)
    assert chosen == {
        "day_first": "dd/MM/yyyy", "month_first": "MM/dd/yyyy", "iso_date": "iso",
        "none": "iso", "named": "MMM d, yyyy", "tied": "dd/MM/yyyy",
    }
    assert best_formats(format_counts(df, ["tied"], FORMATS[::-1])) == {"tied": "MM/dd/yyyy"}
    found = {r["column"]: (r["cells"], r["read"], r["missed"]) for r in misses(df, chosen).collect()}
    assert found == {
        "day_first": (3, 3, 0), "month_first": (4, 3, 1), "iso_date": (4, 2, 2), "none": (0, 0, 0), "named": (4, 2, 2), "tied": (3, 3, 0),
    }
    read = df.select(parse_by(F.col("iso_date"), "dd.MM.yyyy HH:mm")).collect()
    assert [r[0] for r in read] == [None, None, dt.datetime(2024, 5, 6, 23, 59), None]
    assert chosen_formats(df, [], FORMATS) == {} and chosen_formats(df, ["tied"], FORMATS[:1]) == {"tied": "iso"}


@pytest.mark.parametrize("fmt", ["", 5, "dd/MM", "yyyy 'of MM", "yyyy-jj-MM"])
def test_what_is_no_format_is_refused(tmp_path, fmt):
    with pytest.raises(ValueError, match="date format"):
        check_format(fmt)
    with pytest.raises(ValueError, match="date format"):
        config_for(tmp_path, "", datasets={"things": {"file": "x", "date_formats": [fmt, "iso"]}})


def test_a_run_reads_each_column_in_its_format(spark, tmp_path):
    things = {
        "file": "t.csv", "key": "k", "columns": {"start": "timestamp", "stop": "timestamp"}, "date_formats": ["iso", "dd/MM/yyyy", "MM/dd/yyyy"],
        "rules": [{"type": "date_order", "column_a": "start", "column_b": "stop"}],
    }
    config = config_for(tmp_path, "formats_", datasets={"things": things}, on_bad_value="quarantine")
    write_csv(tmp_path / "raw_zone/t.csv", ["k", "start", "stop"], [
        ("1", "25/01/2024", "01/26/2024"), ("2", "26/01/2024", "01/25/2024"), ("3", "2024-01-25", "01/26/2024"), ("4", "", "02/13/2024"),
    ])
    build_silver(spark, config, load_bronze(spark, config, STAMP))
    assert {(r.k, r.start, r.stop) for r in table(spark, config, "silver", "things").select("k", "start", "stop").collect()} == {
        ("1", dt.datetime(2024, 1, 25), dt.datetime(2024, 1, 26)), ("4", None, dt.datetime(2024, 2, 13)),
    }
    assert {r.k: r._dq_failures for r in quarantine(spark, config, "things").collect()} == {
        "2": "date_order:start->stop;", "3": "readable:start;",
    }
