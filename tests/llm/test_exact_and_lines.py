"""Exact dedup and line dedup on odd rows, and all queries that have SQL against DuckDB."""

import hashlib
import random
from collections import defaultdict

import pytest
from compare import duck, duck_bag, spark_bag
from conftest import TESTDATA

from claimloom.llm import common, exact_dedup, line_dedup
from claimloom.llm.oracle import SQL
from claimloom.llm.registry import QUERIES


@pytest.mark.parametrize("name", SQL)
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_same_rows_as_the_sql(spark, name, sf):
    folder = f"{TESTDATA}/sf{sf}"
    con = duck(folder, ["documents", "pages", "benchmark", "labels", "conversations"])
    assert spark_bag(QUERIES[name](spark, folder)) == duck_bag(con, SQL[name])


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_groups(rows):
    ids = defaultdict(list)
    for doc, text in rows:
        ids[lowered(text)].append(doc)
    return sorted(
        (
            (doc, max((i for i in ids[lowered(text)] if i is not None), default=None), len(ids[lowered(text)]))
            for doc, text in rows
        ),
        key=repr,
    )


def copies(seed):
    pick = random.Random(seed)
    texts = ["", None, "Ä", "ä", "A", "a", "x" * 5000, "hot", "HOT", "hOt"]
    rows = [(n, pick.choice(texts + ["hot"] * 8)) for n in range(300)]
    return rows + [(n, f"text {n % 150}") for n in range(300, 700)] + [(None, "hot"), (None, "alone"), (5, "twice"), (5, "twice")]


@pytest.mark.parametrize("parts, fan_in, run_rows", [(1, 8, 200_000), (9, 2, 7), (30, 3, 50)])
def test_groups(spark, monkeypatch, parts, fan_in, run_rows):
    monkeypatch.setattr(exact_dedup, "RUN_ROWS", run_rows)
    rows = copies(parts)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, keep_id string")
    found = exact_dedup.resolve(docs.repartition(parts), fan_in).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in found), key=repr) == plain_groups(rows)
    digests = {hashlib.sha256(lowered(t).encode()).digest() for _, t in rows}
    assert {bytes(r["digest"]) for r in found} == digests


def test_deduplicate_keeps_all_columns(spark):
    rows = [(1, "a", "x"), (2, "A", "y"), (3, "b", "z"), (None, "A", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    assert sorted(map(tuple, exact_dedup.deduplicate(docs).collect()), key=repr) == [(2, "A", "y"), (3, "b", "z")]
    assert sorted(map(tuple, exact_dedup.deduplicate(docs, "first_id").collect())) == [(1, "a", "x"), (3, "b", "z")]
    assert exact_dedup.resolve(docs.limit(0)).collect() == []


@pytest.mark.parametrize("small", [True, False])
def test_deduplicate_goes_by_id_and_text(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    rows = [
        (1, "a"), (2, "A"), (None, "a"), (None, "unique"), (None, "Ä"), (None, "both null"), (None, "both null"),
        (3, "b"), (4, "b"), (3, "other text of 3"), (None, None), (5, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone = {(1, "a"), (None, "a"), (3, "b"), (None, None)}
    kept = sorted((r for r in rows if r not in gone), key=repr)
    assert sorted(map(tuple, exact_dedup.deduplicate(docs).collect()), key=repr) == kept


def plain_lines(rows, least):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\r\x0b\x0c"):
                sites[line].add(site)
    out = []
    for doc, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [line for line in lines if len(sites[line]) < least]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 3, 10])
def test_lines(spark, least):
    pick = random.Random(least)
    common = [f"seen on {n} sites" for n in range(1, 25)]
    rows = []
    for doc in range(400):
        site = pick.randrange(25)
        lines = [f"own {doc}", "", "  \t", "É\xa0"] + [c for n, c in enumerate(common, 1) if site < n and pick.random() < 0.8]
        pick.shuffle(lines)
        rows.append((doc, "\n".join(lines), f"s{site}"))
    rows += [(400, None, "s1"), (401, "", "s1"), (402, "\n\n", None), (403, "seen on 2 sites", None)]
    rows += [(None, "seen on 24 sites\nx", "s3"), (7, *rows[7][1:])]
    schema = "doc_id long, text string, source string"
    docs = spark.createDataFrame(rows, schema).repartition(4)
    found = line_dedup.remove_boilerplate(docs, min_sites=least).select(
        "row.doc_id", "n_lines", "n_removed", "kept_text"
    )
    assert sorted(map(tuple, found.collect()), key=repr) == plain_lines(rows, least)
    assert line_dedup.remove_boilerplate(docs.limit(0)).collect() == []


def test_line_dedup_runs_no_python(spark):
    frame = QUERIES["op10_line_dedup"](spark, f"{TESTDATA}/sf0.001")
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_rows_without_an_id_do_not_gather_each_others_lines(spark, monkeypatch):
    rows = [(None, f"shared {n % 7}\nown {n}", f"site{n}") for n in range(140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gathered, kept = [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: (gathered.append((name, kept(df, name))), gathered[-1][1])[1])
    found = line_dedup.remove_boilerplate(docs).collect()
    assert sorted(r["kept_text"] for r in found) == sorted(f"own {n}" for n in range(140))
    removed = dict(gathered)["removed"]
    assert max(len(r["removed"]) for r in removed.collect()) == 1
