"""Removed spans against brute force over all strings of 100 bytes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimloom.llm import suffix_dedup as sd


def plain_spans(docs):
    """Maximal spans to remove of each document, by a dictionary of all strings."""
    seen, out = {}, {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - 99):
            if seen.setdefault(data[at : at + 100], (doc, at)) != (doc, at):
                gone[at : at + 100] = True
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int)))
        out[doc] = (data, list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


def documents():
    pick = random.Random(11)

    def prose(size):
        return "".join(pick.choice("abcdefgh é\n") for _ in range(size))

    passages = [prose(n) for n in (99, 100, 101, 130, 180, 400, 900)]
    docs = []
    for _ in range(60):
        parts = [prose(pick.randint(0, 300)) for _ in range(3)] + pick.sample(passages, 2)
        pick.shuffle(parts)
        docs.append("".join(parts))
    docs += [docs[3], docs[4], docs[5][:500], docs[6][20:], docs[7].upper(), passages[5] * 3]
    docs += ["a" * 99, "a" * 100, "a" * 101, "a" * 400, "ab" * 200, ("abc" * 50) + "x" + ("abc" * 50), "", None]
    near = list(docs[8])
    for at in range(37, len(near), 140):
        near[at] = "#"
    return list(enumerate([*docs, "".join(near)]))


@pytest.fixture(scope="module")
def docs():
    return documents()


def found_spans(spark, docs, parts):
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, kept string")
    return frame, {r["row"]["doc_id"]: r for r in sd.cut(frame.repartition(parts)).collect()}


@pytest.mark.parametrize("parts, piece, held", [(1, 1 << 19, 600_000), (7, 700, 40)])
def test_spans(spark, monkeypatch, docs, parts, piece, held):
    monkeypatch.setattr(sd, "PIECE", piece)
    monkeypatch.setattr(sd, "HELD", held)
    _, found = found_spans(spark, docs, parts)
    for doc, (data, spans) in plain_spans(docs).items():
        row = found[doc]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (
            len(data), sum(e - s for s, e in spans), len(spans)
        ), doc
        assert row["kept"] == b"".join(data[e:s] for e, s in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)]))


def test_text_columns(spark, docs):
    frame, found = found_spans(spark, docs, 3)
    rows = {r["doc_id"]: r for r in sd.remove_repeats(frame.withColumn("n_chars", F.lit(7))).collect()}
    for doc, text in docs:
        expected = text if not found[doc]["n_removed"] else bytes(found[doc]["kept"]).decode("utf-8", "ignore")
        assert rows[doc].asDict() == {
            "doc_id": doc, "text": expected, "kept": "x", "n_chars": len(expected) if found[doc]["n_removed"] else 7
        }


def test_repeated_rows_null_ids_and_empty(spark):
    text = "".join(random.Random(1).choices("abcdefg", k=300))
    rows = [(5, text), (5, text), (None, text), (None, None), (2, text[50:200] + "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["row"]["doc_id"] or -1, r["n_removed"]) for r in sd.cut(frame).collect())
    assert found == [(-1, 0), (-1, 300), (2, 0), (5, 150), (5, 150)]
    assert sd.cut(frame.limit(0)).collect() == []


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_without_an_id_are_told_apart(spark, parts):
    pick = random.Random(3)

    def prose(size):
        return "".join(pick.choices("abcdefg ", k=size))

    shared, other = prose(150), prose(160)
    texts = [prose(400), shared + prose(300), prose(250) + shared, prose(60) + other + prose(40), other, prose(90), "", None]
    rows = [(2**63 - 1, prose(130) + shared + prose(130)), *((None, t) for t in texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    keys = {r["text"]: (r["no_id"], r["doc_id"]) for r in frame.select(*sd.key_columns(), "text").collect()}
    assert len(set(keys.values())) == len(rows) - 1  # a null text is an empty one
    spans = plain_spans([(keys[t], t) for _, t in rows])
    for row in sd.cut(frame.repartition(parts)).collect():
        data, gone = spans[keys[row["row"]["text"]]]
        assert (row["n_removed"], row["n_spans"]) == (sum(e - s for s, e in gone), len(gone))
        assert row["kept"] == b"".join(data[e:s] for e, s in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(data)]))
    assert sum(bool(gone) for _, gone in spans.values()) >= 3


@pytest.mark.parametrize("hot", [1, 20])
def test_strings_of_hot_grams(spark, docs, hot):
    frame = spark.createDataFrame([(d, t) for d, t in [*docs, docs[3]]], "doc_id long, text string").repartition(4)
    found = {r["row"]["doc_id"]: r for r in sd.cut(frame, hot=hot).collect()}
    for doc, (data, spans) in plain_spans(docs).items():
        assert (found[doc]["n_removed"], found[doc]["n_spans"]) == (sum(e - s for s, e in spans), len(spans)), doc
        assert found[doc]["kept"] == b"".join(data[e:s] for e, s in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)]))


def test_edges_of_a_passage_that_many_share_do_not_meet_in_one_bucket():
    pick = random.Random(8)

    def prose(size):
        return "".join(pick.choices("abcdefghijk ", k=size))

    passage, n = prose(600), 300
    texts = [prose(120) + passage + prose(120) for _ in range(n)]
    batch = pa.record_batch({"no_id": pa.array([0] * n, pa.int8()), "doc_id": range(n), "text": texts})
    rows = pa.Table.from_batches(sd.anchor_rows(1)(iter([batch])))
    met = [(r["kind"], [sd.unpacked(a) for a in r["arrays"]]) for r in sd.meet(rows, 50).to_pylist()]
    asked = [len(arrays[0]) for kind, arrays in met if kind == "ask"]
    assert sum(asked) <= 50
    (none, doc, start, end), = [arrays for kind, arrays in met if kind == "hot"]
    assert len(set(doc.tolist())) == n
    spans = [[{"start": s, "end": e} for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist()) if d == i] for i in range(n)]
    given = pa.RecordBatch.from_pylist(
        [{"no_id": 0, "doc_id": i, "text": texts[i], "asked": spans[i]} for i in range(n)],
        pa.schema([("no_id", pa.int8()), ("doc_id", pa.int64()), ("text", pa.string()), ("asked", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]),
    )
    dealt = pa.Table.from_batches(sd.fetch_strings(4)(iter([given]))).to_pylist()
    sent = np.concatenate([np.stack([sd.unpacked(a) for a in r["arrays"]][:2], 1) for r in dealt if r["kind"] == "string"])
    assert len(np.unique(sent, axis=0)) == len(sent)  # one entry for each string of a task
    assert {r["bucket"] for r in dealt if r["kind"] == "string"} == {0, 1, 2, 3}


def test_contexts_are_equal_only_if_both_hashes_are():
    keys = [np.array([7, 7, 7], np.uint64), np.array([9, 9, 9], np.uint64), np.array([1, 2, 1], np.uint64)]
    order, first = sd.collapse(keys, np.zeros(3, np.int8), np.array([5, 6, 4]), np.zeros(3, np.int64))
    assert order.tolist() == [2, 0, 1] and first.tolist() == [True, False, True]


def test_rows_of_a_task_go_by_its_anchors_not_by_the_buckets():
    text = "".join(random.Random(5).choices("abcdefgh ", k=40_000)).encode()
    parts = [sd.text_anchors([0], [1], [text])]
    anchors, sizes = len(parts[0][0]), []
    for buckets in (40, 10**9):
        rows = [r for b in sd._task_rows(parts, buckets) for r in b.to_pylist()]
        assert sum(len(sd.unpacked(r["arrays"][2])) for r in rows if r["kind"] == "anchor") == anchors
        sizes.append(len(rows))
    assert sizes[0] <= 40 and sizes[1] <= anchors
