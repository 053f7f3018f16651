"""Each stage of the pipeline against brute force on what its predecessor kept."""

import random

import pytest
from test_exact_and_lines import lowered
from test_near_dedup import plain_classes
from test_suffix_dedup import plain_spans
from test_tokens import TOKENIZER

import corpus_pipeline
from claimloom.llm import packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents():
    pick = random.Random(21)
    words = {
        "en": ["the", "of", "and", "that", "thing", "with", "this", "house", "water", "light"],
        "de": ["der", "die", "und", "nicht", "schön", "über", "haus", "wasser", "licht", "straße"],
    }
    rows = []

    def text(lang, size):
        return " ".join(pick.choice(words[lang]) + str(pick.randrange(900)) for _ in range(size))

    passage = text("en", 60)
    for n in range(120):
        lang = pick.choice(["en", "de"])
        rows.append((n, text(lang, pick.randint(30, 120)) + (" " + passage if n % 9 == 0 else ""), lang))
    rows += [(200 + n, rows[n][1].upper() if n % 2 else rows[n][1], rows[n][2]) for n in range(10)]
    for n in range(20, 30):
        copy = rows[n][1].split()
        copy[3] = "changed"
        rows.append((300 + n, " ".join(copy), rows[n][2]))
    rows += [(400, None, "en"), (401, "", "de"), (402, "123 456 !!!", "en"), (403, "licht", "de")]
    return rows


@pytest.fixture(scope="module")
def stages(spark):
    rows = [(d, t, lang, f"s{d % 5}", len(t or "")) for d, t, lang in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stage(spark, found[-1], "").cache())
    yield found
    for frame in found[1:]:
        frame.unpersist()


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_stages_are_in_order_and_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "MinHash near-dedup", "suffix-array dedup", "best-fit packing"
    ]
    for frame in stages[:-1]:
        assert frame.columns == COLUMNS


def test_language_id_drops_texts_without_letters_only(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert before.keys() - after.keys() == {400, 401, 402}
    assert all(after[d] == before[d] for d in after)


def test_exact_dedup_keeps_the_largest_id(stages):
    before, after = texts(stages[1]), texts(stages[2])
    last = {lowered(t): max(d for d in before if lowered(before[d]) == lowered(t)) for t in before.values()}
    assert after == {d: before[d] for d in last.values()}


def test_near_dedup_keeps_one_of_each_class(stages):
    before, after = texts(stages[2]), texts(stages[3])
    classes = plain_classes(list(before.items()))
    assert after == {d: before[d] for d in set(classes.values())}
    assert len(before) - len(after) == 10


def test_suffix_dedup_cuts_what_came_before(stages):
    before, after = texts(stages[3]), {r["doc_id"]: r for r in stages[4].collect()}
    assert before.keys() == after.keys()
    spans = plain_spans(list(before.items()))
    assert sum(bool(s) for _, s in spans.values()) > 5
    for doc, (data, cut) in spans.items():
        kept = b"".join(data[e:s] for e, s in zip([0, *(e for _, e in cut)], [*(s for s, _ in cut), len(data)]))
        assert after[doc]["text"] == kept.decode("utf-8", "ignore")
        assert after[doc]["n_chars"] == len(after[doc]["text"])


def test_packing_holds_all_tokens_of_all_documents(stages):
    before, found = texts(stages[4]), stages[5].toPandas()
    for doc, group in found.groupby("doc_id"):
        assert group["length"].sum() == len(TOKENIZER.encode(before[doc], add_special_tokens=False).ids) + 1
    assert set(found["doc_id"]) == before.keys()
    assert found.groupby("sequence_id")["length"].sum().max() <= packing.SIZE


def test_run_equals_the_stages(spark, stages, tmp_path):
    stages[0].write.parquet(str(tmp_path / "documents.parquet"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, stages[5].select(*columns).collect()))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
