"""Encoding and packing against the tokenizer libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimloom.llm import bpe, packing, pretoken
from claimloom.llm.common import stored

ODD = [
    "", " ", "  ", "\n", "a", " a", "a b", "a  b", "a\nb", "a\n\nb", "a \n b", "\n\na", "a\n", "it's 'll don't",
    "x\0y z", "nbsp here and", "tab\there", "\x1c odd", "üöä ßẞ Éclair", "日本語のテキスト", "🙂🙂 🙃", "a" * 300,
    "ab" * 3000, " " * 50 + "x", "<|endoftext|>", "a <|endoftext|> b", "12345 67.89%", "###$$$ %%%", "　wide　",
    "é combining", "The quick brown fox. " * 200, "Word\nOther word\nThird",
]


def plain():
    with open(bpe.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PLAIN, TOKENIZER = plain(), Tokenizer.from_file(packing.VOCABULARY[0])


def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


def odd_texts(seed):
    pick = random.Random(seed)
    signs = ["the", "Thing", " ", "  ", "\n", ".", ",", "é", "ü", "'s", "42", "#", "\t", "🙂", "-", " "]
    return ["".join(pick.choices(signs, k=pick.randint(1, 80))) for _ in range(200)]


def test_chunks_and_segments_lose_nothing(monkeypatch):
    monkeypatch.setattr(pretoken, "SEGMENT_CHARS", 20)
    for text in [*ODD, *odd_texts(1)]:
        assert "".join(pretoken.chunks(text)) == text
        assert "".join(pretoken.segments(text)) == text


def test_ids_equal_the_libraries():
    for texts in (ODD, odd_texts(2), odd_texts(3), ODD):
        assert [numbers(r) for r in bpe.encode_texts(texts)] == [PLAIN.encode_ordinary(t) for t in texts]
        expected = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
        assert [numbers(packing.encoder(*packing.VOCABULARY)(t)) for t in texts] == expected


SEPARATORS = [
    '{"a":1}\x1e{"b":2}', 'x \x1c! y', ' \x1f\ufffd\x08', '\x1e{"', "a\x1d\x1d b", " \x1e", "\x1c\x1d\x1e\x1f", "\n\x1f. \x1f.\n",
    "\x1f\ufffd\x08\x08\ufffd gzip", "\x1c" * 5000 + "!",
]


def test_separators_that_only_python_takes_for_blanks():
    expected = [PLAIN.encode_ordinary(t) for t in SEPARATORS]
    assert [numbers(r) for r in bpe.encode_texts(SEPARATORS)] == expected
    fresh = bpe.Encoder(bpe.ranks_of(bpe.VOCABULARY)).remembered
    assert [numbers(fresh.all_ids([t])[0]) for t in SEPARATORS] == expected


def test_ids_when_little_is_remembered_and_texts_are_cut(monkeypatch):
    monkeypatch.setattr(pretoken, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(pretoken, "SEGMENT_CHARS", 25)
    texts = [*ODD, *odd_texts(4)]
    assert [numbers(r) for r in bpe.encode_texts(texts)] == [PLAIN.encode_ordinary(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=700))
def test_merges_of_any_bytes(data):
    ranks = bpe.ranks_of(bpe.VOCABULARY)
    expected = PLAIN._encode_single_piece(data)
    assert bpe.merge_alone(data, ranks).tolist() == expected
    assert numbers(bpe.encode_pieces([data], ranks)[0]) == expected
    assert bpe.decode_ids(np.array(expected), ranks) == data


def test_decoding_refuses_unknown_ids():
    with pytest.raises(ValueError):
        bpe.decode_ids(np.array([50256]), bpe.ranks_of(bpe.VOCABULARY))


def test_frames_round_trip(spark):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None])] + [(0, "", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.decode(bpe.encode(docs)).collect()
    assert len(found) == len(rows)
    for row in found:
        text = row["row"]["text"] or ""
        assert bytes(row["decoded"]) == text.encode()
        assert row["ids"] == PLAIN.encode_ordinary(text)
        assert row["row"]["ids"] == "x"
    assert bpe.encode(docs.limit(0)).collect() == []


def test_query_digests(spark, tmp_path):
    from claimloom.llm.registry import QUERIES

    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None])], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for row in QUERIES["op1_byte_bpe"](spark, str(tmp_path)).collect():
        text = [*ODD, None][row["doc_id"]] or ""
        ids = PLAIN.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --- packing


@pytest.mark.parametrize("length, expected", [
    (1, [(0, 1)]), (10, [(0, 10)]), (11, [(0, 1), (1, 10)]), (20, [(0, 10), (10, 10)]), (25, [(0, 5), (5, 10), (15, 10)])
])
def test_cut(length, expected):
    assert packing.cut(length, 10) == expected


@pytest.mark.parametrize("most", [1, 3, 50])
def test_open_bins_are_best_fit_in_bounded_space(most):
    pick, bins = random.Random(most), packing.OpenBins(100, most)
    free, opened = {}, 0
    for _ in range(2000):
        length = pick.randint(1, 100)
        fitting = sorted(f for f in free.values() if f >= length)
        number, offset = bins.place(length)
        if fitting:
            assert free[number] == fitting[0] and offset == 100 - fitting[0]
        else:
            assert (number, offset) == (opened, 0)
            opened += 1
            if len(free) >= most and length < 100:
                closed = min(free, key=lambda n: free[n])
                fullest = {n for n, f in free.items() if f == free[closed]}
                free = {n: f for n, f in free.items() if n not in fullest or n in set(sum(bins.by_free.values(), []))}
            free[number] = 100
        free[number] -= length
        if not free[number]:
            del free[number]
        assert len(free) == bins.open <= most
        assert sorted(free.values()) == sorted(f for f, b in bins.by_free.items() for _ in b)


def test_packed_frames(spark):
    texts = [*ODD, *odd_texts(5), "The quick brown fox. " * 900]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 1), (3, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int").repartition(5)
    found = packing.packed(docs).toPandas()
    ids = {i: [*TOKENIZER.encode(t, add_special_tokens=False).ids, packing.END_ID] for i, t in enumerate(texts) if i != 3}
    for doc, group in found[found["doc_id"].notna() & (found["doc_id"] != 3)].groupby("doc_id"):
        group = group.sort_values("piece")
        assert list(group["piece"]) == list(range(len(group)))
        assert [(a, b) for a, b in zip(group["start"], group["length"])] == packing.cut(len(ids[doc]), packing.SIZE)
        for start, length, crc in zip(group["start"], group["length"], group["ids_crc32"]):
            assert crc == zlib.crc32(np.array(ids[doc][start : start + length], "<u4").tobytes())
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert list(group["offset"]) == [0, *np.cumsum(group["length"])[:-1]]
        assert group["length"].sum() <= packing.SIZE
    assert len(found[found["doc_id"].isna()]) == 1 and len(found[found["doc_id"] == 3]) == 2
    least = -(-found["length"].sum() // packing.SIZE)
    assert found["sequence_id"].nunique() <= least + 1
    assert packing.packed(docs.limit(0)).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts(6))], "doc_id long, text string")
    pieces = stored(packing.token_pieces(docs, 64), "pieces")
    placed = packing.pack(pieces.drop("ids"), 64)
    rows = packing.sequences(pieces, placed).collect()
    flat = sorted(sum((numbers(r["ids"]) for r in rows), []))
    expected = sorted(sum(([*TOKENIZER.encode(t, add_special_tokens=False).ids, 2] for t in odd_texts(6)), []))
    assert flat == expected
    assert all(len(numbers(r["ids"])) == r["length"] <= 64 for r in rows)


def test_rows_without_an_id_or_with_one_in_common(spark):
    """No id gathers pieces in one group, and none loses or doubles them."""
    texts = [f"text number {n} of many" for n in range(300)]
    docs = spark.createDataFrame([(None if n % 3 else 5, t) for n, t in enumerate(texts)], "doc_id long, text string")
    pieces = stored(packing.token_pieces(docs.repartition(4), 64), "pieces")
    placed = packing.pack(pieces.drop("ids"), 64, per_group=30)
    groups = {r["sequence_id"] >> packing.GROUP_SHIFT for r in placed.collect()}
    assert len(groups) == 10
    rows = packing.sequences(pieces, stored(placed, "placed")).collect()
    expected = sorted(sum(([*TOKENIZER.encode(t, add_special_tokens=False).ids, 2] for t in texts), []))
    assert sorted(sum((numbers(r["ids"]) for r in rows), [])) == expected
    assert all(len(numbers(r["ids"])) == r["length"] for r in rows)
