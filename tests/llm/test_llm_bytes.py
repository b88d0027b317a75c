"""Byte-level BPE against the rank file's own library, and the way back."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

import public_tokenizers
from llm_frames import awkward, documents, with_clashes
from tidewatch.llm import byte_bpe

FOLDER = "/root/testdata/sf0.001"
RANKS = byte_bpe.ranks_path()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={},
    )


@pytest.fixture(scope="module")
def tokens():
    return byte_bpe.byte_tokens(RANKS)


def test_every_code_point_is_split_and_merged_alike(library, tokens):
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1{c}{c} x{c}" for c in signs]
    for at in range(0, len(texts), 200_000):
        part = texts[at:at + 200_000]
        want = library.encode_ordinary_batch(part)
        assert [ids.tolist() for ids in tokens.encode(part)] == want


def test_random_texts_are_encoded_alike(library, tokens):
    rng = random.Random(5)
    alphabet = "aaabcdeehillnoorstt '''  \n\t.,!1234éßİıñ中文日本語\U0001f600\U00020041́‍\xa0\x85"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 400))) for _ in range(2000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 4000, "\n \n" * 999, "'s'S'll" * 50, "<|endoftext|>"]
    assert [ids.tolist() for ids in tokens.encode(texts)] == [
        library.encode_ordinary(text) for text in texts]


def test_long_texts_are_cut_where_no_token_changes(library, tokens):
    rng = random.Random(6)
    alphabet = "aehinorst  \n'é中文1,"
    for size in (1, 7, 50):
        text = "".join(rng.choices(alphabet, k=3000))
        parts = list(byte_bpe.stretches(text, size))
        assert "".join(parts) == text and len(parts) > 10
        joined = [i for part in parts for i in library.encode_ordinary(part)]
        assert joined == library.encode_ordinary(text)
    assert list(byte_bpe.stretches("x" * 500, 100)) == ["x" * 500]
    long = "words and more of them " * 30_000
    assert tokens.encode([long])[0].tolist() == library.encode_ordinary(long)


def test_offsets_cover_the_text_and_whole_characters(tokens):
    for text in ("plain words", "é中\U0001f600\U00020041 x", "\U0001f9ff" * 5, ""):
        ids = tokens.encode([text])[0]
        starts, ends = tokens.offsets(text, ids)
        at = 0
        for token, start, end in zip(ids, starts, ends):
            piece = tokens.decode(np.array([token]))
            begin = len(text[:start].encode())
            assert begin <= at and at + len(piece) <= len(text[:end].encode())
            assert start == 0 or len(text[:start + 1].encode()) > at
            at += len(piece)
        assert at == len(text.encode())


def test_rows_round_trip(spark, library):
    rows = awkward()
    got = byte_bpe.decode_ids(
        byte_bpe.encode_texts(documents(spark, rows), RANKS, offsets=True), RANKS, characters=True
    ).collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in got) == sorted(
        (r[0] or -1, r[1] or "") for r in rows)
    for row in got:
        text = row["text"] or ""
        assert row["ids"] == library.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode() and row["decoded_text"] == text
        assert "".join(row["spans"]) == text and row["unknown"] == 0
        assert len(row["starts"]) == len(row["ends"]) == len(row["spans"]) == len(row["ids"])


def test_split_characters_and_unknown_ids(spark, tokens):
    ids = tokens.encode(["\U0001f9ff!"])[0].tolist()
    assert len(ids) > 2
    rows = [(1, ids), (2, ids[:1]), (3, [None, -1, 10**9, ids[-1]]), (4, []), (5, None)]
    df = spark.createDataFrame(rows, "k int, ids array<int>")
    got = {r["k"]: r for r in byte_bpe.decode_ids(df, RANKS, characters=True).collect()}
    assert got[1]["spans"] == [""] * (len(ids) - 2) + ["\U0001f9ff", "!"]
    assert got[2]["spans"] == ["�"] and len(got[2]["decoded"]) < 4
    assert got[3]["unknown"] == 3 and got[3]["decoded_text"] == "!"
    assert got[4]["decoded_text"] == got[5]["decoded_text"] == "" and got[5]["unknown"] == 0


def test_clashing_and_empty_tables(spark):
    docs = with_clashes(documents(spark))
    docs = docs.withColumns({"ids": docs["lang"], "decoded": docs["lang"]})
    got = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, RANKS), RANKS)
    assert set(got.columns) == {*docs.columns, "unknown"}
    assert got.count() == docs.count() and {r["row"] for r in got.collect()} == {"own row"}
    empty = documents(spark, [])
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(empty, RANKS), RANKS).count() == 0


def test_query_equals_the_library(spark, library):
    got = {r["doc_id"]: r[1:] for r in byte_bpe.op11_byte_bpe(spark, FOLDER).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    want = {}
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        ids = library.encode_ordinary(row["text"] or "")
        want[row["doc_id"]] = (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode_bytes(ids)).hexdigest())
    assert got == want
