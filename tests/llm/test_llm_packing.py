"""Packing: exact placement, efficiency against bounds, tokens against the tokenizer itself."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_frames import awkward, documents, with_clashes
from tidewatch.llm.packing import (
    nonnegative_least_squares, pack_documents, pack_histogram, pack_pieces, packed_sequences,
    tokenizer_path,
)
from tidewatch.llm.tokens import WordTokens


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer_path())


def placed_exactly(plan, counts, capacity):
    held = Counter()
    for lengths, times in plan:
        assert sum(lengths) <= capacity and times > 0
        for length in lengths:
            held[length] += times
    return held == Counter({k: v for k, v in counts.items() if v})


def test_least_squares_meets_its_conditions():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((8, 15)), rng.random(8)
        x = nonnegative_least_squares(a, b, slack=1e-9)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gain < 1e-6).all() and abs(gain[x > 0]).max(initial=0) < 1e-6


def test_every_histogram_is_placed_exactly():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([1, 7, 16, 64, 100])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 80)))
        assert placed_exactly(pack_histogram(counts, capacity), counts, capacity)


def test_plan_is_near_the_lower_bound():
    rng = random.Random(2)
    counts = Counter(min(2048, int(rng.lognormvariate(6.3, 0.9)) + 1) for _ in range(20_000))
    plan = pack_histogram(counts, 2048)
    assert placed_exactly(plan, counts, 2048)
    least = sum(k * v for k, v in counts.items()) / 2048
    assert sum(times for _, times in plan) < 1.005 * least + 1


def test_perfect_pairs_are_found():
    plan = pack_histogram(Counter({1500: 300, 548: 300, 1024: 200}), 2048)
    assert sum(times for _, times in plan) == 400


def test_memo_equals_the_tokenizer(whole):
    memo = WordTokens(tokenizer_path())
    texts = [row[1] for row in awkward() if row[1] is not None] + [
        "It's I'LL we’ve 'RE a1b2 ½ ² ª µ × ÷ ÿŸ ΣΑΣ ﬁ é", "x" * 5000, "<|startoftext|>a<|endoftext|>",
        "\x1c \x85 \xa0   　x", "…--!!''s ''d", "",
    ]
    for text in texts:
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(memo.encode(text), dtype="<u4").tolist() == want


def check_places(found, capacity):
    by = found.sort_values(["sequence_id", "offset"])
    ends = (by["offset"] + by["length"]).groupby(by["sequence_id"]).shift().fillna(0)
    assert (by["offset"] == ends).all() and (by["offset"] + by["length"] <= capacity).all()


@pytest.mark.parametrize("capacity", [64, 2048])
def test_documents_are_cut_and_packed(spark, whole, capacity):
    docs = with_clashes(documents(spark))
    found = pack_documents(docs, tokenizer_path(), capacity, ids=True).toPandas()
    check_places(found, capacity)
    want = Counter()
    for doc_id, text, *_ in awkward():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], dtype="<u4")
            want[(doc_id, n, at, len(part), zlib.crc32(part.tobytes()))] += 1
    got = Counter((None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length,
                   r.ids_crc32) for r in found.itertuples())
    assert got == want


def test_sequences_hold_their_pieces(spark):
    placed = pack_documents(documents(spark), tokenizer_path(), 128, ids=True)
    pieces = {(r.sequence_id, r.offset): list(r.ids) for r in placed.toPandas().itertuples()}
    for row in packed_sequences(placed).collect():
        for part in row["documents"]:
            got = row["ids"][part["offset"]:part["offset"] + part["length"]]
            assert got == pieces[(row["sequence_id"], part["offset"])]


def test_odd_lengths_get_no_place_and_a_hot_length_is_spread(spark):
    lengths = [None, 0, -1, 11] + [5] * 400 + [10] * 50
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long")
    found = pack_pieces(pieces, 10, order=[F.col("id")], cell_rows=10).toPandas()
    odd = found[found["id"] < 4]
    assert odd["sequence_id"].isna().all() and odd["offset"].isna().all()
    rest = found[found["id"] >= 4]
    check_places(rest, 10)
    assert rest["sequence_id"].nunique() == 250


def test_empty_table(spark):
    assert pack_documents(documents(spark, []), tokenizer_path(), 64).count() == 0
