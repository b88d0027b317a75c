"""Near-duplicates, components and top-k against brute force."""

import random
import re

import numpy as np
import pytest

from llm_frames import awkward, documents, sentence, with_clashes
from tidewatch.llm import near_dup, topk
from tidewatch.llm.components import connected_components
from tidewatch.llm.shingles import WordHashes, shingle_set, signature, signature_seeds
from tidewatch.sources.work import WorkTables


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def roots(items, linked):
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def brute_components(rows):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, set()).add(shingles(text))
    flat = [(d, s) for d, many in sets.items() for s in many if s]
    links = [(a, b) for i, (a, s) in enumerate(flat) for b, t in flat[:i]
             if a != b and 100 * len(s & t) >= 75 * len(s | t)]
    return roots(sets, links)


def check(spark, rows, clash=False):
    docs = documents(spark, [(d, t, None, None, None) for d, t in rows])
    found = near_dup.near_duplicates(with_clashes(docs) if clash else docs).collect()
    want = brute_components(rows)
    assert len(found) == len(rows)
    sizes = sorted((repr(d), len(shingles(t))) for d, t in rows)
    assert sorted((repr(r["doc"]), r["n_shingles"]) for r in found) == sizes
    for row in found:
        assert row["component_id"] == (None if row["doc"] is None else want[row["doc"]]), row


def test_awkward_documents(spark):
    check(spark, [(row[0], row[1]) for row in awkward()], clash=True)


def test_chains_and_borders(spark):
    """Similarities on both sides of 0.75, in chains whose ends are far apart."""
    rng = random.Random(4)
    rows, number = [], 1000
    for family in range(12):
        words = sentence(rng, 60 + 7 * family).split()
        for _ in range(14):
            rows.append((number, " ".join(words)))
            number += 1
            words = list(words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = sentence(rng, 1)
    rng.shuffle(rows)
    check(spark, [(i, text) for i, (_, text) in enumerate(rows)])


def test_hot_passage_and_hot_family(spark, monkeypatch):
    """Many documents that share a passage only, and a family of copies, in slices of 16."""
    monkeypatch.setattr(near_dup, "SIGN_SLICE", 32)
    monkeypatch.setattr(near_dup, "STAR_SLICE", 16)
    monkeypatch.setattr(near_dup, "SET_SLICE", 16)
    rng = random.Random(6)
    passage, base = sentence(rng, 40), sentence(rng, 50).split()
    rows = [(i, passage + " " + sentence(rng, 25)) for i in range(150)]
    for i in range(200, 330):
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_one_row_of_each_group_stays(spark):
    docs = with_clashes(documents(spark))
    kept = near_dup.keep_one_per_group(docs)
    want = brute_components([(row[0], row[1]) for row in awkward()])
    expected = sorted((repr(row[0]) for row in awkward() if row[0] is None or want[row[0]] == row[0]))
    assert kept.columns == docs.columns
    assert sorted(repr(row["doc_id"]) for row in kept.collect()) == expected


def test_no_documents(spark):
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0
    assert near_dup.keep_one_per_group(documents(spark, [])).count() == 0


def test_near_signatures_share_a_key():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 1 << 16, (200, near_dup.COMPONENTS)).astype(np.uint16)
    second = first.copy()
    for row in second:
        at = rng.choice(near_dup.COMPONENTS, near_dup.FARTHEST, replace=False)
        row[at] += 1
    same = near_dup.chunk_keys(first) == near_dup.chunk_keys(second)
    assert same.any(axis=1).all()


def test_a_pair_is_owned_by_exactly_one_of_its_keys():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = rng.integers(0, 1 << 16, (1, near_dup.COMPONENTS)).astype(np.uint16)
        b = a.copy()
        b[0, rng.choice(near_dup.COMPONENTS, rng.integers(0, 32), replace=False)] += 1
        keys = near_dup.chunk_keys(a)[0]
        shared = keys[keys == near_dup.chunk_keys(b)[0]]
        assert sum(near_dup._owned_pairs(int(k), a, b)[0, 0] for k in shared) == 1


def test_signature_estimates_similarity():
    hashes, seeds = WordHashes(), signature_seeds(64)
    rng = random.Random(8)
    gaps = []
    for _ in range(60):
        words = sentence(rng, 200).split()
        other = list(words)
        for _ in range(6):
            other[rng.randrange(200)] = "new"
        a, b = shingle_set(" ".join(words), hashes), shingle_set(" ".join(other), hashes)
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        gaps.append((signature(a, seeds) == signature(b, seeds)).mean() - exact)
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.09


def test_components_equal_plain_search(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2200)] + [(5, 5)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), WorkTables(spark))
    want = roots({x for a, b in links if a != b for x in (a, b)}, [(a, b) for a, b in links if a != b])
    assert {r["node"]: r["component"] for r in found.collect()} == want
    assert found.count() == len(want)


# ---- top-k ------------------------------------------------------------------


def brute_top(vectors, queries, k):
    out = []
    for q, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in vectors if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows,wide,most,k", [(0, 3, 5, 4), (3, 2, 5, 10), (400, 8, 30, 5),
                                              (300, 3, 1, 20), (250, 4, 40_000, 3), (60, 2, 10**8, 3)])
def test_top_equals_brute_force(spark, monkeypatch, rows, wide, most, k):
    monkeypatch.setattr(topk, "_BLOCK", 32)
    rng = random.Random(rows + wide)
    vectors = [(i, [rng.randint(-most, most) for _ in range(wide)]) for i in range(rows)]
    vectors += [(rows + i, [most] * wide) for i in range(40 if rows > 100 else 0)]
    queries = [v for v in vectors if v[0] % 7 == 0]
    schema = "vec_id long, v array<long>"
    found = topk.top_inner_products(
        spark.createDataFrame(vectors, schema), spark.createDataFrame(queries, schema), k,
        candidate_rows=100, query_rows=16)
    assert sorted(map(tuple, found.collect())) == brute_top(vectors, queries, k)


def test_lists_are_read_until_outsiders_cannot_qualify():
    """Some lists are never read to their ends, and few scores are resolved."""
    rng = np.random.default_rng(1)
    vectors = np.floor(20 * rng.standard_normal((500, 12))).astype(np.float32)
    vectors[:, 1:] = np.floor(vectors[:, 1:] / 10)
    ids = np.arange(500)
    found, read, resolved = topk.search(ids, vectors, ids[:10], vectors[:10], 5)
    pairs = [(int(i), v.astype(int).tolist()) for i, v in zip(ids, vectors)]
    want = sorted((q, i, s) for q, _, i, s in brute_top(pairs, pairs[:10], 5))
    assert sorted(zip(*(found[c].tolist() for c in ("query_id", "vec_id", "score")))) == want
    assert read < 0.75 * vectors.size * 10 and resolved < 0.1 * 500 * 10


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    frame = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids = frame["vec_id"].to_numpy()
    steps = np.floor(64 * np.stack(frame["embedding"]).astype(float)).astype(np.int64)
    want = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = steps @ steps[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:20]
        want += [(ids[q], n + 1, ids[i], scores[i]) for n, i in enumerate(order)]
    found = topk.op10_nra_topk(spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted(tuple(map(int, row)) for row in want)


def test_components_too_large_for_exact_scores_are_refused(spark):
    frame = spark.createDataFrame([(0, [1e18, 1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        frame.select(topk.whole_steps(frame["embedding"], 64)).collect()


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.51]), (1, None), (2, [nan, 1.0]), (3, [1.0, None]), (4, [inf, 0.0]),
            (5, [0.5]), (6, []), (None, [1.0, 1.0]), (8, [-1.0, -1.0]), (8, [-1.0, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    steps = with_clashes(frame).select("vec_id", topk.whole_steps(frame["embedding"], 64).alias("v"))
    assert {r["vec_id"]: r["v"] for r in steps.collect() if r["v"] is not None} == {
        0: [64, -33], 5: [32], 6: [], None: [64, 64], 8: [-64, -64]}
    found = topk.top_inner_products(steps, steps.filter("vec_id = 0"), 20).collect()
    assert sorted(map(tuple, found)) == [
        (0, 1, 5, 2048), (0, 2, 6, 0), (0, 3, 8, -1984), (0, 4, 8, -1984)]
