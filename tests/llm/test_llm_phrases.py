"""Phrase mining against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm_frames import awkward, documents, with_clashes
from tidewatch.llm import phrases

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_counts(rows):
    """{lang: (words, Counter of phrases)} by going over every piece."""
    out = defaultdict(lambda: [0, Counter()])
    for text, lang in rows:
        own = out["und" if lang is None else lang]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            own[0] += len(words)
            for n in range(1, 5):
                own[1].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    return out


def brute(rows, least, top, share=80):
    result = []
    for lang, (n, f) in plain_counts(rows).items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        kept = []
        for p, a in frequent.items():
            if 100 * longer[p] >= share * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


def mined(docs, **options):
    got = phrases.collocations(docs, **options)
    assert got.columns == COLUMNS
    return sorted(tuple(r) for r in got.collect())


def prose(seed, rows=300):
    rng = random.Random(seed)
    common = "the of and to in a is that for on with as it at by".split()
    rare = ["".join(rng.choices("abcdefé中", k=4)) for _ in range(60)]
    passage = "Some passage, of words that\tstands in many TEXTS and ends here!"
    out = []
    for i in range(rows):
        words = rng.choices(common, k=rng.randint(0, 60)) + rng.choices(rare, k=rng.randint(0, 30))
        rng.shuffle(words)
        for _ in range(rng.randint(0, 6)):
            words.insert(rng.randint(0, len(words)), rng.choice([".", ", x", "\n", "?!", "\x0b", passage]))
        out.append((rng.choice([" ", "  ", " \t"]).join(words), rng.choice(["aa", "bb", None, "und"])))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def test_chunks_hold_every_phrase_once():
    words = phrases._Words()
    for text, _ in prose(3, 60) + [("same word " * 500, None), ("a", None), ("...", None)]:
        for spacing in (1, 2, 7, 1000):
            chunks = list(phrases.parse(text, words, spacing))
            symbols = phrases.symbols_of(text)
            joined = [s for c in chunks for s in (
                c.split()[:-1 - phrases.OVERLAP] if c.endswith(b";") else c.split()[:-1])]
            assert joined == symbols
            held = b"\n".join(chunks).split()
            grams = phrases._Grams(
                ["xx"] * len(chunks), words.of(held),
                np.ones(len(chunks), np.int64), words)
            found = Counter(
                tuple(held[at:at + n])
                for n in range(1, 5) for at in grams.starts(n).nonzero()[0])
            want = plain_counts([(text, "xx")])["xx"][1]
            assert found == Counter({tuple(w.encode() for w in p): c for p, c in want.items()})


def test_copies_share_their_chunks():
    words = phrases._Words()
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(400))
    first = set(phrases.parse("one way to begin " + passage, words))
    second = set(phrases.parse("quite another, longer beginning of it " + passage, words))
    assert len(first & second) >= 0.8 * len(first) > 8


def test_phrases_equal_plain_counting(spark):
    rows = prose(1)
    want = brute(rows, 5, 40)
    assert len(want) > 100
    assert mined(frame(spark, rows), least=5, top=40) == want
    assert mined(frame(spark, rows), least=5, top=40, spacing=2) == want


def test_a_filter_that_lets_all_pass_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_FILTER_BITS", 64)
    rows = prose(2, 120)
    assert mined(frame(spark, rows), least=4, top=25) == brute(rows, 4, 25)


def test_awkward_rows_and_clashing_columns(spark):
    rows = awkward() + [(None, "hot words here " * 4000, "xx", None, None)] * 2
    plain = [(r[1], r[2]) for r in rows]
    docs = with_clashes(documents(spark, rows)).withColumns({
        name: F.lit("own") for name in ("chunk", "weight", "phrase", "a", "l", "f", "_part")})
    assert mined(docs, least=3, top=50) == brute(plain, 3, 50)
    assert mined(documents(spark, []), least=1, top=5) == []
    assert mined(frame(spark, [(None, None), ("", "xx"), (" ,. ", "xx")]), least=1, top=5) == []


def test_ties_and_covered_phrases(spark):
    rows = [("b c", "xx"), ("a b", "xx"), ("B C", "xx"), ("A  B", "xx"), ("x y z, x y", "yy")] * 5
    assert mined(frame(spark, rows), least=5, top=9) == brute(rows, 5, 9)
    few = mined(frame(spark, rows), least=5, top=1)
    assert [r[1] for r in few] == [1, 1]


def test_arithmetic_passes_64_bits(spark):
    big = 2**45
    counts = spark.createDataFrame(
        [("xx", 0, "", 2**46), ("xx", 1, "p", big + 1), ("xx", 1, "q", big), ("xx", 2, "p q", big)],
        "lang string, words int, phrase string, f long")
    row = phrases.cut_counts(counts).collect()
    assert [(r["a"], r["l"], r["r"]) for r in row] == [(big, big + 1, big)]
    score = phrases.scored(phrases.cut_counts(counts)).first()["score"]
    assert score == 2_000_000 * big // (2 * big + 1)
