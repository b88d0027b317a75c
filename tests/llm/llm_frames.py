"""Small document tables with every awkward case: NULLs, empty and long texts, copies, odd columns."""

from __future__ import annotations

import random

import pandas as pd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = SCHEMA + ", row string, shard string, copy string, node string, score string, len string"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(words))


def awkward(seed: int = 0, rows: int = 60) -> list[tuple]:
    """Rows of SCHEMA: ordinary texts, near and exact copies, NULLs, blanks, a long text, repeats."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        text = "\n".join(sentence(rng, rng.randint(3, 25)) for _ in range(rng.randint(1, 6)))
        out.append((i, text, rng.choice(["xx", "yy", None]), f"s{i % 3}", len(text)))
    base = sentence(rng, 120)
    for i in range(12):
        words = base.split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "changed"
        out.append((100 + i, " ".join(words), "xx", "s0", 1))
    out += [
        (200, None, None, None, None), (201, "", "xx", "s1", 0), (202, " \n\t ", "xx", "s1", 4),
        (203, "one two", "yy", None, 7), (204, "One  TWO", "yy", None, 8),
        (205, sentence(rng, 9000), "xx", "s0", None), (None, "an id is missing here", "xx", "s2", 1),
        (206, base, "xx", "s1", 1), (206, base, "xx", "s1", 1),
        (207, "é ß 中文 \U0001f600 İ x\x1cy <|endoftext|> I'LL", None, "s2", 1),
    ]
    return out


def documents(spark, rows: list[tuple] | None = None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def with_clashes(docs):
    """The same rows with extra columns named like things the operators use inside."""
    from pyspark.sql import functions as F

    names = ["row", "shard", "slot", "copy", "place", "node", "score", "len", "salt", "rank", "cell",
             "key", "host", "n", "drop", "line", "_host", "_key", "_text", "text_", "label", "found"]
    return docs.withColumns({name: F.lit(f"own {name}") for name in names})


def plain(frame: pd.DataFrame) -> list[tuple]:
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=repr)
