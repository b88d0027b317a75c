"""Best-fit packing: few-document patterns fitted to the length histogram, residuals best-fit."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.common import row_struct, small_frame, table
from tidewatch.llm.tokens import token_pieces
from tidewatch.sources.work import WorkTables

Plan = list[tuple[tuple[int, ...], int]]


def nonnegative_least_squares(
    a: np.ndarray, b: np.ndarray, *, rounds: int = 400, slack: float = 0.05
) -> np.ndarray:
    """x >= 0 that nearly minimises |a x - b|, by the active-set method.

    It ends when no column gains more than ``slack``; counts are rounded afterwards anyway.
    """
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[passive] = -np.inf
        if not len(gain) or gain.max() <= slack:
            break
        passive[int(gain.argmax())] = True
        while True:
            at = np.flatnonzero(passive)
            solved = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0.0
                x[at] = solved
                break
            down = solved <= 0
            old = x[at]
            ratio = np.min(old[down] / np.maximum(old[down] - solved[down], 1e-300))
            x[at] = np.maximum(0.0, old + ratio * (solved - old))
            passive[at[x[at] <= 1e-12]] = False
            x[~passive] = 0.0
            if not passive.any():
                break
    return x


def _patterns(present: Sequence[int], units: int, most: int) -> list[tuple[int, ...]]:
    """Multisets of 2 to ``most`` length classes that fill a sequence, largest class first."""
    classes = set(present)
    found = []
    for few in range(1, most):
        for head in itertools.combinations_with_replacement(sorted(present, reverse=True), few):
            last = units - sum(head)
            if 0 < last <= head[-1] and last in classes:
                found.append((*head, last))
    return found


def pack_histogram(
    counts: dict[int, int], capacity: int, *, units: int = 128, pattern_documents: int = 3
) -> Plan:
    """[(lengths of one sequence, number of such sequences)] that places every length exactly.

    Lengths are put in ``units`` classes, rounded up. Patterns of up to ``pattern_documents``
    classes that fill a sequence get repeat counts by non-negative least squares against the
    class histogram; counts are rounded down and given concrete lengths: the longest of each
    class, and last the longest that still fits. What is left is packed best-fit, longest
    first, into the gaps that patterns leave and into new sequences. Work depends on the
    number of distinct lengths, not of documents.
    """
    left = [0] * (capacity + 1)
    for length, count in counts.items():
        left[length] = count
    step = -(-capacity // units)
    units = -(-capacity // step)
    sizes = defaultdict(int)
    for length in range(1, capacity + 1):
        sizes[-(-length // step)] += left[length]
    present = [c for c, n in sizes.items() if n]
    patterns = _patterns(present, units, pattern_documents)
    # gap -> [(lengths, number)]: sequences that can still take something.
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    if patterns:
        rows = {c: i for i, c in enumerate(present)}
        fit = np.zeros((len(present), len(patterns)))
        for j, pattern in enumerate(patterns):
            for c in pattern:
                fit[rows[c], j] += 1
        repeats = nonnegative_least_squares(fit, np.array([sizes[c] for c in present], float))
        for j in np.argsort(-repeats, kind="stable"):
            _repeat(patterns[j], int(repeats[j] + 1e-6), step, capacity, left, gaps)
    for length in range(capacity, 0, -1):
        _best_fit(length, left, capacity, gaps)
    return [entry for entries in gaps.values() for entry in entries]


def _longest(left: list[int], low: int, high: int, used: Sequence[int]) -> int:
    """The longest length in (low, high] of which one is left besides those used; 0 if none."""
    for length in range(high, low, -1):
        if left[length] > used.count(length):
            return length
    return 0


def _repeat(pattern, repeats, step, capacity, left, gaps) -> None:
    while repeats > 0:
        lengths: list[int] = []
        for c in pattern[:-1]:
            found = _longest(left, (c - 1) * step, min(c * step, capacity), lengths)
            if not found:
                return
            lengths.append(found)
        found = _longest(left, 0, capacity - sum(lengths), lengths)
        if not found:
            return
        lengths.append(found)
        times = min(repeats, *(left[x] // lengths.count(x) for x in lengths))
        for x in lengths:
            left[x] -= times
        gaps[capacity - sum(lengths)].append((tuple(lengths), times))
        repeats -= times


def _best_fit(length: int, left: list[int], capacity: int, gaps) -> None:
    """Put all documents of one length into the tightest gaps, then into new sequences."""
    count, left[length] = left[length], 0
    for gap in range(length, capacity):
        if not count:
            return
        again = []
        while gaps.get(gap) and count:
            lengths, times = gaps[gap].pop()
            fits = gap // length
            whole = min(times, count // fits)
            if whole:
                again.append((gap - fits * length, ((*lengths, *[length] * fits), whole)))
                count, times = count - whole * fits, times - whole
            if times and count and count < fits:
                again.append((gap - count * length, ((*lengths, *[length] * count), 1)))
                count, times = 0, times - 1
            if times:
                again.append((gap, (lengths, times)))
        for rest, entry in again:
            gaps[rest].append(entry)
    if count:
        fits = capacity // length
        whole, rest = divmod(count, fits)
        if whole:
            gaps[capacity - fits * length].append(((length,) * fits, whole))
        if rest:
            gaps[capacity - rest * length].append(((length,) * rest, 1))


def _places(plan: Plan) -> list[tuple[int, list[dict]]]:
    """Per length: which ranks among its documents go to which sequences, at which offset."""
    used, sequence = defaultdict(int), 0
    places = defaultdict(list)
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            places[length].append({
                "low": used[length], "high": used[length] + times, "first": sequence,
                "at": offset,
            })
            used[length] += times
            offset += length
        sequence += times
    return sorted(places.items())


def pack_pieces(
    pieces: DataFrame, capacity: int, *, length: str = "length", order: Sequence[Column],
    cell_rows: int = 500_000, least_cells: int = 32, **planning,
) -> DataFrame:
    """All columns of ``pieces`` plus ``sequence_id`` and ``offset`` (gapless from 0).

    ``pieces`` should be a written table, since its rows are read three times. The driver
    sees one count per distinct length, at most ``capacity`` of them, and plans on these.
    Rows get a rank among those of their length, counted in salted cells of about
    ``cell_rows``, so that a hot length is no hot task; rank and length name the place.
    Rows whose length is NULL, below 1 or above ``capacity`` get NULL places. Rows of
    equal ``order`` must be interchangeable. Existing columns of the two names are replaced.
    """
    spark = pieces.sparkSession
    fits = F.col(length).between(1, capacity)
    counts = {row[0]: row[1] for row in pieces.filter(fits).groupBy(F.col(length).cast("long"))
              .count().collect()}
    places = _places(pack_histogram(counts, capacity, **planning)) if counts else []
    cells = max(least_cells, sum(counts.values()) // cell_rows)
    lookup = small_frame(
        spark, places, "len long,places array<struct<low:bigint;high:bigint;first:bigint;at:bigint>>"
    )
    keyed = pieces.select(
        row_struct(pieces).alias("row"), F.when(fits, F.col(length)).cast("long").alias("len"),
        F.struct(*order).alias("by"),
    ).withColumn("salt", F.pmod(F.xxhash64("by"), F.lit(cells)))
    before = Window.partitionBy("len").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy("len", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("len").alias("_len"), F.col("salt").alias("_salt"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
    )
    in_cell = Window.partitionBy("len", "salt").orderBy("by")
    ranked = keyed.withColumn("rank", F.row_number().over(in_cell) - 1).join(
        sums, F.col("len").eqNullSafe(F.col("_len")) & (F.col("salt") == F.col("_salt"))
    ).withColumn("rank", F.col("rank") + F.col("before")).drop("_len", "_salt", "before")
    kept = [name for name in pieces.columns if name not in ("sequence_id", "offset")]
    rank = F.col("rank")
    return (
        ranked.join(F.broadcast(lookup), "len", "left")
        .withColumn("place", F.filter(
            "places", lambda p: (p["low"] <= rank) & (rank < p["high"]))[0])
        .select(*[F.col("row")[name].alias(name) for name in kept],
                (F.col("place.first") + rank - F.col("place.low")).alias("sequence_id"),
                F.col("place.at").alias("offset"))
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int, *, keys: tuple[str, ...] = ("doc_id",),
    text: str = "text", ids: bool = False, tables: WorkTables | None = None,
) -> DataFrame:
    """Tokenise whole documents, cut those beyond ``capacity``, and pack all pieces.

    Returns the pieces with their place; with ``ids``, their token ids too.
    """
    tables = tables or WorkTables(docs.sparkSession)
    pieces = tables.write(
        token_pieces(docs, tokenizer, longest=capacity, keys=keys, text=text, ids=ids), "pieces"
    )
    order = [*map(F.col, keys), F.col("piece"), F.col("ids_crc32")]
    return pack_pieces(pieces, capacity, order=order)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, documents): the ids of each sequence in a row, from pieces with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return placed.filter(F.col("sequence_id").isNotNull()).groupBy("sequence_id").agg(
        parts.alias("parts")
    ).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"),
        F.transform("parts", lambda p: F.struct(
            p["doc_id"].alias("doc_id"), p["piece"].alias("piece"),
            p["offset"].alias("offset"), p["length"].alias("length"))).alias("documents"),
    )


SEQUENCE_TOKENS = 2048
VOCABULARY = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def op2_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2,048 tokens."""
    docs = table(spark, folder, "documents")
    return pack_documents(docs, tokenizer_path(), SEQUENCE_TOKENS)
