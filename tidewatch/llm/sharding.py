"""Sharding by histogram sort: exact byte counts below candidate boundaries, then one exchange."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.common import row_struct, small_frame, table, utf8_bytes
from tidewatch.sources.work import WorkTables

# A key is three hashes of 60 bits: of the group, of the row's own order, and of its place
# in the written key table (which sets even equal rows apart). Candidate boundaries refine
# it by 10 bits a level.
_BITS, _HASH_BITS, _HASHES = 10, 60, 3
_FAN = 1 << _BITS
_PER_HASH = _HASH_BITS // _BITS
_LEVELS = _PER_HASH * _HASHES


@dataclass(eq=False)
class Cell:
    """Keys between two neighbouring candidate boundaries, with their exact counts.

    ``level`` tells how many digits of the key all its rows share, less one.
    """

    number: int
    level: int
    rows: int
    size: int
    parent: Cell | None = None
    inside: list[Cell] = field(default_factory=list)
    base: int = -1

    @property
    def single_group(self) -> bool:
        return self.level >= _PER_HASH - 1

    def chain(self) -> list[Cell]:
        """The cell and all cells around it."""
        return [self, *(self.parent.chain() if self.parent else [])]


@dataclass
class Layout:
    """Leaf cells in key order, the first cell of each shard, and the cells that were refined."""

    leaves: list[Cell]
    starts: list[int]
    refined: list[Cell]


def _digit(level: int) -> Column:
    shift = _HASH_BITS - _BITS * (level % _PER_HASH + 1)
    return F.shiftright(F.col(f"k{level // _PER_HASH}"), shift).bitwiseAND(F.lit(_FAN - 1))


def _numbered(keys: DataFrame, refined: list[Cell]) -> DataFrame:
    """Adds ``cell``, the number of the leaf cell that holds the row's key."""
    keys = keys.withColumn("cell", _digit(0))
    for level in sorted({c.level for c in refined}):
        opened = small_frame(
            keys.sparkSession, [(c.number, c.base) for c in refined if c.level == level],
            "cell long,base long",
        )
        keys = keys.join(F.broadcast(opened), "cell", "left").withColumn(
            "cell", F.coalesce(F.col("base") + _digit(level + 1), F.col("cell"))
        ).drop("base")
    return keys


def _count_inside(keys: DataFrame, around: list[Cell]) -> dict[int, tuple[int, int, int]]:
    """{cell number: (level, rows, bytes)} of the candidates inside ``around``; [] is all keys.

    One aggregation over the rows inside; at most 1,024 sums a cell are collected. Levels
    at which the rows of a cell do not differ are skipped.
    """
    if around:
        roots = small_frame(
            keys.sparkSession, [(n,) for n in {c.chain()[-1].number for c in around}], "root long"
        )
        keys = keys.join(F.broadcast(roots), _digit(0) == F.col("root"), "left_semi")
    keys = _numbered(keys, list(dict.fromkeys(c for cell in around for c in cell.chain())))
    if around:
        first = min(c.base for c in around)
        keys = keys.filter(F.col("cell").between(first, max(c.base for c in around) + _FAN - 1))
    spans = [F.max(f"k{i}") == F.min(f"k{i}") for i in range(_HASHES)]
    sums = keys.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"), F.array(*spans).alias("same")
    )
    found = {}
    for row in sums.collect():
        level = around[0].level + 1 if around else 0
        for i in range(level // _PER_HASH, _HASHES):
            if not row["same"][i]:
                break
            level = _PER_HASH * (i + 1) - 1
        found[row["cell"]] = (level, row["n"], row["b"])
    return found


def _leaves(cells: list[Cell], group: int | None = None):
    """(leaf, number of the single-group cell around it or None) in key order."""
    for cell in cells:
        own = cell.number if group is None and cell.single_group else group
        if cell.base < 0:
            yield cell, own
        else:
            yield from _leaves(cell.inside, own)


def _edges(leaves: list[tuple[Cell, int | None]]) -> list[tuple[int, bool]]:
    """Bytes below each leaf, and whether a group can start there (not inside one group's keys)."""
    below, out, before = 0, [], None
    for cell, group in leaves:
        out.append((below, group is None or group != before))
        before, below = group, below + cell.size
    return out


def histogram_layout(
    keys: DataFrame, shards: int, *, tolerance: float, group_tolerance: float, cell_rows: int
) -> Layout:
    """Refine candidate boundaries until each splitter is within ``tolerance`` of its byte target.

    Each round counts the rows and bytes of the new candidates in one aggregation and
    collects at most 1,024 sums per cell refined. Only cells that hold an unsettled
    target, or too many rows for one sort task, are refined, so the sums collected
    depend on ``shards`` and on rows / ``cell_rows``.
    """
    roots = [Cell(n, *found) for n, found in sorted(_count_inside(keys, []).items())]
    refined: list[Cell] = []
    number = _FAN
    rows, total = sum(c.rows for c in roots), sum(c.size for c in roots)
    share = total / shards
    most = max(256, min(cell_rows, 4 * rows // _FAN))
    while True:
        leaves = list(_leaves(roots))
        edges = _edges(leaves)
        ends = [below for below, _ in edges] + [total]
        starts, unsettled = [0], {i for i, (c, _) in enumerate(leaves) if c.rows > most}
        at = 0
        for shard in range(1, shards):
            target = total * shard / shards
            while at < len(leaves) and ends[at + 1] <= target:
                at += 1
            near = range(max(0, at - _FAN), min(len(leaves), at + _FAN))
            whole = [i for i in near if edges[i][1]] + [len(leaves)] * (near.stop == len(leaves))
            best = min(whole, key=lambda i: abs(ends[i] - target), default=0)
            allowed = group_tolerance if at < len(leaves) and leaves[at][1] is not None else tolerance
            if abs(ends[best] - target) > allowed * share:
                if at < len(leaves) and leaves[at][0].rows > 1:
                    unsettled.add(at)
                best = min(range(len(ends)), key=lambda i: abs(ends[i] - target)) \
                    if leaves[min(at, len(leaves) - 1)][1] is not None else best
            starts.append(max(best, starts[-1]))
        level = {leaves[i][0].level for i in unsettled if leaves[i][0].level + 1 < _LEVELS}
        if not level:
            return Layout([c for c, _ in leaves], starts, refined)
        # All open cells of the coarsest level are refined together.
        cells = [leaves[i][0] for i in sorted(unsettled) if leaves[i][0].level == min(level)]
        for cell in cells:
            cell.base, number = number, number + _FAN
        refined += cells
        found = _count_inside(keys, cells)
        for cell in cells:
            cell.inside = [Cell(n, *found[n], parent=cell)
                           for n in range(cell.base, cell.base + _FAN) if n in found]


def shard_documents(
    docs: DataFrame, shards: int, *, size: Column, group: Column, order: Sequence[Column],
    tables: WorkTables | None = None, tolerance: float = 0.005, group_tolerance: float = 0.02,
    cell_rows: int = 1_000_000,
) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0).

    Rows are ordered by (hash of ``group``, hash of ``order``). Shards are runs of that
    order of nearly equal total ``size``: each splitter lies within ``tolerance`` of a
    shard's share of its exact byte target, or at the row next to it. Rows of one
    ``group`` are neighbours and stay in one shard, unless that would move a splitter by
    more than ``group_tolerance`` of a share; such a hot group is cut between rows.

    The keyed rows are written once, counted a few times by key columns alone, and
    exchanged once, by cells of at most about ``cell_rows`` rows that are sorted by
    themselves. A NULL size counts 0; NULL groups are one group; equal rows are set apart by
    their place in the written table. Existing columns ``shard`` and ``slot`` are replaced.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    tables = tables or WorkTables(spark)
    bits = 64 - _HASH_BITS
    keys = tables.write(
        docs.select(
            row_struct(docs).alias("row"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            F.shiftrightunsigned(F.xxhash64(group), bits).alias("k0"),
            F.shiftrightunsigned(F.xxhash64(F.lit("order"), *order), bits).alias("k1"),
            F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), bits).alias("k2"),
        ),
        "shard-keys",
    )
    layout = histogram_layout(
        keys.drop("row"), shards, tolerance=tolerance, group_tolerance=group_tolerance,
        cell_rows=cell_rows,
    )
    places, shard, slot = [], 0, 0
    for i, cell in enumerate(layout.leaves):
        while shard + 1 < shards and i >= layout.starts[shard + 1]:
            shard, slot = shard + 1, 0
        places.append((cell.number, shard, slot))
        slot += cell.rows
    lookup = F.broadcast(small_frame(spark, places, "cell long,shard int,first long"))
    in_cell = Window.partitionBy("cell").orderBy("k0", "k1", "k2")
    kept = [name for name in docs.columns if name not in ("shard", "slot")]
    return (
        _numbered(keys, layout.refined)
        .withColumn("rank", F.row_number().over(in_cell) - 1)
        .join(lookup, "cell")
        .select(*[F.col("row")[name].alias(name) for name in kept], "shard",
                (F.col("first") + F.col("rank")).alias("slot"))
    )


SHARDS = 16


def op1_histogram_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes; equal texts lie together.

    The text itself is hashed at the scan and need not travel: NULL text has size 1 and
    the checksum of no bytes, 0.
    """
    docs = table(spark, folder, "documents")
    text = F.col("text")
    measured = docs.select(
        "doc_id", (utf8_bytes(text) + 1).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("same"),
    )
    placed = shard_documents(
        measured, SHARDS, size=F.col("size"), group=F.col("same"), order=[F.col("doc_id")]
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
