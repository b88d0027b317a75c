"""Prefix trie of conversations, by collapsing identical whole sequences first.

Identical conversations become one weighted sequence with a list of ends; sequences that are
proper prefixes of others are told by an anti-join, the rest are leaves; the prefixes of the
sequences, with their weights, add up to the nodes.

A prefix is known by its depth and four sums of 32 bits per turn, each a hash of the turn and
its place, so that a sequence's key adds up on the map side and a prefix's key is a running
sum. Rows hold hashes and counts, never texts, and no step gathers the turns of a conversation
or the members of a node: running sums go by blocks of places, ends by blocks of ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.common import broadcast_if_small, table, words_of
from tidewatch.sources.work import WorkTables

# Turns per block of a running sum, and ids per block of a list of ends, as a power of two.
BLOCK_BITS = 12
# Children from which a parent's row travels to them, and not they to it.
MANY_CHILDREN = 1_000

_KEY = ["k0", "k1", "k2", "k3"]
_PARENT = ["p0", "p1", "p2", "p3"]
_NODE = ["depth", *_KEY]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def sums_before(
    df: DataFrame, by: str, block: Column, order: Sequence[Column], sums: dict[str, Column]
) -> DataFrame:
    """Add for each name the total of a column over the earlier rows of the same ``by``.

    Rows are ordered by ``block`` first. Totals run within a block and over the blocks' totals,
    so that no task holds more of one ``by`` than a block, or one row per block. ``df`` is read
    twice.
    """
    marked = df.withColumn("_block", block)
    earlier = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(by, "_block").orderBy(*order).rowsBetween(*earlier)
    over = Window.partitionBy("_by").orderBy("_at").rowsBetween(*earlier)
    totals = marked.groupBy(F.col(by).alias("_by"), F.col("_block").alias("_at")).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()])
    # The first block, mostly the only one, needs no row.
    offsets = totals.select("_by", "_at", F.lead("_at", -1).over(
        Window.partitionBy("_by").orderBy("_at")).alias("_last"),
        *[F.sum(name).over(over).alias(f"_{name}") for name in sums],
    ).filter(F.col("_last").isNotNull()).drop("_last")
    inner = marked.withColumns({
        name: F.coalesce(F.sum(value).over(within), F.lit(0)) for name, value in sums.items()
    })
    joined = inner.join(
        offsets, (F.col(by) == F.col("_by")) & (F.col("_block") == F.col("_at")), "left")
    return joined.select(*df.columns, *[
        (F.col(name) + F.coalesce(f"_{name}", F.lit(0))).alias(name) for name in sums
    ])


def numbered_turns(
    conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", tables: WorkTables,
) -> DataFrame:
    """(conv_id, place, h1, h2, words) of every turn, placed 1, 2, ... in its conversation.

    Turns go by number, NULL first; equal numbers by a hash of role and text, so that repeated
    rows keep all their places. NULL role and text are empty. Rows without a conversation are
    in none and left out.
    """
    said = conversations.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter(F.col("conv_id").isNotNull())
    hashed = tables.write(said.select(
        "conv_id", "turn", F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit("turn"), "text", "role").alias("h2"),
        F.size(words_of(F.col("text"))).cast("long").alias("words"),
    ), "turns")
    # Below the block of any number, for the turns without one.
    block = F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(-2**62))
    placed = sums_before(
        hashed, "conv_id", block, [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")],
        {"place": F.lit(1).cast("long")},
    )
    return placed.select("conv_id", (F.col("place") + 1).alias("place"), "h1", "h2", "words")


def share_heads(
    turns: DataFrame, group: int, most: int, tables: WorkTables
) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of their group's first, and the list of all of them.

    Conversation c takes the first h = crc32(c) mod ``most`` turns of conversation c - c %
    ``group`` (all if it has fewer, none if there is none) and then its own after its first h.
    """
    own = F.col("conv_id")
    known = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    firsts = known.select(own.alias("_first"), F.col("n").alias("_n"))
    convs = known.select(
        "conv_id", (own - own % group).alias("first"),
        F.when(own % group == 0, F.lit(0)).otherwise(
            F.crc32(own.cast("string").cast("binary")) % most).cast("long").alias("h"),
    ).join(firsts, F.col("first") == F.col("_first"), "left").select(
        "conv_id", "first", "h", F.least("h", F.coalesce("_n", F.lit(0))).alias("taken"))
    convs = tables.write(convs, "conversations")
    heads = turns.filter((own % group == 0) & (F.col("place") < most)).select(
        own.alias("first"), F.col("place").alias("depth"), "h1", "h2", "words")
    taken = convs.join(heads, "first").filter(F.col("depth") <= F.col("taken"))
    rest = turns.join(convs, "conv_id").filter(F.col("place") > F.col("h")).withColumn(
        "depth", F.col("place") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "depth", "h1", "h2", "words"]
    return taken.select(columns).unionByName(rest.select(columns)), convs.select("conv_id")


def _turn_sums() -> dict[str, Column]:
    """Four 32-bit hashes of a turn at its depth; a sum of 2^31 of them fits a long."""
    pair = [F.xxhash64("depth", "h1", "h2"), F.xxhash64("h2", "h1", "depth")]
    halves = [part for value in pair for part in (
        value.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(value, 32))]
    return dict(zip(_KEY, halves, strict=True))


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's id lists in a row, comma-joined; rows come ordered by node."""
    node, digest = None, None

    def result() -> pa.RecordBatch:
        arrays = [pa.array([value], pa.int64()) for value in node]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array([digest.hexdigest()])], names=[*_NODE, "ends_sha256"])

    for batch in batches:
        keys = list(zip(*[column.to_pylist() for column in batch.columns[:len(_NODE)]]))
        for key, ids in zip(keys, batch.column(len(_NODE)).to_pylist(), strict=True):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    yield result()
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
    if node is not None:
        yield result()


def weighted_sequences(
    turns: DataFrame, convs: DataFrame, tables: WorkTables
) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences (depth, key, rep, weight), and their ends' digests by node.

    Conversations without a turn are the empty sequence. Ends are joined within blocks of ids,
    which bound the lists, and digested block after block.
    """
    totals = turns.withColumns(_turn_sums()).groupBy("conv_id").agg(
        F.max("depth").alias("depth"), *[F.sum(name).alias(name) for name in _KEY])
    members = convs.join(totals, "conv_id", "left").select(
        "conv_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in _NODE])
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = tables.write(
        members.groupBy(*_NODE, F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
            F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n"),
            F.array_join(ids, ",").alias("ids")), "ends")
    sequences = chunks.groupBy(*_NODE).agg(
        F.min("least").alias("rep"), F.sum("n").alias("weight"))
    digests = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "block").select(
        *_NODE, "ids"
    ).mapInArrow(_digest_runs, ", ".join(f"{name} long" for name in _NODE) + ", ends_sha256 string")
    return sequences, digests


def prefix_trie(turns: DataFrame, convs: DataFrame, tables: WorkTables) -> DataFrame:
    """One row per distinct prefix of the conversations' sequences, the empty one included.

    ``turns`` (conv_id, depth from 1, h1, h2, words) need no order; ``convs`` lists every
    conversation once, also those without a turn. No conversation, no node. Columns: conv_id
    (smallest member), depth, parent_conv_id (NULL at the root), n_convs, n_children, n_leaves
    (nodes without children in the subtree), saved_tokens (over the subtree, members beyond the
    first times the words of the last turn), ends_sha256 (of the ids that end there, ascending).
    Turns count as equal if two 64-bit hashes of them are.
    """
    sequences, ends = weighted_sequences(turns, convs, tables)
    sequences = tables.write(sequences, "sequences")

    # Every prefix of every sequence: its key, its parent's and its last turn's words.
    own = tables.write(turns.join(
        sequences.select(F.col("rep").alias("conv_id"), "weight",
                         F.col("depth").alias("length")), "conv_id"
    ).select(F.col("conv_id").alias("rep"), "depth", "words", "weight", "length",
             *[value.alias(f"t{name}") for name, value in _turn_sums().items()]), "steps")
    block = F.shiftright("depth", BLOCK_BITS)
    steps = sums_before(own, "rep", block, [F.col("depth")], {
        parent: F.col(f"t{name}") for parent, name in zip(_PARENT, _KEY)})
    zero = F.lit(0).cast("long")
    roots = sequences.select(
        "rep", zero.alias("depth"), zero.alias("words"), "weight",
        F.col("depth").alias("length"),
        *[zero.alias(name) for name in _KEY], *[F.lit(None).cast("long").alias(p) for p in _PARENT])
    paths = tables.write(roots.unionByName(steps.select(
        "rep", "depth", "words", "weight", "length", *_PARENT,
        *[(F.col(parent) + F.col(f"t{name}")).alias(name) for parent, name in zip(_PARENT, _KEY)],
    )), "paths")

    nodes = tables.write(paths.groupBy(*_NODE).agg(
        F.sum("weight").alias("n_convs"), F.min("rep").alias("conv_id"),
        F.max("words").alias("words"), *[F.min(p).alias(p) for p in _PARENT]), "nodes")
    inner = paths.filter("depth < length").select(*_NODE).distinct()
    leaves = sequences.join(inner, _NODE, "left_anti").select("rep")
    n_leaves = paths.join(leaves, "rep", "left_semi").groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("n_leaves"))
    below = nodes.filter("depth > 0")
    children = tables.write(below.groupBy(
        (F.col("depth") - 1).alias("depth"), *[F.col(p).alias(k) for p, k in zip(_PARENT, _KEY)]
    ).agg(F.count(F.lit(1)).alias("n_children")).join(
        nodes.select(*_NODE, "conv_id"), _NODE), "children")

    gathered = [
        nodes.select(*_NODE, "conv_id", "n_convs"),
        children.select(*_NODE, "n_children"), n_leaves, ends,
        _saved_tokens(paths, nodes), _parents(below, children),
    ]
    whole = gathered[0]
    for part in gathered[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    one = whole.groupBy(*_NODE).agg(*[F.max(name).alias(name) for name in whole.columns
                                      if name not in _NODE])
    return one.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def _saved_tokens(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Savings of each node's subtree.

    A node's own savings are booked once, on the sequence of its smallest member, at its depth;
    each prefix of that sequence then holds what is booked at its depth and below.
    """
    booked = nodes.select(
        F.col("conv_id").alias("rep"), F.col("depth").alias("_depth"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("cost")).filter("cost > 0")
    totals = booked.groupBy("rep").agg(F.sum("cost").alias("total"))
    steps = paths.select("rep", *_NODE).join(totals, "rep").join(
        booked.withColumnRenamed("rep", "_rep"),
        (F.col("rep") == F.col("_rep")) & (F.col("depth") == F.col("_depth")), "left")
    above = sums_before(
        steps.select("rep", *_NODE, "total", F.coalesce("cost", F.lit(0)).alias("cost")),
        "rep", F.shiftright("depth", BLOCK_BITS), [F.col("depth")], {"before": F.col("cost")})
    return above.groupBy(*_NODE).agg(
        F.sum(F.col("total") - F.col("before")).alias("saved_tokens"))


def _parents(below: DataFrame, children: DataFrame) -> DataFrame:
    """Each node's parent's smallest member; parents of very many children travel to them."""
    many = children.filter(F.col("n_children") > MANY_CHILDREN)
    keys = [F.col("depth").alias("_depth"), *[F.col(k).alias(f"_{k}") for k in _KEY]]

    def match(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        named = right.select(*keys, F.col("conv_id").alias("parent_conv_id"))
        same = F.col("depth") == F.col("_depth") + 1
        for parent, key in zip(_PARENT, _KEY):
            same = same & (F.col(parent) == F.col(f"_{key}"))
        return left.join(broadcast_if_small(named, n_many) if right is many else named, same, how)

    n_many = many.count()
    asked = below.select(*_NODE, *_PARENT)
    found = match(asked, many, "inner").select(*_NODE, "parent_conv_id")
    rest = match(match(asked, many, "left_anti"), children, "inner")
    return found.unionByName(rest.select(*_NODE, "parent_conv_id"))


GROUP, MOST = 20, 4


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    tables = WorkTables(spark)
    turns = tables.write(
        numbered_turns(table(spark, folder, "conversations"), tables=tables), "numbered")
    rebuilt, convs = share_heads(turns, GROUP, MOST, tables)
    return prefix_trie(tables.write(rebuilt, "rebuilt"), convs, tables)


_CRC = (
    "xor(list_reduce(list_transform(range(length(d)), lambda i: "
    "CAST(ascii(substr(d, CAST(i AS INTEGER) + 1, 1)) AS BIGINT)), lambda a, b: "
    "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: "
    "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), "
    "CAST(4294967295 AS BIGINT)), 4294967295)"
)

OP12_SQL = rf"""
WITH turns AS (
       SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
              coalesce(role, '') AS role, coalesce(text, '') AS text
       FROM conversations WHERE conv_id IS NOT NULL),
     convs AS (
       SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {_CRC} % {MOST} AS h
       FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS d FROM turns)),
     parts AS (
       SELECT c.conv_id, 0 AS part, t.place, role, text
       FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
       UNION ALL
       SELECT c.conv_id, 1, t.place, role, text
       FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
     rebuilt AS (
       SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY part, place) AS said
       FROM parts GROUP BY conv_id),
     whole AS (
       SELECT c.conv_id, coalesce(said, []) AS said
       FROM convs c LEFT JOIN rebuilt USING (conv_id)),
     steps AS (
       SELECT conv_id, said, CAST(depth AS BIGINT) AS depth, said[1:depth] AS path,
              depth = len(said) AS ends
       FROM (SELECT conv_id, said, unnest(range(len(said) + 1)) AS depth FROM whole)),
     nodes AS (
       SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
              sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                              FILTER (ends), '')) AS ends_sha256,
              CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(list_filter(regexp_split_to_array(
                path[depth].t, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS saved
       FROM steps GROUP BY path, depth),
     children AS (
       SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
     flat AS (
       SELECT n.*, coalesce(c.n, 0) AS n_children
       FROM nodes n LEFT JOIN children c ON n.path = c.path),
     below AS (
       SELECT path[1:up] AS path, sum(saved) AS saved,
              count(*) FILTER (n_children = 0) AS n_leaves
       FROM (SELECT *, unnest(range(depth + 1)) AS up FROM flat) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM flat f JOIN below b ON f.path = b.path
LEFT JOIN nodes p ON f.depth > 0 AND p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]
"""
