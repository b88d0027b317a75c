"""MinHash near-duplicates by a multi-index Hamming join, links confirmed on full sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.common import broadcast_if_small, row_struct, table
from tidewatch.llm.components import connected_components
from tidewatch.llm.shingles import WordHashes, mix, shingle_set, signature, signature_seeds
from tidewatch.sources.work import WorkTables

# Signatures of 64 components of 16 bits. They are cut into 16 chunks of 4, so two that differ
# in at most 31 components differ in at most one component of some chunk (pigeonhole). One
# key per chunk and component left out enumerates these errors: such a pair shares a key.
# At a similarity of 0.75, 16 of 64 differ on average, and over 31 in about 1 of 50,000 pairs.
COMPONENTS, CHUNKS = 64, 16
_WIDE = COMPONENTS // CHUNKS
FARTHEST = 2 * CHUNKS - 1
PERCENT = 75
# Members of one group that are compared in one go: by signature; by full set around one
# smallest member; and by full set within a key.
SIGN_SLICE, STAR_SLICE, SET_SLICE = 1024, 256, 512


def _arrow(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, from sums over its members."""
    with np.errstate(over="ignore"):
        first = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        second = (shingles * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(np.int64(first)), int(np.int64(second))


def shingle_signatures(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """(doc, n_shingles, h1, h2, sig): size, hash and signature of each row's shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seeds = WordHashes(), signature_seeds(COMPONENTS)
        for batch in batches:
            sizes, first, second, signs = [], [], [], []
            for value in batch.column(1):
                found = shingle_set(value.as_py(), hashes)
                one, two = _set_hash(found)
                sizes.append(len(found))
                first.append(one)
                second.append(two)
                signs.append(signature(found, seeds).tobytes() if len(found) else None)
            yield _arrow(
                doc=batch.column(0), n_shingles=pa.array(sizes, pa.int64()),
                h1=pa.array(first, pa.int64()), h2=pa.array(second, pa.int64()),
                sig=pa.array(signs, pa.binary()),
            )

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc long, n_shingles long, h1 long, h2 long, sig binary")


def chunk_keys(signs: np.ndarray) -> np.ndarray:
    """(rows x 64) keys: chunk, component left out, and the chunk's other three components."""
    keys = np.empty((len(signs), COMPONENTS), dtype=np.int64)
    wide = signs.astype(np.int64)
    for chunk in range(CHUNKS):
        for out in range(_WIDE):
            key = np.full(len(signs), chunk * _WIDE + out, dtype=np.int64)
            for i in range(_WIDE):
                if i != out:
                    key = (key << 16) | wide[:, chunk * _WIDE + i]
            keys[:, chunk * _WIDE + out] = key
    return keys


def _signs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, COMPONENTS)


def index_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): the 64 keys of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = chunk_keys(_signs(batch.column(1)))
                owners = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), COMPONENTS)
                yield _arrow(key=pa.array(keys.ravel()), node=pa.array(owners))

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def within_distance(pairs: DataFrame, farthest: int = FARTHEST) -> DataFrame:
    """Those pairs (a, b, sig_a, sig_b) whose signatures differ in at most ``farthest`` components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                differ = (_signs(batch.column(2)) != _signs(batch.column(3))).sum(axis=1)
                near = batch.filter(pa.array(differ <= farthest))
                yield near.select(["a", "b"])

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _by_group(
    batches: Iterator[pa.RecordBatch], keys: int, handle: Callable[[pa.Table], pa.RecordBatch | None]
) -> Iterator[pa.RecordBatch]:
    """Hands each run of rows of equal leading ``keys`` to ``handle``; rows come sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        new = np.zeros(rows.num_rows, dtype=bool)
        for i in range(keys):
            values = rows.column(i).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.r_[0, np.flatnonzero(new)]
        for start, end in zip(starts, starts[1:], strict=False):
            found = handle(rows.slice(start, end - start))
            if found is not None:
                yield found
        rest = rows.slice(starts[-1])
    if rest is not None:
        found = handle(rest.combine_chunks())
        if found is not None:
            yield found


def _sorted_groups(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def _owned_pairs(key: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which (left x right) signature pairs are near and meet first at this key.

    A pair that shares several keys is handled at the first: the first chunk with at most
    one error, and there, without an error, the first component left out.
    """
    chunk, out = divmod(key >> (16 * (_WIDE - 1)), _WIDE)
    differ = left[:, None, :] != right[None, :, :]
    near = differ.sum(axis=2) <= FARTHEST
    errors = differ.reshape(*differ.shape[:2], CHUNKS, _WIDE)[:, :, :chunk + 1].sum(axis=3)
    first = (errors[:, :, :chunk] > 1).all(axis=2)
    return near & first & ((errors[:, :, chunk] > 0) | (out == 0))


def open_members(rows: DataFrame) -> DataFrame:
    """Members of slices (key, i, j, side, node, comp, sig) with a near partner in another component.

    ``side`` tells slice ``i`` from slice ``j``. Pairs stay inside the task; what comes out
    is at most every row once.
    """

    def handle(group: pa.Table) -> pa.RecordBatch | None:
        sides, nodes, comps = (group.column(n).to_numpy() for n in ("side", "node", "comp"))
        if (comps == comps[0]).all():
            return None
        signs = _signs(group.column("sig"))
        key, i, j = (group.column(n)[0].as_py() for n in ("key", "i", "j"))
        a = np.flatnonzero(sides == i)
        b = a if i == j else np.flatnonzero(sides == j)
        used = np.zeros(len(nodes), dtype=bool)
        for at in range(0, len(a), 32):
            part = a[at:at + 32]
            open_pair = _owned_pairs(key, signs[part], signs[b]) & (comps[part][:, None] != comps[b])
            used[part[open_pair.any(axis=1)]] = True
            used[b[open_pair.any(axis=0)]] = True
        if not used.any():
            return None
        taken = group.select(["key", "i", "j", "node"]).filter(pa.array(used)).combine_chunks()
        return taken.to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_group(batches, 3, handle)

    columns = ["key", "i", "j", "side", "node", "comp", "sig"]
    return _sorted_groups(rows.select(*columns), "key", "i", "j").mapInArrow(
        run, "key long, i int, j int, node long"
    )


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Matrix of which sets have 100 * intersection >= percent * union."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, number, counts = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    renumbered = np.cumsum(shared) - 1
    keep = shared[number]
    owner, number = owner[keep], renumbered[number[keep]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    common = np.zeros((len(sets), len(sets)))
    width = 4096
    for at in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(number, [at, at + width])
        block = np.zeros((len(sets), width), dtype=np.float32)
        block[owner[low:high], number[low:high] - at] = 1.0
        common += block @ block.T
    union = sizes[:, None] + sizes[None, :] - common
    return 100 * common >= percent * union


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``linked`` connects, one less than members."""
    edges, open_ = [], np.ones(len(linked), dtype=bool)
    for root in range(len(linked)):
        if not open_[root]:
            continue
        open_[root], queue = False, [root]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(linked[at] & open_)
            open_[found] = False
            edges += [(at, int(to)) for to in found]
            queue += found.tolist()
    return edges


def confirmed_links(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) links among the members of each group (g1, g2, g3, node, shingles).

    Groups are slices of bounded size, compared exactly on full sets by matrix products;
    at most one link less than a group's members comes out, and none is lost between
    what they connect.
    """

    def handle(group: pa.Table) -> pa.RecordBatch | None:
        nodes = group.column("node").to_numpy()
        if len(nodes) < 2:
            return None
        sets = [np.frombuffer(s.as_py(), dtype=np.uint64) for s in group.column("shingles")]
        edges = _forest(_linked(sets, percent))
        if not edges:
            return None
        a, b = nodes[[x for x, _ in edges]], nodes[[y for _, y in edges]]
        return _arrow(a=pa.array(a), b=pa.array(b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_group(batches, 3, handle)

    columns = ["g1", "g2", "g3", "node", "shingles"]
    links = _sorted_groups(rows.select(*columns), "g1", "g2", "g3").mapInArrow(run, "a long, b long")
    return links.filter("a <> b")


def full_sets(docs: DataFrame, wanted: DataFrame, *, key: str, text: str) -> DataFrame:
    """(node, shingles): full sets of the wanted nodes (node, h1, h2), from their documents."""
    few = broadcast_if_small(wanted, wanted.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keep, sets = [], []
            first, second = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, value in enumerate(batch.column(1)):
                found = shingle_set(value.as_py(), hashes)
                if _set_hash(found) == (first[i], second[i]):
                    keep.append(i)
                    sets.append(found.tobytes())
            yield _arrow(node=batch.column(0).take(pa.array(keep, pa.int64())),
                         shingles=pa.array(sets, pa.binary()))

    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    return rows.join(few, "node").select("node", "text", "h1", "h2").mapInArrow(
        run, "node long, shingles binary"
    )


def _sliced(rows: DataFrame, keys: list[str], width: int, tables: WorkTables) -> DataFrame:
    """Adds ``slices``, of about ``width`` members each, and ``slice``, the row's own.

    Sizes are a written table, so the join with them can be split at a hot group.
    """
    sizes = tables.write(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    return rows.join(sizes, keys).withColumn(
        "slices", F.ceil(F.col("n") / width).cast("int")).withColumn("slice", own).drop("n")


def _slice_pairs(sliced: DataFrame) -> DataFrame:
    """Each row once per slice of its group, as a member of the pair of slices (i, j)."""
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    kept = [name for name in sliced.columns if name not in ("slice", "slices")]
    return sliced.select(*kept, F.col("slice").alias("side"), every).select(
        *kept, "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))


def _nodes(signed: DataFrame) -> DataFrame:
    """One node per distinct set, named by its smallest document: (node, h1, h2, sig)."""
    held = signed.filter((F.col("n_shingles") > 0) & F.col("doc").isNotNull())
    return held.groupBy("h1", "h2").agg(F.min("doc").alias("node"), F.first("sig").alias("sig"))


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", tables: WorkTables | None = None,
) -> DataFrame:
    """(doc, n_shingles, component_id) of each row of ``docs``.

    Documents of 75 percent or more common five-word shingles are linked; a component is
    named by its smallest document. The steps, all on written tables:

    1. Equal sets collapse to one node. Each node has 64 index keys; nodes within the
       signature distance share one (see the constants above).
    2. Each key links its members to the smallest of them, where the signatures are near
       and full sets confirm it. That joins groups of copies without their pairs.
    3. Keys whose members are still in several components are compared member by member,
       in slices of bounded size inside tasks. Only members with a near, unjoined partner
       come out; their full sets are compared in the same slices, and only links that
       connect come out. So every pair within the distance is confirmed, refuted, or joined.

    Rows with the same key are one document; rows without a key or without a word have no
    links (their component is their own key).
    """
    spark = docs.sparkSession
    tables = tables or WorkTables(spark)
    signed = tables.write(shingle_signatures(docs, key=key, text=text), "signatures")
    nodes = tables.write(_nodes(signed), "nodes")
    named = nodes.select("node", "h1", "h2")
    signs = nodes.select("node", "sig")
    keys = index_keys(nodes)

    pivots = tables.write(
        keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .filter("pivot < last").select("key", "pivot"), "pivots")
    members = tables.write(keys.join(pivots, "key"), "members")
    stars = members.filter("node <> pivot").select(
        F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    near = tables.write(within_distance(
        stars.join(signs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(signs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")), "near")
    sliced = tables.write(
        _sliced(near.select("a", F.col("b").alias("node")), ["a"], STAR_SLICE, tables), "star-slices")
    centres = sliced.select("a", "slice").distinct().select("a", "slice", F.col("a").alias("node"))
    links = tables.write(_confirm(
        docs, named, sliced.select("a", "slice", "node").unionByName(centres).select(
            F.col("a").alias("g1"), F.col("slice").alias("g2"), F.lit(0).alias("g3"), "node"),
        key=key, text=text, tables=tables), "links")
    joined = connected_components(links, tables)

    placed = tables.write(
        members.select("key", "node").join(joined, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("comp")), "placed")
    unsettled = tables.write(
        placed.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
        .filter("least < most").select("key"), "unsettled")
    spread = _slice_pairs(
        _sliced(tables.write(placed.join(unsettled, "key"), "unsettled-members"), ["key"],
                SIGN_SLICE, tables))
    left = tables.write(open_members(spread.join(signs, "node")), "open")
    pairs = _slice_pairs(_sliced(left, ["key", "i", "j"], SET_SLICE, tables).select(
        F.xxhash64("key", "i", "j").alias("g1"), "node", "slice", "slices"))
    more = tables.write(_confirm(
        docs, named, pairs.select("g1", F.col("i").alias("g2"), F.col("j").alias("g3"), "node"),
        key=key, text=text, tables=tables), "more-links")
    components = connected_components(links.unionByName(more), tables)

    labelled = named.join(components, "node", "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
        F.coalesce("component", "node").alias("component"))
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("n_shingles") > 0)
    return signed.drop("sig").join(labelled, same, "left").select(
        "doc", "n_shingles",
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"))


def _confirm(
    docs: DataFrame, named: DataFrame, groups: DataFrame, *, key: str, text: str, tables: WorkTables
) -> DataFrame:
    wanted = tables.write(groups.select("node").distinct().join(named, "node"), "wanted")
    sets = full_sets(docs, wanted, key=key, text=text)
    return confirmed_links(groups.join(sets, "node"))


def keep_one_per_group(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", tables: WorkTables | None = None
) -> DataFrame:
    """The rows of ``docs`` whose key names their component; rows without a key stay.

    Of rows that repeat a kept key all stay, since they are one document.
    """
    found = near_duplicates(docs, key=key, text=text, tables=tables)
    gone = found.filter(F.col("doc") != F.col("component_id")).select("doc").distinct()
    rows = docs.select(row_struct(docs).alias("row"), F.col(key).cast("long").alias("_key"))
    return rows.join(
        broadcast_if_small(gone, gone.count()), F.col("_key") == F.col("doc"), "left_anti"
    ).select(*[F.col("row")[name].alias(name) for name in docs.columns])


def op9_minhash_hamming(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(
        F.col("doc").alias("doc_id"), "n_shingles", "component_id",
        F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"))
