"""Exact top-k inner products by aggregation of sorted lists without random access."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.common import table

# Lists are read in this many steps, all to the same depth; bounds are compared after each.
_STEPS = 8
# Once at most this share of a block's vectors is left for a query, their scores are resolved.
_FEW = 1 / 16
_BLOCK = 2048
# Queries of a block that read side by side.
_TOGETHER = 256


def whole_steps(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; NULL for a vector that is NULL or holds a component
    that is NULL, NaN or infinite. A step beyond 2^62 is an error, for it has no exact long."""
    good = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    step = lambda x: x.cast("double") * scale
    refused = F.raise_error(F.lit("a component is too large for exact scores")).cast("bigint")
    return F.when(good, F.transform(vector, lambda x: F.when(
        F.abs(step(x)) < float(2**62), F.floor(step(x))).otherwise(refused)))


def _number_type(vectors: np.ndarray, queries: np.ndarray) -> type:
    """The smallest type in which every sum of products is exact."""
    most = vectors.shape[1] * float(np.abs(vectors).max(initial=0)) * float(
        np.abs(queries).max(initial=0))
    if most >= 2**62:
        raise ValueError("components are too large for scores of 64 bits")
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


class SortedLists:
    """The vectors of one block as a list per component, and each vector's rank in the lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.lists = np.take_along_axis(vectors, order, axis=0)
        self.rank = np.empty(vectors.shape, dtype=np.int32)
        np.put_along_axis(self.rank, order, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)
        self.entries_read = self.resolved = 0

    def qualify(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query numbers, scores, ids) of the vectors that reading could not rule out.

        Every query reads all lists it has a weight for, a step at a time and from the high end
        where its component is positive, else from the low end; queries read side by side.
        A vector's known products add up as they are read; an entry not yet read lies
        between the last one read and the list's other end. So each vector has a lower and an
        upper bound, and one that no list has shown yet is bounded by the last entries alone.
        Vectors whose upper bound is below the k-th best lower bound, or below the query's
        ``floor``, are out. A query stops reading when few vectors are left or its lists end;
        only the scores of those left are resolved. Its own id is no candidate.
        """
        size, kind = len(self.ids), queries.dtype
        number = np.arange(len(queries))
        left = query_ids[:, None] != self.ids[None, :]
        known = np.zeros(left.shape, dtype=kind)
        floor = floor.copy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        start = 0
        for step in range(_STEPS + 1):
            # Queries with few vectors left, or at the end of their lists, are resolved.
            done = (left.sum(axis=1) <= max(k, _FEW * size)) | (step == _STEPS)
            if done.any():
                query, place = np.divmod(np.flatnonzero(left[done]), size)
                scores = np.einsum("ij,ij->i", queries[done][query], self.vectors[place])
                found.append((number[done][query], scores.astype(np.int64), self.ids[place]))
                self.resolved += len(place)
                keep = ~done
                number, queries, left = number[keep], queries[keep], left[keep]
                known, floor = known[keep], floor[keep]
            end = size * (step + 1) // _STEPS
            if not len(queries):
                break
            if end == start:
                continue
            up, down = np.maximum(queries, 0), np.minimum(queries, 0)
            high = (self.rank >= size - end) & (self.rank < size - start)
            low = (self.rank >= start) & (self.rank < end)
            known += up @ np.where(high, self.vectors, 0).T + down @ np.where(low, self.vectors, 0).T
            self.entries_read += int(np.count_nonzero(queries)) * (end - start)
            start = end
            last_high, last_low = up * self.lists[size - end], down * self.lists[end - 1]
            if 2 * (step + 1) < _STEPS and (
                    (last_high.sum(axis=1) + last_low.sum(axis=1)) >= floor).all():
                continue  # nothing is ruled out while vectors not seen yet could qualify
            unread_high = (self.rank < size - end).astype(kind).T
            unread_low = (self.rank >= end).astype(kind).T
            upper = known + last_high @ unread_high + last_low @ unread_low
            if size > k:
                lower = known + (up * self.lists[0]) @ unread_high + (
                    down * self.lists[-1]) @ unread_low
                lower[query_ids[number][:, None] == self.ids[None, :]] = _least(kind)
                best = np.partition(lower, size - k, axis=1)[:, size - k]
                floor = np.maximum(floor, best)
            left &= upper >= floor[:, None]
        columns = [np.concatenate(column) for column in zip(*found, strict=True)]
        return columns[0], columns[1], columns[2]


def _least(kind: np.dtype) -> float:
    return np.iinfo(kind).min if np.issubdtype(kind, np.integer) else -np.inf


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[dict[str, np.ndarray], int, int]:
    """The ``k`` best of each query, how many entries of lists were read, and scores resolved.

    Vectors come block by block, so that the k-th best of earlier blocks bounds later ones.
    """
    held = [np.empty(0, dtype=np.int64)] * 3
    floor = np.full(len(queries), _least(queries.dtype), dtype=queries.dtype)
    read = resolved = 0
    for at in range(0, len(ids), _BLOCK):
        block = SortedLists(ids[at:at + _BLOCK], vectors[at:at + _BLOCK])
        new = [held]
        for first in range(0, len(queries), _TOGETHER):
            some = slice(first, first + _TOGETHER)
            number, score, own = block.qualify(query_ids[some], queries[some], k, floor[some])
            new.append([number + first, score, own])
        query, score, own = (np.concatenate(column) for column in zip(*new, strict=True))
        order = np.lexsort((own, -score, query))
        query, score, own = query[order], score[order], own[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        held = [column[place < k] for column in (query, score, own)]
        full = place == k - 1
        floor[query[full]] = score[full]
        read, resolved = read + block.entries_read, resolved + block.resolved
    return {"query_id": query_ids[held[0]], "vec_id": held[2], "score": held[1]}, read, resolved


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer rows, shorter ones filled up with zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _search(k: int):
    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy().astype(bool)
        both = group.column("v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        matrix = _matrix(group.column("v"), int(both.max(initial=0)))
        ids = group.column("id").to_numpy()
        queries, vectors = matrix[asks], matrix[~asks]
        kind = _number_type(vectors, queries)
        found, _, _ = search(ids[~asks], vectors.astype(kind), ids[asks], queries.astype(kind), k)
        return pa.table({name: pa.array(column, pa.int64()) for name, column in found.items()})

    return run


def top_inner_products(
    vectors: DataFrame, queries: DataFrame, k: int, *, key: str = "vec_id", vector: str = "v",
    candidate_rows: int = 8192, query_rows: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best vectors of each query, all if fewer.

    ``vector`` columns are arrays of whole numbers; scores are exact inner products, ties go
    to the smaller id, and a query's own id is no candidate. The query set meets all
    vectors block by block: every pair of a query part and a vector part is one task with
    at most about ``query_rows`` and ``candidate_rows`` rows. The task sorts its vectors into
    one list per component, reads these for each query and keeps its k best; the parts' best
    are merged per query. Rows with a NULL id or vector take no part; repeated rows are
    candidates each; equal queries of one id count as one, and an id with several vectors
    asks with each, its answers ranked together. Shorter vectors are filled up with zeros.
    Empty tables give no rows; other columns are ignored, whatever their names. Components
    whose sums of products could pass 62 bits are an error.
    """

    def numbered(df: DataFrame, parts: int, name: str) -> DataFrame:
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
        return rows.filter("id IS NOT NULL AND v IS NOT NULL").withColumn(
            name, F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int"))

    columns = max(1, -(-vectors.count() // candidate_rows))
    rows = max(1, -(-queries.count() // query_rows))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = numbered(vectors, columns, "c").withColumn("r", every(rows)).withColumn("asks", F.lit(0))
    asked = numbered(queries.dropDuplicates([key, vector]), rows, "r").withColumn(
        "c", every(columns)).withColumn("asks", F.lit(1))
    found = held.unionByName(asked).groupBy("c", "r").applyInArrow(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


SCALE, BEST, EVERY = 64, 20, 20


def op10_nra_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of every 20th vector among all others."""
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", whole_steps(F.col("embedding"), SCALE).alias("v")
    ).filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    queries = vectors.filter(F.col("vec_id") % EVERY == 0)
    return top_inner_products(vectors, queries, BEST)
