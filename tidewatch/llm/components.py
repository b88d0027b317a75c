"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.sources.work import WorkTables


def connected_components(links: DataFrame, tables: WorkTables) -> DataFrame:
    """(node, component) of every node that has a link; a component is its smallest node.

    ``links`` (a, b) may repeat, in either direction. Each round hangs nodes under smaller
    neighbours; both halves read written tables, so lost executors cost one round at most.
    The smallest neighbour is a minimum that combines before the shuffle, and joins of
    two written tables let adaptive execution split a hot node.
    """
    edges = tables.write(
        links.filter("a <> b").select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
        edges = _large_star(edges, tables)
        edges = _small_star(edges, tables)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large_star(edges: DataFrame, tables: WorkTables) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = tables.write(
        both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tables.write(moved.distinct(), "large-star")


def _small_star(edges: DataFrame, tables: WorkTables) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = tables.write(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").filter("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return tables.write(moved.unionByName(kept).distinct(), "small-star")
