"""Finding keys that one task cannot take, with driver-side data of a proven size.

Each helper runs one narrow job over a single column. What it finds decides on
routes only; every route gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewatch.sources.work import WorkTables


@dataclass(frozen=True)
class SkewLimits:
    """``group_rows``: rows of one key that a single task may sort.
    ``lookup_rows``: most rows of a lookup that passes through the driver.
    ``broadcast_rows``: most rows of a broadcast lookup of 8-byte hashes."""

    group_rows: int = 5_000_000
    lookup_rows: int = 200_000
    broadcast_rows: int = 10_000_000


DEFAULT_LIMITS = SkewLimits()

# Rows of a key at the limit that a sample is to hold, and how many of them settle it.
_EXPECTED_HITS = 400
_ENOUGH_HITS = 300


def heavy_keys(df: DataFrame, column: str, limits: SkewLimits = DEFAULT_LIMITS) -> list:
    """Values of ``column`` (NULL included) held by about ``group_rows`` rows or more.

    With a high limit a sample is counted, so that the job shuffles next to
    nothing: a key at the limit has 400 expected rows in it, and 300 suffice.
    Should there be more than ``lookup_rows`` such keys, the heaviest are
    returned; every other key then has at most ``total / lookup_rows`` rows.
    """
    keys, least = df.select(column), limits.group_rows
    if least > _EXPECTED_HITS:
        keys, least = keys.sample(_EXPECTED_HITS / least, seed=0), _ENOUGH_HITS
    counts = keys.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.filter(F.col("n") >= least).orderBy(F.desc("n"))
    return [row[0] for row in heavy.limit(limits.lookup_rows).collect()]


def key_lookup(spark: SparkSession, keys: list, column: str, kind: T.DataType) -> DataFrame:
    """Broadcastable one-column frame of a bounded key list."""
    schema = T.StructType([T.StructField(column, kind, True)])
    return F.broadcast(spark.createDataFrame([(key,) for key in keys], schema))


def split_by_keys(df: DataFrame, column: str, keys: list) -> tuple[DataFrame, DataFrame]:
    """(rows of the listed keys, all other rows), without moving a row."""
    lookup = key_lookup(df.sparkSession, keys, "_key", df.schema[column].dataType)
    same = F.col(column).eqNullSafe(F.col("_key"))
    return df.join(lookup, same, "left_semi"), df.join(lookup, same, "left_anti")


@dataclass(frozen=True)
class RepeatedKeys:
    """Hashes of keys that occur more than once.

    ``lookup`` is a broadcastable frame ``(_hash)``, or None if it would be empty.
    ``complete`` says whether it holds every repeated key or only the heaviest;
    ``few``, whether it is at most ``lookup_rows`` long.
    """

    lookup: DataFrame | None
    complete: bool
    few: bool
    most_copies: int


def repeated_keys(df: DataFrame, key: Column, limits: SkewLimits = DEFAULT_LIMITS) -> RepeatedKeys:
    """Hashes of repeated keys. Only 16 bytes per distinct key are shuffled.

    A hash collision may list a key that is unique; callers decide on the key
    itself, so that costs a little work and never changes a result.
    """
    spark = df.sparkSession
    copies = (
        df.select(F.xxhash64(key).alias("_hash"))
        .groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        found, most = copies.agg(F.count(F.lit(1)), F.max("n")).first()
        if found == 0:
            return RepeatedKeys(None, True, True, 0)
        if limits.lookup_rows < found <= limits.broadcast_rows:
            # The table is left behind for the plans that read it.
            table = WorkTables(spark).write(copies.select("_hash"), "repeated-keys")
            return RepeatedKeys(F.broadcast(table), True, False, most)
        complete = found <= limits.lookup_rows
        if not complete:
            heavy = copies.filter(F.col("n") >= limits.group_rows)
            copies_listed = heavy.orderBy(F.desc("n")).limit(limits.lookup_rows)
        else:
            copies_listed = copies
        hashes = copies_listed.select("_hash").toArrow()
    finally:
        copies.unpersist()
    if hashes.num_rows == 0:
        return RepeatedKeys(None, complete, True, 0)
    return RepeatedKeys(F.broadcast(spark.createDataFrame(hashes)), complete, True, most)
