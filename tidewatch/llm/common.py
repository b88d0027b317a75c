"""Helpers that several corpus operators share."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The six bytes that separate words.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

# Rows up to which a lookup of a few numbers a row is broadcast; it is counted first.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; the path stays text, so any file system Spark reads will do."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A frame of a bounded list that the driver made, such as splitters or a plan.

    ``schema`` is ``name type,name type``; fields within a struct are parted by semicolons.
    The rows travel as one JSON literal, so no Python runs on executors.
    """
    columns = [part.split(" ", 1) for part in schema.split(",")]
    text = json.dumps([
        {name: value for (name, _), value in zip(columns, row, strict=True)} for row in rows
    ])
    fields = ",".join(f"{name}:{kind.replace(';', ',')}" for name, kind in columns)
    parsed = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    return spark.range(1, numPartitions=1).select(F.inline(parsed))


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the counted ``rows`` of ``df`` are few; else leave it to a shuffle join."""
    return F.broadcast(df) if rows <= limit else df


def row_struct(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that helper columns beside it clash with none."""
    return F.struct(*[df[f"`{name}`"] for name in df.columns])


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; no text, no words."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def unit_hash(*columns: Column) -> Column:
    """A uniform number in [0, 1) that depends on the columns' text alone: the first 48 bits of MD5."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def crc_fold(column: str, folds: int) -> Column:
    """CRC-32 of a value's text modulo ``folds``; NULL is in fold -1."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce((crc % folds).cast("int"), F.lit(-1))
