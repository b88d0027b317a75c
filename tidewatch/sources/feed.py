"""Reading the feed: JSON-lines directories (batch and stream), text, memory."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from tidewatch.schema import (
    CAPTURE_SCHEMA, CORE_COLUMNS, CORRUPT_COLUMN, FEED_SCHEMA, ISO_FORMAT,
)

_PARSER_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def require_utc(spark: SparkSession) -> SparkSession:
    """Hours, and the epoch of zone-less timestamps, are only defined under UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}, set it to 'UTC'")
    return spark


def _schema(capture: bool) -> T.StructType:
    return CAPTURE_SCHEMA if capture else FEED_SCHEMA


def read_feed(spark: SparkSession, path: str, *, capture: bool = False) -> DataFrame:
    """JSON-lines directory against the declared schema, never failing on a bad line.

    A line or field that does not parse becomes NULL. With ``capture`` the text
    of such a line is kept in ``_corrupt_record`` as well.
    """
    reader = require_utc(spark).read.schema(_schema(capture)).options(**_PARSER_OPTIONS)
    return reader.json(path)


def read_feed_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A feed already landed as Parquet: only the core columns are read."""
    return require_utc(spark).read.parquet(path).select(*CORE_COLUMNS)


def stream_feed(
    spark: SparkSession, path: str, *, capture: bool = False, max_files: int | None = 1
) -> DataFrame:
    """The same directory as an unbounded source, ``max_files`` files per trigger
    (None: all that landed)."""
    reader: DataStreamReader = require_utc(spark).readStream.schema(_schema(capture))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**_PARSER_OPTIONS).json(path)


def parse_lines(df: DataFrame, column: str) -> DataFrame:
    """JSON lines held in a text column, parsed as the capturing reader would."""
    parsed = F.from_json(F.col(column), CAPTURE_SCHEMA, _PARSER_OPTIONS)
    return df.select(parsed.alias("_row")).select("_row.*")


def parse_iso_ts(column: str) -> Column:
    """ISO-8601 text to a timestamp; text of another shape becomes NULL."""
    return F.try_to_timestamp(F.col(column), F.lit(ISO_FORMAT))


def rows_to_feed(spark: SparkSession, rows: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Small in-memory feed from dicts; ISO text in ``txn_ts`` is parsed by Spark."""
    records = [{name: row.get(name) for name in CORE_COLUMNS} for row in rows]
    if not any(isinstance(record["txn_ts"], str) for record in records):
        return spark.createDataFrame(records, FEED_SCHEMA)
    textual = T.StructType([
        T.StructField(field.name, T.StringType() if field.name == "txn_ts" else field.dataType)
        for field in FEED_SCHEMA.fields
    ])
    for record in records:
        if record["txn_ts"] is not None and not isinstance(record["txn_ts"], str):
            record["txn_ts"] = record["txn_ts"].strftime("%Y-%m-%dT%H:%M:%S")
    frame = spark.createDataFrame(records, textual)
    return frame.withColumn("txn_ts", parse_iso_ts("txn_ts")).select(*CORE_COLUMNS)
