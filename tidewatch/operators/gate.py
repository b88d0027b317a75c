"""Data-quality gate: name what is wrong with a row, then split, never drop."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewatch.functions.checks import compile_checks
from tidewatch.operators.skew import DEFAULT_LIMITS, RepeatedKeys, SkewLimits, repeated_keys


# Copies that one row unfolds to at once.
_UNFOLDED_ROWS = 100_000


def _no_failures() -> Column:
    return F.array().cast("array<string>")


def _arrival_order(df: DataFrame, key: str, time_column: str) -> list[Column]:
    """Earliest first, rows without a time last; the other columns break ties."""
    rest = [
        F.col(field.name)
        for field in df.schema.fields
        if field.name not in (key, time_column) and not isinstance(field.dataType, T.MapType)
    ]
    return [F.col(time_column).isNull(), F.col(time_column), *rest]


def _contest(
    df: DataFrame, key: str, order: list[Column], flag: str, repeated: RepeatedKeys,
    chunk_rows: int,
) -> DataFrame:
    """Flag all rows but the first of each key, without gathering a key's rows.

    Identical rows collapse to one row and a number on the map side, the first
    row of a key is a minimum (combined on the map side too), and the numbers
    are unfolded again afterwards, big ones in chunks that are shuffled apart
    first.
    """
    names = df.columns
    rank = F.struct(*[column.alias(f"o{i}") for i, column in enumerate(order)])
    contents = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).withColumn("_rank", rank)
    first = contents.groupBy(F.col(key).alias("_key")).agg(F.min("_rank").alias("_first"))
    if repeated.few:
        first = F.broadcast(first)  # one row per listed key
    judged = contents.join(first, F.col(key).eqNullSafe(F.col("_key"))).select(
        *names, "_n", F.col("_rank").eqNullSafe(F.col("_first")).alias("_is_first")
    )
    start = F.lit(0).cast("long")
    if repeated.most_copies > chunk_rows:
        step = F.lit(chunk_rows).cast("long")
        chunk_starts = F.sequence(start, F.col("_n") - 1, step)
        judged = judged.withColumn("_from", F.explode(chunk_starts)).repartition("_from", *names)
        copies = F.sequence(F.col("_from"), F.least(F.col("_from") + step, F.col("_n")) - 1)
    else:
        copies = F.sequence(start, F.col("_n") - 1)
    unfolded = judged.select(*names, "_is_first", F.explode(copies).alias("_copy"))
    return unfolded.select(*names, (~F.col("_is_first") | (F.col("_copy") > 0)).alias(flag))


def mark_duplicates(
    df: DataFrame,
    key: str,
    *,
    time_column: str = "txn_ts",
    flag: str = "is_duplicate",
    limits: SkewLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``flag``: TRUE on every row of a key but the earliest.

    NULL keys count as one key. A first narrow job finds the repeated keys; when
    they fit the lookup bound, rows of unique keys are flagged in place with no
    shuffle and only repeated ones are compared. Beyond the bound the heavy keys
    alone take that route and all others one window per key.
    """
    order = _arrival_order(df, key, time_column)
    repeated = repeated_keys(df, F.col(key), limits)
    same = F.xxhash64(F.col(key)) == F.col("_hash")

    def settle(rows: DataFrame) -> DataFrame:
        if repeated.complete:
            return rows.withColumn(flag, F.lit(False))
        position = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        return rows.withColumn(flag, position > 1)

    if repeated.lookup is None:
        return settle(df)
    contested = df.join(repeated.lookup, same, "left_semi")
    others = df.join(repeated.lookup, same, "left_anti")
    chunk_rows = min(limits.group_rows, _UNFOLDED_ROWS)
    decided = _contest(contested, key, order, flag, repeated, chunk_rows)
    return settle(others).unionByName(decided)


def label_failures(
    df: DataFrame, dq_config: Mapping[str, Any], duplicate: Column | None = None
) -> DataFrame:
    """Add ``dq_failures`` and ``dq_passed`` from the row checks and a duplicate verdict.

    Needs no job and no shuffle, so it also runs on an unbounded frame.
    """
    checks = compile_checks(dq_config, df.schema)
    failed = [check.failed for check in checks]
    labels = [check.label_if_failed for check in checks]
    if duplicate is not None:
        failed.append(duplicate)
        labels.append(F.when(duplicate, F.lit(f"duplicate_{dq_config['unique_key']}")))
    if not failed:
        return df.withColumns({"dq_failures": _no_failures(), "dq_passed": F.lit(True)})
    any_failed = reduce(or_, failed)
    # The pass flag reads the predicates, not the array, so a filter on it stays
    # a cheap boolean expression and clean rows never build an array at all.
    named = F.when(any_failed, F.array_compact(F.array(*labels))).otherwise(_no_failures())
    return df.withColumns({"dq_failures": named, "dq_passed": ~any_failed})


def annotate_dq(
    df: DataFrame,
    dq_config: Mapping[str, Any],
    *,
    limits: SkewLimits = DEFAULT_LIMITS,
    known_duplicate: Column | None = None,
) -> DataFrame:
    """Add ``dq_failures`` (labels in configured order, duplicate last) and ``dq_passed``.

    ``known_duplicate`` marks rows whose key was already seen elsewhere, such as
    in an earlier micro-batch; they get the duplicate label too.
    """
    compile_checks(dq_config, df.schema)  # a bad configuration fails before any job runs
    df = df.drop("dq_failures", "dq_passed")  # of an earlier run
    columns, key, duplicate = df.columns, dq_config.get("unique_key"), None
    if key:
        df = mark_duplicates(df, key, flag="_duplicate", limits=limits)
        duplicate = F.col("_duplicate")
        if known_duplicate is not None:
            duplicate = duplicate | F.coalesce(known_duplicate, F.lit(False))
    return label_failures(df, dq_config, duplicate).select(*columns, "dq_failures", "dq_passed")


def split_dq(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) of an annotated frame: disjoint and exhaustive."""
    clean = annotated.filter(F.col("dq_passed")).drop("dq_passed")
    quarantined = annotated.filter(~F.col("dq_passed")).drop("dq_passed")
    return clean, quarantined


def apply_dq(
    df: DataFrame, dq_config: Mapping[str, Any], *, limits: SkewLimits = DEFAULT_LIMITS
) -> tuple[DataFrame, DataFrame]:
    """Gate a feed into (clean, quarantined); both keep ``dq_failures``."""
    return split_dq(annotate_dq(df, dq_config, limits=limits))


def dq_summary(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows per failed check, most frequent first."""
    return (
        quarantined.select(F.explode("dq_failures").alias("check"))
        .groupBy("check")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("check"))
    )


def quarantine_view(quarantined: DataFrame) -> DataFrame:
    """The diagnostic columns of quarantined rows."""
    return quarantined.select(
        "txn_id", "account_id", "amount", "currency", "channel", "dq_failures"
    )
