"""Reconciliation, run metrics and the alert reports, all as frames."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions import money

# Largest difference in amount that still reconciles.
AMOUNT_TOLERANCE = 0.01

RECONCILE_COLUMNS = [
    "source_count", "clean_count", "quarantined_count", "count_break",
    "source_amount", "split_amount", "amount_break", "status",
]


def _sided(df: DataFrame, side: str | Column) -> DataFrame:
    column = F.lit(side) if isinstance(side, str) else side
    return df.select(column.alias("side"), "amount")


def _tally(stacked: DataFrame, *sides: str) -> DataFrame:
    """One row with ``<side>_n``, the sums of each side's amount parts, and ``wide``: sums of
    wide amounts per bin, an array of at most ``len(money.BINS)``.

    The sides are stacked as (side, amount) rows, so no join is needed to bring
    their totals together. Ordinary rows are one group, combined on the map side.
    """

    def totals(side: str) -> list[Column]:
        here = F.col("side") == side
        parts = money.sums(F.when(here, F.col("amount")))
        return [F.count_if(here).alias(f"{side}_n"),
                *[value.alias(side + part) for part, value in parts.items()],
                F.sum(F.when(here, money.wide_units(F.col("amount"), F.col("bin")))).alias(f"{side}_wide")]

    def added(side: str) -> list[Column]:
        return [F.coalesce(F.sum(name), F.lit(0)).alias(name)
                for name in [f"{side}_n", *[side + part for part in money.PARTS]]]

    by_bin = stacked.withColumn("bin", money.wide_bin(F.col("amount"))).groupBy("bin").agg(
        *[column for side in sides for column in totals(side)])
    wide = F.struct("bin", *[
        F.coalesce(f"{side}_wide", F.lit(0)).cast(money.WIDE).alias(side) for side in sides])
    return by_bin.agg(
        *[column for side in sides for column in added(side)],
        F.collect_list(F.when(F.col("bin").isNotNull(), wide)).alias("wide"))


def _wide_of(units: Callable[[Column], Column]) -> Column:
    return F.transform("wide", lambda item: F.struct(
        item["bin"].alias("bin"), units(item).cast(money.WIDE).alias("units")))


def _parts_of(*sides: str) -> dict[str, Column]:
    return {part: reduce(add, [F.col(side + part) for side in sides]) for part in money.PARTS}


def _cents(parts: dict[str, Column], wide: Column) -> Column:
    return F.coalesce(F.round(money.total(parts, wide), 2), F.lit(0.0))


def _balance(tally: DataFrame, *keep: str) -> DataFrame:
    """Breaks are taken between exact sums, so sides that tie do so at any size of amount."""
    source, split = _parts_of("source"), _parts_of("clean", "quarantined")
    gap = {part: source[part] - split[part] for part in money.PARTS}
    source_wide = _wide_of(lambda item: item["source"])
    split_wide = _wide_of(lambda item: item["clean"] + item["quarantined"])
    gap_wide = _wide_of(lambda item: item["source"] - (item["clean"] + item["quarantined"]))
    settled = tally.select(
        F.col("source_n").alias("source_count"),
        F.col("clean_n").alias("clean_count"),
        F.col("quarantined_n").alias("quarantined_count"),
        (F.col("source_n") - (F.col("clean_n") + F.col("quarantined_n"))).alias("count_break"),
        _cents(source, source_wide).alias("source_amount"),
        _cents(split, split_wide).alias("split_amount"),
        # NaN or an infinity on either side leaves no difference, as it does between doubles.
        F.when(source["_odd"] + split["_odd"] > 0, F.lit(float("nan")))
        .otherwise(_cents({**gap, "_amounts": F.lit(1)}, gap_wide)).alias("amount_break"),
        *keep,
    )
    # NaN sorts above every number, so a NaN break is never below the tolerance.
    balanced = (F.col("count_break") == 0) & (F.abs("amount_break") < F.lit(AMOUNT_TOLERANCE))
    return settled.withColumn("status", F.when(balanced, F.lit("PASS")).otherwise(F.lit("FAIL")))


def _three_sides(source: DataFrame, clean: DataFrame, quarantined: DataFrame) -> DataFrame:
    return _sided(source, "source").unionByName(_sided(clean, "clean")).unionByName(
        _sided(quarantined, "quarantined"))


def _gated_sides(source: DataFrame, annotated: DataFrame) -> DataFrame:
    """The same rows from the annotated feed, which holds both sides of the gate."""
    side = F.when(F.col("dq_passed"), F.lit("clean")).otherwise(F.lit("quarantined"))
    return _sided(source, "source").unionByName(_sided(annotated, side))


def reconcile(source: DataFrame, clean: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: counts and amounts of the source against the two sides of the gate."""
    tally = _tally(_three_sides(source, clean, quarantined), "source", "clean", "quarantined")
    return _balance(tally).select(*RECONCILE_COLUMNS)


def reconcile_gated(source: DataFrame, annotated: DataFrame) -> DataFrame:
    """:func:`reconcile` from the annotated feed, so that the gate runs once."""
    tally = _tally(_gated_sides(source, annotated), "source", "clean", "quarantined")
    return _balance(tally).select(*RECONCILE_COLUMNS)


def _metrics(sides: DataFrame, alerts: DataFrame, run_id: str) -> DataFrame:
    stacked = sides.unionByName(_sided(alerts, "alerts"))
    balance = _balance(_tally(stacked, "source", "clean", "quarantined", "alerts"), "alerts_n")
    rate = 100.0 * F.col("alerts_n") / F.greatest(F.col("clean_count"), F.lit(1))
    return balance.select(
        F.lit(run_id).alias("run_id"),
        F.struct(*RECONCILE_COLUMNS).alias("reconciliation"),
        F.col("alerts_n").alias("alert_count"),
        F.round(rate, 2).alias("alert_rate_pct"),
    )


def run_metrics(
    source: DataFrame, clean: DataFrame, quarantined: DataFrame, alerts: DataFrame, run_id: str
) -> DataFrame:
    """One row: run id, reconciliation (nested), alert count and alert rate in percent."""
    return _metrics(_three_sides(source, clean, quarantined), alerts, run_id)


def run_metrics_gated(
    source: DataFrame, annotated: DataFrame, alerts: DataFrame, run_id: str
) -> DataFrame:
    """:func:`run_metrics` from the annotated feed, so that the gate runs once."""
    return _metrics(_gated_sides(source, annotated), alerts, run_id)


def run_summary(metrics: DataFrame) -> DataFrame:
    """The run metrics as ten (measure, value) text rows."""

    def count(name: str) -> Column:
        return F.col(f"reconciliation.{name}").cast("string")

    def cents(name: str) -> Column:
        return F.format_number(F.col(f"reconciliation.{name}"), 2)

    # Names and order of the measures.
    measures = {
        "source rows": count("source_count"),
        "clean rows": count("clean_count"),
        "quarantined rows": count("quarantined_count"),
        "count break": count("count_break"),
        "source amount": cents("source_amount"),
        "clean + quarantined": cents("split_amount"),
        "amount break": cents("amount_break"),
        "reconciliation": F.col("reconciliation.status"),
        "alerts raised": F.col("alert_count").cast("string"),
        "alert rate": F.format_string("%.2f%%", F.col("alert_rate_pct")),
    }
    pairs = [part for name, value in measures.items() for part in (F.lit(name), value)]
    return metrics.select(F.stack(F.lit(len(measures)), *pairs).alias("measure", "value"))


def _ranking_count(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(column))


def alerts_by_band(alerts: DataFrame) -> DataFrame:
    return _ranking_count(alerts, "risk_band")


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    """Alerts per triggered rule; an alert counts once for each of its rules."""
    return _ranking_count(alerts.select(F.explode("triggered_rules").alias("rule")), "rule")


def _ranked(alerts: DataFrame, columns: list[str]) -> DataFrame:
    return alerts.select(*columns).orderBy(F.desc("risk_score"), F.asc("txn_id"))


# Columns of the ranked reports and lengths of the short ones.
TOP_ALERT_COLUMNS = [
    "txn_id", "account_id", "amount", "channel", "country",
    "risk_score", "risk_band", "triggered_rules",
]
RANKED_ALERT_COLUMNS = [
    "txn_id", "account_id", "amount", "channel", "country", "merchant_category",
    "risk_score", "risk_band", "triggered_rules",
]
BATCH_ALERT_COLUMNS = [
    "txn_id", "account_id", "amount", "channel", "risk_score", "risk_band", "triggered_rules",
]
TOP_ALERTS = 10
TOP_BATCH_ALERTS = 5


def top_alerts(alerts: DataFrame, k: int = TOP_ALERTS) -> DataFrame:
    """The k highest scores; equal scores in order of txn_id."""
    return _ranked(alerts, TOP_ALERT_COLUMNS).limit(k)


def ranked_alerts(alerts: DataFrame) -> DataFrame:
    """Every alert, highest score first."""
    return _ranked(alerts, RANKED_ALERT_COLUMNS)


def top_batch_alerts(alerts: DataFrame, k: int = TOP_BATCH_ALERTS) -> DataFrame:
    """The k highest scores in the short form of a micro-batch report."""
    return _ranked(alerts, BATCH_ALERT_COLUMNS).limit(k)


def batch_counters(annotated: DataFrame, alerts: DataFrame, batch_id: int) -> DataFrame:
    """One row per micro-batch: rows, quarantined rows and alerts."""
    seen = annotated.select(F.lit(1).alias("seen"), (~F.col("dq_passed")).alias("bad"))
    raised = alerts.select(F.lit(0).alias("seen"), F.lit(False).alias("bad"))
    return seen.unionByName(raised).agg(
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.count_if(F.col("seen") == 1).alias("rows"),
        F.count_if(F.col("bad")).alias("quarantined"),
        F.count_if(F.col("seen") == 0).alias("alerts"),
    )


def preview(df: DataFrame, rows: int = TOP_ALERTS) -> DataFrame:
    """The first rows of a frame, for a look at it."""
    return df.limit(rows)
