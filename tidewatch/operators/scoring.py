"""Rule flags, weighted score, risk band and alert selection."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.rules import Rule, compile_rules
from tidewatch.operators.features import derive
from tidewatch.operators.skew import DEFAULT_LIMITS, SkewLimits
from tidewatch.schema import ALERT_COLUMNS
from tidewatch.sources.work import WorkTables

# Bands from lowest to highest, and their default lower bounds.
BANDS = ["NONE", "LOW", "MEDIUM", "HIGH", "CRITICAL"]
DEFAULT_BOUNDS = {"critical": 70, "high": 45, "medium": 20}
DEFAULT_MIN_BAND = "MEDIUM"


def band_bounds(rules_config: Mapping[str, Any]) -> dict[str, float]:
    """Configured lower bounds over the defaults; they must not rise downwards."""
    bounds = {**DEFAULT_BOUNDS, **(rules_config.get("risk_bands") or {})}
    if not bounds["critical"] >= bounds["high"] >= bounds["medium"]:
        raise ValueError(f"risk bands out of order: {bounds}")
    return bounds


def band_column(score: Column, bounds: Mapping[str, float]) -> Column:
    band = F.when(score > 0, F.lit("LOW")).otherwise(F.lit("NONE"))
    for name in ("medium", "high", "critical"):
        band = F.when(score >= F.lit(float(bounds[name])), F.lit(name.upper())).otherwise(band)
    return band


def flag_rules(derived: DataFrame, rules: list[Rule]) -> DataFrame:
    """One boolean column per rule, all in one projection."""
    return derived.withColumns({rule.flag: rule.fires for rule in rules})


def summarise_flags(
    flagged: DataFrame, rules: list[Rule], bounds: Mapping[str, float]
) -> DataFrame:
    """Add ``triggered_rules``, ``risk_score`` and ``risk_band``."""
    fired = [F.when(F.col(rule.flag), F.lit(rule.name)) for rule in rules]
    points = [
        F.when(F.col(rule.flag), F.lit(rule.weight)).otherwise(F.lit(0.0)) for rule in rules
    ]
    scored = flagged.withColumns({
        "triggered_rules": F.array_compact(F.array(*fired)),
        "risk_score": reduce(add, points),
    })
    return scored.withColumn("risk_band", band_column(F.col("risk_score"), bounds))


def score_derived(derived: DataFrame, rules_config: Mapping[str, Any]) -> DataFrame:
    """Score rows that already carry the history columns."""
    rules = compile_rules(rules_config)
    return summarise_flags(flag_rules(derived, rules), rules, band_bounds(rules_config))


def score(
    df: DataFrame,
    rules_config: Mapping[str, Any],
    *,
    heavy: list | None = None,
    bins: list[int] | None = None,
    limits: SkewLimits = DEFAULT_LIMITS,
    tables: WorkTables | None = None,
) -> DataFrame:
    """History columns, a flag per enabled rule, rule list, score and band.

    Rows that skipped the gate are accepted; NULL accounts then share one history.
    """
    compile_rules(rules_config)  # a bad configuration fails before any job runs
    derived = derive(df, heavy=heavy, bins=bins, limits=limits, tables=tables)
    return score_derived(derived, rules_config)


def _known(min_band: str) -> str:
    if min_band not in BANDS:
        raise ValueError(f"unknown risk band {min_band!r}; known: {', '.join(BANDS)}")
    return min_band


def alerts_only(scored: DataFrame, min_band: str = DEFAULT_MIN_BAND) -> DataFrame:
    """Rows whose ``risk_band`` is ``min_band`` or above, wherever the band came from."""
    return scored.filter(F.col("risk_band").isin(*BANDS[BANDS.index(_known(min_band)):]))


def configured_alerts(scored: DataFrame, rules_config: Mapping[str, Any]) -> DataFrame:
    """Rows of the configured minimum band and above, of a frame scored under the same config.

    The config's bounds are compared with the score instead of the band: a filter moves
    below the projection and would repeat the rules for every bound of the band. For
    frames of other origin, or with edited scores, use :func:`alerts_only`.
    """
    min_band = _known(rules_config.get("min_alert_band", DEFAULT_MIN_BAND))
    bounds, points = band_bounds(rules_config), F.col("risk_score")
    if min_band == "NONE":
        return scored
    if min_band == "LOW":
        return scored.filter((points > 0) | (points >= F.lit(float(bounds["medium"]))))
    return scored.filter(points >= F.lit(float(bounds[min_band.lower()])))


def tag_run(alerts: DataFrame, run_id: str) -> DataFrame:
    """Stamp the rows with the run that raised them."""
    return alerts.withColumn("run_id", F.lit(run_id))


def project_alerts(alerts: DataFrame, *, flags: bool = False) -> DataFrame:
    """The stored form of tagged alerts, optionally with the per-rule flags."""
    extra = [name for name in alerts.columns if name.startswith("rule_")] if flags else []
    return alerts.select(*ALERT_COLUMNS, *extra)
