"""Fraud rules: boolean columns over the feed and its derived history columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, functions as F

RuleBuilder = Callable[[Mapping[str, Any]], Column]

# Weight of a rule that states none.
DEFAULT_WEIGHT = 10.0


@dataclass(frozen=True)
class Rule:
    """A compiled rule: name, score weight and its never-NULL predicate."""

    name: str
    weight: float
    fires: Column

    @property
    def flag(self) -> str:
        return f"rule_{self.name}"


def _moves_at_least(params: Mapping[str, Any]) -> Column:
    return F.col("amount") >= F.lit(float(params["amount_threshold"]))


def high_value(params: Mapping[str, Any]) -> Column:
    """Amount at or above a ceiling."""
    return _moves_at_least(params)


def velocity(params: Mapping[str, Any]) -> Column:
    """The account reached its hourly limit with this row."""
    return F.col("txns_last_hour") >= F.lit(int(params["max_txns_per_hour"]))


def structuring(params: Mapping[str, Any]) -> Column:
    """Amount just under the reporting threshold while the rolling day clears it."""
    limit = float(params["reporting_threshold"])
    floor = limit * float(params["band_pct"])
    amount, day_total = F.col("amount"), F.col("amount_last_day")
    return (amount >= F.lit(floor)) & (amount < F.lit(limit)) & (day_total >= F.lit(limit))


def impossible_travel(params: Mapping[str, Any]) -> Column:
    """Country changed since the account's previous row, within a short gap."""
    moved = F.col("country") != F.col("prev_country")
    return moved & (F.col("hours_since_prev") <= F.lit(float(params["max_hours_between"])))


def dormant_reactivation(params: Mapping[str, Any]) -> Column:
    """First sizeable movement after a long silence; a first-ever row never fires."""
    silence = F.lit(24 * float(params["dormant_days"]))
    return (F.col("hours_since_prev") >= silence) & _moves_at_least(params)


def new_beneficiary_high_value(params: Mapping[str, Any]) -> Column:
    """Sizeable first payment from this account to this payee."""
    return (F.col("beneficiary_seq") == F.lit(1)) & _moves_at_least(params)


def odd_hour(params: Mapping[str, Any]) -> Column:
    """Sizeable movement with start <= hour < end; the span does not wrap midnight."""
    hour = F.col("txn_hour")
    in_span = (hour >= F.lit(int(params["start_hour"]))) & (hour < F.lit(int(params["end_hour"])))
    return in_span & _moves_at_least(params)


def high_risk_corridor(params: Mapping[str, Any]) -> Column:
    """Listed merchant category above a floor amount."""
    return F.col("merchant_category").isin(*params["categories"]) & _moves_at_least(params)


_BUILDERS: dict[str, RuleBuilder] = {
    build.__name__: build
    for build in (
        high_value, velocity, structuring, impossible_travel, dormant_reactivation,
        new_beneficiary_high_value, odd_hour, high_risk_corridor,
    )
}


def register_rule(kind: str, builder: RuleBuilder) -> None:
    """Add a rule type; ``builder(params)`` returns a predicate, NULL meaning "no"."""
    _BUILDERS[kind] = builder


def rule_types() -> list[str]:
    return list(_BUILDERS)


def compile_rules(config: Mapping[str, Any]) -> list[Rule]:
    """Compile the enabled entries of ``config["rules"]`` in order.

    Disabled entries are skipped before anything about them is validated. Two
    enabled rules of one name would share one flag column, so that is an error.
    """
    compiled: dict[str, Rule] = {}
    for entry in config.get("rules") or []:
        if not entry.get("enabled", True):
            continue
        name, kind = entry["name"], entry["type"]
        if kind not in _BUILDERS:
            raise ValueError(f"unknown rule type {kind!r}; known: {', '.join(_BUILDERS)}")
        if name in compiled:
            raise ValueError(f"two enabled rules are named {name!r}")
        verdict = _BUILDERS[kind](entry.get("params") or {})
        weight = float(entry.get("weight", DEFAULT_WEIGHT))
        compiled[name] = Rule(name, weight, F.coalesce(verdict, F.lit(False)))
    if not compiled:
        raise ValueError("the configuration enables no rule")
    return list(compiled.values())
