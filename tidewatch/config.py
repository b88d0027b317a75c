"""Default rule and quality configurations, and the loader for external ones.

A configuration is a plain dict on the driver; ``functions.checks`` and
``functions.rules`` compile it to Spark columns when a plan is built.
"""

from __future__ import annotations

import copy
import json
from typing import Any

from tidewatch.schema import CORRUPT_COLUMN

# Default quality gate (labels, order, limits and value lists).
DEFAULT_DQ: dict[str, Any] = {
    "unique_key": "txn_id",
    "checks": [
        {"name": "txn_id_not_null", "type": "not_null", "column": "txn_id"},
        {"name": "account_id_not_null", "type": "not_null", "column": "account_id"},
        {"name": "txn_ts_not_null", "type": "not_null", "column": "txn_ts"},
        {"name": "amount_not_null", "type": "not_null", "column": "amount"},
        {"name": "amount_positive", "type": "positive", "column": "amount"},
        {"name": "amount_within_ceiling", "type": "max_value", "column": "amount",
         "params": {"value": 10_000_000}},
        {"name": "currency_valid", "type": "allowed_values", "column": "currency",
         "params": {"values": ["USD", "EUR", "GBP", "INR", "SGD", "AED"]}},
        {"name": "channel_valid", "type": "allowed_values", "column": "channel",
         "params": {"values": ["ATM", "POS", "ONLINE", "WIRE", "MOBILE", "BRANCH"]}},
        {"name": "country_format", "type": "regex", "column": "country",
         "params": {"pattern": "^[A-Z]{2}$"}},
    ],
}

# Opt-in check for feeds read with ``capture``: the line did not parse whole.
MALFORMED_CHECK = {"name": "malformed_record", "type": "is_null", "column": CORRUPT_COLUMN}

# Default bands, rule names, weights and thresholds.
DEFAULT_RULES: dict[str, Any] = {
    "min_alert_band": "MEDIUM",
    "risk_bands": {"critical": 70, "high": 45, "medium": 20},
    "rules": [
        {"name": "high_value_txn", "type": "high_value", "enabled": True, "weight": 25,
         "params": {"amount_threshold": 15000}},
        {"name": "velocity_burst", "type": "velocity", "enabled": True, "weight": 30,
         "params": {"max_txns_per_hour": 8}},
        {"name": "structuring", "type": "structuring", "enabled": True, "weight": 40,
         "params": {"reporting_threshold": 10000, "band_pct": 0.85}},
        {"name": "impossible_travel", "type": "impossible_travel", "enabled": True, "weight": 35,
         "params": {"max_hours_between": 2}},
        {"name": "dormant_reactivation", "type": "dormant_reactivation", "enabled": True,
         "weight": 30, "params": {"dormant_days": 90, "amount_threshold": 5000}},
        {"name": "new_beneficiary_high_value", "type": "new_beneficiary_high_value",
         "enabled": True, "weight": 20, "params": {"amount_threshold": 10000}},
        {"name": "odd_hour_activity", "type": "odd_hour", "enabled": True, "weight": 10,
         "params": {"start_hour": 1, "end_hour": 5, "amount_threshold": 2000}},
        {"name": "high_risk_corridor", "type": "high_risk_corridor", "enabled": True,
         "weight": 15, "params": {"categories": ["gambling", "crypto"],
                                  "amount_threshold": 1000}},
    ],
}


def load_config(path: str) -> dict[str, Any]:
    """Read a ``.json`` / ``.yaml`` / ``.yml`` configuration file."""
    with open(path, encoding="utf-8") as source:
        if path.endswith(".json"):
            return json.load(source)
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError(f"{path}: PyYAML is not installed, use JSON") from missing
        return yaml.safe_load(source)


def with_malformed_check(dq_config: dict[str, Any]) -> dict[str, Any]:
    """Copy of a gate configuration that also names malformed lines, first of all checks."""
    return {**dq_config, "checks": [MALFORMED_CHECK, *(dq_config.get("checks") or [])]}


def with_params(config: dict[str, Any], **overrides: dict[str, Any]) -> dict[str, Any]:
    """Copy of a rule configuration with some rules' params replaced.

    >>> tuned = with_params(DEFAULT_RULES, velocity_burst={"max_txns_per_hour": 3})
    """
    tuned = copy.deepcopy(config)
    known = {rule["name"]: rule for rule in tuned["rules"]}
    for name, params in overrides.items():
        known[name].setdefault("params", {}).update(params)
    return tuned
