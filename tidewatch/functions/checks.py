"""Quality checks: one configuration entry becomes one "this row fails" column."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, functions as F, types as T

CheckBuilder = Callable[[Column, Mapping[str, Any]], Column]


@dataclass(frozen=True)
class Check:
    """A compiled check: its label and a never-NULL failure predicate."""

    label: str
    failed: Column

    @property
    def label_if_failed(self) -> Column:
        return F.when(self.failed, F.lit(self.label))


def _not_null(value: Column, _: Mapping[str, Any]) -> Column:
    return value.isNull()


def _is_null(value: Column, _: Mapping[str, Any]) -> Column:
    return value.isNotNull()


def _positive(value: Column, _: Mapping[str, Any]) -> Column:
    return value <= F.lit(0)


def _max_value(value: Column, params: Mapping[str, Any]) -> Column:
    # Spark orders NaN above every number, so a NaN is over any ceiling.
    return value > F.lit(float(params["value"]))


def _allowed_values(value: Column, params: Mapping[str, Any]) -> Column:
    return ~value.isin(*params["values"])


def _regex(value: Column, params: Mapping[str, Any]) -> Column:
    return ~value.rlike(params["pattern"])


_BUILDERS: dict[str, CheckBuilder] = {
    "not_null": _not_null,
    "is_null": _is_null,
    "positive": _positive,
    "max_value": _max_value,
    "allowed_values": _allowed_values,
    "regex": _regex,
}
_NUMERIC_CHECKS = {"positive", "max_value"}


def register_check(kind: str, builder: CheckBuilder, *, numeric: bool = False) -> None:
    """Add a check type. ``builder(column, params)`` is TRUE when a row fails.

    A NULL verdict counts as "not failed"; only ``not_null`` speaks for NULLs.
    """
    _BUILDERS[kind] = builder
    (_NUMERIC_CHECKS.add if numeric else _NUMERIC_CHECKS.discard)(kind)


def check_types() -> list[str]:
    return list(_BUILDERS)


def compile_checks(config: Mapping[str, Any], schema: T.StructType) -> list[Check]:
    """Compile ``config["checks"]`` in order against a frame's schema."""
    compiled = []
    for entry in config.get("checks") or []:
        kind, column = entry["type"], entry["column"]
        if kind not in _BUILDERS:
            raise ValueError(f"unknown check type {kind!r}; known: {', '.join(_BUILDERS)}")
        value = F.col(column)
        if kind in _NUMERIC_CHECKS and not isinstance(schema[column].dataType, T.NumericType):
            # Text that is no number reads as NULL instead of failing the job.
            value = value.try_cast("double")
        verdict = _BUILDERS[kind](value, entry.get("params") or {})
        compiled.append(
            Check(entry.get("name", f"{column}_{kind}"), F.coalesce(verdict, F.lit(False)))
        )
    return compiled
