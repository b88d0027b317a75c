"""Amounts in parts whose sums do not depend on the order of adding.

A finite double below 2^80 is split into four integers: multiples of 2^40, whole units,
billionths and billionths of these. Sums of the parts are exact, so 1e20 and 1e-12 both
survive beside each other, and a difference of two running sums is exact as well. Wide
amounts, from 2^80 on or so small that billionths of billionths do not give them back, are
whole numbers of a unit that follows from their binary exponent: one sum per bin of 32
exponents, exact up to 10^12 rows of a total. NaN and infinities are counted, and make a total
what they make of a sum of doubles, but only of totals they belong to.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

LIMIT = float(2**80)
HIGH = float(2**40)
_BILLION = 1e9

# Counts of NaN, +inf and -inf share one decimal, a part each. It is NULL for ordinary rows.
_SHIFT = 10**12
_ODD = "decimal(38,0)"

PARTS = ["_amounts", "_high", "_low", "_nano", "_rest", "_odd"]

# Below this a billionth of a billionth is more than half of the last binary digit.
_SMALL = 2.0**-7
# Exponents per bin of wide amounts, the binary digits of its unit below its least exponent,
# and the bins of all doubles.
_STEP, _DEPTH = 32, 54
BINS = range(-34, 33)
WIDE = "decimal(38,0)"
_HALF = float(2**43)


def _tiny(amount: Column) -> Column:
    small = F.floor(amount * F.lit(_BILLION * _BILLION) + F.lit(0.5)) / F.lit(_BILLION * _BILLION)
    return (F.abs(amount) < F.lit(_SMALL)) & (amount != F.lit(0.0)) & (small != amount)


def _ordinary(amount: Column) -> Column:
    """TRUE if the amount has integer parts; NaN is above every number, so it has none."""
    return (F.abs(amount) < F.lit(LIMIT)) & ~_tiny(amount)


def wide_bin(amount: Column) -> Column:
    """Number of a wide amount's bin; NULL for ordinary amounts, NaN and infinities."""
    amount = amount.cast("double")
    wide = ~_ordinary(amount) & (F.abs(amount) < F.lit(float("inf")))
    return F.when(wide, F.floor(F.log2(F.abs(amount)) / F.lit(float(_STEP))).cast("int"))


def _scaled(value: Column, exponent: Column) -> Column:
    """``value`` times two to the (even) ``exponent``, in two steps so that neither overflows alone."""
    half = F.pow(F.lit(2.0), exponent / F.lit(2))
    return value * half * half


def wide_units(amount: Column, bin_: Column) -> Column:
    """A wide amount as an exact multiple of its bin's unit, 2^(32 bin - 54)."""
    whole = _scaled(amount.cast("double"), F.lit(_DEPTH) - bin_ * F.lit(_STEP))
    upper = F.floor(whole / F.lit(_HALF))
    lower = (whole - upper * F.lit(_HALF)).cast("long").cast("decimal(20,0)")
    half = F.lit(str(int(_HALF))).cast("decimal(14,0)")
    return (upper.cast("decimal(20,0)") * half + lower).cast(WIDE)


def wide_bins(df: DataFrame, column: str = "amount") -> list[int]:
    """Bins that occur among a frame's amounts; none in an ordinary feed.

    One narrow job whose bounds reach the scan. At most ``len(BINS)`` numbers come back.
    """
    amount = F.col(column).cast("double")
    outside = (amount >= F.lit(LIMIT)) | (amount <= F.lit(-LIMIT)) | (
        (amount < F.lit(_SMALL)) & (amount > F.lit(-_SMALL)) & (amount != F.lit(0.0)))
    found = df.select(column).filter(outside).select(wide_bin(amount).alias("bin"))
    return sorted(row[0] for row in found.filter(F.col("bin").isNotNull()).distinct().collect())


def wide_total(sums: Column) -> Column:
    """The total as a double of an array of (bin, units), each bin once, in any order.

    From the top the sum stays a whole number while it fits 38 digits; what comes after is too
    small to cancel it.
    """
    shifts = [(distance, F.lit(str(2**distance)).cast(WIDE)) for distance in (_STEP, 2 * _STEP, 3 * _STEP)]

    def value(state: Column) -> Column:
        return _scaled(state["units"].cast("double"),
                       state["bin"] * F.lit(_STEP) - F.lit(_DEPTH))

    def add(state: Column, item: Column) -> Column:
        distance = (state["bin"] - item["bin"]) * F.lit(_STEP)
        size = F.abs(state["units"].cast("double"))
        exact = F.when(state["units"] == F.lit(0).cast(WIDE), item["units"])
        for shift, times in shifts:
            fits = (distance == F.lit(shift)) & (size < F.lit(2.0**(120 - shift)))
            exact = exact.when(fits, (state["units"] * times + item["units"]).cast(WIDE))
        exact = F.when(state["below"] == F.lit(0.0), exact)
        below = state["below"] + value(item)
        return F.struct(
            F.when(exact.isNull(), state["bin"]).otherwise(item["bin"]).alias("bin"),
            F.coalesce(exact, state["units"]).cast(WIDE).alias("units"),
            F.when(exact.isNull(), below).otherwise(state["below"]).alias("below"),
        )

    start = F.struct(F.lit(max(BINS)).alias("bin"), F.lit(0).cast(WIDE).alias("units"),
                     F.lit(0.0).alias("below"))
    known = F.filter(sums, lambda item: item["units"].isNotNull())
    return F.aggregate(F.sort_array(known, asc=False), start, add,
                       lambda state: value(state) + state["below"])


def wide_array(units: dict[int, Column]) -> Column | None:
    """The array that :func:`wide_total` takes, from sums of units by bin; None for no bins."""
    pairs = [F.struct(F.lit(number).alias("bin"), value.cast(WIDE).alias("units"))
             for number, value in units.items()]
    return F.array(*pairs) if pairs else None


def parts(amount: Column) -> dict[str, Column]:
    """What to add up for each row, by the names in :data:`PARTS`."""
    infinity = float("inf")
    units = F.floor(amount.cast("double"))
    high = F.floor(units / F.lit(HIGH))
    fraction = amount - units
    nano = F.floor(fraction * F.lit(_BILLION))
    rest = F.floor((fraction - nano / F.lit(_BILLION)) * F.lit(_BILLION * _BILLION) + F.lit(0.5))

    def part(value: Column) -> Column:
        return F.when(_ordinary(amount), value).otherwise(F.lit(0)).cast("long")

    # floor() gives a bigint, which holds units below 2^63 only: wider ones are scaled first.
    wide = F.abs(amount) >= F.lit(float(2**62))
    high_wide = F.floor(amount / F.lit(HIGH))
    odd = (
        F.when(F.isnan(amount), F.lit(1))
        .when(amount == F.lit(infinity), F.lit(str(_SHIFT)).cast(_ODD))
        .when(amount == F.lit(-infinity), F.lit(str(_SHIFT**2)).cast(_ODD))
    )
    return {
        "_amounts": amount.isNotNull().cast("long"),
        "_high": part(F.when(wide, high_wide).otherwise(high)),
        "_low": part(F.when(wide, amount - high_wide * F.lit(HIGH)).otherwise(
            units - high * F.lit(HIGH))),
        "_nano": part(F.when(wide, F.lit(0)).otherwise(nano)),
        "_rest": part(F.when(wide, F.lit(0)).otherwise(rest)),
        "_odd": odd.cast(_ODD),
    }


def total(sums: dict[str, Column], wide: Column | None = None) -> Column:
    """Total as a double from sums of the parts, and of wide amounts where there are any (as
    for :func:`wide_total`); NULL if there were no amounts."""
    value = (
        (sums["_high"].cast("double") * F.lit(HIGH) + sums["_low"].cast("double"))
        + (sums["_nano"].cast("double") / F.lit(_BILLION)
           + sums["_rest"].cast("double") / F.lit(_BILLION * _BILLION))
    )
    if wide is not None:
        value = value + wide_total(wide)
    odd = F.coalesce(sums["_odd"].cast(_ODD), F.lit(0).cast(_ODD))
    shift = F.lit(str(_SHIFT)).cast(_ODD)
    nans, signs = odd % shift, F.floor(odd / shift).cast(_ODD)
    plus, minus = signs % shift > 0, signs >= shift
    return (
        F.when(sums["_amounts"] == F.lit(0), F.lit(None).cast("double"))
        .when(odd == F.lit(0), value)
        .when((nans > 0) | (plus & minus), F.lit(float("nan")))
        .when(plus, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )


def sums(amount: Column) -> dict[str, Column]:
    """Aggregates of the parts over any number of rows."""
    wide = "decimal(20,0)"
    return {
        name: F.sum(value if name == "_odd" else value.cast(wide))
        for name, value in parts(amount).items()
    }


def exact_total(df: DataFrame, column: str = "amount") -> DataFrame:
    """One row with the total of a column, by the rules of :func:`total`, under its name.

    Rows are added per bin first; ordinary ones are one group, combined on the map side.
    """
    amount, bin_ = F.col(column), wide_bin(F.col(column))
    by_bin = df.groupBy(bin_.alias("bin")).agg(
        *[value.alias(name) for name, value in sums(amount).items()],
        F.sum(wide_units(amount, bin_)).alias("units"))
    wide = F.when(F.col("bin").isNotNull(), F.struct("bin", "units"))
    merged = by_bin.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in PARTS],
                        F.collect_list(wide).alias("wide"))
    return merged.select(total({name: F.col(name) for name in PARTS}, F.col("wide")).alias(column))


ARRAY_COUNTS = ["amounts", "high", "low", "nano", "rest", "nans", "plus", "minus"]


def array_parts(amount: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
    """The same parts of an array: integers by :data:`ARRAY_COUNTS`, and wide amounts as ``huge``."""
    small = np.where(np.abs(amount) < _SMALL, amount, 0.0)
    tiny = np.floor(small * (_BILLION * _BILLION) + 0.5) / (_BILLION * _BILLION) != small
    ordinary = present & (np.abs(amount) < LIMIT) & ~tiny
    value = np.where(ordinary, amount, 0.0)
    units = np.floor(value)
    high = np.floor(units / HIGH)
    fraction = value - units
    nano = np.floor(fraction * _BILLION)
    rest = np.floor((fraction - nano / _BILLION) * (_BILLION * _BILLION) + 0.5)
    whole = {
        "amounts": present, "high": high, "low": units - high * HIGH, "nano": nano, "rest": rest,
        "nans": present & np.isnan(amount), "plus": present & np.isposinf(amount),
        "minus": present & np.isneginf(amount),
    }
    huge = np.where(present & ~ordinary & np.isfinite(amount), amount, 0.0)
    return {**{name: part.astype("int64") for name, part in whole.items()}, "huge": huge}


def huge_total(values: Iterable[float]) -> float:
    """Sum of finite doubles, rounded once; infinite only where that is."""
    values = list(values)
    try:
        return math.fsum(values)
    except OverflowError:
        return math.fsum(value * 2.0**-64 for value in values) * 2.0**64


def array_total(sums: dict[str, np.ndarray]) -> np.ndarray:
    """:func:`total` of arrays; NaN stands for NULL where there were no amounts."""
    value = (sums["high"] * HIGH + sums["low"]) + (
        sums["nano"] / _BILLION + sums["rest"] / (_BILLION * _BILLION)) + sums["huge"]
    plus, minus = sums["plus"] > 0, sums["minus"] > 0
    value = np.where(plus, np.inf, np.where(minus, -np.inf, value))
    return np.where((sums["nans"] > 0) | (plus & minus), np.nan, value)
