"""History columns of a row: rolling totals, previous row, payee ordinal, hour.

Ordinary accounts take the window route: one shuffle by account and linear-time
frames. Accounts too heavy for one task take the compact route, which folds
their rows into one row per account and second (map-side combined), so a
window over an account is bounded by the calendar, not by the data, and cuts
the rows themselves into ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions import money
from tidewatch.operators.skew import DEFAULT_LIMITS, SkewLimits, heavy_keys, split_by_keys
from tidewatch.sources.work import WorkTables

# Lengths of the rolling frames in seconds, both ends inclusive.
HOUR_SECONDS = 3600
DAY_SECONDS = 86400

FEATURE_COLUMNS = [
    "_epoch", "txns_last_hour", "amount_last_day", "prev_country", "prev_epoch",
    "hours_since_prev", "beneficiary_seq", "txn_hour",
]

# Where rows without a time stand in the range frames: together, before all others.
NO_TIME = -(2**62)

_TIE_BREAKS = [
    "txn_ts", "txn_id", "customer_id", "beneficiary_id", "amount", "currency", "channel",
    "country", "merchant_category",
]


def _rolling(column: str, seconds: int) -> Column:
    """Sum of ``column`` over the last ``seconds`` up to now, in linear time.

    The difference of two frames that only ever grow. A sliding frame would be
    added up again for every row, which is quadratic in the rows of a busy period.
    """
    line = Window.partitionBy("account_id").orderBy("_at")
    now = F.sum(column).over(line.rangeBetween(Window.unboundedPreceding, 0))
    old = F.sum(column).over(line.rangeBetween(Window.unboundedPreceding, -seconds - 1))
    return F.coalesce(now, F.lit(0)) - F.coalesce(old, F.lit(0))


def _wide_part(bin_: int) -> str:
    return f"_wide_{bin_}".replace("-", "m")


def _is_rare(part: str) -> bool:
    """NULL on ordinary rows, which sums pass over."""
    return part == "_odd" or part.startswith("_wide")


def _parts_of_row(bins: list[int]) -> dict[str, Column]:
    """What the rolling frames add up: 1, the parts of the amount, and wide amounts by bin."""
    amount = F.col("amount")
    parts = {
        name: part if _is_rare(name) else F.coalesce(part, F.lit(0))
        for name, part in money.parts(amount).items()
    }
    own = money.wide_bin(amount)
    wide = {_wide_part(bin_): F.when(own == bin_, money.wide_units(amount, own)) for bin_ in bins}
    return {"_rows": F.lit(1).cast("long"), **parts, **wide}


def _day_columns(bins: list[int]) -> list[str]:
    return [f"_day{part}" for part in [*money.PARTS, *map(_wide_part, bins)]]


def _rolling_parts(df: DataFrame, bins: list[int]) -> DataFrame:
    day = {name: _rolling(name.removeprefix("_day"), DAY_SECONDS) for name in _day_columns(bins)}
    return df.withColumns({"txns_last_hour": _rolling("_rows", HOUR_SECONDS), **day})


def _amount_last_day(bins: list[int]) -> Column:
    wide = money.wide_array({bin_: F.col(f"_day{_wide_part(bin_)}") for bin_ in bins})
    return money.total({part: F.col(f"_day{part}") for part in money.PARTS}, wide)


# Totals of a second, and all columns that both routes add to the input.
_TOTALS = ["txns_last_hour", "amount_last_day"]
_ROUTE_COLUMNS = ["prev_country", "prev_epoch", *_TOTALS, "beneficiary_seq"]


def _tie_breaks(df: DataFrame) -> list[str]:
    return [name for name in _TIE_BREAKS if name in df.columns]


def _paid(counted: str | None) -> Column:
    return F.col(counted).cast("int") if counted else F.lit(1)


def _by_windows(df: DataFrame, counted: str | None, bins: list[int]) -> DataFrame:
    order = ["_at", *_tie_breaks(df)]
    account = Window.partitionBy("account_id").orderBy(*order)
    payee = Window.partitionBy("account_id", "beneficiary_id").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    # The previous-row windows come first, as their sort also serves the range
    # frames; the payee ordinal needs a sort of its own and comes last.
    previous = df.withColumns({
        "prev_country": F.lag("country").over(account),
        "prev_epoch": F.lag("_epoch").over(account),
    })
    rolled = _rolling_parts(previous.withColumns(_parts_of_row(bins)), bins)
    ranked = rolled.withColumns({
        "beneficiary_seq": F.sum(_paid(counted)).over(payee).cast("int"),
        "amount_last_day": _amount_last_day(bins),
    })
    return ranked.select(*df.columns, *_ROUTE_COLUMNS)


# Ranges of rows, unless the session's shuffle width is larger.
_MAX_SLICES = 1000


def _in_ranges(df: DataFrame, tables: WorkTables) -> DataFrame:
    """Add ``_slice``, the number of a row's range, and ``_place``, its place in the row order.

    Spark deals all rows into ranges of the row order, so that no account and no second
    (a day, in a feed stamped with dates only) is too heavy for a task. Where ranges meet
    affects balance only, not results, but it must not change between the steps that
    follow, so the rows are written out.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["account_id", "_at", *_tie_breaks(df)]
    dealt = df.repartitionByRange(max(_MAX_SLICES, width), *order).sortWithinPartitions(*order)
    placed = dealt.withColumns({
        "_slice": F.spark_partition_id(), "_place": F.monotonically_increasing_id(),
    })
    # A task writes several ranges, each under its own number.
    return tables.write(placed.coalesce(width), "slices")


def _points_passed(key: Column) -> Column:
    """How many of the sorted ``_points`` are at most ``key``, by halving; none without points."""
    steps = [1 << place for place in reversed(range(_MAX_SLICES.bit_length()))]

    def halve(held: Column, step: Column) -> Column:
        point = F.get("_points", held["passed"] + step - 1)
        passed = F.when(point <= held["key"], held["passed"] + step).otherwise(held["passed"])
        return F.struct(passed.alias("passed"), held["key"].alias("key"))

    start = F.struct(F.lit(0).alias("passed"), key.alias("key"))
    return F.aggregate(F.array(*map(F.lit, steps)), start, halve, lambda held: held["passed"])


# Place of what a range is told of earlier ones, before all of its rows.
_TOLD = -1


def _by_seconds(
    df: DataFrame, counted: str | None, bins: list[int], tables: WorkTables
) -> DataFrame:
    """The same columns for heavy accounts; no window spans an account's rows.

    The windows over a range's rows also pass a few rows that tell what lies outside of it:
    before each second, its totals and the row that precedes it; before all rows, the
    payments to a payee in all ranges before.
    """
    columns = df.columns
    rows = _in_ranges(df, tables)
    units = rows.groupBy("_slice", "account_id", "_at").agg(
        # Decimals: an account's sums may outgrow a bigint here.
        *[F.sum(value if _is_rare(part) else value.cast("decimal(20,0)")).alias(part)
          for part, value in _parts_of_row(bins).items()],
        F.max_by(F.struct("country", "_epoch"), "_place").alias("_last"),
    )
    account = Window.partitionBy("account_id").orderBy("_at", "_slice")
    seconds = _rolling_parts(units.withColumn("_before", F.lag("_last").over(account)), bins).select(
        "_slice", "account_id", "_at", F.lit(_TOLD).alias("_place"), "_before.*",
        F.struct(
            F.col("txns_last_hour").cast("long").alias("txns_last_hour"),
            _amount_last_day(bins).alias("amount_last_day"),
        ).alias("_totals"),
    )
    earlier = (
        Window.partitionBy("account_id", "beneficiary_id").orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    payments = (
        rows.groupBy("_slice", "account_id", "beneficiary_id")
        .agg(F.sum(_paid(counted)).alias("_paid"))
        .withColumns({"_place": F.lit(_TOLD), "_paid": F.sum("_paid").over(earlier)})
        .filter(F.col("_paid").isNotNull())
    )
    told = rows.withColumn("_paid", _paid(counted))
    for outside in (seconds, payments):
        told = told.unionByName(outside, allowMissingColumns=True)
    # What follows needs no other shuffle: one range's rows of an account are together.
    told = told.repartition("_slice", "account_id")
    line = Window.partitionBy("_slice", "account_id").orderBy("_at", "_place")
    payee = Window.partitionBy("_slice", "account_id", "beneficiary_id").orderBy("_place")
    so_far = (Window.unboundedPreceding, 0)
    ranked = told.withColumn("_ordinal", F.sum("_paid").over(payee.rowsBetween(*so_far)))
    known = ranked.withColumns({
        "prev_country": F.lag("country").over(line),
        "prev_epoch": F.lag("_epoch").over(line),
        "_now": F.last("_totals", ignorenulls=True).over(line.rowsBetween(*so_far)),
    })
    return known.filter(F.col("_place") > _TOLD).select(
        *columns, "prev_country", "prev_epoch", "_now.*",
        F.col("_ordinal").cast("int").alias("beneficiary_seq"),
    )


def heavy_accounts(feed: DataFrame, limits: SkewLimits = DEFAULT_LIMITS) -> list:
    """Accounts of a feed that need the compact route (one narrow counting job)."""
    return heavy_keys(feed, "account_id", limits)


def amount_bins(feed: DataFrame) -> list[int]:
    """Bins of a feed's amounts that are too large or too small for the ordinary parts."""
    return money.wide_bins(feed)


def derive(
    df: DataFrame,
    *,
    heavy: list | None = None,
    bins: list[int] | None = None,
    counted: str | None = None,
    limits: SkewLimits = DEFAULT_LIMITS,
    tables: WorkTables | None = None,
) -> DataFrame:
    """Add :data:`FEATURE_COLUMNS` to a feed.

    ``heavy`` lists the accounts for the compact route; when None they are
    counted on ``df`` itself. Counting them on the raw source and passing the
    list saves running the plan behind ``df`` for it. The same holds for ``bins``, what
    :func:`amount_bins` says of ``df`` or of a feed that has all its rows. ``counted`` names a boolean
    column that tells which rows the payee ordinal counts; by default, all. Rows of heavy
    accounts are written out to ``tables``; without, that table stays behind.
    """
    tables = tables or WorkTables(df.sparkSession)
    df = df.drop(*FEATURE_COLUMNS)  # of an earlier run
    if heavy is None:
        heavy = heavy_accounts(df, limits)
    if bins is None:
        bins = amount_bins(df)
    columns = df.columns
    timed = df.withColumn("_epoch", F.col("txn_ts").cast("timestamp").cast("long")).withColumn(
        "_at", F.coalesce("_epoch", F.lit(NO_TIME))
    )
    if heavy:
        hot, others = split_by_keys(timed, "account_id", heavy)
        featured = _by_windows(others, counted, bins).unionByName(
            _by_seconds(hot, counted, bins, tables)
        )
    else:
        featured = _by_windows(timed, counted, bins)
    return featured.select(
        *columns,
        "_epoch",
        *_TOTALS,
        "prev_country",
        "prev_epoch",
        ((F.col("_epoch") - F.col("prev_epoch")) / F.lit(3600.0)).alias("hours_since_prev"),
        "beneficiary_seq",
        F.hour("txn_ts").alias("txn_hour"),
    )
