"""History columns against a direct computation, on every route."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import NOON, after, txn
from pyspark.sql import Window, functions as F

from tidewatch import SkewLimits, amount_bins, derive, heavy_accounts, rows_to_feed
from tidewatch.functions import money
from tidewatch.operators import features
from tidewatch.schema import CORE_COLUMNS
from tidewatch.sources.work import WorkTables, folder_exists

TIES = ["txn_ts", "txn_id", "customer_id", "beneficiary_id", "amount", "currency", "channel",
        "country", "merchant_category"]


def random_rows(seed, n, accounts=4, seconds=200_000, crowded=False):
    """Rows with ties, missing values, few countries and payees."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        second = rng.choice([0, 1, 90_000]) if crowded else rng.randrange(seconds)
        rows.append(txn(
            f"T{rng.randrange(10**6):06d}-{i}", f"A{min(rng.randrange(accounts * 2), accounts)}",
            NOON + dt.timedelta(seconds=second, microseconds=rng.choice([0, 0, 250_000])),
            rng.choice([None, 1.0, 19.99, 7000.1, 9400.0]),
            country=rng.choice(["US", "SG", "GB", None]),
            beneficiary_id=rng.choice(["B1", "B2", None]),
        ))
    return rows


def sort_key(row):
    return [(row[name] is not None, row[name]) if row[name] is not None else (False, 0)
            for name in TIES]


def by_hand(rows):
    """{txn_id: (count 1h, sum 24h, previous country, previous epoch, payee ordinal)}"""
    result = {}
    for account in {row["account_id"] for row in rows}:
        mine = [dict(row, epoch=math.floor((row["txn_ts"] - dt.datetime(1970, 1, 1))
                                           .total_seconds()))
                for row in rows if row["account_id"] == account]
        mine.sort(key=lambda row: (row["epoch"], sort_key(row)))
        paid = {}
        for i, row in enumerate(mine):
            hour = [r for r in mine if row["epoch"] - 3600 <= r["epoch"] <= row["epoch"]]
            day = [r["amount"] for r in mine
                   if row["epoch"] - 86400 <= r["epoch"] <= row["epoch"]
                   and r["amount"] is not None]
            paid[row["beneficiary_id"]] = paid.get(row["beneficiary_id"], 0) + 1
            before = mine[i - 1] if i else None
            result[row["txn_id"]] = (
                len(hour), round(math.fsum(day), 6) if day else None,
                before["country"] if before else None, before["epoch"] if before else None,
                paid[row["beneficiary_id"]],
            )
    return result


def by_spark(spark, rows, **options):
    derived = derive(rows_to_feed(spark, rows), **options)
    return {
        row.txn_id: (
            row.txns_last_hour,
            None if row.amount_last_day is None else round(row.amount_last_day, 6),
            row.prev_country, row.prev_epoch, row.beneficiary_seq,
        )
        for row in derived.collect()
    }


ROUTES = {
    "windows": {"heavy": []},
    "some accounts compact": {"heavy": ["A4", "A0"]},
    "all compact": {"heavy": None, "limits": SkewLimits(group_rows=1)},
    "compact with slices": {"heavy": ["A4"], "limits": SkewLimits(group_rows=5)},
}


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize("crowded", [False, True])
def test_every_route_matches_a_direct_computation(spark, route, crowded):
    rows = random_rows(seed=7 + crowded, n=220, crowded=crowded)
    assert by_spark(spark, rows, **ROUTES[route]) == by_hand(rows)


def test_missing_accounts_share_a_history_on_both_routes(spark):
    rows = random_rows(seed=3, n=60)
    for row in rows[::3]:
        row["account_id"] = None
    expected = by_hand(rows)
    assert by_spark(spark, rows, heavy=[]) == expected
    assert by_spark(spark, rows, heavy=[None]) == expected


def test_rows_without_time_share_a_second(spark):
    rows = [txn("1", "A", None, 5.0), txn("2", "A", None, 6.0), txn("3", "A", NOON, 7.0)]
    for options in ({"heavy": []}, {"heavy": ["A"]}):
        got = by_spark(spark, rows, **options)
        assert got["1"][:2] == (2, 11.0) and got["2"][:2] == (2, 11.0)
        assert got["3"][:2] == (1, 7.0)


def test_nan_amount_spoils_the_total_only_while_in_the_frame(spark):
    rows = [txn("1", "A", NOON, math.nan), txn("2", "A", after(hours=1), 5.0),
            txn("3", "A", after(days=2), 6.0)]
    for options in ({"heavy": []}, {"heavy": ["A"]}):
        got = by_spark(spark, rows, **options)
        assert math.isnan(got["1"][1]) and math.isnan(got["2"][1]) and got["3"][1] == 6.0


def test_sums_are_exact(spark):
    rows = [txn(str(i), "A", after(seconds=i), 0.1) for i in range(1000)]
    derived = derive(rows_to_feed(spark, rows), heavy=[])
    assert derived.filter("txn_id = '999'").first().amount_last_day == 100.0


WIDE = [
    ([2e11, 100.0], 2e11 + 100), ([1e20, 1e-12, 1.0], 1e20 + 1), ([4e-7] * 1000, 4e-4),
    ([1e-12] * 8, 8e-12), ([-3.25, 1e15, -1e15], -3.25), ([1e30, 5.0, 1e29], 1.1e30),
    ([2.0**70, -(2.0**70), 0.5], 0.5), ([-1e-9, 1e-9, 7.0], 7.0), ([math.inf, 1.0], math.inf),
    ([-math.inf, 1.0], -math.inf), ([math.inf, -math.inf], math.nan), ([math.nan, 2.0], math.nan),
    ([None, None], None), ([None, 2.5], 2.5), ([4e-19] * 1200, 4.8e-16), ([1e300, 5.0, -1e300], 5.0),
    ([1e42, 5e24, -1e42], 5e24), ([5e-324, 1e-300, -1e-300], 5e-324), ([1.7e308, -1.7e308, -2.5], -2.5),
    ([1e308, 1e308], math.inf), ([1e30, 1e-30, -1e30], 1e-30), ([-1e40, 1e25], -1e40 + 1e25),
]


def same(got, want):
    if got is None or want is None:
        return got is want
    return got == pytest.approx(want, rel=1e-15, nan_ok=True)


@pytest.mark.parametrize("amounts,want", WIDE)
def test_totals_of_any_amounts_on_all_routes(spark, amounts, want):
    """One day's total, and the next row's after all of them have left the frame."""
    rows = [txn(f"{i:04d}", "A", after(seconds=i), a) for i, a in enumerate(amounts)]
    rows.append(txn("later", "A", after(days=3), 0.75))
    for options in ({"heavy": []}, {"heavy": ["A"]}):
        derived = derive(rows_to_feed(spark, rows), **options).collect()
        got = {row.txn_id: row.amount_last_day for row in derived}
        assert same(got[f"{len(amounts) - 1:04d}"], want) and got["later"] == 0.75
    total = money.exact_total(rows_to_feed(spark, rows[:-1])).first()[0]
    assert same(total, want)


def test_amounts_that_left_the_frame_leave_nothing_behind(spark):
    """Whatever was added before: a total is that of its own day."""
    amounts = [1e42, 5e24, 4e-19, 1e300, 0.25, 2.0**-1074, 1e25]
    rows = [txn(str(i), "A", after(days=3 * i), a) for i, a in enumerate(amounts)]
    for options in ({"heavy": []}, {"heavy": ["A"]}):
        got = {r.txn_id: r.amount_last_day for r in derive(rows_to_feed(spark, rows), **options).collect()}
        assert [got[str(i)] for i in range(len(amounts))] == amounts


def test_units_of_every_bin_give_amounts_back(spark):
    """Each power of two and its neighbours, as the one amount of a total."""
    powers = [2.0**e for e in range(-1074, 1024)]
    amounts = powers + [np.nextafter(p, 0) for p in powers] + [-p * 1.7 for p in powers[1:-1]]
    amounts = [float(a) for a in amounts if a and math.isfinite(a)]
    amount, bin_ = F.col("a"), money.wide_bin(F.col("a"))
    wide = spark.createDataFrame([(a,) for a in amounts], "a double").filter(bin_.isNotNull())
    pair = F.struct(bin_.alias("bin"), money.wide_units(amount, bin_).alias("units"))
    found = wide.select("a", bin_.alias("bin"), money.wide_total(F.array(pair)).alias("total")).collect()
    assert len(found) > 5500 and all(row.a == row.total for row in found)
    assert {row.bin for row in found} <= set(money.BINS)


def test_wide_totals_are_rounded_sums_in_any_order(spark):
    rng = random.Random(11)
    amounts = [rng.choice([-1, 1]) * rng.uniform(1, 10) * 10.0**rng.randint(25, 90) for _ in range(400)]
    amounts += [-a for a in amounts[:395]]
    frame = spark.createDataFrame([(a, rng.random()) for a in amounts], "a double, r double")
    totals = {money.exact_total(frame.repartition(n, "r"), "a").first()[0] for n in (1, 3, 7)}
    assert len(totals) == 1 and totals.pop() == pytest.approx(math.fsum(amounts), rel=1e-15)


def test_an_ordinary_feed_has_no_bins(spark):
    feed = rows_to_feed(spark, [txn(str(i), "A", NOON, a) for i, a in enumerate(
        [0.0, 0.005, 19.99, 1e20, None, math.nan, math.inf, 1e-12])])
    assert amount_bins(feed) == []
    assert amount_bins(feed.limit(0)) == []
    assert len(amount_bins(rows_to_feed(spark, [txn("1", "A", NOON, 1e30), txn("2", "A", NOON, 4e-19)]))) == 2


@pytest.mark.parametrize("amounts,want", WIDE)
def test_array_totals_equal_column_totals(amounts, want):
    present = np.array([a is not None for a in amounts])
    values = np.array([0.0 if a is None else a for a in amounts])
    parts = money.array_parts(values, present)
    sums = {name: part.sum() for name, part in parts.items()}
    sums["huge"] = money.huge_total(parts["huge"])
    if want is not None:
        assert same(float(money.array_total(sums)), want)
    assert (sums["amounts"] == 0) == (want is None)


def test_whole_seconds_floor_and_hours_are_utc(spark):
    rows = [txn("1", "A", dt.datetime(1969, 12, 31, 23, 59, 59, 500_000))]
    row = derive(rows_to_feed(spark, rows), heavy=[]).first()
    assert row._epoch == -1 and row.txn_hour == 23


def test_first_row_has_no_gap_and_gap_is_in_hours(spark):
    rows = [txn("1", "A"), txn("2", "A", after(minutes=90))]
    got = {r.txn_id: r.hours_since_prev for r in
           derive(rows_to_feed(spark, rows), heavy=[]).collect()}
    assert got == {"1": None, "2": 1.5}


def test_heavy_accounts_are_those_at_the_limit(spark):
    rows = [txn(str(i), "BIG") for i in range(5)] + [txn("x", "SMALL")]
    rows += [txn(f"n{i}", None) for i in range(5)]
    feed = rows_to_feed(spark, rows)
    assert set(heavy_accounts(feed, SkewLimits(group_rows=5))) == {"BIG", None}
    assert len(heavy_accounts(feed, SkewLimits(group_rows=5, lookup_rows=1))) == 1


def test_heavy_accounts_of_a_big_feed_are_found_in_a_sample(spark):
    big = spark.range(200_000).selectExpr("IF(id % 3 = 0, 'BIG', concat('A', id)) AS account_id")
    assert heavy_accounts(big, SkewLimits(group_rows=50_000)) == ["BIG"]
    assert heavy_accounts(big, SkewLimits(group_rows=150_000)) == []


def test_input_columns_pass_through(spark):
    from pyspark.sql import functions as F

    feed = rows_to_feed(spark, [txn("1", "A")]).withColumn("note", F.lit("kept"))
    for heavy in ([], ["A"]):
        derived = derive(feed, heavy=heavy)
        assert derived.columns[:11] == [*CORE_COLUMNS, "note"] and derived.first().note == "kept"


def test_slices_are_found_by_halving(spark):
    """The place of a key among any number of split points, without a comparison per point."""
    for length in (0, 1, 2, 3, 127, 128, 999, 1001):
        points = [(None if i < 1 else i // 2 * 2, "b") for i in range(length)]
        keys = [(at, text) for at in (None, 0, 1, 2, 63, 64, 500, 998, 5000) for text in ("a", "b")]
        rows = spark.createDataFrame(
            [(*key, points) for key in keys], "a int, b string, _points array<struct<a:int,b:string>>")
        key = F.struct("a", "b")
        every = F.size(F.filter("_points", lambda point: point <= key))
        found = features._points_passed(key)
        assert rows.filter(found != every).count() == 0
    assert "filter" not in str(found)
    missing = rows.select(F.lit(None).cast("array<struct<a:int,b:string>>").alias("_points"), "a", "b")
    assert {row[0] for row in missing.select(found).collect()} == {0}


def test_slices_are_ranges_of_the_row_order(spark):
    """Slices follow the number of ranges, not that of rows in every second."""
    ids = spark.range(6000).withColumn("day", F.col("id") % 500)
    feed = ids.select(
        F.format_string("T%05d", "id").alias("txn_id"), F.lit("BIG").alias("account_id"),
        F.concat(F.lit("P"), F.col("id") % 3).alias("beneficiary_id"),
        F.timestamp_seconds(F.col("day") * 86400).alias("txn_ts"),
        (F.col("id") % 97).cast("double").alias("amount"),
        F.when(F.col("id") % 5 == 0, "GB").otherwise("US").alias("country"))
    tables = WorkTables(spark)
    sliced = derive(feed, heavy=["BIG"], limits=SkewLimits(group_rows=1), tables=tables)
    [path] = tables._paths
    slices = spark.read.parquet(path).groupBy("_at", "_slice").agg(
        F.min("txn_id").alias("first"), F.max("txn_id").alias("last"))
    assert 500 < slices.count() <= 500 + features._MAX_SLICES
    line = Window.orderBy("_at", "_slice")
    place, before = F.struct("_at", "first"), F.lag(F.struct("_at", "last")).over(line)
    assert slices.withColumn("ordered", before < place).filter("NOT ordered").count() == 0
    plain = derive(feed, heavy=[]).select(*sliced.columns)
    assert sliced.exceptAll(plain).isEmpty() and plain.exceptAll(sliced).isEmpty()
    tables.drop()
    assert not folder_exists(spark, path)


def test_rows_of_heavy_accounts_are_shuffled_once_and_joined_with_nothing(spark, monkeypatch):
    """What lies outside of a range comes as rows among its own, at any number of rows."""
    rows = random_rows(seed=23, n=150, crowded=True)
    feed, tables = rows_to_feed(spark, rows), WorkTables(spark)
    routed, own = [], features._by_seconds

    def watched(df, *others):
        routed.append(own(df, *others))
        return routed[-1]

    monkeypatch.setattr(features, "_by_seconds", watched)
    derive(feed, heavy=["A0"], limits=SkewLimits(group_rows=2), tables=tables)
    plan = routed[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1
    tables.drop()


def test_ranges_number_rows_in_the_row_order(spark):
    """Places follow the row order of an account, through all of its ranges."""
    rows = random_rows(seed=29, n=300, crowded=True)
    tables = WorkTables(spark)
    derive(rows_to_feed(spark, rows), heavy=["A0", "A4"], limits=SkewLimits(group_rows=2), tables=tables)
    table = spark.read.parquet(*tables._paths)
    line = Window.partitionBy("account_id").orderBy("_at", *TIES)
    before = table.select(
        (F.lag("_place").over(line) >= F.col("_place")).alias("turned"),
        (F.lag("_slice").over(line) > F.col("_slice")).alias("back"), "account_id", "_slice")
    assert before.filter("turned OR back").isEmpty()
    assert before.filter("account_id = 'A4'").select("_slice").distinct().count() > 50
    tables.drop()
