"""The gate names every failure, keeps every row and finds duplicates on every route."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from conftest import NOON, after, txn
from pyspark.sql import functions as F

from tidewatch import (
    DEFAULT_DQ, SkewLimits, annotate_dq, apply_dq, dq_summary, mark_duplicates, register_check,
    rows_to_feed,
)
from tidewatch.functions import checks as check_module
from tidewatch.operators.gate import quarantine_view
from tidewatch.schema import CORE_COLUMNS

ROUTES = {
    "few repeats": SkewLimits(),
    "big numbers unfold in chunks": SkewLimits(group_rows=3),
    "repeated keys in a table": SkewLimits(group_rows=4, lookup_rows=0),
    "only heavy keys looked up": SkewLimits(group_rows=4, lookup_rows=2, broadcast_rows=2),
    "one window per key": SkewLimits(lookup_rows=0, broadcast_rows=0),
}


def failures(spark, rows, config=DEFAULT_DQ, **options):
    annotated = annotate_dq(rows_to_feed(spark, rows), config, **options)
    return [(row.txn_id, list(row.dq_failures)) for row in annotated.collect()]


def test_gate_case(spark):
    """One sound row, its later copy, and two rows that each break a check or two."""
    rows = [txn("k1", "one"), txn("k1", "one", after(minutes=1)),
            txn("k2", "one", amount=-3.75, channel="PIGEON"), txn("k3", "two", country="F1")]
    clean, quarantined = apply_dq(rows_to_feed(spark, rows), DEFAULT_DQ)
    assert [(r.txn_id, r.txn_ts, list(r.dq_failures)) for r in clean.collect()] == [("k1", NOON, [])]
    assert sorted((r.txn_id, list(r.dq_failures)) for r in quarantined.collect()) == [
        ("k1", ["duplicate_txn_id"]), ("k2", ["amount_positive", "channel_valid"]),
        ("k3", ["country_format"])]


@pytest.mark.parametrize("change,label", [
    ({"amount": 0.0}, "amount_positive"),
    ({"amount": 1e7}, None),
    ({"amount": 1e7 + 1}, "amount_within_ceiling"),
    ({"amount": math.nan}, "amount_within_ceiling"),
    ({"amount": math.inf}, "amount_within_ceiling"),
    ({"amount": -math.inf}, "amount_positive"),
    ({"amount": None}, "amount_not_null"),
    ({"account_id": None}, "account_id_not_null"),
    ({"txn_ts": None}, "txn_ts_not_null"),
    ({"txn_id": None}, "txn_id_not_null"),
    ({"currency": None}, None),
    ({"currency": "usd"}, "currency_valid"),
    ({"channel": "TELEPATHY"}, "channel_valid"),
    ({"channel": None}, None),
    ({"country": "usa"}, "country_format"),
    ({"country": "USA"}, "country_format"),
    ({"country": "U"}, "country_format"),
    ({"country": None}, None),
])
def test_each_check(spark, change, label):
    row = {**txn("1", "A"), **change}
    assert failures(spark, [row])[0][1] == ([label] if label else [])


def test_labels_come_in_configured_order_with_the_duplicate_last(spark):
    row = dict.fromkeys(CORE_COLUMNS)
    row.update(currency="XXX", country="usa")
    got = failures(spark, [row, row])
    base = ["txn_id_not_null", "account_id_not_null", "txn_ts_not_null", "amount_not_null",
            "currency_valid", "country_format"]
    assert sorted(labels for _, labels in got) == [base, [*base, "duplicate_txn_id"]]


def test_duplicate_of_a_failing_row_stays_a_duplicate(spark):
    rows = [txn("1", "A", NOON, -5.0), txn("1", "A", after(hours=1), 5.0)]
    assert sorted(failures(spark, rows)) == [
        ("1", ["amount_positive"]), ("1", ["duplicate_txn_id"])]


def test_earliest_is_kept_and_rows_without_time_come_last(spark):
    rows = [txn("1", "LATE", after(hours=1)), txn("1", "NONE", None), txn("1", "FIRST", NOON)]
    flagged = mark_duplicates(rows_to_feed(spark, rows), "txn_id").filter("NOT is_duplicate")
    assert [r.account_id for r in flagged.collect()] == ["FIRST"]


def duplicates_by_hand(rows):
    order = ["account_id", "customer_id", "beneficiary_id", "amount", "currency", "channel",
             "country", "merchant_category"]

    def rank(row):
        present = [(row[n] is not None, row[n] if row[n] is not None else 0) for n in order]
        late = row["txn_ts"] is None
        return (late, row["txn_ts"] or dt.datetime.min, present)

    verdicts = Counter()
    for key in {row["txn_id"] for row in rows}:
        for i, row in enumerate(sorted((r for r in rows if r["txn_id"] == key), key=rank)):
            verdicts[(*[row[n] for n in CORE_COLUMNS], i > 0)] += 1
    return verdicts


@pytest.mark.parametrize("route", ROUTES)
def test_duplicates_on_every_route_match_a_direct_computation(spark, route):
    rng = random.Random(11)
    rows = [
        txn(rng.choice([None, "HOT", "HOT", *map(str, range(60))]), rng.choice(["A", "B", None]),
            rng.choice([None, NOON, NOON, after(seconds=1)]), rng.choice([None, 1.0, 2.0]))
        for _ in range(250)
    ]
    rows += [txn("COPY", "A")] * 40
    flagged = mark_duplicates(rows_to_feed(spark, rows), "txn_id", limits=ROUTES[route])
    got = Counter(tuple(row) for row in flagged.collect())
    assert got == duplicates_by_hand(rows)


@pytest.mark.parametrize("route", ROUTES)
def test_no_row_is_lost_or_added(spark, route):
    from tidewatch.plans.catalog import event_feed

    source = event_feed(spark, "/root/testdata/sf0.001")
    clean, quarantined = apply_dq(source, DEFAULT_DQ, limits=ROUTES[route])
    both = clean.unionByName(quarantined).select(*CORE_COLUMNS)
    assert both.exceptAll(source).isEmpty() and source.exceptAll(both).isEmpty()


def test_gate_without_checks_or_key_passes_everything(spark):
    rows = [txn("1", None, None, -1.0), txn("1", None, None, -1.0)]
    assert failures(spark, rows, {}) == [("1", []), ("1", [])]
    assert failures(spark, rows, {"checks": []}) == [("1", []), ("1", [])]
    only_key = sorted(failures(spark, rows, {"unique_key": "txn_id"}))
    assert only_key == [("1", []), ("1", ["duplicate_txn_id"])]


def test_default_label_other_key_and_unknown_type(spark):
    config = {"unique_key": "customer_id",
              "checks": [{"type": "positive", "column": "amount"}]}
    rows = [txn("1", "A", NOON, -1.0), txn("2", "A", after(hours=1), -1.0)]
    assert sorted(failures(spark, rows, config)) == [
        ("1", ["amount_positive"]), ("2", ["amount_positive", "duplicate_customer_id"])]
    with pytest.raises(ValueError, match="unknown check type"):
        failures(spark, rows, {"checks": [{"type": "clairvoyant", "column": "amount"}]})


def test_numeric_check_on_text_reads_no_number_as_missing(spark):
    feed = spark.createDataFrame([("1", "-3"), ("2", "abc"), ("3", "4"), ("4", None)],
                                 "txn_id string, amount string")
    config = {"checks": [{"type": "positive", "column": "amount"},
                         {"type": "max_value", "column": "amount", "params": {"value": 3}}]}
    got = {r.txn_id: list(r.dq_failures) for r in annotate_dq(feed, config).collect()}
    assert got == {"1": ["amount_positive"], "2": [], "3": ["amount_max_value"], "4": []}


def test_regex_finds_anywhere_unless_anchored(spark):
    config = {"checks": [{"type": "regex", "column": "country", "params": {"pattern": "S"}}]}
    assert failures(spark, [txn("1", "A", country="USA"), txn("2", "A", country="GB")], config) \
        == [("1", []), ("2", ["country_regex"])]


def test_registered_check(spark):
    register_check("short", lambda value, params: F.length(value) < params["length"])
    try:
        config = {"checks": [{"type": "short", "column": "txn_id", "params": {"length": 2}}]}
        assert failures(spark, [txn("1", "A"), txn("22", "A")], config) == [
            ("1", ["txn_id_short"]), ("22", [])]
    finally:
        del check_module._BUILDERS["short"]


def test_known_duplicates_are_labelled(spark):
    feed = rows_to_feed(spark, [txn("1", "A"), txn("2", "A")])
    annotated = annotate_dq(feed, DEFAULT_DQ, known_duplicate=F.col("txn_id") == "2")
    got = {r.txn_id: list(r.dq_failures) for r in annotated.collect()}
    assert got == {"1": [], "2": ["duplicate_txn_id"]}


def test_summary_and_view(spark):
    rows = [txn("1", "A", NOON, -1.0), txn("2", "A", NOON, -1.0, currency="XXX"),
            txn("3", "A", channel="FAX")]
    _, quarantined = apply_dq(rows_to_feed(spark, rows), DEFAULT_DQ)
    summary = dq_summary(quarantined)
    assert [tuple(r) for r in summary.collect()] == [
        ("amount_positive", 2), ("channel_valid", 1), ("currency_valid", 1)]
    assert summary.columns == ["check", "count"]
    assert quarantine_view(quarantined).columns == [
        "txn_id", "account_id", "amount", "currency", "channel", "dq_failures"]
