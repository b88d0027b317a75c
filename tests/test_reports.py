"""Reconciliation, metrics and the ranked reports."""

import math

import pytest
from conftest import NOON, after, txn
from pyspark.sql import functions as F

from tidewatch import (
    DEFAULT_DQ, DEFAULT_RULES, alerts_by_band, alerts_by_rule, annotate_dq, apply_dq,
    batch_counters, ranked_alerts, reconcile, reconcile_gated, rows_to_feed, run_metrics,
    run_metrics_gated, run_summary, score, split_dq, top_alerts, top_batch_alerts,
)
from tidewatch.operators.reports import preview
from tidewatch.operators.scoring import configured_alerts


@pytest.fixture(scope="module")
def parts(spark):
    rows = [txn(f"H{i}", f"A{i}", NOON, 20000.0 + i) for i in range(12)]
    rows += [txn("M1", "B1", NOON, 16000.0, beneficiary_id="X", merchant_category="crypto"),
             txn("Q1", "C1", NOON, -0.25), txn("Q2", "C1", NOON, None)]
    source = rows_to_feed(spark, rows)
    clean, quarantined = apply_dq(source, DEFAULT_DQ)
    alerts = configured_alerts(score(clean, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)
    return source, clean, quarantined, alerts


def test_reconcile_passes(parts):
    source, clean, quarantined, _ = parts
    row = reconcile(source, clean, quarantined).first()
    assert tuple(row) == (15, 13, 2, 0, 256065.75, 256065.75, 0.0, "PASS")


def test_reconcile_sees_a_lost_row_and_a_changed_amount(spark, parts):
    source, clean, quarantined, _ = parts
    lost = reconcile(source, clean.filter("txn_id <> 'M1'"), quarantined).first()
    assert (lost.count_break, lost.amount_break, lost.status) == (1, 16000.0, "FAIL")
    changed = reconcile(source, clean.withColumn("amount", clean.amount + 0.01), quarantined)
    assert changed.first().status == "FAIL" and changed.first().count_break == 0


def test_reconcile_of_nothing_and_of_nan(spark):
    empty = rows_to_feed(spark, [txn("1", "A")]).limit(0)
    assert tuple(reconcile(empty, empty, empty).first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0, "PASS")
    odd = rows_to_feed(spark, [txn("1", "A", NOON, math.nan)])
    assert reconcile(odd, *apply_dq(odd, DEFAULT_DQ)).first().status == "FAIL"


@pytest.mark.parametrize("amounts", [[100.0, 2e11], [1e20, 3.0, -7.5], [4e-7] * 300, [1e30, 1.0],
                                     [1e25 * 10 ** (i % 8) for i in range(400)], [1e300, -1e300, 4e-19]])
def test_reconcile_of_amounts_of_any_size(spark, amounts):
    source = rows_to_feed(spark, [txn(str(i), "A", NOON, a) for i, a in enumerate(amounts)])
    annotated = annotate_dq(source, DEFAULT_DQ)
    by_sides = reconcile(source, *split_dq(annotated)).first()
    assert (by_sides.status, by_sides.amount_break) == ("PASS", 0.0)
    assert reconcile_gated(source, annotated).first() == by_sides


def test_reconcile_finds_a_break_beside_huge_amounts(spark):
    source = rows_to_feed(spark, [txn("1", "A", NOON, 1e300), txn("2", "A", NOON, 7.5)])
    clean, quarantined = source, source.limit(0)
    row = reconcile(source, clean.withColumn("amount", F.when(F.col("txn_id") == "2", 5.0)
                                             .otherwise(F.col("amount"))), quarantined).first()
    assert (row.amount_break, row.status) == (2.5, "FAIL")


def test_gated_reports_equal_those_of_the_sides(spark, parts):
    source, clean, quarantined, alerts = parts
    annotated = annotate_dq(source, DEFAULT_DQ)
    assert reconcile_gated(source, annotated).first() == reconcile(source, clean, quarantined).first()
    assert run_metrics_gated(source, annotated, alerts, "r").first() == run_metrics(*parts, "r").first()


def test_metrics_and_summary(spark, parts):
    metrics = run_metrics(*parts, "r1")
    row = metrics.first()
    assert (row.run_id, row.alert_count, row.alert_rate_pct) == ("r1", 13, 100.0)
    assert [tuple(r) for r in run_summary(metrics).collect()] == [
        ("source rows", "15"), ("clean rows", "13"), ("quarantined rows", "2"),
        ("count break", "0"), ("source amount", "256,065.75"),
        ("clean + quarantined", "256,065.75"), ("amount break", "0.00"),
        ("reconciliation", "PASS"), ("alerts raised", "13"), ("alert rate", "100.00%"),
    ]


def test_alert_rate_without_clean_rows(spark):
    feed = rows_to_feed(spark, [txn("1", "A", NOON, -1.0)])
    clean, quarantined = apply_dq(feed, DEFAULT_DQ)
    alerts = configured_alerts(score(clean, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)
    assert run_metrics(feed, clean, quarantined, alerts, "r").first().alert_rate_pct == 0.0


def test_counts(parts):
    alerts = parts[3]
    assert [tuple(r) for r in alerts_by_band(alerts).collect()] == [("HIGH", 13)]
    assert [tuple(r) for r in alerts_by_rule(alerts).collect()] == [
        ("high_value_txn", 13), ("new_beneficiary_high_value", 13), ("high_risk_corridor", 1)]


def test_ranked_reports(parts):
    alerts = parts[3]
    top = top_alerts(alerts)
    ids = [r.txn_id for r in top.collect()]
    assert ids == ["M1", "H0", "H1", "H10", "H11", "H2", "H3", "H4", "H5", "H6"]
    assert [r.txn_id for r in top_batch_alerts(alerts).collect()] == ids[:5]
    assert [r.txn_id for r in ranked_alerts(alerts).collect()] == [*ids, "H7", "H8", "H9"]
    assert [len(f.columns) for f in (top, ranked_alerts(alerts), top_batch_alerts(alerts))] \
        == [8, 9, 7]
    assert preview(alerts, 3).count() == 3


def test_batch_counters(spark):
    rows = [txn("1", "A", NOON, 20000.0), txn("2", "A", after(days=1), 5.0),
            txn("3", "A", NOON, -5.0)]
    annotated = annotate_dq(rows_to_feed(spark, rows), DEFAULT_DQ)
    clean, _ = split_dq(annotated)
    alerts = configured_alerts(score(clean, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)
    assert tuple(batch_counters(annotated, alerts, 7).first()) == (7, 3, 1, 1)
