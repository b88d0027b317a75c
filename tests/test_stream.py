"""Micro-batches with history equal one batch run; restarts and replays are safe."""

import json
import os
import time

import pytest
from conftest import NOON, after, txn
from pyspark.sql import functions as F

from tidewatch import (
    DEFAULT_DQ, DEFAULT_RULES, apply_dq, process_batch, read_output, rows_to_feed, score,
    start_stream,
)
from tidewatch.operators.scoring import configured_alerts, project_alerts, tag_run
from tidewatch.streaming import micro_batch
from tidewatch.streaming.state import Commits, StateTables, bucket_of, run_together


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    lines = []
    for row in rows:
        stamp = row["txn_ts"] and row["txn_ts"].strftime("%Y-%m-%dT%H:%M:%S")
        lines.append(json.dumps({**row, "txn_ts": stamp}))
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(lines))
    time.sleep(0.05)  # files are taken in order of their time


BATCHES = [
    [txn("D0", "DORM", after(days=-200), 10.0), txn("V0", "VEL", after(hours=-30), 5.0),
     txn("P0", "PAYEE", after(days=-10), 11000.0, beneficiary_id="OLD")],
    [txn(f"V{i}", "VEL", after(minutes=i), 5.0) for i in range(1, 6)]
    + [txn("S1", "STR", NOON, 9400.0), txn("G1", "GEO", after(minutes=10), 50.0)]
    + [txn("Z1", "ZONE", NOON, 50.0, country=None)],
    [txn(f"V{i}", "VEL", after(minutes=i), 5.0) for i in range(6, 11)]
    + [txn("S2", "STR", after(hours=23), 9400.0),
       txn("G2", "GEO", after(minutes=40), 60.0, country="SG"),
       txn("D1", "DORM", after(minutes=30), 6000.0),
       txn("P1", "PAYEE", after(minutes=30), 12000.0, beneficiary_id="OLD"),
       txn("P2", "PAYEE", after(minutes=31), 12000.0, beneficiary_id="NEW"),
       txn("V3", "VEL", after(minutes=3), 5.0), txn("BAD", "VEL", NOON, -1.0),
       txn("Z2", "ZONE", after(minutes=5), 50.0, country="SG")],
    [txn("D2", "DORM", after(days=120), 7000.0), txn("S2", "STR", after(hours=23), 9400.0),
     txn("BAD", "VEL", after(days=1), 3.0)],
]


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stream")
    landing, root = str(base / "landing"), str(base / "root")
    for number, rows in enumerate(BATCHES[:2]):
        land(landing, f"{number}.json", rows)
    start_stream(spark, landing, root, DEFAULT_DQ, DEFAULT_RULES,
                 available_now=True, merge_at=2, buckets=4).awaitTermination()
    for number, rows in enumerate(BATCHES[2:], start=2):
        land(landing, f"{number}.json", rows)
    start_stream(spark, landing, root, DEFAULT_DQ, DEFAULT_RULES,
                 available_now=True, merge_at=2, buckets=4).awaitTermination()
    return root


def test_one_file_per_trigger_and_restart_from_checkpoint(spark, streamed):
    counters = read_output(spark, streamed, "counters").orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows) for r in counters] == [
        (i, len(rows)) for i, rows in enumerate(BATCHES)]
    assert [r.quarantined for r in counters] == [0, 0, 2, 2]


def test_stream_alerts_equal_batch_alerts(spark, streamed):
    source = rows_to_feed(spark, [row for rows in BATCHES for row in rows])
    clean, quarantined = apply_dq(source, DEFAULT_DQ)
    alerts = configured_alerts(score(clean, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)
    expected = project_alerts(tag_run(alerts, "stream"), flags=True)
    got = read_output(spark, streamed, "alerts").drop("batch_id")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    by_rule = {r.txn_id: list(r.triggered_rules) for r in got.collect()}
    assert by_rule["D1"] == ["dormant_reactivation"]
    assert by_rule["S2"] == ["structuring"] and by_rule["G2"] == ["impossible_travel"]
    assert "P1" not in by_rule and by_rule["P2"] == ["new_beneficiary_high_value"]
    assert {k for k, v in by_rule.items() if "velocity_burst" in v} == {"V8", "V9", "V10"}
    held = read_output(spark, streamed, "quarantine").select("txn_id", "dq_failures")
    assert held.exceptAll(quarantined.select("txn_id", "dq_failures")).isEmpty()


def test_duplicates_across_batches_are_held_back(spark, streamed):
    held = read_output(spark, streamed, "quarantine")
    assert sorted((r.txn_id, r.batch_id, list(r.dq_failures)) for r in held.collect()) == [
        ("BAD", 2, ["amount_positive"]), ("BAD", 3, ["duplicate_txn_id"]),
        ("S2", 3, ["duplicate_txn_id"]), ("V3", 2, ["duplicate_txn_id"])]


def snapshot_of(spark, root):
    tables = ("alerts", "quarantine", "counters")
    return {t: sorted(map(str, read_output(spark, root, t).collect())) for t in tables}


def test_a_committed_batch_is_left_alone(spark, streamed):
    before = snapshot_of(spark, streamed)
    for number in (2, 3):
        process_batch(rows_to_feed(spark, BATCHES[number]), number, streamed, DEFAULT_DQ,
                      DEFAULT_RULES, merge_at=2, buckets=4)
    assert snapshot_of(spark, streamed) == before


def test_merges_fold_state(spark, streamed):
    state = StateTables(spark, streamed, 4)
    every = range(state.buckets)
    folded = state.accounts(every).select("account_id", F.col("last.txn_id").alias("t")).collect()
    assert {r.account_id: r.t for r in folded}["DORM"] == "D2"
    assert len(folded) == len({r.account_id for r in folded})
    paid = {(r.account_id, r.beneficiary_id): r.paid for r in state.payees(every).collect()}
    assert paid[("PAYEE", "OLD")] == 2 and paid[("PAYEE", "NEW")] == 1


def test_merged_parts_are_deleted_when_no_replay_needs_them(spark, streamed):
    # Batches 1 and 3 fill a level; batch 3 also fills the next one.
    assert Commits(spark, streamed).ids() == [2, 3]
    after = Commits(spark, streamed).newest()
    assert [part.path for part in after.parts["accounts"]] == ["accounts/2-3"]
    kept = sorted(os.listdir(os.path.join(streamed, "state", "accounts")))
    assert kept == ["0-2", "0-3", "1-1", "1-3", "2-3"]
    before = Commits(spark, streamed).newest(before=3)
    for part in before.parts["keys"] + before.parts["history"]:
        assert os.path.isdir(os.path.join(streamed, "state", part.path))


def test_empty_batch_is_skipped(spark, tmp_path):
    root = str(tmp_path / "root")
    process_batch(rows_to_feed(spark, [txn("1", "A")]).limit(0), 0, root, DEFAULT_DQ,
                  DEFAULT_RULES)
    assert not os.path.exists(root)


def test_batch_without_clean_rows(spark, tmp_path):
    root = str(tmp_path / "root")
    process_batch(rows_to_feed(spark, [txn("1", "A", NOON, -1.0)]), 0, root, DEFAULT_DQ,
                  DEFAULT_RULES)
    assert tuple(read_output(spark, root, "counters").first()) == (1, 1, 0, 0)


def test_late_row_is_judged_against_what_is_known(spark, tmp_path):
    root = str(tmp_path / "root")
    first = [txn("1", "A", NOON, 10.0), txn("2", "A", after(days=100), 10.0)]
    late = [txn("3", "A", after(days=95), 9000.0), txn("4", "A", after(days=100), 10.0)]
    for number, rows in enumerate([first, late]):
        process_batch(rows_to_feed(spark, rows), number, root, DEFAULT_DQ, DEFAULT_RULES)
    # Row 2 is newer than row 3 and row 1 is out of reach: no silence is claimed.
    assert read_output(spark, root, "alerts").count() == 0


def test_bad_configuration_fails_before_the_stream_starts(spark, tmp_path):
    with pytest.raises(ValueError):
        start_stream(spark, str(tmp_path), str(tmp_path / "root"), DEFAULT_DQ, {})


def test_processing_time_trigger_runs_until_stopped(spark, tmp_path):
    """The stream that stays up takes files as they land, one micro-batch after another."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    land(landing, "0.json", BATCHES[0])
    query = start_stream(spark, landing, root, DEFAULT_DQ, DEFAULT_RULES, trigger_seconds=1)
    try:
        query.processAllAvailable()
        land(landing, "1.json", BATCHES[1])
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    counters = read_output(spark, root, "counters").orderBy("batch_id").collect()
    assert [row.rows for row in counters if row.rows] == [len(BATCHES[0]), len(BATCHES[1])]
    top = read_output(spark, root, "top").groupBy("batch_id").count().collect()
    assert all(row["count"] <= 5 for row in top)


def run_batches(spark, root, batches, **options):
    for number, rows in enumerate(batches):
        process_batch(rows_to_feed(spark, rows), number, root, DEFAULT_DQ, DEFAULT_RULES, **options)


def test_a_batch_that_dies_between_outputs_is_not_seen(spark, tmp_path, monkeypatch):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    run_batches(spark, whole, BATCHES[1:3], merge_at=2, buckets=4)
    run_batches(spark, broken, BATCHES[1:2], merge_at=2, buckets=4)
    before = snapshot_of(spark, broken)

    def die(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(micro_batch, "batch_counters", die)
        with pytest.raises(RuntimeError):
            process_batch(rows_to_feed(spark, BATCHES[2]), 1, broken, DEFAULT_DQ, DEFAULT_RULES)
        assert os.path.isdir(os.path.join(broken, "alerts", "batch_id=1"))
        assert snapshot_of(spark, broken) == before
    # Once more between the merges and the manifest, after parts of the batch were written.
    with monkeypatch.context() as patch:
        patch.setattr(Commits, "publish", die)
        with pytest.raises(RuntimeError):
            process_batch(rows_to_feed(spark, BATCHES[2]), 1, broken, DEFAULT_DQ, DEFAULT_RULES,
                          merge_at=2)
        assert snapshot_of(spark, broken) == before
    process_batch(rows_to_feed(spark, BATCHES[2]), 1, broken, DEFAULT_DQ, DEFAULT_RULES, merge_at=2)
    assert snapshot_of(spark, broken) == snapshot_of(spark, whole)


def one_day(number, rows=40):
    """Rows of many accounts within one day, new ones in each batch."""
    return [txn(f"{number}-{i}", f"a{number}-{i}", after(seconds=number * 60 + i), 5.0)
            for i in range(rows)]


def leave_behind(spark, root, number, rows, **options):
    """What a micro-batch of clean rows leaves, without its outputs."""
    state = StateTables(spark, root, number, **options)
    feed = rows_to_feed(spark, rows)
    keys = feed.select(F.col("txn_id").alias("key"))
    run_together(spark, state.record(feed, {row["txn_ts"].date() for row in rows}, keys))
    state.commit()


def test_a_batch_opens_its_own_buckets_only(spark, tmp_path):
    root, buckets = str(tmp_path / "root"), 16
    for number in range(3):
        leave_behind(spark, root, number, one_day(number), merge_at=3, buckets=buckets)
    state = StateTables(spark, root, 3)
    assert state.buckets == buckets  # as settled by the first batch
    probe = spark.createDataFrame([("2-7", "a2-7")], "key string, account string")
    key, account = probe.select(
        bucket_of(F.col("key"), buckets), bucket_of(F.col("account"), buckets)).first()
    keys = state.keys({key}, ["2-7"])
    assert [row.key for row in keys.collect()] == ["2-7"]
    assert keys.inputFiles() and all(f"/bucket={key}/" in name for name in keys.inputFiles())
    assert "EqualTo(key,2-7)" in keys._jdf.queryExecution().executedPlan().toString()
    past = state.history({account: NOON.date()})
    assert past.inputFiles() and all(f"/bucket={account}/" in n for n in past.inputFiles())
    assert "a2-7" in {row.account_id for row in past.collect()}
    assert state.history({account: after(days=1).date()}).isEmpty()


def test_what_a_batch_opens_does_not_grow_with_history(spark, tmp_path):
    root, merge_at = str(tmp_path / "root"), 2
    opened, parts = [], []
    for number in range(9):
        leave_behind(spark, root, number, one_day(number, 6), merge_at=merge_at, buckets=2)
        state = StateTables(spark, root, number + 1)
        opened.append(max(len(state.keys({b}).inputFiles()) for b in range(2)))
        parts.append(max(map(len, Commits(spark, root).newest().parts.values())))
    # At most merge_at - 1 parts per level, and levels grow with the logarithm of the batches.
    assert max(opened) <= 4 and max(parts) <= 4
    every = range(state.buckets)
    assert state.keys(every).count() == state.accounts(every).count() == 54
    assert state.history(dict.fromkeys(every, NOON.date())).count() == 54


def test_keys_without_a_value_are_known_too(spark, tmp_path):
    root = str(tmp_path / "root")
    gate = {"unique_key": "txn_id", "checks": []}
    for number in range(3):
        process_batch(rows_to_feed(spark, [txn(None, "A"), txn(f"x{number}", "A")]), number, root,
                      gate, DEFAULT_RULES, merge_at=2, buckets=2)
    held = read_output(spark, root, "quarantine").select("txn_id", "batch_id").collect()
    assert sorted(map(tuple, held), key=str) == [(None, 1), (None, 2)]
