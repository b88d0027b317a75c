"""State per key gives the same verdicts as one batch run."""

import json

import pandas as pd
import pytest
from conftest import NOON, after, txn
from test_stream import BATCHES, land

from tidewatch import DEFAULT_DQ, DEFAULT_RULES, apply_dq, read_output, rows_to_feed, score
from tidewatch.operators.features import DAY_SECONDS
from tidewatch.operators.scoring import configured_alerts, project_alerts, tag_run
from tidewatch.streaming.keyed_state import (
    PAGE_CHARS, PROVIDER_SETTING, ROCKSDB, AccountHistory, FirstOfKey, start_keyed_stream,
)


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("keyed")
    landing, root = str(base / "landing"), str(base / "root")
    before = spark.conf.get(PROVIDER_SETTING)
    spark.conf.set(PROVIDER_SETTING, ROCKSDB)
    try:
        for part in (BATCHES[:2], BATCHES[2:]):  # the second start restores the state
            for number, rows in enumerate(part):
                land(landing, f"{len(part)}-{id(part)}-{number}.json", rows)
            start_keyed_stream(spark, landing, root, DEFAULT_DQ, DEFAULT_RULES,
                               available_now=True).awaitTermination()
    finally:
        spark.conf.set(PROVIDER_SETTING, before)
    return root


def test_keyed_alerts_equal_batch_alerts(spark, streamed):
    source = rows_to_feed(spark, [row for rows in BATCHES for row in rows])
    clean, quarantined = apply_dq(source, DEFAULT_DQ)
    alerts = configured_alerts(score(clean, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)
    expected = project_alerts(tag_run(alerts, "stream"), flags=True)
    got = read_output(spark, streamed, "alerts").drop("batch_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    held = read_output(spark, streamed, "quarantine").drop("batch_id")
    assert sorted(map(str, held.collect())) == sorted(map(str, quarantined.collect()))


def test_keyed_counters(spark, streamed):
    counters = read_output(spark, streamed, "counters").orderBy("batch_id").collect()
    assert [(r.rows, r.quarantined) for r in counters if r.rows] == [
        (len(rows), held) for rows, held in zip(BATCHES, [0, 0, 2, 2])]


def test_missing_keys_share_one_state_entry(spark, tmp_path):
    """NULL ids, accounts and payees through the state store, over two micro-batches."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    config = {"unique_key": "txn_id", "checks": []}
    batches = [
        [txn(None, None, after(hours=i), 11000.0, beneficiary_id=None) for i in range(2)]
        + [txn("1", None, NOON, 12000.0, beneficiary_id=None)],
        [txn(None, "A", after(days=1), 1.0), txn("2", None, after(days=2), 12000.0)],
    ]
    before = spark.conf.get(PROVIDER_SETTING)
    spark.conf.set(PROVIDER_SETTING, ROCKSDB)
    try:
        for number, rows in enumerate(batches):
            land(landing, f"{number}.json", rows)
        start_keyed_stream(spark, landing, root, config, DEFAULT_RULES,
                           available_now=True).awaitTermination()
    finally:
        spark.conf.set(PROVIDER_SETTING, before)
    clean, held = apply_dq(rows_to_feed(spark, [r for rows in batches for r in rows]), config)
    alerts = configured_alerts(score(clean, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)
    expected = project_alerts(tag_run(alerts, "stream"), flags=True)
    got = read_output(spark, root, "alerts").drop("batch_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert read_output(spark, root, "quarantine").count() == held.count() == 2


def test_rocksdb_is_required(spark, tmp_path):
    if spark.conf.get(PROVIDER_SETTING).endswith("RocksDBStateStoreProvider"):
        pytest.skip("the session already uses it")
    with pytest.raises(ValueError, match="RocksDB"):
        start_keyed_stream(spark, str(tmp_path), str(tmp_path / "r"), DEFAULT_DQ, DEFAULT_RULES)




class CountedState:
    """A map state in memory that counts how often it is asked or told."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def containsKey(self, key):
        self.calls += 1
        return key in self.held

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value

    def removeKey(self, key):
        self.calls += 1
        self.held.pop(key, None)


class CountedHandle:
    def __init__(self):
        self.states = []

    def getMapState(self, *_):
        self.states.append(CountedState())
        return self.states[-1]


def test_keys_of_a_group_share_state_entries():
    """Forty thousand keys in three micro-batches: each is told apart, and few calls are made."""
    handle, first = CountedHandle(), FirstOfKey("txn_id", ["amount"])
    first.init(handle)

    def duplicates(start, end):
        ids = [f"T{i}" for i in range(start, end)]
        rows = pd.DataFrame({"txn_id": ids, "txn_ts": pd.Timestamp(NOON), "amount": 1.0})
        chunks = [rows.iloc[at:at + 7000] for at in range(0, len(rows), 7000)]
        out = pd.concat(first.handleInputRows((0,), iter(chunks), None))
        assert sorted(out["txn_id"]) == sorted(ids)
        return set(out.loc[out["is_duplicate"].astype(bool), "txn_id"])

    assert duplicates(0, 30_000) == set()
    assert duplicates(20_000, 40_000) == {f"T{i}" for i in range(20_000, 30_000)}
    state = handle.states[0]
    assert state.calls < 2_000
    before = state.calls
    assert duplicates(5, 6) == {"T5"}
    assert state.calls - before < 20
    assert max(len(value[0]) for value in state.held.values()) <= PAGE_CHARS


def test_accounts_and_days_of_a_group_share_state_entries():
    """Three thousand accounts, one row a day each: every row's predecessor is found, in few calls."""
    handle, history = CountedHandle(), AccountHistory(DAY_SECONDS)
    history.init(handle)
    for day in range(4):
        rows = pd.DataFrame({
            "account_id": [f"A{i}" for i in range(3000)], "txn_id": "T", "customer_id": "c",
            "beneficiary_id": "b", "txn_ts": pd.Timestamp(after(days=day)), "amount": 2.5,
            "currency": "EUR", "channel": "POS", "country": f"C{day}", "merchant_category": "m",
            "second": day * DAY_SECONDS + 5, "has_amount": True, "dq_passed": True})
        out = pd.concat(history.handleInputRows((0,), iter([rows]), None))
        assert set(out["beneficiary_seq"]) == {day + 1}
        assert set(out["txns_last_hour"]) == {1}
        assert set(out["amount_last_day"]) == {5.0 if day else 2.5}
        assert set(out["prev_country"]) == {f"C{day - 1}" if day else None}
    days = [json.loads(value[0]) for value in handle.states[1].held.values() if value[0] != "cut"]
    # Days wholly out of reach are gone.
    assert {name.split(" ")[0] for page in days for name in page} == {"1", "2", "3"}
    assert sum(state.calls for state in handle.states) < 6_000
