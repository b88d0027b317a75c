"""Random feeds: both streams judge every row as one batch run does."""

import random

import pytest
from conftest import after, txn
from test_features import random_rows
from test_stream import land

from tidewatch import (
    DEFAULT_RULES, SkewLimits, apply_dq, process_batch, read_output, rows_to_feed, score, with_params,
)
from tidewatch.operators.gate import annotate_dq
from tidewatch.operators.scoring import project_alerts, tag_run
from tidewatch.sources.work import WorkTables, folder_exists
from tidewatch.streaming import micro_batch
from tidewatch.streaming.keyed_state import PROVIDER_SETTING, ROCKSDB, start_keyed_stream

GATE = {"unique_key": "txn_id", "checks": []}
# Every row is stored, and limits are so low that each rule splits the feed.
RULES = {
    **with_params(
        DEFAULT_RULES,
        high_value_txn={"amount_threshold": 9000},
        velocity_burst={"max_txns_per_hour": 2},
        impossible_travel={"max_hours_between": 1},
        dormant_reactivation={"dormant_days": 0.25, "amount_threshold": 10},
        new_beneficiary_high_value={"amount_threshold": 1},
        odd_hour_activity={"amount_threshold": 10},
    ),
    "min_alert_band": "NONE",
}


@pytest.fixture(scope="module")
def batches():
    """Four batches in time order, cut between seconds."""
    rows = [dict(row, txn_ts=row["txn_ts"].replace(microsecond=0))
            for row in random_rows(seed=21, n=240, seconds=400_000)]
    rows.sort(key=lambda row: row["txn_ts"])
    parts = [rows[i * 60:(i + 1) * 60] for i in range(4)]
    for earlier, later in zip(parts, parts[1:]):
        while later and later[0]["txn_ts"] == earlier[-1]["txn_ts"]:
            earlier.append(later.pop(0))
    return parts


@pytest.fixture(scope="module")
def expected(spark, batches):
    feed = rows_to_feed(spark, [row for rows in batches for row in rows])
    scored = score(feed, RULES, heavy=[])
    fired = {name for row in scored.collect() for name in row.triggered_rules}
    assert len(fired) >= 7
    return sorted(map(str, project_alerts(tag_run(scored, "stream"), flags=True).collect()))


@pytest.mark.parametrize("limits", [SkewLimits(), SkewLimits(group_rows=3)])
def test_tables_of_history(spark, tmp_path, batches, expected, limits):
    root = str(tmp_path / "root")
    for number, rows in enumerate(batches):
        process_batch(rows_to_feed(spark, rows), number, root, GATE, RULES, limits=limits,
                      merge_at=2, buckets=3)
    got = read_output(spark, root, "alerts").drop("batch_id")
    assert sorted(map(str, got.collect())) == expected


def keyed_run(spark, landing, root):
    before = spark.conf.get(PROVIDER_SETTING)
    spark.conf.set(PROVIDER_SETTING, ROCKSDB)
    try:
        start_keyed_stream(spark, landing, root, GATE, RULES,
                           available_now=True).awaitTermination()
    finally:
        spark.conf.set(PROVIDER_SETTING, before)


def test_state_per_key(spark, tmp_path, batches, expected):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    for number, rows in enumerate(batches):
        land(landing, f"{number}.json", rows)
    keyed_run(spark, landing, root)
    got = read_output(spark, root, "alerts").drop("batch_id")
    assert sorted(map(str, got.collect())) == expected


def test_both_streams_agree_on_shuffled_arrival(spark, tmp_path, batches):
    """Rows come in any order within a week; both streams judge each by what came before it."""
    rows = [row for part in batches for row in part]
    random.Random(5).shuffle(rows)
    parts = [rows[i::4] for i in range(4)]
    table, keyed, landing = (str(tmp_path / name) for name in ("table", "keyed", "landing"))
    for number, part in enumerate(parts):
        process_batch(rows_to_feed(spark, part), number, table, GATE, RULES)
        land(landing, f"{number}.json", part)
    keyed_run(spark, landing, keyed)
    first, second = (
        sorted(map(str, read_output(spark, root, "alerts").drop("batch_id").collect()))
        for root in (table, keyed))
    assert first == second
    assert read_output(spark, keyed, "top").count() == read_output(spark, table, "top").count() > 0


def test_duplicates_keep_the_row_that_the_batch_gate_keeps(spark, tmp_path):
    """Same id and time: the first by account, then by the other columns, missing ones first."""
    rows = [txn("d1", "zoe"), txn("d1", "amy"), txn("d2", "bob", amount=None), txn("d2", "bob", amount=9.0),
            txn("d3", "cy", None), txn("d3", "cy", after(days=1)), txn("d4", None), txn("d4", "eve")]
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    land(landing, "0.json", rows)
    keyed_run(spark, landing, root)
    clean, _ = apply_dq(rows_to_feed(spark, rows), GATE)
    shown = ["txn_id", "account_id", "txn_ts", "amount"]
    got = read_output(spark, root, "alerts").select(shown).collect()
    assert sorted(map(str, got)) == sorted(map(str, clean.select(shown).collect()))


def test_a_late_row_meets_the_rows_that_were_known(spark, tmp_path):
    """A row 60 hours late still completes a run of amounts just under the limit."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    known = [txn(f"l{i}", "late", after(minutes=i), 9650.0) for i in range(3)]
    for number, part in enumerate((known, [txn("new", "late", after(hours=60), 5.0)],
                                   [txn("late", "late", after(minutes=9), 9650.0)])):
        land(landing, f"{number}.json", part)
    keyed_run(spark, landing, root)
    rules = {r.txn_id: list(r.triggered_rules) for r in read_output(spark, root, "alerts").collect()}
    assert "structuring" in rules["late"]


@pytest.mark.parametrize("merge_at", [2, 16])
def test_a_late_row_finds_its_previous_row_behind_newer_ones(spark, tmp_path, merge_at):
    """Days after its previous row, days before the rows that came first."""
    root = str(tmp_path / "root")
    known = [[txn("a1", "amy", country="GB"), txn("b1", "bob", after(days=9))],
             [txn("a2", "amy", after(days=9)), txn("b2", "bob", after(days=10))]]
    late = [txn("a3", "amy", after(days=4), country="US"), txn("a4", "amy", after(days=4, minutes=5)),
            txn("b3", "bob", after(days=2))]
    for number, rows in enumerate([*known, late]):
        process_batch(rows_to_feed(spark, rows), number, root, GATE, RULES,
                      merge_at=merge_at, buckets=3, search_late=True)
    fired = {row.txn_id: "dormant_reactivation" in row.triggered_rules
             for row in read_output(spark, root, "alerts").collect()}
    assert fired == {"a1": False, "b1": False, "a2": True, "b2": True,
                     "a3": True, "a4": False, "b3": False}


def test_known_keys_are_searched_once_and_nothing_stays_behind(spark, tmp_path, monkeypatch):
    """The gate reads its input several times; the search among known keys must not run again."""
    searched, tables = [], []

    def annotate(frame, *args, **options):
        searched.append((frame, frame.storageLevel.useMemory))
        return annotate_dq(frame, *args, **options)

    class Tables(WorkTables):
        def write(self, df, name, *partition_by):
            table = super().write(df, name, *partition_by)
            tables.append((name, self._paths[-1]))
            return table

    monkeypatch.setattr(micro_batch, "annotate_dq", annotate)
    monkeypatch.setattr(micro_batch, "WorkTables", Tables)
    rows = [txn("1", "A"), txn("2", "B"), txn("3", "A", after(hours=1))]
    process_batch(rows_to_feed(spark, rows[:2]), 0, str(tmp_path), GATE, RULES)
    process_batch(rows_to_feed(spark, rows), 1, str(tmp_path), GATE, RULES)
    assert [kept for _, kept in searched] == [True, True]
    assert not any(frame.storageLevel.useMemory for frame, _ in searched)
    assert [name for name, _ in tables] == ["bounds", "bounds"]
    assert not any(folder_exists(spark, path) for _, path in tables)
    counters = read_output(spark, str(tmp_path), "counters").orderBy("batch_id").collect()
    assert [(row["rows"], row["quarantined"]) for row in counters] == [(2, 0), (3, 2)]
