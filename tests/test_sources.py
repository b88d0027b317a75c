"""Readers, configuration files, sinks and work tables."""

import datetime as dt
import json
import math
import os

import pytest
from conftest import NOON, txn
from pyspark.sql import functions as F

from tidewatch import (
    DEFAULT_DQ, DEFAULT_RULES, annotate_dq, apply_dq, dq_summary, load_config, parse_iso_ts,
    parse_lines, read_feed, read_feed_parquet, rows_to_feed, run_batch, save_tables,
    with_malformed_check, with_params, write_outputs,
)
from tidewatch.operators.scoring import configured_alerts, score, tag_run
from tidewatch.schema import ALERT_COLUMNS, CORE_COLUMNS, CORRUPT_COLUMN, FEED_SCHEMA
from tidewatch.sources.feed import require_utc
from tidewatch.sources.work import WorkTables, join_path

GOOD = ('{"txn_id":"1","account_id":"A","customer_id":"C","beneficiary_id":"B",'
        '"txn_ts":"2021-09-14T12:00:00","amount":7.5,"currency":"USD","channel":"POS",'
        '"country":"US","merchant_category":"grocery"}')
LINES = {
    "good": GOOD,
    "broken": GOOD[:40],
    "bad date": GOOD.replace("2021-09-14T12", "2021-13-41T12"),
    "quoted number": GOOD.replace("7.5", '"7.5"'),
    "extra field": GOOD.replace("{", '{"extra":1,', 1),
    "integer id": GOOD.replace('"txn_id":"1"', '"txn_id":17'),
    "NaN": GOOD.replace("7.5", '"NaN"'),
}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join([LINES["good"], "", LINES["broken"]]) + "\n")
    (folder / "b.json").write_text("\n".join(
        LINES[k] for k in ("bad date", "quoted number", "extra field", "integer id", "NaN")))
    return str(folder)


def test_json_directory(spark, landing):
    feed = read_feed(spark, landing)
    assert feed.columns == CORE_COLUMNS and all(f.nullable for f in feed.schema.fields)
    rows = feed.collect()
    assert len(rows) == 7
    assert sum(all(value is None for value in row) for row in rows) == 1
    assert sum(row.txn_ts is None for row in rows) == 2
    assert sum(row.amount is None for row in rows) == 2
    assert sum(row.amount is not None and math.isnan(row.amount) for row in rows) == 1
    assert sorted(row.txn_id or "" for row in rows) == ["", "1", "1", "1", "1", "1", "17"]
    assert {row.txn_ts for row in rows} == {NOON, None}


def test_malformed_lines_are_captured_and_quarantined(spark, landing):
    feed = read_feed(spark, landing, capture=True)
    annotated = annotate_dq(feed, with_malformed_check({"checks": DEFAULT_DQ["checks"]}))
    captured = annotated.filter(F.array_contains("dq_failures", "malformed_record"))
    texts = {row[CORRUPT_COLUMN] for row in captured.collect()}
    assert texts == {LINES["broken"], LINES["bad date"], LINES["quoted number"]}
    plain = annotate_dq(feed, {"checks": DEFAULT_DQ["checks"]})
    clean, expected = (
        frame.filter("dq_passed").drop("dq_failures") for frame in (annotated, plain)
    )
    assert sorted(map(str, clean.collect())) == sorted(map(str, expected.collect()))


def test_lines_in_a_column_parse_like_a_file(spark, landing):
    lines = spark.createDataFrame([(line,) for line in LINES.values()], "line string")
    from_text = parse_lines(lines, "line")
    from_file = read_feed(spark, landing, capture=True)
    assert from_text.columns == from_file.columns
    assert sorted(map(str, from_text.collect())) == sorted(map(str, from_file.collect()))


def test_iso_text(spark):
    frame = spark.createDataFrame([("2021-09-14T12:00:00",), ("1 March",), (None,)], "t string")
    assert [r[0] for r in frame.select(parse_iso_ts("t")).collect()] == [NOON, None, None]


def test_rows_to_feed_takes_text_or_datetimes(spark):
    rows = [txn("1", "A"), txn("2", "A", "2021-09-14T12:00:00"), txn("3", "A", None)]
    feed = rows_to_feed(spark, rows)
    assert feed.schema == FEED_SCHEMA
    assert [r.txn_ts for r in feed.collect()] == [NOON, NOON, None]


def test_landed_parquet_reads_core_columns(spark, tmp_path):
    path = str(tmp_path / "landed")
    rows_to_feed(spark, [txn("1", "A")]).withColumn("extra", F.lit(1)).write.parquet(path)
    assert read_feed_parquet(spark, path).columns == CORE_COLUMNS


def test_time_zone_is_required(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_config_files(tmp_path):
    as_json, as_yaml = tmp_path / "rules.json", tmp_path / "rules.yaml"
    as_json.write_text(json.dumps(DEFAULT_RULES))
    assert load_config(str(as_json)) == DEFAULT_RULES
    yaml = pytest.importorskip("yaml")
    as_yaml.write_text(yaml.safe_dump(DEFAULT_DQ))
    assert load_config(str(as_yaml)) == DEFAULT_DQ


def test_with_params_leaves_the_original(spark):
    tuned = with_params(DEFAULT_RULES, velocity_burst={"max_txns_per_hour": 3})
    named = {rule["name"]: rule["params"] for rule in tuned["rules"]}
    assert named["velocity_burst"] == {"max_txns_per_hour": 3}
    assert DEFAULT_RULES["rules"][1]["params"] == {"max_txns_per_hour": 8}
    with pytest.raises(KeyError):
        with_params(DEFAULT_RULES, nothing={})


def test_paths_keep_their_scheme():
    assert join_path("s3://bucket/out/", "alerts") == "s3://bucket/out/alerts"


@pytest.fixture
def outputs(spark):
    rows = [txn("1", "A", NOON, 20000.0), txn("2", "A", NOON, -1.0)]
    clean, quarantined = apply_dq(rows_to_feed(spark, rows), DEFAULT_DQ)
    scored = score(clean, DEFAULT_RULES, heavy=[])
    alerts = tag_run(configured_alerts(scored, DEFAULT_RULES), "run1")
    return alerts, quarantined, dq_summary(quarantined)


def test_parquet_outputs(spark, tmp_path, outputs):
    base = str(tmp_path / "out")
    for _ in range(2):  # overwriting is part of the contract
        paths = write_outputs(base, *outputs)
    assert sorted(os.listdir(base)) == ["alerts", "dq_summary", "quarantine"]
    alerts = spark.read.parquet(paths["alerts"])
    assert alerts.columns[:14] == ALERT_COLUMNS
    assert alerts.columns[14:] == [f"rule_{rule['name']}" for rule in DEFAULT_RULES["rules"]]
    assert alerts.first().run_id == "run1"
    quarantine = spark.read.parquet(paths["quarantine"])
    assert quarantine.columns == [*CORE_COLUMNS, "dq_failures"] and quarantine.count() == 1


def test_tables(spark, outputs):
    spark.sql("CREATE DATABASE IF NOT EXISTS monitoring")
    names = save_tables("monitoring", *outputs)
    assert names == ["monitoring.fraud_alerts", "monitoring.fraud_quarantine",
                     "monitoring.fraud_dq_summary"]
    assert [spark.table(name).count() for name in names] == [1, 1, 1]


def test_work_tables_live_in_the_checkpoint_folder_and_go(spark):
    work = WorkTables(spark)
    frame = spark.createDataFrame([("a", True), ("b", False)], "x string, ok boolean")
    back = work.write(frame, "trial", "ok")
    assert back.schema.simpleString() == frame.schema.simpleString()
    path = work._paths[0]
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert path.startswith(root) and sorted(back.collect()) == sorted(frame.collect())
    work.drop()
    assert not os.path.exists(path)


def test_batch_run(spark, tmp_path, landing):
    from tidewatch.plans.catalog import EVENT_RULES, event_feed

    source = event_feed(spark, "/root/testdata/sf0.001")
    path, out = str(tmp_path / "feed"), str(tmp_path / "out")
    source.write.json(path)
    run = run_batch(spark, path, out, DEFAULT_DQ, EVENT_RULES, run_id="abc")
    again = run_batch(spark, path, out, DEFAULT_DQ, EVENT_RULES)
    assert len(again.run_id) == 8 and again.run_id != run.run_id
    metrics = again.metrics.first()
    balance = metrics.reconciliation
    assert balance.status == "PASS" and balance.source_count == source.count()
    assert balance.quarantined_count == again.quarantined.count()
    assert metrics.alert_count == again.alerts.count() > 0
    assert metrics.alert_rate_pct == round(100 * metrics.alert_count / balance.clean_count, 2)
    assert again.alerts.select("run_id").distinct().first()[0] == again.run_id
    assert again.summary.agg(F.sum("count")).first()[0] >= balance.quarantined_count
    with open(os.path.join(out, "run_metrics.json")) as text:
        document = json.load(text)
    assert set(document) == {"run_id", "reconciliation", "alert_count", "alert_rate_pct"}
    assert document["alert_count"] == metrics.alert_count


def test_batch_run_with_captured_lines(spark, tmp_path, landing):
    run = run_batch(spark, landing, str(tmp_path / "out"), DEFAULT_DQ, DEFAULT_RULES,
                    capture=True)
    assert CORRUPT_COLUMN in run.quarantined.columns
    assert run.quarantined.filter(f"{CORRUPT_COLUMN} IS NOT NULL").count() >= 1
    assert run.metrics.first().reconciliation.count_break == 0


def test_dates_before_the_epoch_survive(spark):
    rows = [txn("1", "A", dt.datetime(1950, 1, 1))]
    assert rows_to_feed(spark, rows).first().txn_ts.year == 1950
