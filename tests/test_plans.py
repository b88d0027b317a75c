"""Plan shapes that hold at scale: few shuffles, pruned and filtered scans."""

import re

import pytest

from tidewatch import (
    DEFAULT_DQ, DEFAULT_RULES, annotate_dq, apply_dq, derive, read_feed_parquet, score, split_dq,
    top_alerts,
)
from tidewatch.operators.scoring import configured_alerts
from tidewatch.plans.catalog import event_feed, queries


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "feed")
    event_feed(spark, "/root/testdata/sf0.001").write.parquet(path)
    return read_feed_parquet(spark, path)


def test_history_columns_cost_one_shuffle_and_two_sorts(landed):
    derived = derive(landed, heavy=[])
    assert exchanges(derived) == 1
    text = plan(derived)
    assert len(re.findall(r"^.*\bSort \[", text, re.M)) == 2
    assert len(re.findall(r"^.*\bWindow \[", text, re.M)) == 3


def test_scoring_and_filtering_add_no_shuffle(landed):
    assert exchanges(configured_alerts(score(landed, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)) == 1


def test_unused_history_is_pruned(landed):
    text = plan(derive(landed, heavy=[]).select("txn_id", "prev_country"))
    assert "sum(" not in text and "row_number" not in text


def test_gate_shuffles_no_row_of_a_unique_key(landed):
    """The branch of unique keys is a broadcast anti join; only repeated keys are compared."""
    text = plan(annotate_dq(landed, DEFAULT_DQ))
    unique, repeated = text.split("LeftAnti")[1].split("LeftSemi")[:2]
    assert "Union" in text.split("LeftAnti")[0]
    assert "Exchange hashpartitioning" not in text.split("LeftAnti")[0]
    assert "BroadcastHashJoin" in unique + repeated


def test_gate_without_repeats_is_a_projection(landed):
    annotated = annotate_dq(landed.filter("txn_id LIKE 'T%3'"), DEFAULT_DQ)
    assert "Exchange" not in plan(annotated) and "Union" not in plan(annotated)


def test_check_predicates_reach_the_scan(landed):
    clean, _ = split_dq(annotate_dq(landed, {"checks": DEFAULT_DQ["checks"]}))
    pushed = " ".join(re.findall(r"PushedFilters: \[.*?\]", plan(clean)))
    assert "IsNotNull(txn_id)" in pushed and "Exchange" not in plan(clean)


def test_clean_rows_build_no_failure_array(landed):
    clean, _ = apply_dq(landed, {"checks": DEFAULT_DQ["checks"]})
    assert "array_compact" not in plan(clean.select("txn_id", "amount"))


def test_account_filters_pass_below_the_windows(landed):
    text = plan(derive(landed, heavy=[]).filter("account_id = 'ACC1'"))
    assert "EqualTo(account_id,ACC1)" in text


def test_amount_filters_stay_above_the_windows(landed):
    text = plan(derive(landed, heavy=[]).filter("amount > 100"))
    assert "GreaterThan(amount" not in text


def test_top_k_is_no_full_sort(landed):
    alerts = configured_alerts(score(landed, DEFAULT_RULES, heavy=[]), DEFAULT_RULES)
    text = plan(top_alerts(alerts))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_projection_prunes_the_scan(landed):
    clean, _ = split_dq(annotate_dq(landed, {"checks": DEFAULT_DQ["checks"][:2]}))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan(clean.select("txn_id"))).group(1)
    assert {column.split(":")[0] for column in schema.split(",")} == {"txn_id", "account_id"}


def test_session_settings_follow_the_input():
    from tidewatch import session_settings

    assert session_settings(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert session_settings(100 * 1024**4)["spark.sql.shuffle.partitions"] == "200000"
    assert session_settings(10 * 1024**4)["spark.sql.shuffle.partitions"] == "20480"


def test_two_scorings_share_one_run_of_the_windows(spark):
    text = plan(queries()["alerts_mixed_configs"](spark, "/root/testdata/sf0.001"))
    assert "Union" in text and "Window" not in text and "Exchange" not in text
