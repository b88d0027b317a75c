"""Plain SQL for the registered queries, written from the definitions.

The SQL takes the direct way (sliding frames, one window per key) and knows
nothing of the routes the Spark side takes; it runs on whole tables.
"""

from __future__ import annotations

# ---- feeds -----------------------------------------------------------------

_EVENT_FEED = """
feed AS (
  SELECT
    CASE WHEN event_id % 500 = 7 THEN 'T' || (event_id - 1) ELSE 'T' || event_id END AS txn_id,
    CASE WHEN event_id % 701 <> 0 THEN 'ACC' || user_id END AS account_id,
    'CUST' || user_id AS customer_id,
    'BEN' || k AS beneficiary_id,
    ts AS txn_ts,
    CASE WHEN event_id % 907 = 0 THEN NULL
         WHEN event_id % 811 = 0 THEN -round(value * 100, 2)
         WHEN event_id % 2503 = 5 THEN CAST(2e7 AS DOUBLE)
         ELSE round(value * 100, 2) END AS amount,
    CASE WHEN event_id % 613 = 0 THEN 'XXX' ELSE 'USD' END AS currency,
    CASE WHEN event_id % 617 = 0 THEN 'TELEPATHY'
         WHEN event_type = 'view' THEN 'POS' WHEN event_type = 'click' THEN 'ONLINE'
         WHEN event_type = 'signup' THEN 'BRANCH' WHEN event_type = 'purchase' THEN 'WIRE'
         WHEN event_type = 'error' THEN 'ATM' END AS channel,
    CASE WHEN event_id % 1009 = 0 THEN 'usa' WHEN event_id % 23 = 0 THEN 'SG'
         WHEN user_id % 3 = 0 THEN 'GB' ELSE 'US' END AS country,
    CASE CAST(k AS BIGINT) % 7 WHEN 0 THEN 'grocery' WHEN 1 THEN 'fuel' WHEN 2 THEN 'electronics'
         WHEN 3 THEN 'travel' WHEN 4 THEN 'gambling' WHEN 5 THEN 'crypto' WHEN 6 THEN 'utilities'
         END AS merchant_category
  FROM (SELECT *, regexp_extract(props, '[0-9]+') AS k FROM events)
)"""

_ORDER_FEED = """
feed AS (
  SELECT
    'O' || o_orderkey AS txn_id,
    'ACC' || o_custkey AS account_id,
    'CUST' || o_custkey AS customer_id,
    'BEN-' || o_orderpriority AS beneficiary_id,
    o_orderdate AS txn_ts,
    o_totalprice AS amount,
    'USD' AS currency,
    CASE o_orderstatus WHEN 'F' THEN 'BRANCH' WHEN 'O' THEN 'ONLINE' ELSE 'WIRE' END AS channel,
    CASE WHEN o_custkey % 3 = 0 THEN 'GB' ELSE 'US' END AS country,
    CASE WHEN o_custkey % 7 = 0 THEN 'crypto' ELSE 'grocery' END AS merchant_category
  FROM orders
)"""

# Whole trillions for half of the customers, fractions of a millionth for the others.
_NUMBER = "(CAST(substr(txn_id, 2) AS BIGINT) % 1000 + 1)"
_BIG = "CAST(substr(customer_id, 5) AS BIGINT) % 2 = 0"
_WIDE_FEED = _EVENT_FEED.replace("feed AS (", "narrow AS (", 1) + f""",
feed AS (
  SELECT * REPLACE (CASE WHEN {_BIG} THEN {_NUMBER} * CAST(1e12 AS DOUBLE)
                         ELSE {_NUMBER} * CAST(4e-7 AS DOUBLE) END AS amount)
  FROM narrow
)"""

_ONE_ACCOUNT = _ORDER_FEED.replace("'ACC' || o_custkey AS", "'ACC' AS")

# ---- gate ------------------------------------------------------------------

_CHECKS = {
    "not_null": [("txn_id_not_null", "txn_id IS NULL"),
                 ("account_id_not_null", "account_id IS NULL"),
                 ("txn_ts_not_null", "txn_ts IS NULL"),
                 ("amount_not_null", "amount IS NULL")],
    "positive": [("amount_positive", "amount <= 0")],
    "max_value": [("amount_within_ceiling", "amount > 10000000")],
    "allowed_values": [
        ("currency_valid", "currency NOT IN ('USD', 'EUR', 'GBP', 'INR', 'SGD', 'AED')"),
        ("channel_valid", "channel NOT IN ('ATM', 'POS', 'ONLINE', 'WIRE', 'MOBILE', 'BRANCH')")],
    "regex": [("country_format", "NOT regexp_matches(country, '^[A-Z]{2}$')")],
}


def _labels(checks: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {fails} THEN '{label}' END" for label, fails in checks)
    return f"concat_ws(',', {cases})"


_RANKED = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY txn_id
    ORDER BY txn_ts ASC NULLS LAST, account_id ASC NULLS FIRST, customer_id ASC NULLS FIRST,
             beneficiary_id ASC NULLS FIRST, amount ASC NULLS FIRST, currency ASC NULLS FIRST,
             channel ASC NULLS FIRST, country ASC NULLS FIRST, merchant_category ASC NULLS FIRST
  ) AS copy_no
  FROM feed
)"""

_ALL_CHECKS = [check for group in _CHECKS.values() for check in group]
_ANNOTATED = f"""
annotated AS (
  SELECT *, {_labels([*_ALL_CHECKS, ('duplicate_txn_id', 'copy_no > 1')])} AS dq_failures
  FROM ranked
),
clean AS (SELECT * FROM annotated WHERE dq_failures = ''),
quarantined AS (SELECT * FROM annotated WHERE dq_failures <> '')"""

# ---- history columns, rules, score -----------------------------------------

_DERIVED = """
timed AS (SELECT *, CAST(epoch_us(txn_ts) // 1000000 AS BIGINT) AS _epoch FROM clean),
windowed AS (
  SELECT *,
    count(*) OVER (PARTITION BY account_id ORDER BY _epoch
                   RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS txns_last_hour,
    sum(amount) OVER (PARTITION BY account_id ORDER BY _epoch
                      RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS amount_last_day,
    lag(country) OVER (PARTITION BY account_id ORDER BY _epoch, txn_ts, txn_id) AS prev_country,
    lag(_epoch) OVER (PARTITION BY account_id ORDER BY _epoch, txn_ts, txn_id) AS prev_epoch,
    row_number() OVER (PARTITION BY account_id, beneficiary_id
                       ORDER BY _epoch, txn_ts, txn_id) AS beneficiary_seq,
    hour(txn_ts) AS txn_hour
  FROM timed
),
derived AS (
  SELECT *, CAST(_epoch - prev_epoch AS DOUBLE) / CAST(3600 AS DOUBLE) AS hours_since_prev
  FROM windowed
)"""


def _rules(per_hour: int, dormant_days: int) -> list[tuple[str, int, str]]:
    return [
        ("high_value_txn", 25, "amount >= 15000"),
        ("velocity_burst", 30, f"txns_last_hour >= {per_hour}"),
        ("structuring", 40, "amount >= 8500 AND amount < 10000 AND amount_last_day >= 10000"),
        ("impossible_travel", 35,
         "prev_country IS NOT NULL AND country <> prev_country AND hours_since_prev <= 2"),
        ("dormant_reactivation", 30,
         f"hours_since_prev >= {dormant_days * 24} AND amount >= 5000"),
        ("new_beneficiary_high_value", 20, "beneficiary_seq = 1 AND amount >= 10000"),
        ("odd_hour_activity", 10, "txn_hour >= 1 AND txn_hour < 5 AND amount >= 2000"),
        ("high_risk_corridor", 15,
         "merchant_category IN ('gambling', 'crypto') AND amount >= 1000"),
    ]


def _scored(rules: list[tuple[str, int, str]]) -> str:
    flags = ",\n    ".join(
        f"coalesce({fires}, false) AS rule_{name}" for name, _, fires in rules
    )
    names = ", ".join(f"CASE WHEN rule_{name} THEN '{name}' END" for name, _, _ in rules)
    points = " + ".join(f"CASE WHEN rule_{name} THEN {weight} ELSE 0 END"
                        for name, weight, _ in rules)
    return f"""
flagged AS (
  SELECT *,
    {flags}
  FROM derived
),
pointed AS (
  SELECT *, concat_ws(',', {names}) AS triggered_rules,
         CAST({points} AS DOUBLE) AS risk_score
  FROM flagged
),
scored AS (
  SELECT *, CASE WHEN risk_score >= 70 THEN 'CRITICAL' WHEN risk_score >= 45 THEN 'HIGH'
                 WHEN risk_score >= 20 THEN 'MEDIUM' WHEN risk_score > 0 THEN 'LOW'
                 ELSE 'NONE' END AS risk_band
  FROM pointed
),
alerts AS (SELECT * FROM scored WHERE risk_band IN ('MEDIUM', 'HIGH', 'CRITICAL'))"""


_EVENT_RULES = _rules(per_hour=3, dormant_days=2)
_DEFAULT_RULES = _rules(per_hour=8, dormant_days=90)

_TO_FEED = f"WITH {_EVENT_FEED}\n"
_TO_GATE = f"WITH {_EVENT_FEED},{_RANKED},{_ANNOTATED}\n"
_TO_DERIVED = f"WITH {_EVENT_FEED},{_RANKED},{_ANNOTATED},{_DERIVED}\n"
_TO_ALERTS = f"WITH {_EVENT_FEED},{_RANKED},{_ANNOTATED},{_DERIVED},{_scored(_EVENT_RULES)}\n"
_ORDERS_TO_ALERTS = (
    f"WITH {_ORDER_FEED},{_RANKED},{_ANNOTATED},{_DERIVED},{_scored(_DEFAULT_RULES)}\n"
)

# Rows in four slices of time, some a slice or two late; each row meets those of its own and of
# earlier slices.
_LATE = f"""
bounds AS (
  SELECT epoch_us(min(txn_ts)) AS first,
         CAST(round_even((epoch_us(max(txn_ts)) - epoch_us(min(txn_ts))) / 4.0, 0)
           AS BIGINT) AS step
  FROM feed),
arriving AS (
  SELECT feed.*, least(3,
    CASE WHEN epoch_us(txn_ts) < first + step THEN 0
         WHEN epoch_us(txn_ts) < first + 2 * step THEN 1
         WHEN epoch_us(txn_ts) < first + 3 * step THEN 2 ELSE 3 END
    + CASE WHEN CAST(substr(txn_id, 2) AS BIGINT) % 11 = 0 THEN 2
           WHEN CAST(substr(txn_id, 2) AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END) AS slice
  FROM feed, bounds),{_RANKED.replace("FROM feed", "FROM arriving").replace(
      "ORDER BY txn_ts", "ORDER BY slice, txn_ts")},{_ANNOTATED},
timed AS (SELECT *, CAST(epoch_us(txn_ts) // 1000000 AS BIGINT) AS _epoch FROM clean),
recent AS (
  SELECT r.txn_id, count(*) FILTER (WHERE h._epoch >= r._epoch - 3600) AS txns_last_hour,
         sum(h.amount) AS amount_last_day
  FROM timed r JOIN timed h ON h.account_id = r.account_id AND h.slice <= r.slice
   AND h._epoch BETWEEN r._epoch - 86400 AND r._epoch
  GROUP BY r.txn_id),
paid AS (
  SELECT r.txn_id, count(*) AS beneficiary_seq
  FROM timed r JOIN timed h ON h.account_id = r.account_id
   AND h.beneficiary_id IS NOT DISTINCT FROM r.beneficiary_id
   AND (h.slice < r.slice OR (h.slice = r.slice AND (h.txn_ts < r.txn_ts
        OR (h.txn_ts = r.txn_ts AND h.txn_id <= r.txn_id))))
  GROUP BY r.txn_id),
placed AS (
  SELECT r.txn_id, h.country AS prev_country, h._epoch AS prev_epoch,
         row_number() OVER (PARTITION BY r.txn_id ORDER BY h.txn_ts DESC, h.txn_id DESC) AS place
  FROM timed r JOIN timed h ON h.account_id = r.account_id AND h.slice <= r.slice
   AND (h.txn_ts < r.txn_ts OR (h.txn_ts = r.txn_ts AND h.txn_id < r.txn_id))),
derived AS (
  SELECT timed.*, txns_last_hour, amount_last_day, beneficiary_seq, prev_country, prev_epoch,
         hour(txn_ts) AS txn_hour,
         CAST(_epoch - prev_epoch AS DOUBLE) / CAST(3600 AS DOUBLE) AS hours_since_prev
  FROM timed JOIN recent USING (txn_id) JOIN paid USING (txn_id)
  LEFT JOIN (SELECT * FROM placed WHERE place = 1) USING (txn_id))"""

# ---- shown columns ---------------------------------------------------------

_CORE = ("txn_id, account_id, customer_id, beneficiary_id, amount, currency, channel, country, "
         "merchant_category")
_TIME = "strftime(txn_ts, '%Y-%m-%d %H:%M:%S') AS txn_time"
_SUM = "round(amount_last_day, 2) AS amount_last_day"
_PREV = "CAST(prev_epoch AS DOUBLE) AS prev_epoch"
_GAP = "round(hours_since_prev, 6) AS hours_since_prev"
_FLAGS = ", ".join(f"rule_{name}" for name, _, _ in _EVENT_RULES)
_FULL = (f"{_CORE}, {_TIME}, _epoch, txns_last_hour, {_SUM}, prev_country, {_PREV}, {_GAP}, "
         f"beneficiary_seq, txn_hour, {_FLAGS}, triggered_rules, risk_score, risk_band")
_ALERT = f"{_CORE}, {_TIME}, triggered_rules, risk_score, risk_band"

_FEATURES = {
    "epoch_seconds": "_epoch", "rolling_count_1h": "txns_last_hour", "rolling_sum_24h": _SUM,
    "lag_country": "prev_country", "lag_epoch": _PREV, "gap_hours": _GAP,
    "payee_sequence": "beneficiary_seq", "hour_of_day": "txn_hour",
}
_RULE_KEYS = {
    "rule_high_value": "high_value_txn", "rule_velocity": "velocity_burst",
    "rule_structuring": "structuring", "rule_impossible_travel": "impossible_travel",
    "rule_new_beneficiary": "new_beneficiary_high_value", "rule_odd_hour": "odd_hour_activity",
    "rule_corridor": "high_risk_corridor",
}

_BALANCE = """
tally AS (
  SELECT (SELECT count(*) FROM feed) AS source_count,
         (SELECT count(*) FROM clean) AS clean_count,
         (SELECT count(*) FROM quarantined) AS quarantined_count,
         (SELECT round(coalesce(sum(amount), 0), 2) FROM feed) AS source_amount,
         (SELECT round(coalesce(sum(amount), 0), 2) FROM clean) AS clean_amount,
         (SELECT round(coalesce(sum(amount), 0), 2) FROM quarantined) AS quarantined_amount
),
split AS (
  SELECT source_count, clean_count, quarantined_count,
         source_count - (clean_count + quarantined_count) AS count_break, source_amount,
         round(clean_amount + quarantined_amount, 2) AS split_amount
  FROM tally
),
balance AS (
  SELECT *, round(source_amount - split_amount, 2) AS amount_break,
         CASE WHEN count_break = 0 AND abs(round(source_amount - split_amount, 2)) < 0.01
              THEN 'PASS' ELSE 'FAIL' END AS status
  FROM split
)"""

_METRICS = """
metrics AS (
  SELECT 'run00001' AS run_id, balance.*, alert_count,
         round(CAST(100 AS DOUBLE) * alert_count / greatest(clean_count, 1), 2) AS alert_rate_pct
  FROM balance, (SELECT count(*) AS alert_count FROM alerts)
)"""


def _ranked_report(columns: str, limit: int | None) -> str:
    tail = f" ORDER BY risk_score DESC, txn_id LIMIT {limit}" if limit else ""
    return f"{_TO_ALERTS} SELECT {columns}, triggered_rules FROM alerts{tail}"


def _explode_count(name: str, source: str, values: list[str], alias: str) -> str:
    """Rows per label in a comma-joined list column, labels that never occur left out."""
    parts = " UNION ALL ".join(
        f"SELECT '{value}' AS \"{alias}\" FROM {source} "
        f"WHERE list_contains(string_split({name}, ','), '{value}')" for value in values
    )
    return f"SELECT \"{alias}\", count(*) AS \"count\" FROM ({parts}) GROUP BY \"{alias}\""


def oracle_sql() -> dict[str, str]:
    sql = {
        "ingest_json": f"{_TO_FEED} SELECT {_CORE}, {_TIME} FROM feed",
        "parse_iso_ts": """
            SELECT event_id, CASE WHEN event_id % 97 <> 0
                                  THEN CAST(epoch_us(ts) // 1000000 AS DOUBLE) END AS epoch
            FROM events""",
        "corrupt_capture": f"""{_TO_FEED},
            numbered AS (SELECT *, CAST(substr(txn_id, 2) AS BIGINT) AS n FROM feed)
            SELECT CASE WHEN n % 331 <> 0 THEN txn_id END AS txn_id,
                   CASE WHEN n % 331 <> 0 THEN account_id END AS account_id,
                   CASE WHEN n % 331 <> 0 AND n % 337 <> 0 THEN amount END AS amount,
                   CASE WHEN n % 331 <> 0 THEN strftime(txn_ts, '%Y-%m-%d %H:%M:%S')
                        END AS txn_time,
                   n % 331 = 0 OR (n % 337 = 0 AND amount IS NOT NULL) AS is_corrupt
            FROM numbered""",
        "dq_duplicates": f"""{_TO_GATE}
            SELECT txn_id, account_id, amount, {_TIME} FROM ranked WHERE copy_no > 1""",
        "dq_duplicates_orders": f"""WITH {_ORDER_FEED}
            SELECT customer_id, txn_id, row_number() OVER (
                     PARTITION BY customer_id
                     ORDER BY txn_ts ASC NULLS LAST, txn_id, account_id, beneficiary_id, amount,
                              currency, channel, country, merchant_category) > 1 AS is_duplicate
            FROM feed""",
        "dq_duplicates_heavy": """
            SELECT l_suppkey, l_quantity, is_duplicate, count(*) AS n
            FROM (SELECT l_suppkey, l_quantity, row_number() OVER (
                           PARTITION BY l_suppkey
                           ORDER BY l_shipdate ASC NULLS LAST, l_quantity ASC NULLS FIRST
                         ) > 1 AS is_duplicate
                  FROM lineitem)
            GROUP BY l_suppkey, l_quantity, is_duplicate""",
        "dq_failures": f"""{_TO_GATE}
            SELECT txn_id, {_TIME}, dq_failures, dq_failures = '' AS dq_passed FROM annotated""",
        "dq_clean": f"{_TO_GATE} SELECT {_CORE}, {_TIME} FROM clean",
        "dq_quarantine": f"{_TO_GATE} SELECT {_CORE}, {_TIME}, dq_failures FROM quarantined",
        "dq_summary": _TO_GATE + _explode_count(
            "dq_failures", "quarantined",
            [label for label, _ in _ALL_CHECKS] + ["duplicate_txn_id"], "check"),
        "quarantine_view": f"""{_TO_GATE}
            SELECT txn_id, account_id, amount, currency, channel, dq_failures FROM quarantined""",
        "rule_dormant": f"""{_ORDERS_TO_ALERTS}
            SELECT txn_id, account_id, amount, {_TIME} FROM scored
            WHERE rule_dormant_reactivation""",
        "score_flags": f"{_TO_ALERTS} SELECT txn_id, {_FLAGS} FROM scored",
        "score_triggered": f"{_TO_ALERTS} SELECT txn_id, triggered_rules FROM scored",
        "score_risk": f"{_TO_ALERTS} SELECT txn_id, risk_score FROM scored",
        "score_band": f"{_TO_ALERTS} SELECT txn_id, risk_band FROM scored",
        "score_full": f"{_TO_ALERTS} SELECT {_FULL} FROM scored",
        "score_heavy_accounts": f"{_TO_ALERTS} SELECT {_FULL} FROM scored",
        "score_orders": f"{_ORDERS_TO_ALERTS} SELECT {_FULL} FROM scored",
        "score_heavy_seconds": f"""WITH {_ONE_ACCOUNT},{_RANKED},{_ANNOTATED},{_DERIVED},
            {_scored(_DEFAULT_RULES)} SELECT {_FULL} FROM scored""",
        "alerts": f"{_TO_ALERTS} SELECT {_ALERT} FROM alerts",
        "alerts_tagged": f"""{_TO_ALERTS}
            SELECT txn_id, risk_score, 'run00001' AS run_id FROM alerts""",
        "alerts_projected": f"{_TO_ALERTS} SELECT {_ALERT}, 'run00001' AS run_id FROM alerts",
        "reconcile": f"{_TO_GATE},{_BALANCE} SELECT * FROM balance",
        "rolling_sum_wide": f"""WITH {_WIDE_FEED},
            timed AS (SELECT *, CAST(epoch_us(txn_ts) // 1000000 AS BIGINT) AS _epoch FROM feed),
            added AS (
              SELECT *, sum(CASE WHEN {_BIG} THEN {_NUMBER} END) OVER day AS big,
                     sum(CASE WHEN NOT {_BIG} THEN {_NUMBER} END) OVER day AS small
              FROM timed
              WINDOW day AS (PARTITION BY account_id ORDER BY _epoch
                             RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW))
            SELECT txn_id, account_id, {_TIME},
                   CASE WHEN big IS NULL THEN CAST(small * 400 AS DOUBLE)
                        ELSE CAST(big * 1000000000000 AS DOUBLE)
                             + coalesce(CAST(small AS DOUBLE), 0) * CAST(4e-7 AS DOUBLE)
                   END AS amount_last_day
            FROM added""",
        "reconcile_wide": f"""WITH {_WIDE_FEED},{_RANKED},{_ANNOTATED},
            sides AS (
              SELECT (SELECT count(*) FROM feed) AS source_count,
                     (SELECT count(*) FROM clean) AS clean_count,
                     (SELECT count(*) FROM quarantined) AS quarantined_count,
                     (SELECT sum({_NUMBER}) FROM feed) AS whole,
                     (SELECT sum({_NUMBER}) FROM annotated) AS split)
            SELECT source_count, clean_count, quarantined_count,
                   source_count - clean_count - quarantined_count AS count_break,
                   CAST(whole - split AS DOUBLE) AS amount_break,
                   CASE WHEN source_count = clean_count + quarantined_count AND whole = split
                        THEN 'PASS' ELSE 'FAIL' END AS status
            FROM sides""",
        "alerts_mixed_configs": f"""{_TO_ALERTS}
            SELECT txn_id, account_id, risk_score, 'CRITICAL' AS risk_band
            FROM (SELECT txn_id, account_id, risk_score FROM scored WHERE risk_score >= 70
                  UNION ALL
                  SELECT txn_id, account_id, risk_score FROM scored WHERE risk_score >= 30)""",
        "alerts_by_band": f"""{_TO_ALERTS}
            SELECT risk_band, count(*) AS "count" FROM alerts GROUP BY risk_band""",
        "alerts_by_rule": _TO_ALERTS + _explode_count(
            "triggered_rules", "alerts", [name for name, _, _ in _EVENT_RULES], "rule"),
        "top10_alerts": _ranked_report(
            "txn_id, account_id, amount, channel, country, risk_score, risk_band", 10),
        "top5_alerts": _ranked_report(
            "txn_id, account_id, amount, channel, risk_score, risk_band", 5),
        "alerts_ranked": _ranked_report(
            "txn_id, account_id, amount, channel, country, merchant_category, risk_score, "
            "risk_band", None),
        "run_metrics": f"{_TO_ALERTS},{_BALANCE},{_METRICS} SELECT * FROM metrics",
        "run_summary": f"""{_TO_ALERTS},{_BALANCE},{_METRICS}
            SELECT 'source rows' AS measure, CAST(source_count AS VARCHAR) AS value FROM metrics
            UNION ALL SELECT 'clean rows', CAST(clean_count AS VARCHAR) FROM metrics
            UNION ALL SELECT 'quarantined rows', CAST(quarantined_count AS VARCHAR) FROM metrics
            UNION ALL SELECT 'count break', CAST(count_break AS VARCHAR) FROM metrics
            UNION ALL SELECT 'source amount', format('{{:,.2f}}', source_amount) FROM metrics
            UNION ALL SELECT 'clean + quarantined', format('{{:,.2f}}', split_amount) FROM metrics
            UNION ALL SELECT 'amount break', format('{{:,.2f}}', amount_break) FROM metrics
            UNION ALL SELECT 'reconciliation', status FROM metrics
            UNION ALL SELECT 'alerts raised', CAST(alert_count AS VARCHAR) FROM metrics
            UNION ALL SELECT 'alert rate', format('{{:.2f}}%', alert_rate_pct) FROM metrics""",
        "batch_counters": f"""{_TO_ALERTS}
            SELECT CAST(0 AS BIGINT) AS batch_id, (SELECT count(*) FROM annotated) AS "rows",
                   (SELECT count(*) FROM quarantined) AS quarantined,
                   (SELECT count(*) FROM alerts) AS alerts""",
    }
    sql["batch_run_metrics"] = sql["run_metrics"]
    sql["batch_run_alerts"] = (
        f"{_TO_ALERTS} SELECT {_ALERT}, 'run00001' AS run_id, {_FLAGS} FROM alerts"
    )
    sql["stream_alerts"] = sql["stream_keyed_alerts"] = sql["alerts"]
    sql["stream_late_rows"] = (
        f"WITH {_EVENT_FEED},{_LATE},{_scored(_EVENT_RULES)} SELECT {_ALERT} FROM alerts")
    sql["stream_counters"] = f"""{_TO_ALERTS}
        SELECT (SELECT count(*) FROM annotated) AS "rows",
               (SELECT count(*) FROM quarantined) AS quarantined,
               (SELECT count(*) FROM alerts) AS alerts"""
    sql["stream_top5"] = f"""{_TO_ALERTS},
        bounds AS (
          SELECT epoch_us(min(txn_ts)) AS first,
                 CAST(round_even((epoch_us(max(txn_ts)) - epoch_us(min(txn_ts))) / 4.0, 0)
                   AS BIGINT) AS step
          FROM feed),
        sliced AS (
          SELECT a.*, CASE WHEN epoch_us(txn_ts) < first + step THEN 0
                           WHEN epoch_us(txn_ts) < first + 2 * step THEN 1
                           WHEN epoch_us(txn_ts) < first + 3 * step THEN 2 ELSE 3 END AS slice
          FROM alerts a, bounds),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY slice ORDER BY risk_score DESC, txn_id) AS place
          FROM sliced)
        SELECT txn_id, account_id, amount, channel, risk_score, risk_band, triggered_rules,
               CAST(dense_rank() OVER (ORDER BY slice) AS INTEGER) AS batch_id
        FROM placed WHERE place <= 5"""
    for kind, checks in _CHECKS.items():
        sql[f"dq_{kind}"] = f"""{_TO_FEED}
            SELECT * FROM (SELECT {_CORE}, {_TIME}, {_labels(checks)} AS dq_failures FROM feed)
            WHERE dq_failures <> ''"""
    for key, shown in _FEATURES.items():
        sql[key] = f"{_TO_DERIVED} SELECT txn_id, account_id, {shown} FROM derived"
    for key, rule in _RULE_KEYS.items():
        sql[key] = f"""{_TO_ALERTS}
            SELECT txn_id, account_id, amount, {_TIME} FROM scored WHERE rule_{rule}"""
    return sql
