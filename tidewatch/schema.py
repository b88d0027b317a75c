"""The transaction feed's declared schema and the column lists built on it."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the feed's columns, in feed order.
FEED_COLUMNS = {
    "txn_id": T.StringType(),
    "account_id": T.StringType(),
    "customer_id": T.StringType(),
    "beneficiary_id": T.StringType(),
    "txn_ts": T.TimestampType(),
    "amount": T.DoubleType(),
    "currency": T.StringType(),
    "channel": T.StringType(),
    "country": T.StringType(),
    "merchant_category": T.StringType(),
}

# Every field is nullable: readers never enforce NOT NULL on JSON, and the
# quality gate is the place that names a missing value.
FEED_SCHEMA = T.StructType([T.StructField(name, kind, True) for name, kind in FEED_COLUMNS.items()])

CORE_COLUMNS = list(FEED_COLUMNS)

CORRUPT_COLUMN = "_corrupt_record"

# Feed schema plus the raw text of a line the JSON parser could not read whole.
CAPTURE_SCHEMA = T.StructType(
    FEED_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Timestamp format of the feed's JSON lines.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# What a stored alert carries after the core columns.
ALERT_COLUMNS = [*CORE_COLUMNS, "triggered_rules", "risk_score", "risk_band", "run_id"]
