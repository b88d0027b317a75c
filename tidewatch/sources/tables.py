"""Adapters that present other tables as a transaction feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _every(column: Column, step: int, offset: int = 0) -> Column:
    return column % F.lit(step) == F.lit(offset)


def _tagged(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def events_as_feed(events: DataFrame) -> DataFrame:
    """Event stream as a feed, with defects of every kind at fixed event ids."""
    event, user = F.col("event_id"), F.col("user_id")
    digits = F.regexp_extract("props", "[0-9]+", 0)
    cents = F.round(F.col("value") * 100, 2)
    channel = F.when(_every(event, 617), "TELEPATHY")
    for kind, name in [("view", "POS"), ("click", "ONLINE"), ("signup", "BRANCH"),
                       ("purchase", "WIRE"), ("error", "ATM")]:
        channel = channel.when(F.col("event_type") == kind, name)
    kinds = ["grocery", "fuel", "electronics", "travel", "gambling", "crypto", "utilities"]
    category = F.element_at(
        F.array(*map(F.lit, kinds)), (digits.cast("int") % len(kinds) + 1).cast("int")
    )
    return events.select(
        F.when(_every(event, 500, 7), _tagged("T", event - 1)).otherwise(_tagged("T", event))
        .alias("txn_id"),
        F.when(~_every(event, 701), _tagged("ACC", user)).alias("account_id"),
        _tagged("CUST", user).alias("customer_id"),
        F.concat(F.lit("BEN"), digits).alias("beneficiary_id"),
        F.col("ts").cast("timestamp").alias("txn_ts"),
        F.when(_every(event, 907), F.lit(None).cast("double"))
        .when(_every(event, 811), -cents)
        .when(_every(event, 2503, 5), F.lit(2e7))
        .otherwise(cents)
        .alias("amount"),
        F.when(_every(event, 613), "XXX").otherwise("USD").alias("currency"),
        channel.alias("channel"),
        F.when(_every(event, 1009), "usa").when(_every(event, 23), "SG")
        .when(_every(user, 3), "GB").otherwise("US").alias("country"),
        category.alias("merchant_category"),
    )


def orders_as_feed(orders: DataFrame) -> DataFrame:
    """Orders as a feed of whole days: long silences and many same-second rows."""
    customer, status = F.col("o_custkey"), F.col("o_orderstatus")
    return orders.select(
        _tagged("O", F.col("o_orderkey")).alias("txn_id"),
        _tagged("ACC", customer).alias("account_id"),
        _tagged("CUST", customer).alias("customer_id"),
        F.concat(F.lit("BEN-"), "o_orderpriority").alias("beneficiary_id"),
        F.col("o_orderdate").cast("timestamp").alias("txn_ts"),
        F.col("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(status == "F", "BRANCH").when(status == "O", "ONLINE").otherwise("WIRE")
        .alias("channel"),
        F.when(_every(customer, 3), "GB").otherwise("US").alias("country"),
        F.when(_every(customer, 7), "crypto").otherwise("grocery").alias("merchant_category"),
    )
