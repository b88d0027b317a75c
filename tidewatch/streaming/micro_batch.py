"""Structured Streaming job: the batch operators over micro-batches with history.

Contract: alerts equal those of a batch run over all files when every account's
rows arrive in time order and rows of one second arrive in one micro-batch. A
late row is judged against what is known when it arrives, with ``search_late``
however far back that lies; verdicts already written are not revised.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.rules import compile_rules
from tidewatch.operators.features import DAY_SECONDS, derive
from tidewatch.operators.gate import annotate_dq, split_dq
from tidewatch.operators.reports import batch_counters, top_batch_alerts
from tidewatch.operators.scoring import configured_alerts, project_alerts, score_derived, tag_run
from tidewatch.operators.skew import DEFAULT_LIMITS, SkewLimits
from tidewatch.schema import CORE_COLUMNS
from tidewatch.sources.feed import stream_feed
from tidewatch.sources.work import WorkTables, cached, join_path
from tidewatch.streaming.state import (
    BUCKETS, FEW_KEYS, MERGE_AT, Commits, StateTables, bucket_of, fold_accounts, fold_payees,
    run_together,
)

# Trigger interval in seconds and files per trigger.
TRIGGER_SECONDS = 5
FILES_PER_TRIGGER = 1


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def flag_seen_keys(batch: DataFrame, key: str, state: StateTables) -> DataFrame:
    """Add ``_seen``: the row's key occurred in an earlier batch.

    Only the buckets of the batch's keys are opened; a few keys are asked for by value.
    """
    text = F.col(key).cast("string")
    rows, wanted = batch.agg(
        F.count(F.lit(1)), F.collect_set(bucket_of(text, state.buckets))).first()
    few = None
    if rows <= FEW_KEYS:
        few = {row[0] for row in batch.select(text).collect()}
    asked = batch.select(text.alias("_wanted")).distinct()
    known = state.keys(wanted, few).join(asked, _same("key", "_wanted"), "left_semi").distinct()
    marked = known.select("key", F.lit(True).alias("_known"))
    joined = batch.join(marked, text.eqNullSafe(F.col("key")), "left")
    return joined.select(*batch.columns, F.coalesce("_known", F.lit(False)).alias("_seen"))


def _before_late_rows(pool: DataFrame, overtaken: DataFrame, state: StateTables) -> DataFrame:
    """(_account, last): the last known row before the pool of accounts that were ``overtaken``,
    which have known rows in the pool or after it.

    If one of these lies before the batch's first row, that is the previous row already; the
    history of the others is opened from its first date on, in their buckets alone.
    """
    seconds = F.col("txn_ts").cast("long")
    known = pool.filter("NOT _new").groupBy(F.col("account_id").alias("_owner")).agg(
        F.min(seconds).alias("_first"))
    late = overtaken.join(known, _same("_account", "_owner"), "left").filter(
        F.coalesce(F.col("_first") >= F.col("_since"), F.lit(True))).select("_account", "_since")
    wanted = late.agg(F.collect_set(bucket_of(F.col("_account"), state.buckets))).first()[0]
    rows = state.history({bucket: dt.date.min for bucket in wanted})
    row = F.struct(seconds.alias("epoch"), "txn_ts", "txn_id", "country")
    return (
        rows.join(late, _same("account_id", "_account"))
        .filter(seconds < F.col("_since") - DAY_SECONDS)
        .groupBy("_account").agg(F.max(row).alias("last"))
    )


def derive_with_history(
    new: DataFrame, state: StateTables, since: Mapping[int, dt.date],
    limits: SkewLimits = DEFAULT_LIMITS, search_late: bool = False,
    tables: WorkTables | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(History columns of a batch's clean rows, as if all earlier rows were there; a cached
    frame behind it, to be given up after use).

    The rolling frames need a day of earlier rows, of this batch's accounts only: ``since``
    has the date of the first row per bucket of accounts. What lies further back enters as
    one row per account (previous row) and one count per account and payee (payee ordinal).
    With ``search_late`` older history is searched for accounts whose rows come late, behind
    that one row; else such a row has no previous one. What several steps read is written out
    to ``tables``; without, it stays behind.
    """
    seconds = F.col("txn_ts").cast("long")
    tables = tables or WorkTables(new.sparkSession)
    bounds = tables.write(new.groupBy("account_id").agg(F.min(seconds).alias("_since")).select(
        F.col("account_id").alias("_account"), "_since"
    ), "bounds")
    days = {bucket: day - dt.timedelta(days=2) for bucket, day in since.items()}
    recent = (
        state.history(days)
        .join(bounds, _same("account_id", "_account"))
        .filter(seconds >= F.col("_since") - DAY_SECONDS)
        .select(*CORE_COLUMNS)
    )
    pool = cached(new.withColumn("_new", F.lit(True)).unionByName(
        recent.withColumn("_new", F.lit(False))
    ))
    # No account of a small pool can be heavy; counting the pool also fills the cache.
    heavy = [] if pool.count() < limits.group_rows else None
    derived = derive(
        pool, heavy=heavy, counted="_new", limits=limits, tables=tables,
    ).filter("_new").drop("_new")

    # An account's last row counts as the previous one only if it lies before the
    # rows of the pool; otherwise the pool itself holds the previous row, or the batch is late.
    last = fold_accounts(state.accounts(since).join(
        bounds, _same("account_id", "_account"), "left_semi"
    )).join(bounds, _same("account_id", "_account"))
    reach = F.col("_since") - DAY_SECONDS
    before = last.filter(F.col("last.epoch") < reach).select("_account", "last")
    if search_late:
        before = before.unionByName(
            _before_late_rows(pool, last.filter(F.col("last.epoch") >= reach), state))
    older = before.select("_account", F.col("last.epoch").alias("_old_epoch"),
                          F.col("last.country").alias("_old_country"))
    paid = fold_payees(state.payees(since).join(
        bounds, _same("account_id", "_account"), "left_semi"
    )).select(F.col("account_id").alias("_payer"), F.col("beneficiary_id").alias("_payee"), "paid")

    lonely = F.col("prev_epoch").isNull()
    joined = (
        derived.join(older, _same("account_id", "_account"), "left")
        .join(paid, _same("account_id", "_payer") & _same("beneficiary_id", "_payee"), "left")
    )
    patched = joined.withColumns({
        "prev_country": F.when(lonely, F.col("_old_country")).otherwise(F.col("prev_country")),
        "prev_epoch": F.coalesce("prev_epoch", "_old_epoch"),
        "beneficiary_seq": (
            F.col("beneficiary_seq") + F.coalesce("paid", F.lit(0))
        ).cast("int"),
    }).withColumn("hours_since_prev", (F.col("_epoch") - F.col("prev_epoch")) / F.lit(3600.0))
    return patched.select(*derived.columns), pool


def _clean_dates(clean: DataFrame, buckets: int) -> tuple[dict[int, dt.date], set[dt.date]]:
    """(first date per bucket of accounts, all dates) of clean rows; one row per bucket travels.

    A bucket whose rows have no time asks for no history.
    """
    day = F.to_date("txn_ts")
    rows = clean.groupBy(bucket_of(F.col("account_id"), buckets).alias("bucket")).agg(
        F.min(day).alias("first"), F.collect_set(day).alias("dates")).collect()
    since = {row["bucket"]: row["first"] or dt.date.max for row in rows}
    return since, {date for row in rows for date in row["dates"]}


def process_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    dq_config: Mapping[str, Any],
    rules_config: Mapping[str, Any],
    *,
    run_id: str = "stream",
    limits: SkewLimits = DEFAULT_LIMITS,
    merge_at: int = MERGE_AT,
    buckets: int = BUCKETS,
    search_late: bool = False,
) -> None:
    """Gate and score one micro-batch; write outputs and state below ``root``.

    Outputs and state count once the batch's manifest is there, which comes last. A batch
    that failed before is written again over its own parts; a committed one is left alone.
    """
    spark = batch.sparkSession
    rows = cached(batch)
    frames, tables = [rows], WorkTables(spark)
    try:
        if rows.isEmpty():
            return
        state = StateTables(spark, root, batch_id, merge_at=merge_at, buckets=buckets)
        if state.committed:
            return
        key = dq_config.get("unique_key")
        # The gate reads its input several times: the search among known keys runs once.
        seen = rows.withColumn("_seen", F.lit(False))
        if key:
            seen = cached(flag_seen_keys(rows, key, state))
            frames.append(seen)
        annotated = cached(annotate_dq(
            seen, dq_config, limits=limits, known_duplicate=F.col("_seen")).drop("_seen"))
        frames.append(annotated)
        clean, quarantined = split_dq(annotated)
        new = clean.select(*CORE_COLUMNS)
        since, dates = _clean_dates(new, state.buckets)
        derived, pool = derive_with_history(new, state, since, limits, search_late, tables)
        frames.append(pool)
        alerts = configured_alerts(score_derived(derived, rules_config), rules_config)
        stored = project_alerts(tag_run(alerts, run_id), flags=True)

        def put(table: str, frame: DataFrame) -> str:
            path = join_path(root, table, f"batch_id={batch_id}")
            frame.write.mode("overwrite").parquet(path)
            return path

        def put_alerts() -> None:
            written = spark.read.schema(stored.schema).parquet(put("alerts", stored))
            put("top", top_batch_alerts(written))
            put("counters", batch_counters(annotated, written, batch_id).drop("batch_id"))

        keys = rows.select((F.col(key) if key else F.lit(None)).cast("string").alias("key"))
        run_together(spark, [
            put_alerts, lambda: put("quarantine", quarantined),
            *state.record(new, dates, keys if key else keys.limit(0)),
        ])
        state.commit()
    finally:
        for frame in frames:
            frame.unpersist()
        tables.drop()


def start_stream(
    spark: SparkSession,
    landing: str,
    root: str,
    dq_config: Mapping[str, Any],
    rules_config: Mapping[str, Any],
    *,
    checkpoint: str | None = None,
    available_now: bool = False,
    capture: bool = False,
    max_files: int | None = FILES_PER_TRIGGER,
    trigger_seconds: int = TRIGGER_SECONDS,
    run_id: str = "stream",
    limits: SkewLimits = DEFAULT_LIMITS,
    merge_at: int = MERGE_AT,
    buckets: int = BUCKETS,
    search_late: bool = False,
) -> StreamingQuery:
    """Start the job over a landing directory.

    It runs every few seconds until stopped, or with ``available_now`` over what
    has landed and then ends. A restart continues from ``checkpoint``.
    """
    compile_rules(rules_config)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        process_batch(
            batch, batch_id, root, dq_config, rules_config,
            run_id=run_id, limits=limits, merge_at=merge_at, buckets=buckets,
            search_late=search_late,
        )

    feed = stream_feed(spark, landing, capture=capture, max_files=max_files)
    writer = (
        feed.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint or join_path(root, "checkpoint"))
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def read_output(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Alerts, quarantine or counters of all committed micro-batches, with their batch_id.

    Batches commit one after another, so those up to the newest manifest are whole.
    """
    newest = Commits(spark, root).ids()
    written = spark.read.parquet(join_path(root, table))
    return written.filter(F.col("batch_id") <= F.lit(newest[-1] if newest else -1))
