"""The batch run: land, gate, score, reconcile, write."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidewatch.functions.rules import compile_rules
from tidewatch.operators.features import amount_bins, heavy_accounts
from tidewatch.operators.gate import annotate_dq, dq_summary, split_dq
from tidewatch.operators.reports import run_metrics
from tidewatch.operators.scoring import configured_alerts, score, tag_run
from tidewatch.operators.skew import DEFAULT_LIMITS, SkewLimits
from tidewatch.sources.feed import read_feed, require_utc
from tidewatch.sources.sinks import write_metrics, write_outputs
from tidewatch.sources.work import WorkTables


@dataclass(frozen=True)
class BatchRun:
    """Frames read back from a finished run's outputs."""

    run_id: str
    alerts: DataFrame
    quarantined: DataFrame
    summary: DataFrame
    metrics: DataFrame


def run_batch(
    spark: SparkSession,
    landing: str,
    out: str,
    dq_config: Mapping[str, Any],
    rules_config: Mapping[str, Any],
    *,
    run_id: str | None = None,
    capture: bool = False,
    limits: SkewLimits = DEFAULT_LIMITS,
) -> BatchRun:
    """Process a JSON-lines directory into alerts, quarantine, summary and metrics.

    Two work tables below ``spark.checkpoint.dir`` keep every later step a read
    of columns: the landed feed, so JSON is parsed once, and the gated feed,
    partitioned by verdict. They are removed when the run ends, also by a failure.
    """
    require_utc(spark)
    compile_rules(rules_config)
    run_id = run_id or uuid.uuid4().hex[:8]
    work = WorkTables(spark)

    try:
        source = work.write(read_feed(spark, landing, capture=capture), "landed")
        annotated = annotate_dq(source, dq_config, limits=limits)
        clean, quarantined = split_dq(work.write(annotated, "gated", "dq_passed"))

        scored = score(clean, rules_config, heavy=heavy_accounts(source, limits),
                       bins=amount_bins(source), tables=work)
        alerts = tag_run(configured_alerts(scored, rules_config), run_id)
        paths = write_outputs(out, alerts, quarantined, dq_summary(quarantined))

        stored = {name: spark.read.parquet(path) for name, path in paths.items()}
        metrics = run_metrics(source, clean, stored["quarantine"], stored["alerts"], run_id)
        metrics_path = write_metrics(out, metrics)
    finally:
        work.drop()
    return BatchRun(
        run_id=run_id,
        alerts=stored["alerts"],
        quarantined=stored["quarantine"],
        summary=stored["summary"],
        metrics=spark.read.schema(metrics.schema).json(metrics_path),
    )
