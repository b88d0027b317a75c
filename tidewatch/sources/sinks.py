"""Writing results: Parquet folders, catalog tables, the metrics file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.operators.scoring import project_alerts
from tidewatch.sources.work import join_path, write_text

# Names of the output folders, catalog tables and the metrics document.
OUTPUT_FOLDERS = {"alerts": "alerts", "quarantine": "quarantine", "summary": "dq_summary"}
TABLE_NAMES = {
    "alerts": "fraud_alerts", "quarantine": "fraud_quarantine", "summary": "fraud_dq_summary",
}
METRICS_FILE = "run_metrics.json"


def write_outputs(
    base: str, alerts: DataFrame, quarantined: DataFrame, summary: DataFrame
) -> dict[str, str]:
    """Overwrite the three Parquet outputs below ``base``; returns their paths.

    Alerts and quarantined rows are a small part of each task's rows, so they are
    rebalanced into files of a sensible size instead of one sliver per task.
    """
    frames = {
        "alerts": project_alerts(alerts, flags=True).hint("rebalance"),
        "quarantine": quarantined.hint("rebalance"),
        "summary": summary,
    }
    paths = {name: join_path(base, folder) for name, folder in OUTPUT_FOLDERS.items()}
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(paths[name])
    return paths


def save_tables(
    namespace: str, alerts: DataFrame, quarantined: DataFrame, summary: DataFrame,
    *, fmt: str = "parquet",
) -> list[str]:
    """Overwrite the outputs as catalog tables ``<namespace>.<name>`` of format ``fmt``."""
    frames = {"alerts": alerts, "quarantine": quarantined, "summary": summary}
    names = []
    for kind, frame in frames.items():
        name = f"{namespace}.{TABLE_NAMES[kind]}"
        frame.write.format(fmt).mode("overwrite").saveAsTable(name)
        names.append(name)
    return names


def write_metrics(base: str, metrics: DataFrame) -> str:
    """Write the one-row metrics frame as one JSON document next to the outputs."""
    path = join_path(base, METRICS_FILE)
    write_text(metrics.sparkSession, path, metrics.toJSON().first() + "\n")
    return path
