"""Transaction monitoring on Spark: quality gate, history columns, fraud rules, alerts."""

from tidewatch.config import (
    DEFAULT_DQ, DEFAULT_RULES, load_config, with_malformed_check, with_params,
)
from tidewatch.functions.checks import register_check
from tidewatch.functions.rules import register_rule
from tidewatch.operators.features import amount_bins, derive, heavy_accounts
from tidewatch.operators.gate import annotate_dq, apply_dq, dq_summary, mark_duplicates, split_dq
from tidewatch.operators.reports import (
    alerts_by_band, alerts_by_rule, batch_counters, preview, ranked_alerts, reconcile,
    reconcile_gated, run_metrics, run_metrics_gated, run_summary, top_alerts, top_batch_alerts,
)
from tidewatch.operators.scoring import (
    alerts_only, configured_alerts, project_alerts, score, tag_run,
)
from tidewatch.operators.skew import SkewLimits
from tidewatch.plans.batch import BatchRun, run_batch
from tidewatch.plans.settings import session_settings
from tidewatch.schema import ALERT_COLUMNS, CORE_COLUMNS, FEED_SCHEMA
from tidewatch.sources.feed import (
    parse_iso_ts, parse_lines, read_feed, read_feed_parquet, rows_to_feed, stream_feed,
)
from tidewatch.sources.sinks import save_tables, write_metrics, write_outputs
from tidewatch.sources.work import cached
from tidewatch.streaming.keyed_state import start_keyed_stream
from tidewatch.streaming.micro_batch import process_batch, read_output, start_stream

__all__ = [name for name in dir() if not name.startswith("_")]
