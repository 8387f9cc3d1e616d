"""Ad-event fraud analytics on Spark DataFrames, batch and streaming."""

from adstream.config import FraudRules, LookupLimits, TablePaths
from adstream.operators.alerts import fraud_alerts
from adstream.operators.clicks import flag_clicks, flag_clicks_windowed
from adstream.operators.conversions import flag_orphans, orphan_conversions
from adstream.operators.dedupe import dedupe_events
from adstream.operators.parse import encode_events, parse_events
from adstream.operators.sliding import flag_clicks_sliding
from adstream.session import build_session
from adstream.streaming.runner import run_pipeline

__all__ = [
    "FraudRules",
    "LookupLimits",
    "TablePaths",
    "build_session",
    "dedupe_events",
    "encode_events",
    "flag_clicks",
    "flag_clicks_sliding",
    "flag_clicks_windowed",
    "flag_orphans",
    "fraud_alerts",
    "orphan_conversions",
    "parse_events",
    "run_pipeline",
]
