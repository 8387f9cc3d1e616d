"""Roll-up of click flags into alerts per campaign and window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.functions.rules import flag_count, share
from adstream.schemas import GOLD_ALERT


def fraud_alerts(flagged_clicks: DataFrame, window: str = "1 minute") -> DataFrame:
    """Count clicks and flags per tumbling window and campaign.

    Clicks without a time are in no window. A count of flags is NULL when all the
    flags of the group are NULL, and the rate is NULL when no click has an id.
    """
    grouped = flagged_clicks.groupBy(F.window("timestamp", window), "campaign_id").agg(
        F.count("event_id").alias("total_clicks"),
        flag_count(F.col("is_fraud")).alias("fraud_clicks"),
        flag_count(F.col("is_click_flood")).alias("flood_clicks"),
        flag_count(F.col("is_bot_ip")).alias("bot_ip_clicks"),
        flag_count(F.col("is_instant_click")).alias("instant_clicks"),
    )
    return grouped.select(
        "*",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        share(F.col("fraud_clicks"), F.col("total_clicks"), 4).alias("fraud_rate"),
    ).select(GOLD_ALERT.fieldNames())
