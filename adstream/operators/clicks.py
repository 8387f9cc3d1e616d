"""Click rules: flooding users, addresses that hit many campaigns, instant clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.config import FraudRules
from adstream.functions.eventtime import with_window_start
from adstream.functions.rules import any_flag, instant_click, over_limit
from adstream.operators.lookups import Grouping, mark_rows
from adstream.schemas import SILVER_CLICK


def clicks_per_user(clicks: DataFrame, *scope: str) -> DataFrame:
    """Clicks with an id per user, within the scope columns if given."""
    return clicks.groupBy(*scope, "user_id").agg(
        F.count("event_id").alias("click_count"), F.count(F.lit(1)).alias("n_rows")
    )


def campaigns_per_address(clicks: DataFrame, *scope: str) -> DataFrame:
    """Exact number of distinct campaigns per address, within the scope columns."""
    return clicks.groupBy(*scope, "ip_address").agg(
        F.count_distinct("campaign_id").alias("distinct_campaigns"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _flag(
    clicks: DataFrame, rules: FraudRules, *scope: str, workspace: str | None = None
) -> DataFrame:
    users = clicks_per_user(clicks, *scope).withColumn(
        "flagged", over_limit(F.col("click_count"), rules.flood_clicks)
    )
    addresses = campaigns_per_address(clicks, *scope).withColumn(
        "flagged", over_limit(F.col("distinct_campaigns"), rules.bot_campaigns)
    )
    marked = mark_rows(
        clicks,
        [
            Grouping("is_click_flood", (*scope, "user_id"), users),
            Grouping("is_bot_ip", (*scope, "ip_address"), addresses),
        ],
        rules.limits,
        workspace,
    )
    return finish_click_flags(marked, rules)


def finish_click_flags(marked: DataFrame, rules: FraudRules) -> DataFrame:
    """Add the row-local flag and the overall flag, in the silver column order."""
    instant = instant_click(F.col("time_since_impression_ms"), rules.instant_ms)
    flagged = marked.withColumn("is_instant_click", instant)
    return flagged.withColumn(
        "is_fraud", any_flag(F.col("is_click_flood"), F.col("is_bot_ip"), F.col("is_instant_click"))
    ).select(SILVER_CLICK.fieldNames())


def flag_clicks(
    clicks: DataFrame, rules: FraudRules = FraudRules(), workspace: str | None = None
) -> DataFrame:
    """Flag the clicks of one bounded frame, such as a table or a micro-batch.

    The whole frame is the scope of the two counting rules. Their verdicts are kept
    in the ``workspace`` folder (see ``mark_rows``) while the result is in use.
    """
    if clicks.isStreaming:
        raise ValueError("the scope of flag_clicks is a bounded frame; use it in foreachBatch")
    return _flag(clicks, rules, workspace=workspace)


def flag_clicks_windowed(clicks: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """Flag each click by the counts of its own tumbling event-time window.

    Takes tables and streams; a stream must carry a watermark on ``timestamp``.
    A click without a time has no window, so its counting flags are NULL.
    """
    if clicks.isStreaming:
        from adstream.streaming.clicks import flag_click_stream

        return flag_click_stream(clicks, rules)
    return _flag(with_window_start(clicks, "_window", rules.click_window), rules, "_window")
