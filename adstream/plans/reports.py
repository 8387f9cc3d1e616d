"""Reports over the layered tables.

Each returns a DataFrame for the caller to show or save. Samples are ordered, so
that they are the same in every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.config import TablePaths
from adstream.functions.rules import percentage
from adstream.schemas import CLICK, SILVER_CLICK, SILVER_CONVERSION
from adstream.sources import tables


def click_sample(clicks: DataFrame, n: int = 5) -> DataFrame:
    """The first clicks by time."""
    return clicks.orderBy("timestamp", "event_id").limit(n)


def fraud_totals(flagged_clicks: DataFrame) -> DataFrame:
    """One row: clicks, fraudulent clicks and their percentage, in one pass."""
    return flagged_clicks.agg(
        F.count(F.lit(1)).alias("total_clicks"), F.count_if("is_fraud").alias("fraud_clicks")
    ).withColumn("fraud_pct", percentage(F.col("fraud_clicks"), F.col("total_clicks")))


def fraud_click_sample(flagged_clicks: DataFrame, n: int = 10) -> DataFrame:
    """The first fraudulent clicks by time."""
    return click_sample(flagged_clicks.filter("is_fraud"), n)


def top_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Campaign windows with the highest fraud rate; unknown rates come last."""
    worst_first = F.col("fraud_rate").desc_nulls_last()
    return alerts.orderBy(worst_first, "window_start", "campaign_id").limit(n)


def orphan_report(flagged_conversions: DataFrame, n: int = 10) -> DataFrame:
    """The first orphan conversions by time."""
    orphans = flagged_conversions.filter("is_orphan_conversion")
    return (
        orphans.orderBy("timestamp", "event_id")
        .limit(n)
        .select("event_id", "click_id", "campaign_id", "revenue_usd", "is_orphan_conversion")
    )


def all_reports(
    spark: SparkSession, paths: TablePaths, alert_mode: str = "merge", table_format: str = "parquet"
) -> dict[str, DataFrame]:
    """Every report over the tables that the application wrote, by title."""
    bronze = tables.read_table(spark, paths.bronze("clicks"), CLICK, table_format)
    silver = tables.read_table(spark, paths.silver("clicks"), SILVER_CLICK, table_format)
    flagged = tables.read_table(spark, paths.silver("conversions"), SILVER_CONVERSION, table_format)
    alerts = tables.read_alerts(spark, paths.gold(), alert_mode, table_format)
    return {
        "Bronze: first clicks": click_sample(bronze),
        "Silver: share of fraudulent clicks": fraud_totals(silver),
        "Silver: first fraudulent clicks": fraud_click_sample(silver),
        "Gold: campaign windows with the highest fraud rate": top_alerts(alerts),
        "Silver: first orphan conversions": orphan_report(flagged),
    }
