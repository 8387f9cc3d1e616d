"""Click flags by sliding windows, made of panes that all windows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.config import FraudRules
from adstream.functions.rules import over_limit
from adstream.operators.clicks import finish_click_flags
from adstream.operators.lookups import Grouping, mark_rows


def _pane(seconds: int) -> Column:
    """The number of the pane of a row, NULL if it has no time."""
    return F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / seconds)


def _ahead(value: str, key: str, panes: int) -> Column:
    """The largest value among the panes from this one on that a window with it can end in."""
    later = Window.partitionBy(key).orderBy("_pane").rangeBetween(0, panes - 1)
    return F.max(value).over(later)


def sliding_user_counts(clicks: DataFrame, pane_seconds: int, panes: int) -> DataFrame:
    """Per user and pane, the clicks of the fullest window that has the pane in it.

    Clicks are counted per pane once, before anything moves, and windows are sums of panes.
    Only windows that end in a pane with clicks matter, as any other holds no more than the one
    that ends in its last such pane.
    """
    counted = (
        clicks.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", _pane(pane_seconds).alias("_pane"))
        .agg(F.count("event_id").alias("n"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("_pane").isNotNull())
    )
    back = Window.partitionBy("user_id").orderBy("_pane").rangeBetween(-(panes - 1), 0)
    sums = counted.withColumn("_sum", F.sum("n").over(back))
    return sums.select("user_id", "_pane", "n_rows", _ahead("_sum", "user_id", panes).alias("click_count"))


def sliding_campaign_counts(clicks: DataFrame, pane_seconds: int, panes: int) -> DataFrame:
    """Per address and pane, the most distinct campaigns of a window that has the pane in it, exactly.

    A campaign seen in a pane is in the windows that end there or up to ``panes - 1`` later; of
    these it adds one to those that its sight before did not reach. So each (address, campaign, pane) is a
    step up and a step down, added up per address and pane, and a running sum of steps is the count.
    """
    seen = (
        clicks.filter(F.col("ip_address").isNotNull())
        .groupBy("ip_address", "campaign_id", _pane(pane_seconds).alias("_pane"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("_pane").isNotNull())
    )
    known = seen.filter(F.col("campaign_id").isNotNull())
    before = F.lag("_pane").over(Window.partitionBy("ip_address", "campaign_id").orderBy("_pane"))
    reach = known.withColumn("_from", F.greatest("_pane", F.coalesce(before + panes, F.col("_pane"))))
    steps = F.explode(
        F.array(
            F.struct(F.col("_from").alias("_pane"), F.lit(1).alias("step")),
            F.struct((F.col("_pane") + panes).alias("_pane"), F.lit(-1).alias("step")),
        )
    ).alias("s")
    changes = reach.select("ip_address", steps).select(
        "ip_address", "s._pane", "s.step", F.lit(None).cast("long").alias("n_rows")
    )
    there = seen.select("ip_address", "_pane", F.lit(0).alias("step"), "n_rows")
    per_pane = changes.unionByName(there).groupBy("ip_address", "_pane")
    per_pane = per_pane.agg(F.sum("step").alias("step"), F.sum("n_rows").alias("n_rows"))
    so_far = Window.partitionBy("ip_address").orderBy("_pane").rowsBetween(Window.unboundedPreceding, 0)
    counts = per_pane.withColumn("_now", F.sum("step").over(so_far)).filter("n_rows IS NOT NULL")
    return counts.select(
        "ip_address", "_pane", "n_rows", _ahead("_now", "ip_address", panes).alias("distinct_campaigns")
    )


def flag_clicks_sliding(
    clicks: DataFrame, rules: FraudRules = FraudRules(), window_seconds: int = 600, pane_seconds: int = 60
) -> DataFrame:
    """Flag each click of a table that is in any window over a limit, wherever the window begins.

    Windows begin at every pane, so a burst over the edge of a tumbling window is caught. Rows are
    not copied into the windows they are in. A click without a time has no window: its counting
    flags are NULL. Tables only.
    """
    if clicks.isStreaming:
        raise ValueError("sliding windows of a stream would need all panes ahead; use flag_clicks_windowed")
    if window_seconds % pane_seconds:
        raise ValueError("a window is made of whole panes")
    panes = window_seconds // pane_seconds
    users = sliding_user_counts(clicks, pane_seconds, panes).withColumn(
        "flagged", over_limit(F.col("click_count"), rules.flood_clicks)
    )
    addresses = sliding_campaign_counts(clicks, pane_seconds, panes).withColumn(
        "flagged", over_limit(F.col("distinct_campaigns"), rules.bot_campaigns)
    )
    groupings = [
        Grouping("is_click_flood", ("_pane", "user_id"), users),
        Grouping("is_bot_ip", ("_pane", "ip_address"), addresses),
    ]
    marked = mark_rows(clicks.withColumn("_pane", _pane(pane_seconds)), groupings, rules.limits)
    return finish_click_flags(marked, rules)
