"""Click flags on a stream, by tumbling window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.config import FraudRules
from adstream.functions.rules import over_limit
from adstream.operators.clicks import finish_click_flags


def flag_click_stream(clicks: DataFrame, rules: FraudRules) -> DataFrame:
    """Flag each click once the watermark has closed its window.

    Window aggregates find the flagged users and addresses, and the clicks are
    joined to them. Window and key are join keys on both sides, so the watermark
    clears all state. A stream has no exact distinct count; it is made of two
    counts, first one row per campaign, then the number of those rows. Clicks are
    spread over ``stream_salts`` cells per key, and only flagged keys, which are few,
    are repeated for each cell; no group of clicks is ever collected.
    """
    window = F.window("timestamp", rules.click_window)
    cell = F.pmod(F.xxhash64("event_id", F.spark_partition_id()), F.lit(rules.stream_salts))
    # The window is the event time of the rows, and there may be only one: the
    # click's own time travels as a plain number.
    rows = clicks.select(
        "*",
        window.alias("_window"),
        cell.cast("int").alias("_cell"),
        F.unix_micros("timestamp").alias("_micros"),
    ).drop("timestamp")

    users = (
        clicks.filter(F.col("user_id").isNotNull())
        .groupBy(window.alias("_window"), "user_id")
        .agg(F.count("event_id").alias("n"))
        .filter(over_limit(F.col("n"), rules.flood_clicks))
    )
    campaigns = (
        clicks.filter(F.col("ip_address").isNotNull() & F.col("campaign_id").isNotNull())
        .groupBy(window.alias("_window"), "ip_address", "campaign_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    addresses = (
        campaigns.groupBy("_window", "ip_address")
        .agg(F.count("campaign_id").alias("n"))
        .filter(over_limit(F.col("n"), rules.bot_campaigns))
    )

    marked = _mark(rows, users, "user_id", "is_click_flood", rules.stream_salts)
    marked = _mark(marked, addresses, "ip_address", "is_bot_ip", rules.stream_salts)
    windowed = marked.withColumn("timestamp", F.timestamp_micros("_micros"))

    unknown = F.lit(None).cast("boolean")
    timeless = clicks.filter(F.col("timestamp").isNull()).withColumns(
        {"is_click_flood": unknown, "is_bot_ip": unknown}
    )
    return finish_click_flags(windowed, rules).unionByName(finish_click_flags(timeless, rules))


def _mark(rows: DataFrame, flagged: DataFrame, key: str, flag: str, salts: int) -> DataFrame:
    every_cell = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    hits = flagged.select(
        F.col("_window").alias("_hit_window"),
        F.col(key).alias("_hit_key"),
        every_cell.alias("_hit_cell"),
        F.lit(True).alias("_hit"),
    )
    same: Column = (
        (F.col("_window") == F.col("_hit_window"))
        & (F.col(key) == F.col("_hit_key"))
        & (F.col("_cell") == F.col("_hit_cell"))
    )
    verdict = F.when(F.col(key).isNotNull(), F.coalesce("_hit", F.lit(False)))
    return rows.join(hits, same, "left").select(*rows.columns, verdict.alias(flag))
