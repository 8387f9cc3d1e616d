"""How changes of alerts are merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.functions.rules import share
from adstream.schemas import GOLD_ALERT
from adstream.sources.mergelog import Newest, Sums, read_merged

_KEYS = ("campaign_id", "window_start", "window_end")
_RATE = "fraud_rate"
NEWEST_ALERT = Newest(_KEYS, tuple(c for c in GOLD_ALERT.fieldNames() if c not in _KEYS), "window_start")
SUMMED_ALERT = Sums(_KEYS, tuple(c for c in NEWEST_ALERT.values if c != _RATE), "window_start")


def read_newest_alerts(spark: SparkSession, path: str) -> DataFrame:
    return read_merged(spark, path, GOLD_ALERT, NEWEST_ALERT).select(GOLD_ALERT.fieldNames())


def read_summed_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Counts as added up so far, and the rates they give."""
    counts = read_merged(spark, path, GOLD_ALERT, SUMMED_ALERT)
    rate = share(F.col("fraud_clicks"), F.col("total_clicks"), 4)
    return counts.withColumn(_RATE, rate).select(GOLD_ALERT.fieldNames())
