"""Event-time arithmetic that works on TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType


def duration(text: str) -> Column:
    """An interval literal such as ``30 minutes``."""
    return F.expr(f"INTERVAL {text}")


def with_window_start(df: DataFrame, name: str, length: str, time: str = "timestamp") -> DataFrame:
    """Add the start of the tumbling window of each row, NULL if it has no time.

    A bare ``window`` would drop rows without a time; the default given here is
    never seen in the result.
    """
    time_type = df.schema[time].dataType
    filled = F.coalesce(F.col(time), F.lit("1970-01-01 00:00:00").cast(time_type))
    start = F.window(filled, length)["start"]
    return df.withColumn(name, F.when(F.col(time).isNotNull(), start))


def day_number(time: Column, time_type: DataType) -> Column:
    """Days since 1970-01-01 in UTC, independent of the session time zone."""
    if isinstance(time_type, TimestampNTZType):
        return F.unix_date(time.cast("date"))
    return F.floor(F.unix_seconds(time) / F.lit(86_400)).cast("int")
