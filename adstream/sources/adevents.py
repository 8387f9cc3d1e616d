"""Ad events derived from a general ``events`` table.

The table has event_id, ts, user_id, event_type, value and props; views become
impressions, clicks stay clicks, purchases and signups become conversions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.schemas import CLICK, CONVERSION, IMPRESSION

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def _event_name(number: Column) -> Column:
    return F.concat(F.lit("E"), number)


def _user_name(number: Column) -> Column:
    """Numbers under five digits are padded; longer ones stay whole."""
    digits = number.cast("string")
    return F.concat(F.lit("U"), F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits))


def _common(events: DataFrame, kind: str) -> DataFrame:
    k = F.expr("try_cast(get_json_object(props, '$.k') AS INT)")
    number = F.col("event_id")
    return events.withColumn("k", k).withColumns(
        {
            "number": number,
            "event_id": _event_name(number),
            "event_type": F.lit(kind),
            "source_type": F.col("event_type"),
            "ip_address": F.concat(F.lit("10.0.0."), F.col("user_id") % 10 + 1),
            "user_id": _user_name(F.col("user_id")),
            "campaign_id": F.concat(F.lit("C"), F.lpad((F.col("k") % 50 + 1).cast("string"), 3, "0")),
            "impression_id": _event_name(number - 1 - F.col("k") % 3),
            "user_agent": F.lit(None).cast("string"),
            "geo_country": F.lit(None).cast("string"),
            "timestamp": F.col("ts"),
            "fraud_label": F.lit("normal"),
        }
    )


def impressions(events: DataFrame) -> DataFrame:
    views = events.filter(F.col("event_type") == "view")
    return _common(views, "impression").select(IMPRESSION.fieldNames())


def clicks(events: DataFrame) -> DataFrame:
    rows = _common(events.filter(F.col("event_type") == "click"), "click")
    delay = F.round(F.col("value") * 100).try_cast("int")
    return rows.withColumn("time_since_impression_ms", delay).select(CLICK.fieldNames())


def conversions(events: DataFrame) -> DataFrame:
    rows = _common(events.filter(F.col("event_type").isin("purchase", "signup")), "conversion")
    return rows.withColumns(
        {
            "click_id": _event_name(F.col("number") + F.col("k") % 9 - 4),
            "conversion_type": F.col("source_type"),
            "revenue_usd": F.col("value"),
        }
    ).select(CONVERSION.fieldNames())


def with_instants(rows: DataFrame) -> DataFrame:
    """Event times as instants, which watermarks and messages need."""
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def with_local_times(rows: DataFrame, *columns: str) -> DataFrame:
    """The reverse of ``with_instants``, for all timestamp columns named."""
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns or ("timestamp",)})
