"""Schemas of the messages and of the layered tables."""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# A column has the same type in every table; those not listed are strings.
_TYPES: dict[str, DataType] = {
    "time_since_impression_ms": IntegerType(),
    "revenue_usd": DoubleType(),
    "fraud_rate": DoubleType(),
    **dict.fromkeys(["timestamp", "window_start", "window_end"], TimestampType()),
    **dict.fromkeys(
        ["is_click_flood", "is_bot_ip", "is_instant_click", "is_orphan_conversion", "is_fraud"],
        BooleanType(),
    ),
    **dict.fromkeys(
        ["total_clicks", "fraud_clicks", "flood_clicks", "bot_ip_clicks", "instant_clicks"],
        LongType(),
    ),
}


def _table(columns: str, required: str = "") -> StructType:
    return StructType(
        [StructField(c, _TYPES.get(c, StringType()), c != required) for c in columns.split()]
    )


# Column names and order of the published event and table formats.
IMPRESSION = _table(
    "event_id event_type user_id campaign_id ip_address user_agent geo_country timestamp fraud_label",
    required="event_id",
)
CLICK = _table(
    "event_id event_type impression_id user_id campaign_id ip_address user_agent "
    "time_since_impression_ms timestamp fraud_label",
    required="event_id",
)
CONVERSION = _table(
    "event_id event_type click_id impression_id user_id campaign_id conversion_type revenue_usd "
    "timestamp fraud_label",
    required="event_id",
)
SILVER_CLICK = _table(
    "event_id impression_id user_id campaign_id ip_address user_agent time_since_impression_ms "
    "timestamp fraud_label is_click_flood is_bot_ip is_instant_click is_fraud",
    required="event_id",
)
SILVER_CONVERSION = _table(
    "event_id click_id impression_id user_id campaign_id conversion_type revenue_usd timestamp "
    "fraud_label is_orphan_conversion is_fraud"
)
GOLD_ALERT = _table(
    "campaign_id window_start window_end total_clicks fraud_clicks fraud_rate flood_clicks "
    "bot_ip_clicks instant_clicks"
)

MESSAGES = {"impressions": IMPRESSION, "clicks": CLICK, "conversions": CONVERSION}
