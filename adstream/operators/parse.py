"""Messages to typed rows and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed value: ISO-8601 with microseconds and a UTC offset.
MESSAGE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def parse_events(
    messages: DataFrame,
    schema: StructType,
    watermark: str | None = None,
    keep_raw: bool = False,
) -> DataFrame:
    """Parse JSON messages in the binary or string column ``value``.

    Parsing is permissive: a field that does not fit its type is NULL, and a
    payload that is no JSON object becomes a row of NULLs that stays in the data.
    With ``keep_raw`` the original text follows the parsed columns as ``raw``.
    """
    text = F.col("value").cast("string")
    columns = [F.from_json(text, schema).alias("event")]
    if keep_raw:
        columns.append(text.alias("raw"))
    rows = messages.select(columns).select("event.*", *(["raw"] if keep_raw else []))
    return rows.withWatermark("timestamp", watermark) if watermark else rows


def encode_events(events: DataFrame) -> DataFrame:
    """One UTF-8 JSON message per row, in the binary column ``value``."""
    body = F.to_json(F.struct("*"), {"timestampFormat": MESSAGE_TIME})
    return events.select(body.cast("binary").alias("value"))
