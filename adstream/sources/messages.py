"""Message topics as streams or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adstream.operators.parse import parse_events

# The topic of each kind of event.
TOPICS = {
    "impressions": "ad-impressions",
    "clicks": "ad-clicks",
    "conversions": "ad-conversions",
}


def kafka_options(
    servers: str,
    topic: str,
    user: str | None = None,
    password: str | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source for one topic.

    Credentials, if given, are sent by SASL/PLAIN over TLS. ``starting_offsets``
    counts only until a checkpoint exists. A limit per trigger keeps the first
    batches of a long backlog small.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if user is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{password}";',
        }
    return options


def read_messages(
    spark: SparkSession,
    source_format: str,
    options: dict[str, str],
    streaming: bool = True,
) -> DataFrame:
    """Unparsed messages from any source that has a ``value`` column.

    Files of messages need no connector: Parquet with a binary ``value``, or text
    with one message per line. A stream passes over files that expire before it reads them; for a
    table a missing file is an error.
    """
    reader = (spark.readStream if streaming else spark.read).format(source_format)
    if streaming and source_format in ("parquet", "text"):
        reader = reader.option("ignoreMissingFiles", "true")
    if source_format == "parquet":
        reader = reader.schema("value BINARY")
    return reader.options(**options).load().select("value")


def read_events(
    spark: SparkSession,
    source_format: str,
    options: dict[str, str],
    schema: StructType,
    watermark: str | None = "10 minutes",
    keep_raw: bool = False,
) -> DataFrame:
    """A stream of parsed events of one topic, with a watermark on their time."""
    messages = read_messages(spark, source_format, options)
    return parse_events(messages, schema, watermark, keep_raw)
