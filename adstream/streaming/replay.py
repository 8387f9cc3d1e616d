"""Running stored events through the streaming operators to their end.

A stream holds back what a later event could still change. To get the result for
the whole table, two events of a far future follow it: one moves the watermark
past all others, and one makes the next batch act on that. They are told from the
others by their ids, and their alerts by a campaign of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adstream.operators.parse import encode_events, parse_events
from adstream.schemas import MESSAGES
from adstream.session import scratch_path
from adstream.sources import adevents

TO_THE_END = {"availableNow": True}
_LATER = "9999-01-01 00:00:00"
_CLOSING_IDS = {n: -9_000_000_000_000_000_000 - n for n in (1, 2)}
_CLOSING_CAMPAIGN = "closing"
_CLOSING = (
    "SELECT CAST({id} AS BIGINT) AS event_id, TIMESTAMP_NTZ'{later}' + INTERVAL {n} DAYS AS ts, "
    "CAST(0 AS BIGINT) AS user_id, kind AS event_type, CAST(0 AS DOUBLE) AS value, "
    "'{{\"k\": 0}}' AS props FROM VALUES ('click'), ('purchase') AS kinds (kind)"
)
_DERIVE = {
    "impressions": adevents.impressions,
    "clicks": adevents.clicks,
    "conversions": adevents.conversions,
}


def event_stream(spark: SparkSession, sf_dir: str, closing: str) -> DataFrame:
    """The stored events as one micro-batch, then the closing events one by one.

    The braces make the path a pattern, which may name a file as well as a directory.
    """
    stored = spark.readStream.schema(adevents.EVENTS_DDL).parquet(f"{sf_dir}/{{events.parquet}}")
    end = spark.readStream.schema(adevents.EVENTS_DDL).option("maxFilesPerTrigger", 1).parquet(closing)
    return stored.unionByName(end)


def write_closing_events(spark: SparkSession, path: str) -> str:
    for n, number in _CLOSING_IDS.items():
        spark.sql(_CLOSING.format(n=n, id=number, later=_LATER)).coalesce(1).write.mode("append").parquet(path)
    return path


def topic_events(spark: SparkSession, sf_dir: str, topic: str, closing: str) -> DataFrame:
    """One topic of the event stream, before it is encoded."""
    events = adevents.with_instants(_DERIVE[topic](event_stream(spark, sf_dir, closing)))
    campaign = F.when(_is_closing(), F.lit(_CLOSING_CAMPAIGN)).otherwise(F.col("campaign_id"))
    return events.withColumn("campaign_id", campaign)


def topic_stream(
    spark: SparkSession, sf_dir: str, topic: str, closing: str, watermark: str = "10 minutes"
) -> DataFrame:
    """One topic of the event stream, encoded to messages and parsed again."""
    messages = encode_events(topic_events(spark, sf_dir, topic, closing))
    return parse_events(messages, MESSAGES[topic], watermark)


def _is_closing() -> Column:
    return F.coalesce(F.col("event_id").isin([f"E{number}" for number in _CLOSING_IDS.values()]), F.lit(False))


def without_closing(rows: DataFrame) -> DataFrame:
    return rows.filter(~_is_closing())


def alerts_without_closing(alerts: DataFrame) -> DataFrame:
    return alerts.filter(~F.col("campaign_id").eqNullSafe(F.lit(_CLOSING_CAMPAIGN)))


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Let queries started inside have one state partition per core of the cluster.

    The number is fixed by the first batch of a checkpoint, so it follows the
    cluster rather than the default for batch shuffles.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def replay_in_phases(
    spark: SparkSession, name: str, phases: list[DataFrame], run: Callable[[DataFrame, str], None]
) -> str:
    """Add stored events to a feed, phase by phase, and run queries to their end after each.

    Every phase is a restart: ``run`` gets the stream of the feed and the folder below which its
    tables and checkpoints are, and starts its queries anew. The closing events come
    last, or where ``phases`` has None; the batch without data that follows theirs acts on them. Returns the folder.
    """
    root = scratch_path(spark, name)
    first, second = (spark.sql(_CLOSING.format(n=n, id=number, later=_LATER)) for n, number in _CLOSING_IDS.items())
    for phase in phases if None in phases else [*phases, None]:
        step = first.unionByName(second).coalesce(1) if phase is None else phase
        step.write.mode("append").parquet(f"{root}/feed")
        with state_partitions(spark):
            run(spark.readStream.schema(adevents.EVENTS_DDL).parquet(f"{root}/feed"), root)
    return root


def replay(
    spark: SparkSession, start: Callable[[str, str, str], StreamingQuery], name: str
) -> str:
    """Start a query on fresh paths, wait for its end and return the table's path.

    ``start`` gets the path of the closing events, of the table and of the checkpoint.
    """
    root = scratch_path(spark, name)
    closing = write_closing_events(spark, f"{root}/closing")
    with state_partitions(spark):
        query = start(closing, f"{root}/table", f"{root}/checkpoint")
    query.awaitTermination()
    return f"{root}/table"
