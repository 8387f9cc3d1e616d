"""The whole application: three topics to bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adstream.config import FraudRules, TablePaths
from adstream.operators.alerts import fraud_alerts
from adstream.operators.clicks import flag_clicks_windowed
from adstream.operators.conversions import flag_orphans
from adstream.operators.dedupe import dedupe_events
from adstream.schemas import MESSAGES, SILVER_CLICK, SILVER_CONVERSION
from adstream.sources import dated, tables
from adstream.sources.messages import read_events
from adstream.streaming.deferred import DeferredPaths, start_deferred_flags
from adstream.streaming.sinks import (
    ALERT_TRIGGER,
    EVENT_TRIGGER,
    Trigger,
    start_alerts,
    start_append,
    start_click_flags,
    start_dated,
    start_merged_alerts,
)

CLICK_SCOPES = ("deferred", "window", "batch")


def run_pipeline(
    spark: SparkSession,
    source_format: str,
    source_options: dict[str, dict[str, str]],
    paths: TablePaths,
    rules: FraudRules = FraudRules(),
    click_scope: str | None = None,
    alert_mode: str | None = None,
    from_bronze: bool = True,
    keep_raw: bool = False,
    dedupe: bool = False,
    trigger: Trigger | None = None,
    table_format: str = "parquet",
    max_files_per_trigger: int = tables.MAX_FILES_PER_TRIGGER,
) -> dict[str, StreamingQuery]:
    """Start the six queries and return them by the name of their table.

    ``source_options`` has the reader's options for each of ``impressions``,
    ``clicks`` and ``conversions``. ``click_scope`` is ``deferred`` (counts per event-time
    window; no click is lost, and none is in the state), ``window`` (the same counts by a join in
    the state, which late clicks miss) or ``batch`` (counts per micro-batch). The first needs Parquet
    tables and ``from_bronze``, and is the default where it can be had, else ``window``. ``alert_mode``
    is one of ``start_alerts`` or ``merge`` (see ``start_merged_alerts``), the default for Parquet tables, else
    ``complete``. With ``from_bronze``
    the silver queries follow the bronze tables, so each topic is read and parsed
    once; otherwise every query reads its topics itself, which is sooner but more.
    ``dedupe`` removes repeated events on the way to silver; bronze keeps all it was
    sent. ``max_files_per_trigger`` paces the layers that follow a table.
    A ``trigger`` that ends by itself, such as ``{"availableNow": True}``, runs the
    layers one after the other and returns when all is written.
    """
    parquet = table_format == "parquet"
    if click_scope is None:
        click_scope = "deferred" if parquet and from_bronze else "window"
    if alert_mode is None:
        alert_mode = "merge" if parquet else "complete"
    if click_scope not in CLICK_SCOPES:
        raise ValueError(f"unknown click scope {click_scope}")
    deferred = click_scope == "deferred"
    if deferred and not (parquet and from_bronze):
        raise ValueError("deferred flags read clicks from a Parquet bronze table")
    bounded = bool(trigger) and "processingTime" not in trigger
    event_trigger, alert_trigger = trigger or EVENT_TRIGGER, trigger or ALERT_TRIGGER

    def parsed(topic: str) -> DataFrame:
        options = source_options[topic]
        return read_events(spark, source_format, options, MESSAGES[topic], rules.watermark, keep_raw)

    def silver_input(topic: str, reader: str) -> DataFrame:
        if deferred and topic == "clicks":
            bronze = dated.follow_dated(
                spark, paths.bronze(topic), MESSAGES[topic], reader, max_files_per_trigger
            )
            events = bronze.withWatermark("timestamp", rules.watermark)
        elif from_bronze:
            bronze = tables.read_table(
                spark, paths.bronze(topic), MESSAGES[topic], table_format, True, max_files_per_trigger
            )
            events = bronze.withWatermark("timestamp", rules.watermark)
        else:
            events = parsed(topic)
        return dedupe_events(events) if dedupe else events

    queries: dict[str, StreamingQuery] = {}

    def started(layer: dict[str, StreamingQuery]) -> None:
        queries.update(layer)
        if bounded:
            await_all(layer.values())

    for topic, schema in MESSAGES.items():
        tables.create_if_absent(spark, paths.bronze(topic), schema, table_format)
    tables.create_if_absent(spark, paths.silver("clicks"), SILVER_CLICK, table_format)
    tables.create_if_absent(spark, paths.silver("conversions"), SILVER_CONVERSION, table_format)

    def append(stream: DataFrame, layer: str, table: str, path: str) -> StreamingQuery:
        return start_append(
            stream, path, paths.checkpoint(layer, table), f"{layer}_{table}", event_trigger, table_format
        )

    def bronze(topic: str) -> StreamingQuery:
        if not (deferred and topic == "clicks"):
            return append(parsed(topic), "bronze", topic, paths.bronze(topic))
        checkpoint = paths.checkpoint("bronze", topic)
        return start_dated(parsed(topic), paths.bronze(topic), checkpoint, f"bronze_{topic}", event_trigger)

    started({f"bronze_{t}": bronze(t) for t in MESSAGES})

    orphan_reader = paths.checkpoint("silver", "conversions")
    clicks, conversions = silver_input("clicks", orphan_reader), silver_input("conversions", orphan_reader)
    if deferred:
        source = paths.bronze("clicks")
        if dedupe:
            # Once more a table, without copies, as clicks are read from it again.
            source, checkpoint = f"{paths.root}/unique/clicks", paths.checkpoint("unique", "clicks")
            unique = silver_input("clicks", checkpoint)
            started({"unique_clicks": start_dated(unique, source, checkpoint, "unique_clicks", event_trigger)})
        places = DeferredPaths(
            source,
            paths.silver("clicks"),
            f"{paths.root}/verdicts/clicks",
            f"{paths.root}/ledger/clicks",
            paths.checkpoint("silver", "clicks"),
        )
        click_query = start_deferred_flags(spark, places, rules, "silver_clicks", event_trigger, max_files_per_trigger)
    elif click_scope == "window":
        flagged = flag_clicks_windowed(clicks, rules)
        click_query = append(flagged, "silver", "clicks", paths.silver("clicks"))
    else:
        click_query = start_click_flags(
            clicks,
            paths.silver("clicks"),
            paths.checkpoint("silver", "clicks"),
            rules,
            "silver_clicks",
            event_trigger,
            table_format,
        )
    orphans = flag_orphans(conversions, clicks, rules)
    started(
        {
            "silver_clicks": click_query,
            "silver_conversions": append(orphans, "silver", "conversions", paths.silver("conversions")),
        }
    )

    silver = tables.read_table(
        spark, paths.silver("clicks"), SILVER_CLICK, table_format, True, max_files_per_trigger
    )
    place, checkpoint = paths.gold(), paths.checkpoint("gold", "fraud_alerts")
    if alert_mode == "merge":
        gold = start_merged_alerts(
            silver, place, checkpoint, rules.alert_window, "gold_fraud_alerts", alert_trigger
        )
    else:
        alerts = fraud_alerts(silver.withWatermark("timestamp", rules.watermark), rules.alert_window)
        gold = start_alerts(
            alerts, place, checkpoint, alert_mode, "gold_fraud_alerts", alert_trigger, table_format
        )
    started({"gold_fraud_alerts": gold})
    return queries


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; the first failure is raised."""
    for query in queries:
        query.awaitTermination()


def await_first_end(spark: SparkSession) -> None:
    """Block until any query of the session ends; a failure is raised."""
    spark.streams.awaitAnyTermination()
