"""The registered queries: every operator over the ``events`` table of a data folder.

Thresholds are lowered where the published ones would flag nothing on the sparse
test events. Event times come out without a time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.config import FraudRules, TablePaths
from adstream.functions.rules import instant_click
from adstream.operators.alerts import fraud_alerts
from adstream.operators.clicks import (
    campaigns_per_address,
    clicks_per_user,
    flag_clicks,
    flag_clicks_windowed,
)
from adstream.operators.conversions import flag_orphans, orphan_conversions
from adstream.operators.dedupe import dedupe_events
from adstream.operators.parse import encode_events, parse_events
from adstream.operators.sliding import flag_clicks_sliding
from adstream.plans import reports
from adstream.schemas import (
    CLICK,
    MESSAGES,
    SILVER_CLICK,
    SILVER_CONVERSION,
)
from adstream.session import scratch_path
from adstream.sources import adevents, tables
from adstream.streaming import replay as r
from adstream.streaming.deferred import DeferredPaths, start_deferred_flags
from adstream.streaming.runner import await_all, run_pipeline
from adstream.streaming.sinks import (
    start_alerts,
    start_append,
    start_click_flags,
    start_dated,
    start_merged_alerts,
    start_messages,
)

Query = Callable[[SparkSession, str], DataFrame]

WHOLE_TABLE = FraudRules(flood_clicks=13, bot_campaigns=48)
TEN_MINUTES = FraudRules(flood_clicks=1, bot_campaigns=1)
DAILY = FraudRules(flood_clicks=1, bot_campaigns=8, click_window="1 day", alert_window="1 day")
PUBLISHED = FraudRules()
# Which events a replay holds back until all windows have closed.
LATE = "event_id % 7 = 0"


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adevents.clicks(adevents.events_table(spark, sf_dir))


def _conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adevents.conversions(adevents.events_table(spark, sf_dir))


def _parsed(topic: str) -> Query:
    derive = {
        "impressions": adevents.impressions,
        "clicks": adevents.clicks,
        "conversions": adevents.conversions,
    }[topic]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = adevents.with_instants(derive(adevents.events_table(spark, sf_dir)))
        return adevents.with_local_times(parse_events(encode_events(rows), MESSAGES[topic]))

    return query


def click_counts_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_per_user(_clicks(spark, sf_dir)).select("user_id", "click_count")


def campaigns_per_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns_per_address(_clicks(spark, sf_dir)).select("ip_address", "distinct_campaigns")


def instant_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = F.col("time_since_impression_ms")
    return _clicks(spark, sf_dir).filter(instant_click(delay, PUBLISHED.instant_ms))


def flag_clicks_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_clicks(_clicks(spark, sf_dir), WHOLE_TABLE)


def _windowed(rules: FraudRules) -> Query:
    return lambda spark, sf_dir: flag_clicks_windowed(_clicks(spark, sf_dir), rules)


def _sliding(rules: FraudRules) -> Query:
    return lambda spark, sf_dir: flag_clicks_sliding(_clicks(spark, sf_dir), rules)


def _alerts(rules: FraudRules, window: str) -> Query:
    return lambda spark, sf_dir: fraud_alerts(_windowed(rules)(spark, sf_dir), window)


def _orphans(**options: bool) -> Query:
    return lambda spark, sf_dir: flag_orphans(
        _conversions(spark, sf_dir), _clicks(spark, sf_dir), PUBLISHED, **options
    )


def orphan_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_conversions(_conversions(spark, sf_dir), _clicks(spark, sf_dir), PUBLISHED)


def bronze_click_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.click_sample(_clicks(spark, sf_dir))


def fraud_click_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fraud_click_sample(_windowed(DAILY)(spark, sf_dir))


def fraud_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fraud_totals(_windowed(DAILY)(spark, sf_dir))


def top_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_alerts(_alerts(DAILY, "1 day")(spark, sf_dir))


def orphan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orphans = orphan_conversions(_conversions(spark, sf_dir), _clicks(spark, sf_dir), PUBLISHED)
    return reports.orphan_report(orphans.withColumn("is_orphan_conversion", F.lit(True)))


def dedupe_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = _clicks(spark, sf_dir)
    return dedupe_events(clicks.unionByName(clicks))


def dedupe_few_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some clicks come again later, some without an id; the earliest of an id stays, and all without one."""
    clicks = _clicks(spark, sf_dir)
    number = F.substring("event_id", 2, 20).cast("long")
    later = clicks.filter(number % 20 == 0).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 MINUTE"))
    nameless = clicks.filter(number % 50 == 0).withColumn("event_id", F.lit(None).cast("string"))
    return dedupe_events(later.unionByName(clicks).unionByName(nameless).unionByName(nameless))


def stream_bronze_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(closing: str, table: str, checkpoint: str):
        clicks = r.topic_stream(spark, sf_dir, "clicks", closing)
        return start_append(clicks, table, checkpoint, trigger=r.TO_THE_END)

    return _appended(spark, r.replay(spark, start, "bronze"), CLICK)


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(closing: str, table: str, checkpoint: str):
        events = r.event_stream(spark, sf_dir, closing)
        clicks = adevents.with_instants(adevents.clicks(events.unionByName(events)))
        unique = dedupe_events(clicks.withWatermark("timestamp", PUBLISHED.watermark))
        return start_append(unique, table, checkpoint, trigger=r.TO_THE_END)

    return _appended(spark, r.replay(spark, start, "dedupe"), CLICK)


def stream_flag_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(closing: str, table: str, checkpoint: str):
        flagged = flag_clicks_windowed(r.topic_stream(spark, sf_dir, "clicks", closing), TEN_MINUTES)
        return start_append(flagged, table, checkpoint, trigger=r.TO_THE_END)

    return _appended(spark, r.replay(spark, start, "flags"), SILVER_CLICK)


def _deferred(name: str, late: str | None) -> Query:
    """Clicks from a dated bronze table, flagged when their windows have closed.

    Events for which ``late`` holds come after all windows have closed.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = adevents.events_table(spark, sf_dir)
        phases = [events] if late is None else [events.filter(f"NOT ({late})"), None, events.filter(late)]

        def run(feed: DataFrame, root: str) -> None:
            paths = DeferredPaths(*(f"{root}/{n}" for n in ("bronze", "silver", "verdicts", "ledger", "flags")))
            clicks = adevents.with_instants(adevents.clicks(feed))
            start_dated(clicks, paths.bronze, f"{root}/arrival", trigger=r.TO_THE_END).awaitTermination()
            start_deferred_flags(spark, paths, TEN_MINUTES, trigger=r.TO_THE_END).awaitTermination()

        return _appended(spark, f"{r.replay_in_phases(spark, name, phases, run)}/silver", SILVER_CLICK)

    return query


def stream_flag_clicks_microbatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(closing: str, table: str, checkpoint: str):
        clicks = r.without_closing(r.topic_stream(spark, sf_dir, "clicks", closing))
        return start_click_flags(clicks, table, checkpoint, WHOLE_TABLE, trigger=r.TO_THE_END)

    return _appended(spark, r.replay(spark, start, "batches"), SILVER_CLICK)


def stream_flag_orphans_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every click comes twice, and every conversion out once."""

    def start(closing: str, table: str, checkpoint: str):
        clicks = r.topic_stream(spark, sf_dir, "clicks", closing)
        conversions = r.topic_stream(spark, sf_dir, "conversions", closing)
        flagged = flag_orphans(conversions, clicks.unionByName(clicks), PUBLISHED, per_click=False)
        return start_append(flagged, table, checkpoint, trigger=r.TO_THE_END)

    return _appended(spark, r.replay(spark, start, "orphans-once"), SILVER_CONVERSION)


def stream_alerts_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of clicks of which some come after all windows have closed; none is left out."""
    events = adevents.events_table(spark, sf_dir)

    def run(feed: DataFrame, root: str) -> None:
        clicks = _row_local(adevents.with_instants(adevents.clicks(feed)))
        query = start_merged_alerts(
            r.without_closing(clicks), f"{root}/gold", f"{root}/checkpoint", PUBLISHED.alert_window, trigger=r.TO_THE_END
        )
        query.awaitTermination()

    root = r.replay_in_phases(spark, "merged", [events.filter(f"NOT ({LATE})"), None, events.filter(LATE)], run)
    return _gold(spark, f"{root}/gold", "merge")


def _row_local(clicks: DataFrame) -> DataFrame:
    """Clicks flagged by the row-local rule alone."""
    instant = instant_click(F.col("time_since_impression_ms"), PUBLISHED.instant_ms)
    return clicks.withColumns(
        {"is_click_flood": F.lit(False), "is_bot_ip": F.lit(False), "is_instant_click": instant, "is_fraud": instant}
    )


def _stream_orphans(prior_only: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def start(closing: str, table: str, checkpoint: str):
            clicks = r.topic_stream(spark, sf_dir, "clicks", closing)
            conversions = r.topic_stream(spark, sf_dir, "conversions", closing)
            flagged = flag_orphans(conversions, clicks, PUBLISHED, prior_only)
            return start_append(flagged, table, checkpoint, trigger=r.TO_THE_END)

        return _appended(spark, r.replay(spark, start, "orphans"), SILVER_CONVERSION)

    return query


def _stream_alerts(mode: str) -> Query:
    """Published one-minute alerts over clicks flagged by the row-local rule."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def start(closing: str, table: str, checkpoint: str):
            clicks = r.topic_stream(spark, sf_dir, "clicks", closing)
            alerts = fraud_alerts(_row_local(clicks), PUBLISHED.alert_window)
            return start_alerts(alerts, table, checkpoint, mode, trigger=r.TO_THE_END)

        return _gold(spark, r.replay(spark, start, f"alerts-{mode}"), mode)

    return query


def medallion_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six queries, from files of messages to the gold table."""
    root = scratch_path(spark, "medallion")
    closing = r.write_closing_events(spark, f"{root}/closing")
    options, producers = {}, []
    for topic in MESSAGES:
        options[topic] = {"path": f"{root}/topics/{topic}"}
        events = r.topic_events(spark, sf_dir, topic, closing)
        checkpoint = f"{root}/producer/{topic}"
        producers.append(
            start_messages(events, "parquet", options[topic], checkpoint, trigger=r.TO_THE_END)
        )
    await_all(producers)
    paths = TablePaths(f"{root}/tables")
    with r.state_partitions(spark):
        run_pipeline(spark, "parquet", options, paths, TEN_MINUTES, trigger=r.TO_THE_END)
    return _gold(spark, paths.gold(), "merge")


def _appended(spark: SparkSession, path: str, schema) -> DataFrame:
    return adevents.with_local_times(r.without_closing(tables.read_table(spark, path, schema)))


def _gold(spark: SparkSession, path: str, mode: str) -> DataFrame:
    alerts = tables.read_alerts(spark, path, mode)
    current = r.alerts_without_closing(alerts)
    return adevents.with_local_times(current, "window_start", "window_end")


QUERIES: dict[str, Query] = {
    "parse_impressions": _parsed("impressions"),
    "parse_clicks": _parsed("clicks"),
    "parse_conversions": _parsed("conversions"),
    "click_counts_per_user": click_counts_per_user,
    "campaigns_per_ip": campaigns_per_ip,
    "instant_clicks": instant_clicks,
    "flag_clicks_batch": flag_clicks_batch,
    "flag_clicks_10min": _windowed(TEN_MINUTES),
    "flag_clicks_daily": _windowed(DAILY),
    "flag_clicks_sliding": _sliding(TEN_MINUTES),
    "flag_orphans": _orphans(),
    "flag_orphans_once": _orphans(per_click=False),
    "orphans_prior_only": _orphans(prior_only=True),
    "orphan_anti_join": orphan_anti_join,
    "alerts_1min": _alerts(PUBLISHED, "1 minute"),
    "alerts_10min": _alerts(TEN_MINUTES, "10 minutes"),
    "alerts_daily": _alerts(DAILY, "1 day"),
    "bronze_click_sample": bronze_click_sample,
    "fraud_click_sample": fraud_click_sample,
    "fraud_totals": fraud_totals,
    "top_alerts": top_alerts,
    "orphan_report": orphan_report,
    "dedupe_clicks": dedupe_clicks,
    "dedupe_few_copies": dedupe_few_copies,
    "stream_bronze_clicks": stream_bronze_clicks,
    "stream_dedupe": stream_dedupe,
    "stream_flag_clicks": stream_flag_clicks,
    "stream_flag_clicks_deferred": _deferred("deferred", None),
    "stream_late_clicks": _deferred("late", LATE),
    "stream_flag_clicks_microbatch": stream_flag_clicks_microbatch,
    "stream_flag_orphans": _stream_orphans(prior_only=False),
    "stream_orphans_prior_only": _stream_orphans(prior_only=True),
    "stream_flag_orphans_once": stream_flag_orphans_once,
    "stream_alerts_merged": stream_alerts_merged,
    "stream_alerts_append": _stream_alerts("append"),
    "stream_alerts_complete": _stream_alerts("complete"),
    "stream_alerts_update": _stream_alerts("update"),
    "medallion_alerts": medallion_alerts,
}
