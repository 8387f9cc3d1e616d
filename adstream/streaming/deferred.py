"""Click flags on a stream whose state holds no clicks, and which loses none.

Two things are kept apart. A stream of *verdicts* has window aggregates only: which
users and addresses are flagged in a window, and that a window has closed. Clicks stay
in the bronze table, split by date; when windows close, their clicks are read from there,
flagged by the window's verdicts and appended to silver. Clicks that reach bronze
after that are flagged by the same stored verdicts and appended as amendments.

A ledger says, for each batch of verdicts, up to where windows are closed (S) and which bronze
batches had arrived (M). Batch N appends the clicks of bronze batches up to M(N) in windows
from S(N-1) to S(N), and the clicks of bronze batches after M(N-1) in windows before S(N-1).
Each click is in just one of these, so it is appended once: no join of bronze to silver is
needed, and repeated or missing ids do not matter.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from adstream.config import FraudRules
from adstream.functions.eventtime import duration, with_window_start
from adstream.functions.rules import over_limit
from adstream.operators.clicks import finish_click_flags
from adstream.operators.lookups import Grouping, mark_rows
from adstream.schemas import CLICK
from adstream.sources import dated, storage, tables
from adstream.streaming.sinks import EVENT_TRIGGER, Trigger, start_batches

_USER, _ADDRESS, _WINDOW = "user", "address", "window"
VERDICT = StructType(
    [
        StructField("kind", StringType()),
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("name", StringType()),
        StructField("n_rows", LongType()),
    ]
)


def window_verdicts(clicks: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """A stream of flagged users and addresses per window, and of the windows that closed.

    The state has a row per user, per address and campaign, per address and per window. Windows
    pass through two aggregates, as addresses do, so a window comes with or after its verdicts.
    """
    window = F.window("timestamp", rules.click_window).alias("window")
    users = (
        clicks.filter(F.col("user_id").isNotNull())
        .groupBy(window, "user_id")
        .agg(F.count("event_id").alias("n"), F.count(F.lit(1)).alias("n_rows"))
        .filter(over_limit(F.col("n"), rules.flood_clicks))
    )
    # An exact distinct count is made of two counts: a row per campaign, then the number of those.
    addresses = (
        clicks.filter(F.col("ip_address").isNotNull())
        .groupBy(window, "ip_address", "campaign_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .groupBy("window", "ip_address")
        .agg(F.count("campaign_id").alias("n"), F.sum("n_rows").alias("n_rows"))
        .filter(over_limit(F.col("n"), rules.bot_campaigns))
    )
    cell = F.pmod(F.xxhash64("event_id", F.spark_partition_id()), F.lit(rules.stream_salts)).alias("cell")
    windows = (
        clicks.groupBy(window, cell)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .groupBy("window")
        .agg(F.sum("n_rows").alias("n_rows"))
    )

    def part(rows: DataFrame, kind: str, name: Column) -> DataFrame:
        start, end = F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")
        return rows.select(F.lit(kind).alias("kind"), start, end, name.alias("name"), "n_rows")

    found = part(users, _USER, F.col("user_id")).unionByName(part(addresses, _ADDRESS, F.col("ip_address")))
    return found.unionByName(part(windows, _WINDOW, F.lit(None).cast("string")))


@dataclass(frozen=True)
class DeferredPaths:
    """Where the parts are: bronze clicks, silver clicks, stored verdicts, the ledger and the checkpoint."""

    bronze: str
    silver: str
    verdicts: str
    ledger: str
    checkpoint: str


def start_deferred_flags(
    spark: SparkSession,
    paths: DeferredPaths,
    rules: FraudRules = FraudRules(),
    name: str | None = None,
    trigger: Trigger = EVENT_TRIGGER,
    max_files_per_trigger: int = tables.MAX_FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Flag the clicks of a dated bronze table into a silver table of batches, none lost.

    A click is flagged when the watermark has closed its window, by the counts of the clicks that
    came in time; a later one as soon as it is seen, by the same counts, which it does not change.
    A click without a time has no window: its counting flags are NULL, and it comes at once.
    """
    tables.check_owner(spark, paths.silver, paths.checkpoint)
    bronze = dated.follow_dated(spark, paths.bronze, CLICK, paths.checkpoint, max_files_per_trigger)
    verdicts = window_verdicts(bronze.withWatermark("timestamp", rules.watermark), rules)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # Also when all is there already, as in a replay: the state is committed by this.
            batch.count()
            dated.append_dated(batch, paths.verdicts, batch_id, "window_start")
            _append_flagged(batch, batch_id, paths, rules)
        finally:
            batch.unpersist()

    return start_batches(verdicts, write, paths.checkpoint, name, trigger)


def _append_flagged(verdicts: DataFrame, batch_id: int, paths: DeferredPaths, rules: FraudRules) -> None:
    """Append to silver what batch ``batch_id`` of the verdicts lets out; the ledger makes replays alike."""
    spark = verdicts.sparkSession
    before = _entry(spark, paths.ledger, batch_id - 1)
    now = _entry(spark, paths.ledger, batch_id, exact=True)
    if now is None:
        closed = F.max(F.when(F.col("kind") == _WINDOW, F.unix_micros("window_end")))
        reached = verdicts.agg(closed).first()[0]
        sealed = max([t for t in (before["sealed"], reached) if t is not None], default=None)
        now = {"sealed": sealed, "bronze": dated.last_batch(spark, paths.bronze)}
        storage.make_directory(spark, paths.ledger)
        storage.write_text(spark, f"{paths.ledger}/{batch_id:012d}.json", json.dumps(now))
    if now == before:
        return
    rows = _let_out(spark, paths.bronze, before, now, rules)
    flagged = _flagged(rows, paths, batch_id, rules)
    tables.append_batch(flagged, paths.silver, batch_id)


def _entry(spark: SparkSession, ledger: str, batch_id: int, exact: bool = False) -> dict | None:
    """The ledger's entry of a batch, or of the newest one up to it."""
    numbers = [int(n.removesuffix(".json")) for n in storage.names(spark, ledger) if n.endswith(".json")]
    numbers = [n for n in numbers if n == batch_id or (not exact and n < batch_id)]
    if not numbers:
        return None if exact else {"sealed": None, "bronze": -1}
    return json.loads(storage.read_text(spark, f"{ledger}/{max(numbers):012d}.json"))


def _let_out(spark: SparkSession, bronze: str, before: dict, now: dict, rules: FraudRules) -> DataFrame:
    """The bronze clicks that are due, with the start of their window as ``_window``.

    Dates and batches are filters on directories. A window of one day's end may reach into the next.
    """

    def clicks(first: int | None) -> DataFrame:
        rows = dated.read_dated(spark, bronze, CLICK, first, now["bronze"])
        return with_window_start(rows, "_window", rules.click_window)

    def instant(micros: int) -> Column:
        return F.timestamp_micros(F.lit(micros))

    def day(micros: int) -> Column:
        return dated.utc_date(instant(micros))

    end = F.col("_window") + duration(rules.click_window)
    arrived = clicks(before["bronze"] + 1)
    due = arrived.filter(F.col("timestamp").isNull())
    if before["sealed"] is not None:
        last = instant(before["sealed"])
        due = due.unionByName(arrived.filter((end <= last) & (F.col("event_date") <= day(before["sealed"]))))
    if now["sealed"] is not None and now["sealed"] != before["sealed"]:
        closing = clicks(None).filter((end <= instant(now["sealed"])) & (F.col("event_date") <= day(now["sealed"])))
        if before["sealed"] is not None:
            since = dated.utc_date(instant(before["sealed"]) - duration(rules.click_window))
            closing = closing.filter((end > instant(before["sealed"])) & (F.col("event_date") >= since))
        due = due.unionByName(closing)
    return due


def _flagged(rows: DataFrame, paths: DeferredPaths, batch_id: int, rules: FraudRules) -> DataFrame:
    """Rows flagged by the stored verdicts of their windows."""
    spark = rows.sparkSession
    stored = dated.read_dated(spark, paths.verdicts, VERDICT, last=batch_id)
    # Amendments are few and of few dates; verdicts of other dates are not read.
    dates = [r[0] for r in rows.select(dated.utc_date(F.col("_window")).alias("d")).distinct().collect()]
    dates = [d for d in dates if d is not None]
    stored = stored.filter(F.col("event_date").isin(dates)) if dates else stored.filter("false")

    def grouping(flag: str, kind: str, key: str) -> Grouping:
        found = stored.filter(F.col("kind") == kind).select(
            F.col("window_start").alias("_window"), F.col("name").alias(key), "n_rows", F.lit(True).alias("flagged")
        )
        return Grouping(flag, ("_window", key), found)

    groupings = [grouping("is_click_flood", _USER, "user_id"), grouping("is_bot_ip", _ADDRESS, "ip_address")]
    marked = mark_rows(rows, groupings, rules.limits, f"{paths.checkpoint}-verdicts-{batch_id % 2}")
    return finish_click_flags(marked, rules)
