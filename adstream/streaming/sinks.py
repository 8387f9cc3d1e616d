"""Starting the streaming queries that write the layered tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from adstream.config import FraudRules
from adstream.operators.alerts import fraud_alerts
from adstream.operators.clicks import flag_clicks
from adstream.operators.parse import encode_events
from adstream.sources import dated, mergelog, storage, tables
from adstream.sources.alerts import NEWEST_ALERT, SUMMED_ALERT

Trigger = dict[str, object]

# The published trigger intervals.
EVENT_TRIGGER: Trigger = {"processingTime": "15 seconds"}
ALERT_TRIGGER: Trigger = {"processingTime": "30 seconds"}


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: Trigger = EVENT_TRIGGER,
    table_format: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a table, exactly once through the sink's own log.

    A table of files that another checkpoint wrote is refused.
    """
    if table_format == "parquet":
        tables.check_owner(stream.sparkSession, path, checkpoint)
    writer = stream.writeStream.format(table_format).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return _start(writer, name, trigger)


def start_messages(
    events: DataFrame,
    sink_format: str,
    options: dict[str, str],
    checkpoint: str,
    name: str | None = None,
    trigger: Trigger = EVENT_TRIGGER,
) -> StreamingQuery:
    """Send events as JSON messages to a topic, or to files that can be read as one."""
    writer = encode_events(events).writeStream.format(sink_format).outputMode("append")
    return _start(writer.options(**options).option("checkpointLocation", checkpoint), name, trigger)


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
    trigger: Trigger = EVENT_TRIGGER,
    output_mode: str = "append",
) -> StreamingQuery:
    """Hand each micro-batch to a function that can be called again with the same batch."""
    writer = stream.writeStream.foreachBatch(write).outputMode(output_mode)
    return _start(writer.option("checkpointLocation", checkpoint), name, trigger)


def start_dated(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: Trigger = EVENT_TRIGGER,
) -> StreamingQuery:
    """Append a stream to a table of batches that are split by event date."""
    tables.check_owner(stream.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not dated.append_dated(batch, path, batch_id):
            _run_through(batch)

    return start_batches(stream, write, checkpoint, name, trigger)


def start_click_flags(
    clicks: DataFrame,
    path: str,
    checkpoint: str,
    rules: FraudRules = FraudRules(),
    name: str | None = None,
    trigger: Trigger = EVENT_TRIGGER,
    table_format: str = "parquet",
) -> StreamingQuery:
    """Flag clicks with each micro-batch as the scope of the counting rules.

    Empty batches are skipped. The batch is kept for the duration of the write, as
    its counts and its rows would each read the source again.
    """
    tables.check_owner(clicks.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        workspace = f"{checkpoint}-verdicts"
        batch.persist()
        try:
            if not batch.isEmpty():
                flagged = flag_clicks(batch, rules, workspace)
                tables.append_batch(flagged, path, batch_id, table_format)
        finally:
            batch.unpersist()
            storage.delete(batch.sparkSession, workspace)

    return start_batches(clicks, write, checkpoint, name, trigger)


def start_alerts(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "complete",
    name: str | None = None,
    trigger: Trigger = ALERT_TRIGGER,
    table_format: str = "parquet",
) -> StreamingQuery:
    """Write windowed alerts.

    ``complete`` replaces the table at each trigger and keeps every window in the
    state for ever. ``append`` writes a window once, when it closes, and ``update``
    merges the windows that changed into a table of runs; both let the state expire. Read the
    result with ``tables.read_alerts`` and the same mode. ``start_merged_alerts`` needs no state.
    """
    spark = alerts.sparkSession
    if mode == "update" and table_format != "parquet":
        raise ValueError("upserts are kept as a Parquet table of changed rows")
    if mode == "append" or (mode == "complete" and table_format != "parquet"):
        if table_format == "parquet":
            tables.check_owner(spark, path, checkpoint)
        writer = alerts.writeStream.format(table_format).outputMode(mode)
        writer = writer.option("checkpointLocation", checkpoint).option("path", path)
        return _start(writer, name, trigger)
    tables.check_owner(spark, path, checkpoint)
    if mode == "complete":
        write = partial(_replace, path)
    elif mode == "update":
        write = partial(_merge, path, NEWEST_ALERT)
    else:
        raise ValueError(f"unknown output mode {mode}")
    return start_batches(alerts, write, checkpoint, name, trigger, mode)


def start_merged_alerts(
    flagged_clicks: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "1 minute",
    name: str | None = None,
    trigger: Trigger = ALERT_TRIGGER,
) -> StreamingQuery:
    """Alerts whose counts are added up in the table, as mode ``merge`` of ``tables.read_alerts``.

    Each micro-batch of flagged clicks is counted by itself and its counts are added to those that
    are there, whenever its clicks are from. So open windows are seen at once, as in ``complete``,
    late clicks count, the stream has no state, and a trigger writes what it changed.
    """
    tables.check_owner(flagged_clicks.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        _merge(path, SUMMED_ALERT, fraud_alerts(batch, window), batch_id)

    return start_batches(flagged_clicks, write, checkpoint, name, trigger)


def _replace(path: str, rows: DataFrame, batch_id: int) -> None:
    if not tables.replace_table(rows, path, batch_id):
        _run_through(rows)


def _merge(path: str, merge: mergelog.Merge, rows: DataFrame, batch_id: int) -> None:
    if not mergelog.apply_changes(rows, path, batch_id, merge):
        _run_through(rows)


def _run_through(rows: DataFrame) -> None:
    """Compute a replayed batch that was written before: its state is committed by nothing else."""
    rows.write.format("noop").mode("overwrite").save()


def _start(writer, name: str | None, trigger: Trigger) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger).start()
