"""Layered tables and their sinks."""

import pytest

from adstream.operators.clicks import flag_clicks
from adstream.schemas import CLICK, GOLD_ALERT, SILVER_CLICK
from adstream.sources import storage, tables
from adstream.streaming.sinks import start_alerts, start_append, start_click_flags
from conftest import F, at, click_frame, rows_of
from pyspark.sql.types import LongType, StructField, StructType

NOW = {"availableNow": True}


def test_a_new_table_is_empty_and_readable(spark, tmp_path):
    path = str(tmp_path / "new" / "table")
    tables.create_if_absent(spark, path, CLICK)
    tables.create_if_absent(spark, path, CLICK)
    assert tables.read_table(spark, path, CLICK).count() == 0
    stream = tables.read_table(spark, path, CLICK, streaming=True)
    query = stream.writeStream.format("memory").queryName("nothing").trigger(**NOW).start()
    query.awaitTermination()
    assert query.exception() is None


def test_a_batch_is_written_once(spark, tmp_path):
    path = str(tmp_path / "table")
    batch = click_frame(spark, [{"event_id": "a"}])
    assert tables.append_batch(batch, path, 0)
    assert tables.append_batch(batch, path, 1)
    assert not tables.append_batch(batch, path, 1)
    found = tables.read_table(spark, path, CLICK)
    assert found.columns == CLICK.fieldNames() and found.count() == 2


def test_an_incomplete_batch_is_written_again(spark, tmp_path):
    path = str(tmp_path / "table")
    batch = click_frame(spark, [{"event_id": "a"}])
    tables.append_batch(batch, path, 0)
    storage.delete(spark, f"{path}/batch_id=0/_SUCCESS")
    assert tables.append_batch(batch, path, 0)
    assert tables.read_table(spark, path, CLICK).count() == 1


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "table")
    assert tables.read_latest(spark, path, CLICK).count() == 0
    for n in range(4):
        tables.replace_table(click_frame(spark, [{"event_id": f"k{n}"}]), path, n)
    assert rows_of(tables.read_latest(spark, path, CLICK), "event_id") == [("k3",)]
    assert storage.numbered_directories(spark, path, "version") == [2, 3]
    storage.delete(spark, f"{path}/version=3/_SUCCESS")
    assert rows_of(tables.read_latest(spark, path, CLICK), "event_id") == [("k2",)]


def test_upserts_show_the_last_state(spark, tmp_path):
    path = str(tmp_path / "table")
    columns = GOLD_ALERT.fieldNames()

    def alert(campaign, clicks):
        values = {"campaign_id": campaign, "window_start": at("10:00"), "window_end": at("10:01"), "total_clicks": clicks}
        return spark.createDataFrame([tuple(values.get(c) for c in columns)], GOLD_ALERT)

    tables.append_batch(alert("C1", 1).union(alert("C2", 5)), path, 0)
    tables.append_batch(alert("C1", 2), path, 9)
    tables.append_batch(alert("C1", 3), path, 10)
    found = tables.read_upserts(spark, path, GOLD_ALERT, ["campaign_id", "window_start", "window_end"])
    assert found.columns == columns
    assert rows_of(found, "campaign_id", "total_clicks") == [("C1", 3), ("C2", 5)]


def test_a_table_belongs_to_one_checkpoint(spark, tmp_path, feed):
    stream = feed().add(click_frame(spark, [{}])).stream()
    path, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for _ in range(2):
        start_click_flags(stream, path, checkpoint, trigger=NOW).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        start_click_flags(stream, path, str(tmp_path / "other"), trigger=NOW)


def test_micro_batches_are_the_scope_and_a_replay_adds_nothing(spark, tmp_path, feed):
    source = feed()
    for batch in range(2):
        source.add(click_frame(spark, [{"event_id": f"k{batch}-{i}"} for i in range(51 - batch)]))
    source.add(click_frame(spark, [{}]).limit(0))
    path, checkpoint = str(tmp_path / "table"), tmp_path / "checkpoint"

    def run():
        start_click_flags(source.stream(), path, str(checkpoint), trigger=NOW).awaitTermination()
        return tables.read_table(spark, path, SILVER_CLICK)

    flagged = run()
    assert flagged.columns == SILVER_CLICK.fieldNames()
    assert flagged.count() == 101
    assert flagged.filter("is_click_flood").count() == 51
    assert storage.numbered_directories(spark, path, "batch_id") == [0, 1]

    # Take back the commit of the batch with rows, as if the driver had died after the write.
    for n in (1, 2):
        for name in (f"{n}", f".{n}.crc"):
            if (checkpoint / "commits" / name).exists():
                storage.delete(spark, str(checkpoint / "commits" / name))
    assert run().count() == 101


def test_following_a_table_of_batches(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.create_if_absent(spark, path, SILVER_CLICK)
    flagged = flag_clicks(click_frame(spark, [{"event_id": "a"}, {"event_id": "b"}]))
    tables.append_batch(flagged, path, 0)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def follow():
        stream = tables.read_table(spark, path, SILVER_CLICK, streaming=True)
        writer = stream.writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(**NOW).start().awaitTermination()
        return spark.read.schema(SILVER_CLICK).parquet(out).count()

    assert follow() == 2
    tables.append_batch(flagged, path, 0)
    assert follow() == 2
    tables.append_batch(flagged, path, 1)
    assert follow() == 4


def test_unknown_modes_are_refused(spark, feed):
    stream = feed().add(click_frame(spark, [{}])).stream()
    counts = stream.groupBy(F.window("timestamp", "1 minute")).count()
    with pytest.raises(ValueError, match="unknown output mode"):
        start_alerts(counts, "/nowhere", "/nowhere-either", mode="other")
    with pytest.raises(ValueError, match="upserts"):
        start_alerts(counts, "/nowhere", "/nowhere-either", mode="update", table_format="other")


def test_a_table_of_another_checkpoint_is_refused(spark, tmp_path):
    """Its sink log knows the batch numbers, so a new checkpoint's rows would be left out."""
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id LONG").parquet(str(tmp_path / "in"))
    start = [str(tmp_path / "out"), str(tmp_path / "first")]
    start_append(stream, *start, trigger=NOW).awaitTermination()
    start_append(stream, *start, trigger=NOW).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        start_append(stream, str(tmp_path / "out"), str(tmp_path / "second"), trigger=NOW)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_a_stream_takes_a_backlog_in_several_batches(spark, tmp_path):
    spark.range(0, 40, 1, 4).write.parquet(str(tmp_path / "in"))
    schema = StructType([StructField("id", LongType())])
    stream = tables.read_table(spark, str(tmp_path / "in"), schema, streaming=True, max_files_per_trigger=1)
    query = start_append(stream, str(tmp_path / "out"), str(tmp_path / "check"), trigger=NOW)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
