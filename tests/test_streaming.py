"""Stateful operators on streams, fed one file per micro-batch."""

import pytest
from pyspark.errors import StreamingQueryException

from adstream import (
    FraudRules,
    dedupe_events,
    flag_clicks_windowed,
    flag_orphans,
    fraud_alerts,
)
from adstream.functions.rules import instant_click
from adstream.schemas import SILVER_CLICK, SILVER_CONVERSION
from adstream.sources import mergelog, tables
from adstream.streaming.sinks import start_alerts
from conftest import F, NOON, at, click_frame, conversion_frame, flags, rows_of, run_to_end

NOW = {"availableNow": True}
FAR = [NOON.replace(year=2100, day=1), NOON.replace(year=2100, day=2)]


def clicks_at(spark, *times, **fixed):
    return click_frame(spark, [{"event_id": f"k{t}", "timestamp": at(t), **fixed} for t in times])


def close(source, make, spark):
    """Two events of a far future: one moves the watermark, the other acts on it."""
    for moment in FAR:
        source.add(make(spark, [{"event_id": "end", "click_id": "end", "user_id": None, "timestamp": moment}]))
    return source


def unflagged(clicks):
    names = ("is_click_flood", "is_bot_ip")
    instant = instant_click(F.col("time_since_impression_ms"), 200)
    return clicks.withColumns(
        {**{n: F.lit(False) for n in names}, "is_instant_click": instant, "is_fraud": instant}
    )


LATE_FEED = [
    ("10:00:00", "10:14:30"),
    ("10:14:40",),
    ("10:04:40", "10:03:10", "10:04:30"),
    ("10:40:00",),
    ("10:41:00",),
]


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_late_rows(spark, tmp_path, feed, mode):
    source = feed()
    for times in LATE_FEED:
        source.add(clicks_at(spark, *times))
    path = str(tmp_path / "gold")
    alerts = fraud_alerts(unflagged(source.stream()))
    query = start_alerts(alerts, path, str(tmp_path / "checkpoint"), mode, trigger=NOW)
    query.awaitTermination()
    found = tables.read_alerts(spark, path, mode)
    minutes = [(r["window_start"].minute, r["total_clicks"]) for r in found.orderBy("window_start").collect()]
    kept = [(0, 1), (4, 2), (14, 2)]
    head = [(40, 1), (41, 1)]
    expected = {
        "append": kept,
        "update": kept + head,
        "complete": [(0, 1), (3, 1), (4, 2), (14, 2)] + head,
    }
    assert minutes == expected[mode]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == (0 if mode == "complete" else 1)


def test_windowed_flags_of_a_stream(spark, tmp_path, feed):
    rules = FraudRules(flood_clicks=2, bot_campaigns=2)
    rows = [{"event_id": f"f{i}", "user_id": "flooder", "timestamp": at(f"10:0{i}")} for i in range(3)]
    rows += [{"event_id": f"g{i}", "user_id": "flooder", "timestamp": at(f"10:1{i}")} for i in range(2)]
    rows += [
        {"event_id": f"b{i}", "user_id": f"U{i}", "ip_address": "9.9.9.9", "campaign_id": f"C{i}"} for i in range(3)
    ]
    rows += [
        {"event_id": "null-user", "user_id": None},
        {"event_id": "null-ip", "ip_address": None, "user_id": "other"},
        {"event_id": "fast", "user_id": "fast", "time_since_impression_ms": 5},
    ]
    rows += [{"event_id": f"n{i}", "user_id": None} for i in range(4)]
    timeless = [{"event_id": "timeless", "timestamp": None, "user_id": "flooder"}]
    source = feed()
    for start in range(0, len(rows), 5):
        source.add(click_frame(spark, rows[start : start + 5]))
    source.add(click_frame(spark, timeless))
    close(source, click_frame, spark)
    query = run_to_end(flag_clicks_windowed(source.stream(), rules), tmp_path / "out")
    found = tables.read_table(spark, str(tmp_path / "out"), SILVER_CLICK).filter("event_id != 'end'")
    batch = flag_clicks_windowed(click_frame(spark, rows + timeless), rules)
    assert rows_of(found) == rows_of(batch)
    assert flags(found, "is_click_flood")["f0"] and not flags(found, "is_click_flood")["g0"]
    assert flags(found, "is_bot_ip")["b0"]
    # All that is left in the state is what belongs to the closing events.
    assert max(s["numRowsTotal"] for s in query.recentProgress[-1]["stateOperators"]) <= 2


def test_windowed_flags_survive_a_restart(spark, tmp_path, feed):
    rules = FraudRules(flood_clicks=1)
    source = feed().add(clicks_at(spark, "10:00"))
    run_to_end(flag_clicks_windowed(source.stream(), rules), tmp_path / "out")
    source.add(clicks_at(spark, "10:01"))
    close(source, click_frame, spark)
    run_to_end(flag_clicks_windowed(source.stream(), rules), tmp_path / "out")
    found = tables.read_table(spark, str(tmp_path / "out"), SILVER_CLICK).filter("event_id != 'end'")
    assert flags(found, "is_click_flood") == {"k10:00": True, "k10:01": True}
    assert found.count() == 2


ORPHAN_CASES = {
    "late-edge": ("k", "10:30:00"),
    "early-edge": ("k", "09:30:00"),
    "too-late": ("k", "10:30:01"),
    "no-id": (None, "10:05"),
    "unknown": ("x", "10:05"),
    "twice": ("d", "10:05"),
    "no-time": ("k", None),
}


@pytest.mark.parametrize("prior_only", [False, True])
def test_orphans_of_streams(spark, tmp_path, feed, prior_only):
    rows = [{"event_id": "k", "timestamp": NOON}]
    rows += [{"event_id": "d", "timestamp": at(t)} for t in ("10:00", "10:01")]
    rows.append({"event_id": "timeless", "timestamp": None})
    wanted = [
        {"event_id": e, "click_id": c, "timestamp": t and at(t)} for e, (c, t) in ORPHAN_CASES.items()
    ]
    clicks = close(feed("clicks").add(click_frame(spark, rows)), click_frame, spark)
    conversions = close(feed("conversions").add(conversion_frame(spark, wanted)), conversion_frame, spark)
    flagged = flag_orphans(conversions.stream(), clicks.stream(), prior_only=prior_only)
    query = run_to_end(flagged, tmp_path / "out")
    found = tables.read_table(spark, str(tmp_path / "out"), SILVER_CONVERSION).filter("event_id != 'end'")
    batch = flag_orphans(conversion_frame(spark, wanted), click_frame(spark, rows), prior_only=prior_only)
    assert rows_of(found) == rows_of(batch)
    assert found.filter("event_id = 'twice'").count() == 2
    # Only rows of the closing events may be left in the state.
    per_cell = FraudRules().orphan_salts
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2 * (1 + per_cell)


def test_an_unmatched_head_waits_and_a_late_conversion_is_dropped(spark, tmp_path, feed):
    clicks = feed("clicks").add(click_frame(spark, [{"event_id": "k", "timestamp": at("12:00")}]))
    conversions = feed("conversions").add(
        conversion_frame(spark, [{"event_id": "head", "click_id": "none", "timestamp": at("12:00")}])
    )
    out = tmp_path / "out"

    def found():
        run_to_end(flag_orphans(conversions.stream(), clicks.stream()), out)
        return rows_of(tables.read_table(spark, str(out), SILVER_CONVERSION), "event_id", "is_fraud")

    assert found() == []
    for side, frame in ((clicks, click_frame), (conversions, conversion_frame)):
        side.add(frame(spark, [{"event_id": "m", "click_id": "none", "timestamp": at("14:00")}]))
        side.add(frame(spark, [{"event_id": "n", "click_id": "none", "timestamp": at("14:01")}]))
    assert found() == [("head", True)]
    conversions.add(conversion_frame(spark, [{"event_id": "late", "click_id": "none", "timestamp": at("12:00")}]))
    clicks.add(clicks_at(spark, "14:02"))
    close(conversions, conversion_frame, spark)
    close(clicks, click_frame, spark)
    assert [r for r in found() if r[0] in ("head", "late")] == [("head", True)]


def test_dedupe_of_a_stream(spark, tmp_path, feed):
    source = feed()
    source.add(click_frame(spark, [{"event_id": "a"}, {"event_id": None}]))
    timeless = {"event_id": "t", "timestamp": None}
    source.add(click_frame(spark, [{"event_id": "a"}, {"event_id": "b"}, {"event_id": None}, timeless, timeless]))
    run_to_end(dedupe_events(source.stream()), tmp_path / "out")
    found = spark.read.schema(source.schema).parquet(str(tmp_path / "out"))
    assert rows_of(found, "event_id") == [("a",), ("b",), ("t",), ("t",), (None,), (None,)]


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_a_batch_that_was_written_but_not_committed_is_replayed(spark, tmp_path, feed, monkeypatch, mode):
    source = feed()
    for times in LATE_FEED:
        source.add(clicks_at(spark, *times))
    path, checkpoint = str(tmp_path / "gold"), str(tmp_path / "checkpoint")
    run = lambda: start_alerts(
        fraud_alerts(unflagged(source.stream())), path, checkpoint, mode, trigger=NOW
    ).awaitTermination()
    place, name = {"update": (mergelog, "apply_changes"), "complete": (tables, "replace_table")}[mode]
    write = getattr(place, name)

    def crash(*arguments):
        write(*arguments)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(place, name, crash)
        with pytest.raises(StreamingQueryException):
            run()
    run()
    found = tables.read_alerts(spark, path, mode)
    assert found.agg(F.sum("total_clicks")).first()[0] == (8 if mode == "complete" else 7)


@pytest.mark.parametrize("prior_only", [False, True])
def test_orphans_once_per_conversion_on_streams(spark, tmp_path, feed, prior_only):
    """Repeated clicks, several conversions of a click, and rows without an id or a time, over several batches."""
    clicks = [
        {"event_id": "a", "timestamp": at("10:00")},
        {"event_id": "a", "timestamp": at("10:00")},
        {"event_id": "a", "timestamp": at("10:05")},
        {"event_id": "b", "timestamp": at("10:20")},
        {"event_id": "c", "timestamp": at("09:00")},
        {"event_id": None, "timestamp": at("10:00")},
    ]
    conversions = [
        {"event_id": "v1", "click_id": "a", "timestamp": at("10:10")},
        {"event_id": "v1", "click_id": "a", "timestamp": at("10:10")},
        {"event_id": "v2", "click_id": "a", "timestamp": at("10:34")},
        {"event_id": "v3", "click_id": "b", "timestamp": at("10:01")},
        {"event_id": "v4", "click_id": "c", "timestamp": at("10:00")},
        {"event_id": "v5", "click_id": None, "timestamp": at("10:00")},
        {"event_id": "v6", "click_id": "a", "timestamp": None},
        {"event_id": "v7", "click_id": "none", "timestamp": at("10:00")},
    ]
    left, right = feed("conversions"), feed("clicks")
    for part in (conversions[:3], conversions[3:]):
        left.add(conversion_frame(spark, part))
    for part in (clicks[:1], clicks[1:4], clicks[4:]):
        right.add(click_frame(spark, part))
    close(left, conversion_frame, spark)
    close(right, click_frame, spark)
    rules = FraudRules()
    flagged = flag_orphans(left.stream(), right.stream(), rules, prior_only, per_click=False)
    run_to_end(flagged, tmp_path / "silver")
    got = spark.read.parquet(str(tmp_path / "silver")).filter("event_id <> 'end'")
    table = [conversion_frame(spark, conversions), click_frame(spark, clicks)]
    want = flag_orphans(*table, rules, prior_only, per_click=False)
    assert rows_of(got.select(SILVER_CONVERSION.fieldNames())) == rows_of(want) and got.count() == 8
