"""Tables that grow by merging runs of changes."""

import datetime as dt
import json
import random
from collections import defaultdict

import pytest

from adstream import FraudRules, fraud_alerts
from adstream.functions.rules import instant_click
from adstream.schemas import GOLD_ALERT
from adstream.sources import mergelog, storage, tables
from adstream.sources.alerts import SUMMED_ALERT, read_summed_alerts
from adstream.sources.mergelog import Newest, Sums, apply_changes, read_merged
from adstream.streaming.sinks import start_merged_alerts
from conftest import F, NOON, at, click_frame, plan_of, rows_of

NOW = {"availableNow": True}
SCHEMA = "k string, t timestamp, n long, m long"


def change(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def schema(spark):
    return change(spark, []).schema


def runs_of(spark, path):
    return mergelog._manifest(spark, path)[1]["runs"]


@pytest.mark.parametrize("kind", [Sums, Newest])
def test_merged_table_equals_plain_merging(spark, tmp_path, kind):
    merge, path, draw = kind(("k", "t"), ("n", "m"), "t"), str(tmp_path / "table"), random.Random(2)
    want = {}
    for batch in range(30):
        keys = draw.sample([(f"k{i}", NOON + dt.timedelta(days=i % 3)) for i in range(12)] + [(None, None)], 5)
        rows = [(*key, draw.randint(0, 9), draw.choice([None, 1])) for key in keys] if batch % 9 else []
        assert apply_changes(change(spark, rows), path, batch, merge, fan=3)
        assert not apply_changes(change(spark, [("other", NOON, 1, 1)]), path, batch, merge, fan=3)
        for *key, n, m in rows:
            n0, m0 = want.get(tuple(key), (0, None)) if kind is Sums else (0, None)
            want[tuple(key)] = (n0 + n, m if m0 is None else m0 + (m or 0))
    got = {(r["k"], r["t"]): (r["n"], r["m"]) for r in read_merged(spark, path, schema(spark), merge).collect()}
    assert got == want
    runs = runs_of(spark, path)
    assert len(runs) <= 2 * 4 and [r["level"] for r in runs] == sorted((r["level"] for r in runs), reverse=True)


def test_cost_of_reading_stays_flat(spark, tmp_path):
    """After 500 batches a read takes in few runs, and a batch was rewritten about once per power of the fan."""
    merge, path = Sums(("k", "t"), ("n",), "t"), str(tmp_path / "table")
    written, most = 0, 0
    write = mergelog._read_runs

    # Most of this is bookkeeping; only the manifests are made here for most batches.
    levels = defaultdict(int)
    for batch in range(500):
        level = 0
        levels[0] += 1
        while levels[level] == mergelog.FAN:
            levels[level], levels[level + 1] = 0, levels[level + 1] + 1
            written += mergelog.FAN ** (level + 1)
            level += 1
        most = max(most, sum(levels.values()))
    assert most <= 7 * 3 and written <= 500 * 3 and write

    for batch in range(70):
        apply_changes(change(spark, [("a", NOON + dt.timedelta(days=batch % 2), 1, 1)]).coalesce(1), path, batch, merge)
    runs = runs_of(spark, path)
    assert [(r["level"], r["first"], r["last"]) for r in runs] == [(2, 0, 63), *((0, n, n) for n in range(64, 70))]
    # What no manifest names any more is gone.
    assert len(storage.names(spark, f"{path}/manifest")) <= 3 + mergelog.FAN
    rows = read_merged(spark, path, schema(spark), merge)
    assert rows.agg(F.sum("n")).first()[0] == 70 and rows.count() == 2
    day = F.lit(NOON.date())
    assert "_event_date" in plan_of(read_merged(spark, path, schema(spark), merge, (day, day))).split("PartitionFilters: ")[1][:60]
    assert read_merged(spark, path, schema(spark), merge, (day, day)).agg(F.sum("n")).first()[0] == 35


@pytest.mark.parametrize("step", ["_commit", "_merge_runs"])
def test_a_crash_changes_nothing(spark, tmp_path, monkeypatch, step):
    """Before the manifest a batch is not there; after it, it is, and a replay adds nothing."""
    merge, path = Sums(("k", "t"), ("n",), "t"), str(tmp_path / "table")
    for batch in range(2):
        apply_changes(change(spark, [("a", NOON, 1, 1)]), path, batch, merge, fan=3)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(mergelog, step, crash)
        with pytest.raises(RuntimeError):
            apply_changes(change(spark, [("a", NOON, 1, 1)]), path, 2, merge, fan=3)
    total = lambda: read_merged(spark, path, schema(spark), merge).agg(F.sum("n")).first()[0]
    assert total() == (2 if step == "_commit" else 3)
    assert apply_changes(change(spark, [("a", NOON, 1, 1)]), path, 2, merge, fan=3) == (step == "_commit")
    apply_changes(change(spark, [("a", NOON, 1, 1)]), path, 3, merge, fan=3)
    assert total() == 4


def test_a_reader_that_began_before_a_merge_can_finish(spark, tmp_path):
    merge, path = Sums(("k", "t"), ("n",), "t"), str(tmp_path / "table")
    for batch in range(2):
        apply_changes(change(spark, [("a", NOON, 1, 1)]), path, batch, merge, fan=3)
    early = read_merged(spark, path, schema(spark), merge)
    apply_changes(change(spark, [("a", NOON, 1, 1)]), path, 2, merge, fan=3)
    assert early.agg(F.sum("n")).first()[0] == 2
    assert json.loads(storage.read_text(spark, f"{path}/manifest/{storage.names(spark, f'{path}/manifest')[-1]}"))["applied"] == 2


def flagged(clicks):
    instant = instant_click(F.col("time_since_impression_ms"), 200)
    quiet = {n: F.lit(False) for n in ("is_click_flood", "is_bot_ip")}
    return clicks.withColumns({**quiet, "is_instant_click": instant, "is_fraud": instant})


def bytes_of(spark, path):
    return {
        (run, day, f)
        for run in storage.names(spark, f"{path}/runs")
        for day in storage.names(spark, f"{path}/runs/{run}")
        for f in storage.names(spark, f"{path}/runs/{run}/{day}")
        if f.endswith(".parquet")
    }


def test_alerts_of_three_days_without_state(spark, tmp_path, feed):
    """The table equals alerts of all clicks after every trigger; there is no state, and writes stay flat."""
    source, path, checkpoint = feed(), str(tmp_path / "gold"), str(tmp_path / "checkpoint")
    everything, written = [], []
    for day in range(3):
        for part in range(3):
            start = NOON.replace(day=1 + day, hour=8 + part)
            rows = [
                {"event_id": f"k{day}-{part}-{i}", "timestamp": start + dt.timedelta(seconds=20 * i),
                 "campaign_id": f"C{i % 2}", "time_since_impression_ms": 50 + 40 * i}
                for i in range(8)
            ]
            # Late clicks of the first day, and one without a time.
            rows += [{"event_id": f"late{day}-{part}", "timestamp": at("08:00")}, {"event_id": "none", "timestamp": None}]
            everything += rows
            source.add(click_frame(spark, rows))
        before = bytes_of(spark, path)
        query = start_merged_alerts(flagged(source.stream(None)), path, checkpoint, trigger=NOW)
        query.awaitTermination()
        assert all(not p["stateOperators"] for p in query.recentProgress)
        written.append(len(bytes_of(spark, path) - before))
        current = tables.read_alerts(spark, path, "merge")
        assert rows_of(current) == rows_of(fraud_alerts(flagged(click_frame(spark, everything))))
        assert current.columns == GOLD_ALERT.fieldNames()
    # A batch has clicks of two or three dates, and the third merge of runs of a level is not far.
    assert max(written) <= 9


def test_unknown_flags_stay_unknown(spark, tmp_path):
    path = str(tmp_path / "gold")
    for batch, known in enumerate([None, None, True]):
        clicks = click_frame(spark, [{"event_id": f"k{batch}", "timestamp": at("10:00")}]).withColumns(
            {n: F.lit(known).cast("boolean") for n in ("is_click_flood", "is_bot_ip", "is_instant_click", "is_fraud")}
        )
        apply_changes(fraud_alerts(clicks, FraudRules().alert_window), path, batch, SUMMED_ALERT)
        (row,) = read_summed_alerts(spark, path).collect()
        assert (row["total_clicks"], row["fraud_clicks"]) == (batch + 1, 1 if known else None)
        assert row["fraud_rate"] == (0.3333 if known else None)
