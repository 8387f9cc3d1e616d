"""Click flags by verdicts and deferred reads: late clicks, restarts, state and packing."""

import json
import re
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from adstream import FraudRules, flag_clicks_windowed
from adstream.schemas import CLICK, SILVER_CLICK
from adstream.sources import dated, storage, tables
from adstream.streaming import deferred
from adstream.streaming.deferred import DeferredPaths, start_deferred_flags
from conftest import F, NOON, at, click_frame, plan_of, rows_of

NOW = {"availableNow": True}
RULES = FraudRules(flood_clicks=2, bot_campaigns=2)
FAR = [NOON.replace(year=2100, day=1), NOON.replace(year=2100, day=2)]


@pytest.fixture
def paths(tmp_path):
    return DeferredPaths(*(str(tmp_path / n) for n in ("bronze", "silver", "verdicts", "ledger", "checkpoint")))


class Bronze:
    """A bronze table that grows by one batch at a time."""

    def __init__(self, spark, paths):
        self.spark, self.paths, self.n = spark, paths, 0

    def add(self, rows):
        assert dated.append_dated(click_frame(self.spark, rows).coalesce(1), self.paths.bronze, self.n)
        self.n += 1

    def close(self):
        for moment in FAR:
            self.add([{"event_id": "end", "user_id": None, "ip_address": None, "timestamp": moment}])

    def run(self):
        query = start_deferred_flags(self.spark, self.paths, RULES, trigger=NOW, max_files_per_trigger=1)
        query.awaitTermination()
        return query

    def silver(self):
        rows = tables.read_table(self.spark, self.paths.silver, SILVER_CLICK)
        return rows.filter(F.col("timestamp").isNull() | (F.col("timestamp") < F.lit(FAR[0])))


def click(name, time, **fields):
    return {"event_id": name, "timestamp": at(time) if time else None, **fields}


def in_time():
    rows = [click(f"f{i}", f"10:0{i}", user_id="flooder") for i in range(3)]
    rows += [click(f"b{i}", f"10:1{i}", user_id=f"V{i}", ip_address="9.9.9.9", campaign_id=f"C{i}") for i in range(3)]
    return rows + [click("n1", "10:05", user_id=None, ip_address=None), click("x1", "10:21", user_id="calm")]


def test_clicks_in_time_are_flagged_as_in_a_table(spark, paths):
    bronze = Bronze(spark, paths)
    rows = in_time()
    bronze.add(rows[:4])
    bronze.add(rows[4:])
    bronze.close()
    bronze.run()
    want = flag_clicks_windowed(click_frame(spark, rows), RULES)
    assert rows_of(bronze.silver()) == rows_of(want)


def test_late_clicks_are_amended_by_stored_verdicts(spark, paths):
    bronze = Bronze(spark, paths)
    bronze.add(in_time())
    bronze.add([click("later", "11:30", user_id="calm")])
    bronze.add([click("later", "11:40", user_id="calm")])
    bronze.run()
    late = [
        click("late1", "10:04", user_id="flooder"),
        click("late2", "10:15", user_id="V9", ip_address="9.9.9.9", campaign_id="C9"),
        # These would make a flood, had they come in time; a window closed without them.
        *(click(f"late{i}", "10:25", user_id="second") for i in range(3, 7)),
        # A window that had no click at all, a repeated id, a missing id, and no time.
        click("late7", "10:55", user_id="third"),
        click("f0", "10:00", user_id="flooder"),
        click(None, "10:02", user_id="flooder"),
        click("timeless", None, user_id="flooder"),
    ]
    bronze.add(late)
    bronze.run()
    bronze.close()
    bronze.run()
    got = bronze.silver().collect()
    assert Counter(r["event_id"] for r in got) == Counter(
        [r["event_id"] for r in in_time() + late] + ["later", "later"]
    )
    floods = Counter(r["event_id"] for r in got if r["is_click_flood"])
    assert floods == Counter({"f0": 2, "f1": 1, "f2": 1, "late1": 1, None: 1})
    assert {r["event_id"] for r in got if r["is_bot_ip"]} == {"b0", "b1", "b2", "late2"}
    assert [r["is_click_flood"] for r in got if r["event_id"] == "timeless"] == [None]


def test_each_click_once_whatever_the_pace(spark, paths):
    """Bronze may be far ahead of the verdicts, and a run may stop anywhere."""
    bronze = Bronze(spark, paths)
    names = []
    for n in range(6):
        rows = [click(f"c{n}-{k}", f"{10 + (n * k) % 3}:{(7 * n + 11 * k) % 60:02d}", user_id=f"U{k % 2}") for k in range(8)]
        names += [r["event_id"] for r in rows]
        bronze.add(rows)
        if n in (1, 2, 4):
            bronze.run()
    bronze.close()
    bronze.run()
    assert Counter(r["event_id"] for r in bronze.silver().collect()) == Counter(names)


def test_state_holds_groups_not_clicks(spark, paths):
    bronze = Bronze(spark, paths)
    bronze.add([click(f"k{i}", f"10:0{i % 9}", user_id=f"U{i % 3}", campaign_id=f"C{i % 2}") for i in range(900)])
    query = bronze.run()
    states = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    # Users, an address with its campaigns, and the cells of one window.
    assert max(states) <= 3 + 2 + 1 + RULES.stream_salts + 1


@pytest.mark.parametrize("written", [False, True])
def test_a_crash_around_the_write_is_made_up_for(spark, paths, monkeypatch, written):
    """The ledger is written, silver is or is not, and the batch is not committed."""
    bronze = Bronze(spark, paths)
    bronze.add(in_time())
    bronze.close()
    append, crashes = tables.append_batch, []

    def crash(rows, path, batch_id, *more):
        if written:
            append(rows, path, batch_id, *more)
        crashes.append(batch_id)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(deferred.tables, "append_batch", crash)
        with pytest.raises(StreamingQueryException):
            bronze.run()
    # More has come meanwhile; the ledger still says what that batch was.
    bronze.add([click("more", "10:01", user_id="flooder")])
    bronze.run()
    want = rows_of(flag_clicks_windowed(click_frame(spark, in_time()), RULES))
    assert rows_of(bronze.silver().filter("event_id <> 'more'")) == want
    (more,) = bronze.silver().filter("event_id = 'more'").collect()
    assert more["is_click_flood"] and len(crashes) == 1


# --- dated tables -----------------------------------------------------------------


def filters_on(plan):
    """The columns of the filters that choose directories."""
    return set(re.findall(r"(\w+)#", re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)))


def days(spark, n):
    return [
        {"event_id": f"d{n}-{k}", "timestamp": NOON.replace(day=1 + (n + k) % 5), "user_id": f"U{k}"} for k in range(6)
    ]


def test_dates_and_batches_are_directory_filters(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(3):
        dated.append_dated(click_frame(spark, days(spark, n)), path, n)
    assert not dated.append_dated(click_frame(spark, days(spark, 9)), path, 1)
    rows = dated.read_dated(spark, path, CLICK, first=1, last=2)
    plan = plan_of(rows.filter(F.col("event_date") == F.lit("2024-05-03").cast("date")))
    assert filters_on(plan) >= {"event_date", "batch_id"}
    assert rows.count() == 12 and dated.last_batch(spark, path) == 2
    assert dated.read_dated(spark, path, CLICK).count() == 18
    assert dated.read_dated(spark, str(tmp_path / "none"), CLICK).count() == 0


def follow(spark, path, out, checkpoint):
    stream = dated.follow_dated(spark, path, CLICK, checkpoint, 3)
    query = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return Counter(r["event_id"] for r in spark.read.parquet(out).collect())


def test_a_follower_sees_every_row_once_across_packing(spark, tmp_path):
    path, names = str(tmp_path / "table"), []

    def add(n):
        rows = days(spark, n) + [{"event_id": f"null-{n}", "timestamp": None}]
        dated.append_dated(click_frame(spark, rows).repartition(3), path, n)
        names.extend(r["event_id"] for r in rows)

    def all_rows():
        return Counter(r["event_id"] for r in dated.read_dated(spark, path, CLICK).collect())

    first = [str(tmp_path / n) for n in ("first", "first-checkpoint")]
    for n in range(5):
        add(n)
    assert follow(spark, path, *first) == Counter(names)
    for n in range(5, 8):
        add(n)
    # The follower has passed five batches only; the others stay where they are.
    assert dated.pack(spark, path, CLICK, least=2) == 5
    assert all_rows() == Counter(names) and dated.live_batches(spark, path) == list(range(8))
    assert dated.pack(spark, path, CLICK, least=2) == 0
    assert dated.live_batches(spark, path) == [5, 6, 7]
    assert all_rows() == Counter(names)
    assert not dated.append_dated(click_frame(spark, days(spark, 1)), path, 1)
    assert follow(spark, path, *first) == Counter(names)
    # A new follower begins with what is packed, and keeps that while it needs it.
    second = [str(tmp_path / n) for n in ("second", "second-checkpoint")]
    assert follow(spark, path, *second) == Counter(names)
    for n in range(8, 12):
        add(n)
    assert follow(spark, path, *first) == Counter(names)
    assert dated.pack(spark, path, CLICK, least=2) == 3
    dated.pack(spark, path, CLICK, least=100)
    assert follow(spark, path, *second) == Counter(names)
    assert all_rows() == Counter(names)
    runs = json.loads(storage.read_text(spark, f"{path}/_log/{storage.names(spark, f'{path}/_log')[-1]}"))
    assert [(r["first"], r["last"], r["batches"]) for r in runs] == [(0, 7, 8)]


def test_packing_makes_few_files(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(20):
        dated.append_dated(click_frame(spark, days(spark, n)).repartition(4), path, n)
    assert dated.pack(spark, path, CLICK, rows_per_file=15) == 20
    dated.pack(spark, path, CLICK)
    files = dated.read_dated(spark, path, CLICK).inputFiles()
    assert 5 <= len(files) <= 15 and dated.read_dated(spark, path, CLICK).count() == 120
    plan = plan_of(dated.read_dated(spark, path, CLICK).filter(F.col("event_date") == F.lit("2024-05-03").cast("date")))
    assert "event_date" in filters_on(plan)
