"""Sliding click flags against plain counting."""

import datetime as dt
import random

import pytest

from adstream import FraudRules, flag_clicks_windowed
from adstream.operators.sliding import flag_clicks_sliding
from conftest import NOON, at, click_frame, flags, plain_shuffle


def plain_flags(rows, limit_clicks, limit_campaigns):
    """Every window of ten minutes that begins at a minute, and what is in it."""
    minute = lambda r: None if r["timestamp"] is None else int((r["timestamp"] - dt.datetime(1970, 1, 1)).total_seconds()) // 60
    flood, bot = set(), set()
    for first in {m - k for m in map(minute, rows) if m is not None for k in range(10)}:
        inside = [r for r in rows if minute(r) is not None and first <= minute(r) < first + 10]
        for r in inside:
            if r["user_id"] is not None:
                if sum(x["user_id"] == r["user_id"] and x["event_id"] is not None for x in inside) > limit_clicks:
                    flood.add(id(r))
            if r["ip_address"] is not None:
                same = {x["campaign_id"] for x in inside if x["ip_address"] == r["ip_address"]} - {None}
                if len(same) > limit_campaigns:
                    bot.add(id(r))
    known = lambda r, key, found: None if minute(r) is None or r[key] is None else id(r) in found
    return [(known(r, "user_id", flood), known(r, "ip_address", bot)) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_flags_match_plain_counting(spark, seed):
    draw = random.Random(seed)
    rows = [
        {
            "event_id": draw.choice(["e", "e", "e", None]) and f"e{i}",
            "user_id": draw.choice(["a", "b", "c", "d", None]),
            "ip_address": draw.choice(["1", "2", "3", None]),
            "campaign_id": draw.choice(["x", "y", "z", "w", None]),
            "timestamp": draw.choice([NOON, NOON, NOON, None]) and NOON + dt.timedelta(seconds=draw.randint(0, 7200)),
            # Tells rows apart, as ids are missing.
            "time_since_impression_ms": 1000 + i,
        }
        for i in range(150)
    ]
    want = dict(zip((r["time_since_impression_ms"] for r in rows), plain_flags(rows, 3, 2)))
    got = flag_clicks_sliding(click_frame(spark, rows), FraudRules(flood_clicks=3, bot_campaigns=2)).collect()
    assert {r["time_since_impression_ms"]: (r["is_click_flood"], r["is_bot_ip"]) for r in got} == want
    assert len(got) == len(rows) and len(set(want.values())) > 4


def test_a_burst_over_a_window_edge_is_caught(spark):
    rows = [{"event_id": f"k{i}", "timestamp": at(t)} for i, t in enumerate(["10:08", "10:09", "10:10", "10:11"])]
    rows += [{"event_id": "far", "timestamp": at("10:20")}]
    rules = FraudRules(flood_clicks=3)
    clicks = click_frame(spark, rows)
    assert not any(flags(flag_clicks_windowed(clicks, rules), "is_click_flood").values())
    assert flags(flag_clicks_sliding(clicks, rules), "is_click_flood") == {
        **{f"k{i}": True for i in range(4)},
        "far": False,
    }


def test_rows_move_as_panes(spark):
    """A user with most of the clicks is a row per pane in the shuffle."""
    rows = [{"event_id": f"k{i}", "timestamp": NOON + dt.timedelta(seconds=i)} for i in range(600)]
    clicks = click_frame(spark, rows).coalesce(1)
    with plain_shuffle(spark):
        from adstream.operators.sliding import sliding_user_counts

        counts = sliding_user_counts(clicks, 60, 10)
        assert counts.count() == 10 and {r["click_count"] for r in counts.collect()} == {600}


def test_whole_panes_and_tables_only(spark, feed):
    with pytest.raises(ValueError, match="whole panes"):
        flag_clicks_sliding(click_frame(spark, []), window_seconds=90)
    stream = feed().add(click_frame(spark, [{}])).stream()
    with pytest.raises(ValueError, match="stream"):
        flag_clicks_sliding(stream)
