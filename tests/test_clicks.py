"""Click rules on tables."""

import dataclasses
import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adstream import FraudRules, LookupLimits, flag_clicks, flag_clicks_windowed, session
from adstream.functions.rules import any_flag
from adstream.operators import lookups
from adstream.schemas import SILVER_CLICK
from conftest import F, at, click_frame, flags, plain_shuffle, plan_of, rows_of

# Forces the plan for more flagged groups than may be broadcast.
TINY = LookupLimits(max_rows=1, heavy_rows=2)


def _clicks(spark, n, **fixed):
    return click_frame(spark, [{"event_id": f"k{i}", **fixed} for i in range(n)])


@pytest.mark.parametrize(("n", "expected"), [(50, False), (51, True)])
def test_flood_threshold_is_strict_and_flags_all_clicks(spark, n, expected):
    flagged = flag_clicks(_clicks(spark, n))
    assert set(flags(flagged, "is_click_flood").values()) == {expected}
    assert flagged.columns == SILVER_CLICK.fieldNames()


@pytest.mark.parametrize(("n", "expected"), [(20, False), (21, True)])
def test_bot_threshold_counts_distinct_campaigns(spark, n, expected):
    rows = [{"event_id": f"k{i}", "user_id": f"U{i}", "campaign_id": f"C{i % n}"} for i in range(40)]
    assert set(flags(flag_clicks(click_frame(spark, rows)), "is_bot_ip").values()) == {expected}


@pytest.mark.parametrize(("delay", "expected"), [(199, True), (200, False), (None, None), (-5, True)])
def test_instant_threshold(spark, delay, expected):
    flagged = flag_clicks(_clicks(spark, 1, time_since_impression_ms=delay))
    row = flagged.first()
    assert row["is_instant_click"] is expected and row["is_fraud"] is expected


def test_null_campaigns_and_null_ids_do_not_count(spark):
    rows = [{"event_id": None, "campaign_id": None} for _ in range(60)]
    row = flag_clicks(click_frame(spark, rows)).select("is_click_flood", "is_bot_ip").distinct().collect()
    assert [tuple(r) for r in row] == [(False, False)]


@pytest.mark.parametrize("limits", [LookupLimits(), TINY])
def test_null_keys_give_unknown_flags(spark, limits):
    rules = FraudRules(limits=limits)
    many = _clicks(spark, 60, user_id=None, ip_address=None)
    assert {tuple(r) for r in flag_clicks(many, rules).select("is_click_flood", "is_bot_ip").collect()} == {
        (None, None)
    }
    assert set(flags(flag_clicks(many, rules), "is_fraud").values()) == {None}


@pytest.mark.parametrize("values", list(itertools.product([True, False, None], repeat=3)))
def test_three_valued_or(spark, values):
    frame = spark.createDataFrame([values], "a BOOLEAN, b BOOLEAN, c BOOLEAN")
    expected = True if True in values else None if None in values else False
    assert frame.select(any_flag(F.col("a"), F.col("b"), F.col("c"))).first()[0] is expected


def test_windows_are_counted_apart(spark):
    rules = FraudRules(flood_clicks=1)
    rows = [
        {"event_id": "a", "timestamp": at("10:09:59")},
        {"event_id": "b", "timestamp": at("10:10:00")},
        {"event_id": "c", "timestamp": at("10:19:59")},
    ]
    flagged = flag_clicks_windowed(click_frame(spark, rows), rules)
    assert flags(flagged, "is_click_flood") == {"a": False, "b": True, "c": True}


def test_click_without_a_time_is_kept_with_unknown_counts(spark):
    rows = [{"event_id": "a", "timestamp": None, "time_since_impression_ms": 5}, {"event_id": "b"}]
    flagged = flag_clicks_windowed(click_frame(spark, rows))
    assert flags(flagged, "is_click_flood") == {"a": None, "b": False}
    assert flags(flagged, "is_fraud") == {"a": True, "b": False}


def test_streams_are_refused_by_the_bounded_form(spark, feed):
    stream = feed().add(click_frame(spark, [{}])).stream()
    with pytest.raises(ValueError, match="bounded"):
        flag_clicks(stream)


CLICK_ROWS = st.lists(
    st.fixed_dictionaries(
        {
            "user_id": st.sampled_from(["U1", "U2", "U3", None]),
            "ip_address": st.sampled_from(["1.1.1.1", "2.2.2.2", None]),
            "campaign_id": st.sampled_from(["C1", "C2", "C3", None]),
            "timestamp": st.sampled_from([at("10:00"), at("10:05"), at("10:10"), None]),
        }
    ),
    min_size=1,
    max_size=25,
)


def _brute_force(rows, rules, windowed):
    def scope(row):
        if not windowed:
            return 0
        return row["timestamp"] and (row["timestamp"].hour, row["timestamp"].minute // 10)

    result = {}
    for row in rows:
        mine = [r for r in rows if scope(r) == scope(row)]
        flood = bot = None
        if scope(row) is not None and row["user_id"] is not None:
            flood = sum(r["user_id"] == row["user_id"] for r in mine) > rules.flood_clicks
        if scope(row) is not None and row["ip_address"] is not None:
            seen = {r["campaign_id"] for r in mine if r["ip_address"] == row["ip_address"]} - {None}
            bot = len(seen) > rules.bot_campaigns
        result[row["event_id"]] = (flood, bot)
    return result


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=CLICK_ROWS, windowed=st.booleans(), tiny=st.booleans())
def test_flags_equal_brute_force(spark, rows, windowed, tiny):
    rows = [{"event_id": f"k{i}", **r} for i, r in enumerate(rows)]
    rules = FraudRules(flood_clicks=2, bot_campaigns=1, limits=TINY if tiny else LookupLimits())
    flagged = (flag_clicks_windowed if windowed else flag_clicks)(click_frame(spark, rows), rules)
    found = {r["event_id"]: (r["is_click_flood"], r["is_bot_ip"]) for r in flagged.collect()}
    assert found == _brute_force(rows, rules, windowed)


def test_plans_agree_and_nothing_moves_when_the_flagged_fit(spark, monkeypatch):
    rows = [
        {"event_id": f"k{i}", "user_id": f"U{i % 7}", "ip_address": f"ip{i % 5}", "campaign_id": f"C{i % 11}"}
        for i in range(300)
    ]
    clicks = click_frame(spark, rows)
    rules = FraudRules(flood_clicks=42, bot_campaigns=5)
    small = flag_clicks(clicks, rules)
    large = flag_clicks(clicks, dataclasses.replace(rules, limits=TINY))
    too_wide = flag_clicks(clicks, dataclasses.replace(rules, limits=LookupLimits(max_bytes=1)))
    expected = rows_of(small)
    assert rows_of(large) == expected
    assert rows_of(too_wide) == expected
    monkeypatch.setattr(session, "has_checkpoint_dir", lambda spark: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        flag_clicks(clicks, rules)

    plan = plan_of(small)
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan
    plan = plan_of(large)
    assert "TakeOrderedAndProject" not in plan


@pytest.mark.parametrize("name", ["hot", "h" * 200])
def test_a_dominant_key_is_spread_in_the_shuffle_form(spark, name):
    """A third of all rows have one user, maybe of a long name; they must not end in one partition."""
    rows = spark.range(30_000, numPartitions=8).select(
        F.concat(F.lit("k"), "id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, name).otherwise(F.concat(F.lit("U"), "id")).alias("user_id"),
    )
    verdicts = rows.groupBy("user_id").agg(F.count("event_id").alias("n_rows")).withColumn(
        "flagged", F.col("user_id").substr(-1, 1) != "7"
    )
    grouping = lookups.Grouping("hit", ("user_id",), verdicts)
    with plain_shuffle(spark):
        marked = lookups.mark_rows(rows, [grouping], LookupLimits(max_rows=5, heavy_rows=1000))
        where = marked.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("user_id") == name).alias("n"))
        sizes = [r["n"] for r in where.collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 4_000
    assert marked.filter("hit").count() == marked.filter("substr(user_id, -1) != '7'").count()


def test_only_repeated_events_are_aggregated(spark):
    from adstream import dedupe_events

    rows = [{"event_id": f"k{i}", "timestamp": at("10:00"), "user_id": f"U{i}"} for i in range(40)]
    rows += [{"event_id": "k3", "timestamp": at("09:59"), "user_id": "early"}]
    rows += [{"event_id": "k4", "timestamp": at("10:00"), "user_id": "A"}, {"event_id": "k4", "timestamp": None, "user_id": "Z"}]
    rows += [{"event_id": None, "user_id": "same"}] * 2
    clicks = click_frame(spark, rows)
    kept = dedupe_events(clicks)
    plain = dedupe_events(clicks, limits=LookupLimits(max_rows=0))
    assert rows_of(kept) == rows_of(plain) and kept.count() == 42
    users = {r["event_id"]: r["user_id"] for r in kept.filter("event_id IN ('k3', 'k4')").collect()}
    assert users == {"k3": "early", "k4": "Z"}
    # The shuffle before the aggregate takes the few repeated rows alone.
    with plain_shuffle(spark):
        plan = plan_of(dedupe_events(clicks))
    below = plan.split("Exchange hashpartitioning(event_id")[1].split("Union")[0]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below and "LeftAnti" in plan
