"""The orphan rule on tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adstream import FraudRules, LookupLimits, flag_orphans, orphan_conversions
from adstream.schemas import CONVERSION, SILVER_CONVERSION
from conftest import F, NOON, at, click_frame, conversion_frame, flags, plain_shuffle, plan_of, rows_of

FORMS = pytest.mark.parametrize("per_click", [True, False])


@FORMS
@pytest.mark.parametrize(
    ("when", "both_ways", "prior"),
    [
        ("10:30:00", False, False),
        ("10:30:01", True, True),
        ("09:30:00", False, True),
        ("09:29:59", True, True),
        ("10:00:00", False, False),
    ],
)
def test_reach_is_inclusive(spark, when, both_ways, prior, per_click):
    clicks = click_frame(spark, [{"event_id": "k", "timestamp": at("10:00")}])
    conversions = conversion_frame(spark, [{"click_id": "k", "timestamp": at(when)}])
    for prior_only, expected in ((False, both_ways), (True, prior)):
        row = flag_orphans(conversions, clicks, prior_only=prior_only, per_click=per_click).first()
        assert row["is_orphan_conversion"] is expected and row["is_fraud"] is expected
        assert orphan_conversions(conversions, clicks, prior_only=prior_only).count() == int(expected)


@FORMS
def test_unmatched_conversions_are_kept(spark, per_click):
    clicks = click_frame(spark, [{"event_id": "k"}, {"event_id": None}, {"event_id": "x", "timestamp": None}])
    conversions = conversion_frame(
        spark,
        [
            {"event_id": "a", "click_id": None},
            {"event_id": "b", "click_id": "unknown"},
            {"event_id": "c", "click_id": "k", "timestamp": None},
            {"event_id": "d", "click_id": "x"},
            {"event_id": "e", "click_id": "k"},
        ],
    )
    flagged = flag_orphans(conversions, clicks, per_click=per_click)
    assert flagged.columns == SILVER_CONVERSION.fieldNames()
    expected = {"a": True, "b": True, "c": True, "d": True, "e": False}
    assert flags(flagged, "is_orphan_conversion") == expected
    assert rows_of(orphan_conversions(conversions, clicks), "event_id") == [("a",), ("b",), ("c",), ("d",)]
    assert orphan_conversions(conversions, clicks).columns == CONVERSION.fieldNames()


def test_repeated_click_ids_repeat_the_conversion(spark):
    times = ["10:00", "10:01", "10:01", "12:00"]
    clicks = click_frame(spark, [{"event_id": "k", "timestamp": at(t)} for t in times])
    conversions = conversion_frame(spark, [{"click_id": "k", "timestamp": at("10:05")}])
    assert flags(flag_orphans(conversions, clicks), "is_fraud") == {"v": False}
    assert flag_orphans(conversions, clicks).count() == 3
    assert flag_orphans(conversions, clicks, per_click=False).count() == 1


def test_many_copies_of_a_click(spark):
    one = click_frame(spark, [{"event_id": "k"}])
    clicks = one.crossJoin(spark.range(25_000)).drop("id")
    conversions = conversion_frame(spark, [{"event_id": "v"}, {"event_id": "w", "click_id": "other"}])
    counts = dict(flag_orphans(conversions, clicks).groupBy("event_id").count().collect())
    assert counts == {"v": 25_000, "w": 1}


def test_matches_across_midnight(spark):
    clicks = click_frame(spark, [{"event_id": "k", "timestamp": dt.datetime(2024, 5, 1, 23, 50)}])
    conversions = conversion_frame(spark, [{"click_id": "k", "timestamp": dt.datetime(2024, 5, 2, 0, 15)}])
    assert flags(flag_orphans(conversions, clicks), "is_fraud") == {"v": False}


def test_a_tolerance_longer_than_a_day(spark):
    rules = FraudRules(tolerance="60 hours")
    clicks = click_frame(spark, [{"event_id": "k", "timestamp": NOON}])
    conversions = conversion_frame(
        spark,
        [
            {"event_id": "a", "timestamp": NOON + dt.timedelta(hours=60)},
            {"event_id": "b", "timestamp": NOON + dt.timedelta(hours=61)},
        ],
    )
    for per_click in (True, False):
        flagged = flag_orphans(conversions, clicks, rules, per_click=per_click)
        assert flags(flagged, "is_fraud") == {"a": False, "b": True}


MINUTES = st.integers(min_value=-100, max_value=100)
CLICKS = st.lists(st.tuples(st.sampled_from(["k1", "k2", None]), st.one_of(st.none(), MINUTES)), max_size=12)
CONVERSIONS = st.lists(
    st.tuples(st.sampled_from(["k1", "k2", "k3", None]), st.one_of(st.none(), MINUTES)), min_size=1, max_size=8
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(clicks=CLICKS, conversions=CONVERSIONS, prior_only=st.booleans(), heavy=st.booleans())
def test_all_forms_equal_brute_force(spark, clicks, conversions, prior_only, heavy):
    # In half of the cases an id counts as much-used as soon as it occurs twice.
    rules = FraudRules(limits=LookupLimits(heavy_rows=2) if heavy else LookupLimits())

    def moment(minutes):
        return None if minutes is None else NOON + dt.timedelta(minutes=minutes)

    expected = {}
    for i, (wanted, time) in enumerate(conversions):
        expected[f"v{i}"] = sum(
            None not in (wanted, time, when)
            and key == wanted
            and time - 30 <= when <= (time if prior_only else time + 30)
            for key, when in clicks
        )
    k = click_frame(spark, [{"event_id": key, "timestamp": moment(when)} for key, when in clicks])
    v = conversion_frame(
        spark,
        [{"event_id": f"v{i}", "click_id": c, "timestamp": moment(t)} for i, (c, t) in enumerate(conversions)],
    )
    for per_click in (True, False):
        flagged = flag_orphans(v, k, rules, prior_only=prior_only, per_click=per_click)
        assert flags(flagged, "is_orphan_conversion") == {e: n == 0 for e, n in expected.items()}
        counts = dict(flagged.groupBy("event_id").count().collect())
        assert counts == {e: max(n, 1) if per_click else 1 for e, n in expected.items()}
    orphans = orphan_conversions(v, k, rules, prior_only=prior_only)
    assert rows_of(orphans, "event_id") == sorted((e,) for e, n in expected.items() if n == 0)


def test_conversions_without_click_id_are_spread(spark):
    conversions = spark.range(20_000, numPartitions=8).select(
        F.concat(F.lit("v"), "id").alias("event_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("click_id", "impression_id", "user_id", "campaign_id")],
        F.lit("purchase").alias("conversion_type"),
        F.lit(1.0).alias("revenue_usd"),
        F.lit(NOON).alias("timestamp"),
        F.lit("normal").alias("fraud_label"),
    )
    clicks = click_frame(spark, [{}])
    with plain_shuffle(spark):
        for flagged in (flag_orphans(conversions, clicks), flag_orphans(conversions, clicks, per_click=False)):
            sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 20_000 and max(sizes) < 7_000


def test_a_much_used_click_id_is_split(spark):
    conversions = spark.range(20_000, numPartitions=8).select(
        F.concat(F.lit("v"), "id").alias("event_id"),
        F.lit("k").alias("click_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("impression_id", "user_id", "campaign_id")],
        F.lit("purchase").alias("conversion_type"),
        F.lit(1.0).alias("revenue_usd"),
        F.lit(NOON).alias("timestamp"),
        F.lit("normal").alias("fraud_label"),
    )
    clicks = click_frame(spark, [{"event_id": "k"}])
    rules = FraudRules(limits=LookupLimits(heavy_rows=1000))
    with plain_shuffle(spark):
        flagged = flag_orphans(conversions, clicks, rules, per_click=False)
        parts = flagged.groupBy(F.spark_partition_id()).agg(F.count_if("is_fraud"), F.count("*")).collect()
    assert sum(p[1] for p in parts) == 0 and sum(p[2] for p in parts) == 20_000
    assert max(p[2] for p in parts) < 7_000


def test_click_side_is_narrow(spark, tmp_path):
    click_frame(spark, [{}]).write.parquet(str(tmp_path / "clicks"))
    plan = plan_of(flag_orphans(conversion_frame(spark, [{}]), spark.read.parquet(str(tmp_path / "clicks"))))
    assert "ReadSchema: struct<event_id:string,timestamp:timestamp>" in plan
    assert "IsNotNull(event_id), IsNotNull(timestamp)" in plan
