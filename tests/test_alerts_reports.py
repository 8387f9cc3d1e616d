"""Alerts, reports and the removal of copies."""

import pytest

from adstream import dedupe_events, fraud_alerts
from adstream.plans import reports
from adstream.schemas import GOLD_ALERT, SILVER_CLICK
from conftest import F, NOON, at, click_frame, plan_of, rows_of


def silver(spark, rows):
    defaults = {
        "event_id": "k",
        "campaign_id": "C1",
        "timestamp": NOON,
        **dict.fromkeys(("is_click_flood", "is_bot_ip", "is_instant_click", "is_fraud"), False),
    }
    schema = type(SILVER_CLICK).fromJson(SILVER_CLICK.jsonValue())
    schema["event_id"].nullable = True
    values = [tuple({**defaults, **r}.get(c) for c in schema.fieldNames()) for r in rows]
    return spark.createDataFrame(values, schema)


def test_counts_and_rate(spark):
    rows = [{"is_fraud": True, "is_bot_ip": True}, {}, {}]
    alert = fraud_alerts(silver(spark, rows)).first()
    assert alert.asDict() == {
        "campaign_id": "C1",
        "window_start": at("10:00"),
        "window_end": at("10:01"),
        "total_clicks": 3,
        "fraud_clicks": 1,
        "fraud_rate": 0.3333,
        "flood_clicks": 0,
        "bot_ip_clicks": 1,
        "instant_clicks": 0,
    }


def test_columns_and_types(spark):
    alerts = fraud_alerts(silver(spark, [{}]))
    assert [(f.name, f.dataType) for f in alerts.schema] == [(f.name, f.dataType) for f in GOLD_ALERT]


def test_only_unknown_flags_give_unknown_counts(spark):
    unknown = dict.fromkeys(("is_click_flood", "is_bot_ip", "is_instant_click", "is_fraud"))
    alert = fraud_alerts(silver(spark, [unknown, unknown])).first()
    assert alert["total_clicks"] == 2
    assert alert["fraud_clicks"] is None and alert["fraud_rate"] is None


def test_no_click_with_an_id(spark):
    alert = fraud_alerts(silver(spark, [{"event_id": None, "is_fraud": True}])).first()
    assert alert["total_clicks"] == 0 and alert["fraud_clicks"] == 1 and alert["fraud_rate"] is None


def test_windows(spark):
    rows = [{"timestamp": at("10:00:59")}, {"timestamp": at("10:01:00")}, {"timestamp": None}]
    found = rows_of(fraud_alerts(silver(spark, rows)), "window_start", "total_clicks")
    assert found == [(at("10:00"), 1), (at("10:01"), 1)]


def test_null_campaign_is_a_group(spark):
    found = rows_of(fraud_alerts(silver(spark, [{"campaign_id": None}, {}])), "campaign_id", "total_clicks")
    assert found == [("C1", 1), (None, 1)]


def test_totals_and_share(spark):
    flagged = silver(spark, [{"is_fraud": True}, {"is_fraud": None}, {}])
    assert reports.fraud_totals(flagged).first().asDict() == {
        "total_clicks": 3,
        "fraud_clicks": 1,
        "fraud_pct": 33.3,
    }
    assert tuple(reports.fraud_totals(flagged.limit(0)).first()) == (0, 0, None)


def test_samples_are_ordered(spark):
    rows = [{"event_id": e, "timestamp": at(t), "is_fraud": f} for e, t, f in [
        ("c", "10:00", True), ("a", "10:01", True), ("b", "10:00", True), ("d", "09:00", None), ("e", "08:00", False)
    ]]
    flagged = silver(spark, rows)
    assert [r[0] for r in reports.click_sample(flagged, 3).collect()] == ["e", "d", "b"]
    assert [r[0] for r in reports.fraud_click_sample(flagged, 2).collect()] == ["b", "c"]


def test_top_alerts(spark):
    alerts = spark.createDataFrame(
        [("C1", 0.5), ("C2", None), ("C3", 0.9), ("C4", 0.5)], "campaign_id STRING, fraud_rate DOUBLE"
    ).withColumn("window_start", F.lit(NOON))
    top = reports.top_alerts(alerts, 3)
    assert [r[0] for r in top.collect()] == ["C3", "C1", "C4"]
    assert [r[0] for r in reports.top_alerts(alerts).collect()][-1] == "C2"
    assert "TakeOrderedAndProject(limit=3," in plan_of(top)


def test_orphan_report(spark):
    rows = spark.createDataFrame(
        [("v1", "k1", "C1", 1.0, True, NOON), ("v2", "k2", "C1", 2.0, False, NOON), ("v0", None, "C1", 3.0, True, NOON)],
        "event_id STRING, click_id STRING, campaign_id STRING, revenue_usd DOUBLE,"
        "is_orphan_conversion BOOLEAN, timestamp TIMESTAMP",
    )
    assert [r["event_id"] for r in reports.orphan_report(rows).collect()] == ["v0", "v1"]


def test_filters_reach_the_scan(spark, tmp_path):
    silver(spark, [{"is_fraud": True}]).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert "EqualTo(is_fraud,true)" in plan_of(reports.fraud_click_sample(table))
    assert "ReadSchema: struct<is_fraud:boolean>" in plan_of(reports.fraud_totals(table))


@pytest.mark.parametrize("copies", [1, 3])
def test_dedupe_keeps_the_earliest_and_all_without_id(spark, copies):
    rows = [
        {"event_id": "a", "timestamp": at("10:05"), "user_id": "late"},
        {"event_id": "a", "timestamp": at("10:00"), "user_id": "early"},
        {"event_id": "b"},
        {"event_id": None},
        {"event_id": None},
    ] * copies
    clicks = click_frame(spark, rows)
    kept = dedupe_events(clicks)
    assert kept.columns == clicks.columns
    assert rows_of(kept, "event_id", "user_id") == sorted(
        [("a", "early"), ("b", "U1")] + [(None, "U1")] * 2 * copies, key=repr
    )
