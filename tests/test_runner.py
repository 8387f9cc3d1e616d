"""The whole application over files of messages."""

import pytest

from adstream import FraudRules, TablePaths, encode_events, run_pipeline
from adstream.__main__ import main
from adstream.plans.reports import all_reports
from adstream.schemas import CLICK, CONVERSION, GOLD_ALERT, IMPRESSION, SILVER_CLICK, SILVER_CONVERSION
from adstream.sources import tables
from adstream.streaming.runner import await_first_end
from conftest import F, NOON, at, click_frame, conversion_frame, rows_of

NOW = {"availableNow": True}
END = NOON.replace(year=2100)


@pytest.fixture
def topics(spark, feed):
    """Three topics; the clicks hold one flood of three, and each topic is closed."""
    sources = {t: feed(t) for t in ("impressions", "clicks", "conversions")}
    impression = spark.createDataFrame([("i1",)], "event_id STRING").withColumn("timestamp", F.lit(NOON))
    sources["impressions"].add(encode_events(impression))
    rows = [{"event_id": f"k{i}", "timestamp": at(f"10:0{i}")} for i in range(3)]
    rows.append({"event_id": "k9", "user_id": "calm", "time_since_impression_ms": 50})
    sources["clicks"].add(encode_events(click_frame(spark, rows)))
    wanted = [{"event_id": "v1", "click_id": "k0"}, {"event_id": "v2", "click_id": "none"}]
    sources["conversions"].add(encode_events(conversion_frame(spark, wanted)))
    for day in (1, 2):
        end = {"event_id": "end", "click_id": "end", "user_id": None, "timestamp": END.replace(day=day)}
        sources["clicks"].add(encode_events(click_frame(spark, [end])))
        sources["conversions"].add(encode_events(conversion_frame(spark, [end])))
    return sources


def _run(spark, topics, root, **settings):
    options = {t: {"path": str(s.root), "maxFilesPerTrigger": "1"} for t, s in topics.items()}
    settings = {"rules": FraudRules(flood_clicks=2), "trigger": NOW, **settings}
    return run_pipeline(spark, "parquet", options, TablePaths(str(root)), **settings)


def _before_the_end(frame, time="timestamp"):
    return frame.filter(F.col(time) < F.lit(NOON.replace(year=2099)))


@pytest.mark.parametrize(
    "settings",
    [
        {"click_scope": "window", "alert_mode": "complete", "from_bronze": True},
        {"click_scope": "window", "alert_mode": "append", "from_bronze": False},
        {"click_scope": "batch", "alert_mode": "update", "from_bronze": True, "dedupe": True},
        {"click_scope": "deferred", "alert_mode": "merge", "from_bronze": True},
    ],
)
def test_all_layers(spark, tmp_path, topics, settings):
    paths = TablePaths(str(tmp_path / "lake"))
    queries = _run(spark, topics, paths.root, **settings)
    assert sorted(queries) == [
        "bronze_clicks",
        "bronze_conversions",
        "bronze_impressions",
        "gold_fraud_alerts",
        "silver_clicks",
        "silver_conversions",
    ]
    assert all(q.exception() is None and not q.isActive for q in queries.values())
    assert tables.read_table(spark, paths.bronze("impressions"), IMPRESSION).count() == 1
    assert tables.read_table(spark, paths.bronze("clicks"), CLICK).count() == 6
    assert tables.read_table(spark, paths.bronze("conversions"), CONVERSION).count() == 4

    silver = _before_the_end(tables.read_table(spark, paths.silver("clicks"), SILVER_CLICK))
    assert rows_of(silver, "event_id", "is_click_flood", "is_fraud") == [
        ("k0", True, True),
        ("k1", True, True),
        ("k2", True, True),
        ("k9", False, True),
    ]
    orphans = _before_the_end(tables.read_table(spark, paths.silver("conversions"), SILVER_CONVERSION))
    assert rows_of(orphans, "event_id", "is_orphan_conversion") == [("v1", False), ("v2", True)]

    current = tables.read_alerts(spark, paths.gold(), settings["alert_mode"])
    alerts = _before_the_end(current, "window_start")
    minutes = rows_of(alerts.select(F.minute("window_start"), "total_clicks", "fraud_clicks", "flood_clicks"))
    assert minutes == [(0, 2, 2, 1), (1, 1, 1, 1), (2, 1, 1, 1)]


def test_a_second_run_adds_only_what_is_new(spark, tmp_path, topics):
    paths = TablePaths(str(tmp_path / "lake"))
    _run(spark, topics, paths.root, click_scope="batch", alert_mode="complete")
    before = tables.read_table(spark, paths.silver("clicks"), SILVER_CLICK).count()
    _run(spark, topics, paths.root, click_scope="batch", alert_mode="complete")
    assert tables.read_table(spark, paths.silver("clicks"), SILVER_CLICK).count() == before == 6
    topics["clicks"].add(encode_events(click_frame(spark, [{"event_id": "new", "timestamp": END}])))
    _run(spark, topics, paths.root, click_scope="batch", alert_mode="complete")
    assert tables.read_table(spark, paths.silver("clicks"), SILVER_CLICK).count() == 7
    alerts = tables.read_latest(spark, paths.gold(), GOLD_ALERT)
    assert alerts.agg(F.sum("total_clicks")).first()[0] == 7


def test_raw_text_in_bronze(spark, tmp_path, topics):
    paths = TablePaths(str(tmp_path / "lake"))
    _run(spark, topics, paths.root, click_scope="batch", keep_raw=True)
    assert spark.read.parquet(paths.bronze("clicks")).filter("raw LIKE '{%}'").count() == 6


def test_continuous_queries_run_together(spark, tmp_path, topics):
    queries = _run(
        spark,
        topics,
        tmp_path / "lake",
        click_scope="batch",
        alert_mode="complete",
        trigger={"processingTime": "1 second"},
    )
    try:
        assert len(queries) == 6 and all(q.isActive for q in queries.values())
        for name in ("bronze_clicks", "silver_clicks", "gold_fraud_alerts"):
            queries[name].processAllAvailable()
        alerts = tables.read_latest(spark, str(tmp_path / "lake" / "gold" / "fraud_alerts"), GOLD_ALERT)
        assert alerts.count() > 0
    finally:
        for query in queries.values():
            query.stop()
    await_first_end(spark)


def test_no_click_is_lost_by_default(spark, tmp_path, topics):
    """Late clicks reach silver and gold, though their windows have closed; copies are removed on request."""
    paths = TablePaths(str(tmp_path / "lake"))
    _run(spark, topics, paths.root, dedupe=True)
    late = [{"event_id": f"late{i}", "timestamp": at("10:02")} for i in range(2)]
    topics["clicks"].add(encode_events(click_frame(spark, late)))
    paths_too = TablePaths(str(tmp_path / "too"))
    for queries in (_run(spark, topics, paths.root, dedupe=True), _run(spark, topics, paths_too.root)):
        assert all(q.exception() is None for q in queries.values())
    # Removing copies needs a bounded memory of ids, so it drops what comes too late.
    assert _before_the_end(tables.read_table(spark, paths.silver("clicks"), SILVER_CLICK)).count() == 4
    _run(spark, topics, paths_too.root)
    topics["clicks"].add(encode_events(click_frame(spark, [{"event_id": "late9", "timestamp": at("10:01")}])))
    _run(spark, topics, paths_too.root)
    silver = _before_the_end(tables.read_table(spark, paths_too.silver("clicks"), SILVER_CLICK))
    assert silver.count() == 7 and silver.filter("event_id = 'late9' AND is_click_flood").count() == 1
    alerts = _before_the_end(tables.read_alerts(spark, paths_too.gold(), "merge"), "window_start")
    assert alerts.agg(F.sum("total_clicks")).first()[0] == 7


def test_deferred_flags_need_a_bronze_table(spark, tmp_path, topics):
    with pytest.raises(ValueError, match="bronze"):
        _run(spark, topics, tmp_path, click_scope="deferred", from_bronze=False)


def test_unknown_scope_is_refused(spark, tmp_path, topics):
    with pytest.raises(ValueError, match="scope"):
        _run(spark, topics, tmp_path, click_scope="other")


def test_command_line(spark, tmp_path, capsys):
    topics, root = tmp_path / "topics", tmp_path / "lake"
    encode_events(click_frame(spark, [{"time_since_impression_ms": 5}])).write.parquet(f"{topics}/ad-clicks")
    encode_events(conversion_frame(spark, [{}])).write.parquet(f"{topics}/ad-conversions")
    encode_events(click_frame(spark, [{}]).select("event_id")).write.parquet(f"{topics}/ad-impressions")
    common = ["--root", str(root), "--alert-mode", "update"]
    main(["run", *common, "--format", "parquet", "--topics", str(topics), "--click-scope", "batch", "--once"])
    main(["report", *common])
    shown = capsys.readouterr().out
    assert "Silver: share of fraudulent clicks" in shown and "100.0" in shown
    reports = all_reports(spark, TablePaths(str(root)), "update")
    assert [frame.count() for frame in reports.values()] == [1, 1, 1, 1, 0]
