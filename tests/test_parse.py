"""Messages to rows: the permissive parser and the encoder."""

import datetime as dt

import pytest
from pyspark.sql.types import StructType

from adstream import encode_events, parse_events
from adstream.schemas import CLICK, MESSAGES
from adstream.sources.messages import TOPICS, kafka_options, read_events
from conftest import at, click_frame, rows_of

CASES = [
    ('{"event_id":"a","time_since_impression_ms":5,"timestamp":"2024-01-01T00:00:07.179575+00:00"}',
     ("a", 5, dt.datetime(2024, 1, 1, 0, 0, 7, 179575))),
    ('{"event_id":"b","time_since_impression_ms":5.5,"timestamp":"2024-01-01T00:00:07+02:00"}',
     ("b", None, dt.datetime(2023, 12, 31, 22, 0, 7))),
    ('{"time_since_impression_ms":5,"timestamp":"nope"}', (None, 5, None)),
    ("not json", (None, None, None)),
    ('{"event_id":"e","time_since_impression_ms":"7","timestamp":"2024-01-01 00:00:00"}',
     ("e", None, dt.datetime(2024, 1, 1))),
    (None, (None, None, None)),
    ('{"event_id":"f","time_since_impression_ms":99999999999,"timestamp":null}', ("f", None, None)),
    ('{"event_id":12,"extra":1}', ("12", None, None)),
]


@pytest.mark.parametrize(("payload", "expected"), CASES)
def test_permissive_parse(spark, payload, expected):
    value = None if payload is None else bytearray(payload, "utf-8")
    messages = spark.createDataFrame([(value,)], "value BINARY")
    parsed = parse_events(messages, CLICK)
    assert parsed.columns == CLICK.fieldNames()
    row = parsed.select("event_id", "time_since_impression_ms", "timestamp").first()
    assert tuple(row) == expected


def test_raw_text_is_kept_on_request(spark):
    messages = spark.createDataFrame([(bytearray(b"not json"),)], "value BINARY")
    row = parse_events(messages, CLICK, keep_raw=True).first()
    assert row["raw"] == "not json" and row["event_id"] is None


def test_text_messages_need_no_bytes(spark):
    messages = spark.createDataFrame([('{"event_id":"é"}',)], "value STRING")
    assert parse_events(messages, CLICK).first()["event_id"] == "é"


def test_encode_keeps_microseconds_and_types(spark):
    moment = at("10:00").replace(microsecond=123456)
    clicks = click_frame(spark, [{"event_id": "a", "timestamp": moment}, {"event_id": "b", "user_id": None}])
    encoded = encode_events(clicks)
    assert encoded.columns == ["value"] and encoded.schema["value"].dataType.typeName() == "binary"
    assert rows_of(parse_events(encoded, CLICK)) == rows_of(clicks)


def test_only_the_needed_part_of_the_json_is_parsed_once(spark):
    messages = spark.createDataFrame([(bytearray(b"{}"),)], "value BINARY")
    plan = parse_events(messages, CLICK)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_stream_of_text_messages(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.txt").write_text('{"event_id":"a"}\nnot json\n')
    stream = read_events(spark, "text", {"path": str(tmp_path / "topic")}, CLICK)
    query = stream.writeStream.format("memory").queryName("texts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows_of(spark.table("texts"), "event_id") == [("a",), (None,)]


def test_kafka_options():
    plain = kafka_options("host:9092", TOPICS["clicks"])
    assert plain == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "ad-clicks",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    secured = kafka_options("host:9092", "t", "me", "secret", max_offsets_per_trigger=5)
    assert secured["kafka.security.protocol"] == "SASL_SSL"
    assert secured["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="me" password="secret";' in secured["kafka.sasl.jaas.config"]
    assert secured["maxOffsetsPerTrigger"] == "5"


def test_declared_schemas():
    assert set(MESSAGES) == set(TOPICS)
    for schema in MESSAGES.values():
        assert isinstance(schema, StructType) and not schema["event_id"].nullable


def test_long_user_ids_stay_whole(spark):
    from adstream.sources import adevents

    row = "0L, TIMESTAMP_NTZ'2024-01-01', {}L, 'click', 1e12D, '{{\"k\": 1}}'"
    values = ", ".join(f"({row.format(u)})" for u in (7, 123456, 123457))
    events = spark.sql(f"SELECT * FROM VALUES {values} AS t(event_id, ts, user_id, event_type, value, props)")
    clicks = adevents.clicks(events).select("user_id", "time_since_impression_ms").collect()
    assert sorted(r["user_id"] for r in clicks) == ["U00007", "U123456", "U123457"]
    assert {r["time_since_impression_ms"] for r in clicks} == {None}
