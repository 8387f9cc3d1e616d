import datetime as dt
import os
import sys
import time
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from adstream import build_session  # noqa: E402
from adstream.schemas import CLICK, CONVERSION  # noqa: E402

TESTDATA = "/root/testdata"
NOON = dt.datetime(2024, 5, 1, 10, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "adstream-tests",
        master="local[4]",
        options={
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.sql.session.timeZone": "UTC",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    """A time of day on the test date."""
    hours, minutes, *seconds = text.split(":")
    return NOON.replace(hour=int(hours), minute=int(minutes), second=int(seconds[0]) if seconds else 0)


def _frame(spark, schema, defaults, rows):
    names = schema.fieldNames()
    values = [tuple({**defaults, **row}.get(n) for n in names) for row in rows]
    relaxed = type(schema).fromJson(schema.jsonValue())
    for field in relaxed.fields:
        field.nullable = True
    return spark.createDataFrame(values, relaxed)


def click_frame(spark, rows):
    """Clicks with defaults that no rule flags."""
    defaults = {
        "event_id": "k",
        "event_type": "click",
        "user_id": "U1",
        "campaign_id": "C1",
        "ip_address": "1.1.1.1",
        "time_since_impression_ms": 5000,
        "timestamp": NOON,
        "fraud_label": "normal",
    }
    return _frame(spark, CLICK, defaults, rows)


def conversion_frame(spark, rows):
    defaults = {
        "event_id": "v",
        "event_type": "conversion",
        "click_id": "k",
        "campaign_id": "C1",
        "revenue_usd": 1.5,
        "timestamp": NOON,
        "fraud_label": "normal",
    }
    return _frame(spark, CONVERSION, defaults, rows)


class Feed:
    """A directory of Parquet files that a stream reads one by one, in the order added."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, Path(root), 0
        self.root.mkdir(parents=True)

    def add(self, frame):
        self.schema = frame.schema
        staging = self.root.parent / f"{self.root.name}-staging-{self.n}"
        frame.coalesce(1).write.parquet(str(staging))
        (part,) = staging.glob("*.parquet")
        target = self.root / f"{self.n:04d}.parquet"
        os.link(part, target)
        moment = time.time() - 10_000 + self.n
        os.utime(target, (moment, moment))
        self.n += 1
        return self

    def stream(self, watermark="10 minutes"):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        rows = reader.parquet(str(self.root))
        return rows.withWatermark("timestamp", watermark) if watermark else rows


@pytest.fixture
def feed(spark, tmp_path):
    return lambda name="feed": Feed(spark, tmp_path / name)


def run_to_end(stream, path, checkpoint=None, mode="append"):
    """Run a stream over all that is there; returns the query."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", str(path))
        .option("checkpointLocation", str(checkpoint or f"{path}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def rows_of(frame, *columns):
    """Rows as a sorted list of tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_of(frame):
    """The physical plan as text, before any adaptive change."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[-1]


@contextmanager
def plain_shuffle(spark):
    """Eight shuffle partitions that stay as they are, and no automatic broadcast."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def flags(frame, column, key="event_id"):
    return {r[key]: r[column] for r in frame.select(key, column).collect()}


__all__ = ["F", "TESTDATA", "at", "click_frame", "conversion_frame", "flags", "plain_shuffle", "plan_of", "rows_of", "run_to_end"]
