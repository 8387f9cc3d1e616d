"""Every registered query against its SQL on the same data."""

import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

from adstream.plans.catalog import QUERIES  # noqa: E402
from adstream.plans.oracle import ORACLE_SQL  # noqa: E402
from conftest import TESTDATA  # noqa: E402

# The library's own queries; those of the subpackage for training data have tests of their own.
BATCH = [q for q in QUERIES if not q.startswith(("stream_", "medallion"))]
STREAMING = [q for q in QUERIES if q not in BATCH]


def _rows(frame: pd.DataFrame) -> list[str]:
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(repr([getattr(v, "isoformat", lambda v=v: v)() for v in row]) for row in plain.values.tolist())


def _check(spark, name, sf):
    data = f"{TESTDATA}/sf{sf}"
    ours = contract.queries()[name](spark, data).toPandas()
    database = duckdb.connect()
    database.execute(f"CREATE VIEW events AS SELECT * FROM '{data}/events.parquet'")
    theirs = database.execute(contract.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert _rows(ours) == _rows(theirs)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", BATCH)
def test_batch_query(spark, name):
    _check(spark, name, "0.01")


@pytest.mark.parametrize("name", STREAMING)
def test_streaming_query(spark, name):
    _check(spark, name, "0.001")


def test_entry(spark):
    assert contract.entry(spark).count() == 192


def test_alerts_count_every_click_once(spark):
    from pyspark.sql import functions as F

    for name in ("alerts_1min", "alerts_10min", "alerts_daily"):
        alerts = contract.queries()[name](spark, f"{TESTDATA}/sf0.01")
        assert alerts.agg(F.sum("total_clicks")).first()[0] == 2006


# Counts of the fixture notes, at the scale of their discriminating column.
def test_known_counts(spark):
    from pyspark.sql import functions as F

    data = f"{TESTDATA}/sf0.01"
    count = {}
    for name in ("flag_clicks_batch", "flag_clicks_10min", "flag_clicks_daily"):
        row = contract.queries()[name](spark, data).agg(
            F.count_if("is_click_flood"), F.count_if("is_bot_ip"), F.count_if("is_fraud")
        )
        count[name] = tuple(row.first())
    assert count == {
        "flag_clicks_batch": (1175, 1441, 1784),
        "flag_clicks_10min": (6, 90, 170),
        "flag_clicks_daily": (746, 513, 1048),
    }
    orphans = contract.queries()["flag_orphans"](spark, data)
    prior = contract.queries()["orphans_prior_only"](spark, data)
    assert orphans.filter("is_fraud").count() == 3284
    assert prior.filter("is_fraud").count() == 3639
