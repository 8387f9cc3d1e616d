"""Keyed tables that grow by merging: a log of runs, few of which are ever read.

Each micro-batch adds a run of changes, split by date. Runs of one size are merged into one
of the next size, so there are about ``fan`` for each power of it, and a row is rewritten
once per power, however many batches there were. A manifest names the runs that count;
it is replaced as a whole, so readers see a batch or a merge fully or not at all.

Changes of one key are either added up (``Sums``) or the newest one stands (``Newest``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from adstream.sources import storage
from adstream.sources.dated import utc_date

FAN = 8
# Manifests that are kept for readers that began before the newest one.
_KEPT = 3
_VERSION, _DATE = "_version", "_event_date"


@dataclass(frozen=True)
class Sums:
    """Changes add up; a sum of NULLs only is NULL, so additions may come in any parts."""

    keys: tuple[str, ...]
    values: tuple[str, ...]
    time: str

    def merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(_DATE, *self.keys).agg(
            *(F.sum(v).alias(v) for v in self.values), F.max(_VERSION).alias(_VERSION)
        )


@dataclass(frozen=True)
class Newest:
    """Of the changes of a key that of the last batch stands."""

    keys: tuple[str, ...]
    values: tuple[str, ...]
    time: str

    def merged(self, rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*self.values), _VERSION).alias("_newest")
        kept = rows.groupBy(_DATE, *self.keys).agg(newest, F.max(_VERSION).alias(_VERSION))
        return kept.select(_DATE, *self.keys, "_newest.*", _VERSION)


Merge = Sums | Newest


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    names = [n for n in storage.names(spark, f"{path}/manifest") if n.endswith(".json")]
    if not names:
        return -1, {"applied": -1, "runs": []}
    return int(names[-1].split(".")[0]), json.loads(storage.read_text(spark, f"{path}/manifest/{names[-1]}"))


def _commit(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    storage.make_directory(spark, f"{path}/manifest")
    storage.write_text(spark, f"{path}/manifest/{number:012d}.json", json.dumps(manifest))


def applied_upto(spark: SparkSession, path: str) -> int:
    """The newest batch in the table, -1 if there is none."""
    return _manifest(spark, path)[1]["applied"]


def apply_changes(changes: DataFrame, path: str, batch_id: int, merge: Merge, fan: int = FAN) -> bool:
    """Add a micro-batch's changes, one row per key; False if they were added before."""
    spark = changes.sparkSession
    number, manifest = _manifest(spark, path)
    if batch_id <= manifest["applied"]:
        return False
    size = Observation()
    rows = changes.select(*merge.keys, *merge.values).withColumns(
        {_VERSION: F.lit(batch_id).cast("long"), _DATE: utc_date(F.col(merge.time))}
    )
    name = f"{batch_id}-{batch_id}"
    counted = rows.observe(size, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite").partitionBy(_DATE).parquet(f"{path}/runs/{name}")
    runs = manifest["runs"]
    if size.get["n"]:
        runs = [*runs, {"name": name, "first": batch_id, "last": batch_id, "level": 0}]
    _commit(spark, path, number + 1, {"applied": batch_id, "runs": runs})
    _merge_runs(spark, path, rows.schema, merge, fan)
    return True


def _merge_runs(spark: SparkSession, path: str, schema: StructType, merge: Merge, fan: int) -> None:
    """Merge the newest runs of one level as soon as there are ``fan`` of them, then those of the next level."""
    while True:
        number, manifest = _manifest(spark, path)
        runs = manifest["runs"]
        level = runs[-1]["level"] if runs else 0
        tail = [run for run in runs if run["level"] == level]
        if len(tail) < fan:
            return
        name = f"{tail[0]['first']}-{tail[-1]['last']}"
        merged = merge.merged(_read_runs(spark, path, tail, schema))
        merged.select(schema.fieldNames()).write.mode("overwrite").partitionBy(_DATE).parquet(f"{path}/runs/{name}")
        run = {"name": name, "first": tail[0]["first"], "last": tail[-1]["last"], "level": level + 1}
        rest = [r for r in runs if r["level"] != level]
        _commit(spark, path, number + 1, {"applied": manifest["applied"], "runs": [*rest, run]})
        _forget(spark, path)


def _forget(spark: SparkSession, path: str) -> None:
    """Remove old manifests, and the runs that no manifest left names."""
    names = [n for n in storage.names(spark, f"{path}/manifest") if n.endswith(".json")]
    for old in names[:-_KEPT]:
        storage.delete(spark, f"{path}/manifest/{old}")
    needed, applied = set(), -1
    for name in names[-_KEPT:]:
        manifest = json.loads(storage.read_text(spark, f"{path}/manifest/{name}"))
        needed |= {run["name"] for run in manifest["runs"]}
        applied = max(applied, manifest["applied"])
    for run in storage.names(spark, f"{path}/runs"):
        if run not in needed and int(run.split("-")[1]) <= applied:
            storage.delete(spark, f"{path}/runs/{run}")


def _read_runs(spark: SparkSession, path: str, runs: list[dict], schema: StructType) -> DataFrame:
    parts = [spark.read.schema(schema).parquet(f"{path}/runs/{run['name']}").select(schema.fieldNames()) for run in runs]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def read_merged(
    spark: SparkSession, path: str, schema: StructType, merge: Merge, days: tuple[Column, Column] | None = None
) -> DataFrame:
    """One row per key as it is now; ``days`` (first, last) reads only the directories of these dates."""
    fields = [schema[c] for c in (*merge.keys, *merge.values)]
    stored = StructType([*fields, StructField(_VERSION, LongType()), StructField(_DATE, DateType())])
    runs = _manifest(spark, path)[1]["runs"]
    columns = [f.name for f in fields]
    if not runs:
        return spark.createDataFrame([], StructType(fields))
    rows = _read_runs(spark, path, runs, stored)
    if days is not None:
        rows = rows.filter((F.col(_DATE) >= days[0]) & (F.col(_DATE) <= days[1]))
    return merge.merged(rows).select(columns)
