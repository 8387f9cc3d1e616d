"""Tables of batches that are split by event date, and that can be packed.

A table is a directory with one ``batch_id=N`` per micro-batch, each split into
``event_date=D``. A batch appears as a whole, by the renaming of its directory. Packing
rewrites finished batches into few files per date below ``_packed``; a small log tells readers
which batches are read from where, and the packed ones are removed once every stream that
follows the table is past them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from adstream.sources import storage
from adstream.sources.tables import MAX_FILES_PER_TRIGGER

_EVENT_DATE, _BATCH = "event_date", "batch_id"


def append_dated(batch: DataFrame, path: str, batch_id: int, time: str = "timestamp") -> bool:
    """Write a micro-batch once, however often it is replayed; False if it was there.

    Rows without a time go to a date of their own. The batch is written beside the
    table and renamed into it, so nobody sees a part of it.
    """
    spark, target = batch.sparkSession, f"{path}/{_BATCH}={batch_id}"
    if storage.exists(spark, target) or batch_id <= packed_upto(spark, path):
        return False
    staged = f"{path}/_staged-{batch_id}"
    dated = batch.withColumn(_EVENT_DATE, _date(F.col(time)))
    dated.write.mode("overwrite").partitionBy(_EVENT_DATE).parquet(staged)
    storage.rename(spark, staged, target)
    return True


def _date(time: Column) -> Column:
    """The date in UTC, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(time.cast("timestamp")) / 86_400).cast("int"))


def utc_date(time: Column) -> Column:
    return _date(time)


def live_batches(spark: SparkSession, path: str) -> list[int]:
    """The batches that have directories of their own, ascending."""
    found = [n.removeprefix(f"{_BATCH}=") for n in storage.names(spark, path) if n.startswith(f"{_BATCH}=")]
    return sorted(int(n) for n in found)


def last_batch(spark: SparkSession, path: str) -> int:
    """The newest batch, -1 if there is none."""
    return max([packed_upto(spark, path), *live_batches(spark, path)])


def _log(spark: SparkSession, path: str) -> list[dict]:
    """The packed runs, as the newest entry of the log has them."""
    entries = [n for n in storage.names(spark, f"{path}/_log") if n.endswith(".json")]
    return json.loads(storage.read_text(spark, f"{path}/_log/{entries[-1]}")) if entries else []


def packed_upto(spark: SparkSession, path: str) -> int:
    return max([run["last"] for run in _log(spark, path)], default=-1)


def _stored(schema: StructType, *more: StructField) -> StructType:
    return StructType([*schema.fields, *more, StructField(_EVENT_DATE, DateType())])


_BATCH_FIELD = StructField(_BATCH, LongType())


def read_dated(
    spark: SparkSession, path: str, schema: StructType, first: int | None = None, last: int | None = None
) -> DataFrame:
    """The rows of the batches ``first`` to ``last`` with their ``batch_id`` and ``event_date``.

    A filter on ``event_date`` reaches the directories. A batch comes from a packed run or from its
    own directory, never from both, whenever the log was read. A missing file is an error.
    """
    runs = _log(spark, path)
    done = max([run["last"] for run in runs], default=-1)
    wanted = lambda a, b: (last is None or a <= last) and (first is None or b >= first)
    live = [n for n in live_batches(spark, path) if n > done and wanted(n, n)]
    packed = [f"{path}/_packed/{run['name']}" for run in runs if wanted(run["first"], run["last"])]
    columns = [*schema.fieldNames(), _BATCH, _EVENT_DATE]
    parts = [
        # Each run is a base path of its own, below which only dates are directories.
        spark.read.schema(_stored(schema, _BATCH_FIELD)).parquet(run).select(columns) for run in packed
    ]
    if live:
        reader = spark.read.schema(_stored(schema, _BATCH_FIELD)).option("basePath", path)
        parts.append(reader.parquet(*(f"{path}/{_BATCH}={n}" for n in live)).select(columns))
    if not parts:
        return spark.createDataFrame([], _stored(schema, _BATCH_FIELD)).select(columns)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    bounds = [F.col(_BATCH) >= first] if first is not None else []
    bounds += [F.col(_BATCH) <= last] if last is not None else []
    for bound in bounds:
        found = found.filter(bound)
    return found


def follow_dated(
    spark: SparkSession,
    path: str,
    schema: StructType,
    checkpoint: str,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """A stream of all rows of the table, each once, whatever is packed meanwhile.

    What was packed when the stream first started is read from there, and all later
    batches from their own directories. The start is kept with the table, under the name of the
    stream's checkpoint; packing leaves batches in place that a stream so known has not passed.
    """
    note = _follower(path, checkpoint)
    if storage.exists(spark, note):
        start = json.loads(storage.read_text(spark, note))
    else:
        runs = _log(spark, path)
        start = {
            "checkpoint": checkpoint,
            "packed": [run["name"] for run in runs],
            "last": max([run["last"] for run in runs], default=-1),
        }
        storage.write_text(spark, note, json.dumps(start))

    def reader():
        return spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)

    storage.make_directory(spark, path)
    columns = schema.fieldNames()
    stream = reader().schema(_stored(schema, _BATCH_FIELD)).parquet(path).filter(F.col(_BATCH) > start["last"])
    stream = stream.select(columns)
    for name in start["packed"]:
        packed = reader().schema(_stored(schema)).parquet(f"{path}/_packed/{name}")
        stream = stream.unionByName(packed.select(columns))
    return stream


def _follower(path: str, checkpoint: str) -> str:
    import hashlib

    return f"{path}/_followers/{hashlib.sha256(checkpoint.encode()).hexdigest()[:24]}.json"


def _passed(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether every stream known to follow the table has committed all files of the batch."""
    files = _files(spark, f"{path}/{_BATCH}={batch_id}")
    for name in storage.names(spark, f"{path}/_followers"):
        note = json.loads(storage.read_text(spark, f"{path}/_followers/{name}"))
        if batch_id > note["last"] and not files <= _committed_files(spark, note["checkpoint"]):
            return False
    return True


def _files(spark: SparkSession, path: str) -> set[str]:
    """Data files of a batch, by their path from the table's directory on."""
    parent = path.rsplit("/", 1)[-1]
    found = set()
    for date in storage.names(spark, path):
        if date.startswith(f"{_EVENT_DATE}="):
            found |= {f"{parent}/{date}/{f}" for f in storage.names(spark, f"{path}/{date}") if f.endswith(".parquet")}
    return found


def _committed_files(spark: SparkSession, checkpoint: str) -> set[str]:
    """Files of batches that a stream has committed, by the last three parts of their paths.

    The stream's log of sources numbers its entries by its own offsets; the offsets of
    the last committed batch tell how far they count.
    """
    commits = [int(n) for n in storage.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not commits:
        return set()
    lines = storage.read_text(spark, f"{checkpoint}/offsets/{max(commits)}").splitlines()[2:]
    found = set()
    for source, line in enumerate(lines):
        reached = json.loads(line)["logOffset"] if line.startswith("{") else -1
        log = f"{checkpoint}/sources/{source}"
        entries = [n for n in storage.names(spark, log) if n.split(".")[0].isdigit()]
        packs = [int(n.split(".")[0]) for n in entries if n.endswith(".compact")]
        newest = max(packs, default=-1)
        for name in entries:
            # A compact entry holds all before it.
            number = int(name.split(".")[0])
            if number < newest or (number == newest and not name.endswith(".compact")):
                continue
            for entry in storage.read_text(spark, f"{log}/{name}").splitlines()[1:]:
                seen = json.loads(entry)
                if seen["batchId"] <= reached:
                    found.add("/".join(seen["path"].split("/")[-3:]))
    return found


def pack(spark: SparkSession, path: str, schema: StructType, rows_per_file: int = 5_000_000, least: int = 8) -> int:
    """Rewrite the batches that all followers have passed into few files per date; returns how many.

    Nothing is done for fewer than ``least`` batches. Runs of at most eight times as many batches are
    taken in, so a batch is rewritten a number of times that grows as the logarithm of their number.
    Directories of packed batches go at the next call, when readers that began before have had time.
    """
    runs = _log(spark, path)
    done = max([run["last"] for run in runs], default=-1)
    live = live_batches(spark, path)
    _forget(spark, path, runs, [n for n in live if n <= done])
    ready = []
    for n in (n for n in live if n > done):
        if not _passed(spark, path, n):
            break
        ready.append(n)
    if len(ready) < least:
        return 0
    first, taken = ready[0], []
    while runs and runs[-1]["batches"] <= 8 * (len(ready) + sum(r["batches"] for r in taken)):
        taken.insert(0, runs.pop())
        first = taken[0]["first"]
    rows = read_dated(spark, path, schema, first, ready[-1])
    name = f"{first}-{ready[-1]}"
    target = f"{path}/_packed/{name}"
    # One task per date would be a hot date in one task: rows of a date are dealt to as many as they fill.
    counts = rows.groupBy(_EVENT_DATE).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    dealt = rows.join(F.broadcast(counts), rows[_EVENT_DATE].eqNullSafe(counts[_EVENT_DATE])).drop(counts[_EVENT_DATE])
    spread = F.pmod(F.xxhash64(*schema.fieldNames(), _BATCH), F.col("_files"))
    dealt = dealt.withColumn("_file", spread).repartition(_EVENT_DATE, "_file").drop("_files", "_file")
    dealt.write.mode("overwrite").partitionBy(_EVENT_DATE).parquet(target)
    batches = len(ready) + sum(r["batches"] for r in taken)
    runs.append({"name": name, "first": first, "last": ready[-1], "batches": batches})
    entries = storage.names(spark, f"{path}/_log")
    number = int(entries[-1].split(".")[0]) + 1 if entries else 0
    storage.make_directory(spark, f"{path}/_log")
    storage.write_text(spark, f"{path}/_log/{number:012d}.json", json.dumps(runs))
    return len(ready)


def _forget(spark: SparkSession, path: str, runs: list[dict], packed: list[int]) -> None:
    """Remove batches that the last packing took in, and runs that none needs any more."""
    for n in packed:
        storage.delete(spark, f"{path}/{_BATCH}={n}")
    needed = {run["name"] for run in runs}
    for name in storage.names(spark, f"{path}/_followers"):
        needed |= set(json.loads(storage.read_text(spark, f"{path}/_followers/{name}"))["packed"])
    for name in storage.names(spark, f"{path}/_packed"):
        if name not in needed:
            storage.delete(spark, f"{path}/_packed/{name}")
