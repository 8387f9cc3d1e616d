"""Removal of repeated deliveries of the same event."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from adstream.config import LookupLimits
from adstream.session import has_checkpoint_dir, scratch_path


def dedupe_events(events: DataFrame, key: str = "event_id", limits: LookupLimits = LookupLimits()) -> DataFrame:
    """Keep one row per event id; rows without an id are all kept.

    In a batch the earliest row of an id wins (ties by the other columns), so the
    result depends on the data alone. It is an aggregate rather than a ranking:
    copies collapse before the shuffle, however many an id has. Hashes of ids are counted first, and
    only rows whose hash is there more than once are aggregated; all others stay where they are. That count
    is written below the session's checkpoint folder. If it finds more hashes than may be
    broadcast, or there is no such folder, all rows are aggregated.

    A stream needs a watermark and forgets an id once the watermark has passed it; rows without a
    time, which it could not forget, are all kept as well.
    """
    no_identity = F.col(key).isNull()
    if events.isStreaming:
        no_identity = no_identity | F.col("timestamp").isNull()
    known, unknown = events.filter(~no_identity), events.filter(no_identity)
    if events.isStreaming:
        return known.dropDuplicatesWithinWatermark([key]).unionByName(unknown)
    repeated = _repeated(known, key, limits)
    if repeated is None:
        return _earliest(known, key).unionByName(unknown)
    same = F.xxhash64(key) == F.col("_repeated")
    # Rows without an id match no hash, so one pass finds all that stay as they are.
    alone = events.join(F.broadcast(repeated), same & F.col(key).isNotNull(), "left_anti")
    several = known.join(F.broadcast(repeated), same, "left_semi")
    return _earliest(several, key).unionByName(alone)


def _earliest(events: DataFrame, key: str) -> DataFrame:
    rest = [name for name in events.columns if name not in (key, "timestamp")]
    order = [name for name in ("timestamp", *rest) if name in events.columns]
    kept = events.groupBy(key).agg(F.min(F.struct(*order)).alias("kept"))
    return kept.select(key, "kept.*").select(events.columns)


def _repeated(known: DataFrame, key: str, limits: LookupLimits) -> DataFrame | None:
    """Hashes that several rows have, if they are few enough to broadcast. Eight bytes a row move, less within a task."""
    spark = known.sparkSession
    if not has_checkpoint_dir(spark):
        return None
    size, path = Observation(), scratch_path(spark, "repeated-ids")
    counts = known.groupBy(F.xxhash64(key).alias("_repeated")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.filter("n > 1").select("_repeated")
    found.observe(size, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if 8 * size.get["n"] > limits.max_bytes or size.get["n"] > limits.max_rows:
        return None
    return spark.read.schema(found.schema).parquet(path)
