"""Layered tables: directories of files that are read and written like tables.

Parquet is the default format. A table written by micro-batches has one directory
``batch_id=N`` per batch, a table that is replaced has one ``version=N`` per state.
Another format name, such as a transactional lake format whose connector is on the
classpath, is passed through to Spark, which then keeps the log itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from adstream.schemas import GOLD_ALERT
from adstream.sources import storage

MAX_FILES_PER_TRIGGER = 1000


def create_if_absent(
    spark: SparkSession, path: str, schema: StructType, table_format: str = "parquet"
) -> None:
    """Make the table readable before the first row is written."""
    if table_format == "parquet":
        storage.make_directory(spark, path)
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table_format}.`{path}` ({columns}) USING {table_format}")


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    table_format: str = "parquet",
    streaming: bool = False,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """The rows of an appended table, as a table or as a stream that follows it.

    The schema is given, never inferred, so an empty table can be read. It includes
    the batch number: a stream that starts before the first batch would otherwise
    not expect the column that the directory names add. A stream takes at most
    ``max_files_per_trigger`` new files in a micro-batch and the rest in later ones. For a table
    a missing file is an error.
    """
    if not streaming and table_format == "parquet" and storage.exists(spark, f"{path}/_log"):
        from adstream.sources import dated

        return dated.read_dated(spark, path, schema).select(schema.fieldNames())
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger) if streaming else spark.read
    if table_format != "parquet":
        return reader.format(table_format).load(path).select(schema.fieldNames())
    stored = _with_batch_id(schema)
    if streaming:
        reader = reader.option("ignoreMissingFiles", "true")
    return reader.schema(stored).parquet(path).select(schema.fieldNames())


def _with_batch_id(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch_id", LongType())])


def append_batch(batch: DataFrame, path: str, batch_id: int, table_format: str = "parquet") -> bool:
    """Write a micro-batch once, however often it is replayed; False if it was there.

    A complete directory is left alone rather than rewritten, as a stream that
    follows the table would take rewritten files for new rows.
    """
    if table_format != "parquet":
        writer = batch.write.format(table_format).mode("append")
        writer.option("txnAppId", path).option("txnVersion", batch_id).save(path)
        return True
    target = f"{path}/batch_id={batch_id}"
    if storage.is_complete(batch.sparkSession, target):
        return False
    batch.write.mode("overwrite").parquet(target)
    return True


def check_owner(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse to add to a table of batches under a checkpoint that did not write it.

    Batch numbers start again with a new checkpoint, so its batches would be taken
    for replays and left out. The log of the file sink has such numbers as well.
    """
    if storage.exists(spark, f"{checkpoint}/offsets"):
        return
    numbered = [storage.numbered_directories(spark, path, name) for name in ("batch_id", "version")]
    if any(numbered) or any(storage.exists(spark, f"{path}/{log}") for log in ("_spark_metadata", "manifest", "_log")):
        raise ValueError(f"{path} was written under another checkpoint than {checkpoint}")


def replace_table(rows: DataFrame, path: str, version: int, keep: int = 2) -> bool:
    """Write the whole table as a new version and drop all but the last ones; False if it was there.

    Readers stay on complete versions; a version is replaced only while incomplete.
    """
    spark = rows.sparkSession
    target = f"{path}/version={version}"
    new = not storage.is_complete(spark, target)
    if new:
        rows.write.mode("overwrite").parquet(target)
    for old in storage.numbered_directories(spark, path, "version")[:-keep]:
        storage.delete(spark, f"{path}/version={old}")
    return new


def read_latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete version of a replaced table, empty if there is none."""
    versions = storage.numbered_directories(spark, path, "version")
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1]}")


def read_upserts(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """A table of changed rows as its current state: per key the row of the last batch."""
    values = [c for c in schema.fieldNames() if c not in keys]
    changes = spark.read.schema(_with_batch_id(schema)).parquet(path)
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("row"))
    return newest.select(*keys, "row.*").select(schema.fieldNames())


def read_alerts(
    spark: SparkSession, path: str, mode: str = "complete", table_format: str = "parquet"
) -> DataFrame:
    """The current alerts of a gold table that was written in the given output mode."""
    if mode == "complete" and table_format == "parquet":
        return read_latest(spark, path, GOLD_ALERT)
    if mode in ("update", "merge"):
        from adstream.sources import alerts

        return (alerts.read_newest_alerts if mode == "update" else alerts.read_summed_alerts)(spark, path)
    return read_table(spark, path, GOLD_ALERT, table_format)
