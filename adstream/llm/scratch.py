"""Tables that a job writes and reads again, below the session's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adstream.session import scratch_path
from adstream.sources import storage


class Scratch:
    """A fresh shared folder. Written tables cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def save(self, table: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        table.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            storage.delete(self.spark, f"{self.root}/{name}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")
