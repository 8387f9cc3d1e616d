"""A pipeline that prepares ``documents`` for training, in five stages.

Each stage takes what its predecessor kept, as a written table with the columns of
documents, whatever others there are beside those it reads, and its decisions take effect on it.
An empty table passes through; NULL texts and texts without words go with the first stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adstream.llm.mixing import mix_sources
from adstream.llm.ngram_join import near_duplicates
from adstream.llm.packing import pack_documents
from adstream.llm.quality import assess_quality
from adstream.llm.scratch import Scratch
from adstream.llm.secrets import mask_secrets

def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """Rows as one column, so that no name in them meets a name that a stage uses, beside those it reads."""
    return docs.select(F.struct("*").alias("row"), *columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return assess_quality(_packed(docs, "text"), columns=["row"]).filter("kept").select("row.*")


def _numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``row`` and a ``number`` per row that stays the same however often the table is read.

    A row of a file has a place in it, and files are numbered in a written list. Other
    tables are written with their numbers.
    """
    place = ["_metadata.file_path", "_metadata.row_index"]
    try:
        rows = docs.select(F.struct(*docs.columns).alias("row"), *place)
    except AnalysisException:
        rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number"))
        return scratch.save(rows, "numbered")
    files = docs.select(place[0]).distinct().withColumn("file", F.monotonically_increasing_id())
    files = scratch.save(files.withColumnRenamed("file_path", "path"), "files")
    # Numbers of files are numbers of a partition and of a row in it; counted through, they leave room for rows.
    counted = files.select("path", F.row_number().over(Window.orderBy("file")).cast("long").alias("file"))
    counted = scratch.save(counted, "counted")
    number = F.shiftleft("file", 40) + F.col("row_index")
    return rows.join(counted, F.col("file_path") == F.col("path")).select("row", number.alias("number"))


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: the one with the smallest id, NULL last.

    Rows are told apart by a number of their own, so repeated and NULL ids are rows like
    others: no text goes but for a near one that stays, and of repeated rows one stays.
    """
    scratch = Scratch(spark, "near-duplicate-removal")
    numbered = _numbered(docs, scratch)
    groups = near_duplicates(numbered.select("number", "row.text"), id_col="number").select(
        F.col("number").alias("member"), F.col("component_id").alias("component")
    )
    order = F.struct(F.col("row.doc_id").isNull(), "row.doc_id", F.xxhash64("row.text"), "number")
    ids = numbered.select("number", order.alias("order"))
    members = groups.join(ids, F.col("member") == F.col("number"))
    first = members.groupBy("component").agg(F.min("order").alias("first")).select(F.col("first.number").alias("keep"))
    return numbered.join(first, F.col("number") == F.col("keep"), "left_semi").select("row.*")


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it, which may be not at all."""
    mixed = mix_sources(_packed(docs, "doc_id", "text", "source"), keep=("row",))
    copies = F.explode(F.expr("sequence(1, copies)"))
    return mixed.filter("copies > 0").select("row", copies).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicate_removal),
    ("secret_scans", secret_masking),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs


# Models and packings are beyond SQL; tests/llm/test_pipeline.py holds each stage's effect against plain Python.
ORACLE_SQL = None
