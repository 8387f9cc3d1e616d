"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm import oracle
from adstream.llm.bpe import round_trip_texts
from adstream.llm.fingerprints import edit_likeness
from adstream.llm.html import extract_pages
from adstream.llm.importance import resample
from adstream.llm.mixing import mix_sources
from adstream.llm.ngram_join import near_duplicates
from adstream.llm.packing import pack_documents
from adstream.llm.quality import assess_quality
from adstream.llm.ranking import search
from adstream.llm.scratch import benchmark, documents
from adstream.llm.secrets import BASE_KINDS, find_secrets, spans_text
from adstream.llm.sharding import assign_shards
from adstream.llm.tokencount import count_tokens
from adstream.llm.toxicity import score_toxicity, train

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_pages(pages, columns=["page_id", "url"])


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE_KINDS))
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess_quality(documents(spark, sf_dir), columns=["doc_id"])


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(documents(spark, sf_dir))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, model, columns=["doc_id"])
    return scored.withColumn("toxic", F.col("grade") > 0)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), columns=["doc_id"])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = round_trip_texts(documents(spark, sf_dir), columns=["doc_id"])
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_html_extraction,
        op3_secret_scan,
        op4_quality_rules,
        op5_document_fingerprints,
        op6_source_mixing,
        op7_toxicity,
        op8_token_counts,
        op9_sharding,
        op10_best_fit_packing,
        op11_bpe_round_trip,
        op12_importance_resampling,
        op13_ranked_lexical_search,
    )
}

# The methods of the others (models, packings, trees, tokenizers) are beyond SQL; tests hold
# them against brute force instead.
ORACLE_SQL: dict[str, str] = {
    "op12_importance_resampling": oracle.IMPORTANCE_RESAMPLING,
    "op13_ranked_lexical_search": oracle.RANKED_LEXICAL_SEARCH,
}
