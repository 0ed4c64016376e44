"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    block_anchors, bpe, conversations, html_crf, language_id, near_embeddings, ngram_join, oracles, packing, phrases, quality_crf, sharding, token_store, topk,
)
from tallyloom.llm.html_blocks import visible_text
from tallyloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Tokenizers, trained models, placements and grammar repair cannot be said in SQL; those queries are tested against brute force.
ORACLES: dict[str, str] = {
    "op2_exact_top_k": oracles.top_k_sql(),
    "op5_near_embeddings": oracles.near_embeddings_sql(),
    "op9_ngram_jaccard": oracles.ngram_jaccard_sql(),
    "op11_phrase_collocations": oracles.collocations_sql(),
    "op12_substring_dedup": oracles.substring_dedup_sql(),
}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


@query
def op4_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op5_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language; the text model is fitted on a sample of ``documents``."""
    model = language_id.train(table(spark, sf_dir, "documents"))
    host = language_id.host_of(F.col("url"))
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", "html", language_id.declared_in(F.col("html")).alias("declared"), language_id.suffix_of(F.col("url")).alias("suffix"),
        host.alias("host"), language_id.parent_of(host).alias("parent"),
    )
    found = language_id.identify(pages, model, "page_id", "html", "declared", "suffix", "host", "parent", text_of=visible_text)
    return found.select(
        F.col("key").alias("page_id"), "declared", "suffix", "host", "language", F.round("posterior", 6).alias("posterior"), "text_language", "accepted"
    )


@query
def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_crf.score_documents(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-store")
    token_store.write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_store.read_documents(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_anchors.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair_structure(damaged).withColumnRenamed("id", "conv_id")
