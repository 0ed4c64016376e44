"""The corpus pipeline: language, quality, near duplicates, packing. Each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import language_id, ngram_join, packing, quality_crf
from tallyloom.operators.ranking import surrogate_key
from tallyloom.session import park, scratch_path

SHINGLE_WORDS, SIMILARITY_PERCENT, CAPACITY = 5, 80, 2048


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the declared language and the source's habits count beside the text.

    Null and empty texts and texts without letters go.
    """
    return language_id.keep_identified(docs, language_id.train(docs))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good by the labels' measure. Without any label all stay; null and empty texts are scored as one empty line."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_crf.keep_good(docs, quality_crf.train(docs, labels))


def _one_text_a_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``tallyloom_key``: the id, or for further texts of an id a number beyond all ids."""
    rows = docs.withColumn("tallyloom_key", F.col("doc_id").cast("long")).withColumn("tallyloom_text", F.xxhash64("text"))
    least = rows.groupBy("doc_id").agg(F.min("tallyloom_text").alias("least"), F.max("tallyloom_text").alias("most"), F.count("*").alias("n"))
    several = park(least.where("doc_id is not null and least <> most").select("doc_id", "least"), "several-texts")
    if several.head(1):
        further = rows.join(several, "doc_id").where("tallyloom_text <> least").select("doc_id", "tallyloom_text").distinct()
        beyond = F.lit(docs.agg(F.max(F.col("doc_id").cast("long"))).head()[0])
        numbered = surrogate_key(further, ["doc_id", "tallyloom_text"], "tallyloom_more")
        rows = rows.join(numbered, ["doc_id", "tallyloom_text"], "left").withColumn(
            "tallyloom_key", F.coalesce(F.col("tallyloom_more") + beyond, "tallyloom_key")
        )
    return rows.select(*docs.columns, "tallyloom_key")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; of rows that repeat an id and its text, one.

    Another text under a repeated id is a document of its own; it comes after all ids when a group's first is chosen. Rows without
    an id link with nothing and stay; null texts and texts without words link with nothing.
    """
    keyed = _one_text_a_key(docs)
    classes = ngram_join.jaccard_classes(keyed, SHINGLE_WORDS, SIMILARITY_PERCENT, "tallyloom_key")
    copies = park(classes.where("component_id <> tallyloom_key").select(F.col("tallyloom_key").alias("tallyloom_copy")).distinct(), "copies")
    single = keyed.join(copies, F.col("tallyloom_key") == F.col("tallyloom_copy"), "left_anti").where("tallyloom_key is not null")
    first = Window.partitionBy("tallyloom_key").orderBy(F.xxhash64(*docs.columns))
    once = single.withColumn("tallyloom_row", F.row_number().over(first)).where("tallyloom_row = 1").select(*docs.columns)
    return once.unionByName(docs.where("doc_id is null"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left and its place in a sequence. Null and empty texts are a piece of the end id alone."""
    return packing.pack_documents(docs, CAPACITY)


STAGES = [("language_id", identify_language), ("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: Trained models and tokenizers cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
