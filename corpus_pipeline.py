"""A training corpus from `documents`: quality, toxicity, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of
`documents`; the last returns the packed pieces. `run` writes each stage as Parquet and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import near_dedup, packing, quality, suffix_dedup, toxicity
from featureflow.llm.common import discard, fold, scratch_folder, shared_folder, stored, table
from featureflow.llm.queries import END_ID, tokenizer_file


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more. Without usable labels all stay."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 3) != 1)
    return quality.filtered(docs, labels)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    return toxicity.filtered(docs, labels)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the one with the least id.

    Rows without an id stay; of rows that repeat an id one stays.
    """
    found = near_dedup.near_duplicates(docs).where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"))
    found = stored(found)
    kept = docs.join(found.select("doc_id"), "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
    twice = found.where("rows > 1").select("doc_id")
    if twice.isEmpty():
        return kept
    return kept.join(twice, "doc_id", "left_anti").unionByName(kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what a document with a smaller id already has; all documents stay, `n_chars` follows the text."""
    return suffix_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, tokenizer_file(), END_ID)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("packing", packing_stage),
]

#: No SQL for trees, noisy-or and the tokenizer; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. What a stage stores on its way goes when it is written, and so does what it read."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = shared_folder(spark)
        with scratch_folder(spark):
            docs = stored(stage(spark, docs, sf_dir), path)
        if before is not None:
            discard(spark, before)
        before = path
    return docs
