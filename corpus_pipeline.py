"""Corpus pipeline: quality, near-dedup, passage dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents. All stages but the last return
the columns of ``documents``; the last adds how often the mix takes a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm import decontam, minhash, mixing, quality, suffixes
from noticeloom.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else docs


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return minhash.dedupe(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they stand first."""
    return counted(suffixes.remove(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark words are cut out of the documents."""
    return counted(decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, with ``copies`` and ``taken`` words."""
    return mixing.mix(docs)


STAGES = [("quality", good_quality), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("decontamination", decontaminate), ("mix", mix)]

#: Trained models and hashes of whole sets have no SQL; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
