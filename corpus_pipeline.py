"""Five stages from raw documents to packed token ids; each writes Parquet that the next one reads."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsloom.llm import decontaminate, mixing, near_dedup, packing, quality_model  # noqa: E402
from newsloom.llm.common import stored  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.keep_good(docs, labels).select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one with the smallest ``doc_id``, one row of it per text."""
    return near_dedup.one_per_group(near_dedup.one_of_equal_rows(docs)).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and pass, its text the words that are taken."""
    made = mixing.mix_sources(docs, block_words=512)
    rows = mixing.mixed_documents(docs, made)
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of 2,048 token ids."""
    return packing.pack_tokens(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_packing", token_packing),
]

# A learned classifier, MinHash and random draws have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
