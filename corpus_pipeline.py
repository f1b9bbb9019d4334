"""From raw documents to packed training sequences: one operator after the other.

Each stage gets the documents that the one before it left, as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparktape.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from sparktape.llm.tables import materialise, read_table, small_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_duplicate_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", drop_benchmark),
    ("packing", pack),
]

# Tokens, kernels and fuzzy lines are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
