"""The corpus pipeline: clean, score, deduplicate, decontaminate, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from boxmill.llm import decontaminate, neardup, packing, quality_ordinal, quality_rules
from boxmill.llm.queries import LEAST_EXPECTED, quality_model


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the basic counts and the line rules, without their failing and repeated lines."""
    return quality_rules.keep_clean(docs, length_col="n_chars")


def good_grades(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected grade is high enough."""
    return quality_ordinal.keep_good(docs, quality_model(spark, sf_dir), least_expected=LEAST_EXPECTED)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return neardup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in full windows."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", clean_lines),
    ("quality_classifier", good_grades),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the learned and sketch-based stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another on the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
