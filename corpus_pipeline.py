"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

Nulls: null and empty texts are judged as empty ones: the classifier scores them, one of them stays after the exact stage, the
others keep it, and the mix takes none of it, for it has no words. Rows with a null identifier are judged by their texts; a null source is a
source of its own. Rows that repeat identifier and text leave one after the exact stage; different texts of one identifier are judged each by
itself in every stage. Texts are read whole, however long. Empty tables give empty results. Extra columns, whatever their names, are
kept, but for those of the names that the last stage adds, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataq.llm import decontaminate, exact_dedup, jaccard, mixing, quality
from strataq.llm.common import fresh_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the one with the smallest doc_id stays."""
    return jaccard.keep_one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the documents that are taken, with their texts and all columns, and size, source_size, target, copies and taken."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing to target weights", source_mix),
]

#: The classifier, the Jaccard join and the mix have no SQL; the tests hold each stage and run() against plain computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path := fresh_path(spark, f"stage{k}"))
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
