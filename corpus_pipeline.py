"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mix.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one
before kept.  All but the last return the columns of documents; the last adds
copy_no, as a document may be taken several times.  Nulls, empty texts, repeated
rows, empty tables and further columns are handled as each operator states.
Every stage's result is written to the shared checkpoint folder, so that no stage
runs twice however often the next one reads its documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import decontaminate, linedup, mixing, quality_rules, simhash
from quillon.llm.clusterio import checkpointed


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go; documents stay."""
    return linedup.dedup_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark spans are cut; mostly contaminated documents go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    _, last = STAGES[-1]
    return last(spark, docs, sf_dir)
