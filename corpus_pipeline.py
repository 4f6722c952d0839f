"""The corpus pipeline: from raw documents to shards of a training mix.

Every stage takes the documents that the stage before kept, whole, and returns documents
with the same columns; the last one adds the shard of every row. ``run`` writes each
stage's result to the shared folder and reads it again, so a lost executor costs one stage
at most. Stages keep clean documents: they reject texts without a language, all but one
document of a group of near-duplicates, and documents that hold a benchmark item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, hmm, language, mixing, neardup, sharding
from strata.session import cut_lineage, tune

SHINGLE = 5  # words, for near-duplicates and benchmark items
SIMILARITY = 80  # percent


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are in a language that the labelled ones teach."""
    labelled = docs.filter((hmm.remainder(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull())
    field = language.fitted(labelled.select(F.col("lang").alias("label"), "text"))
    return language.keep_identified(docs, field)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.deduplicate(docs, SHINGLE, SIMILARITY)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items, SHINGLE, SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks."""
    return mixing.mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard, none above the byte limit."""
    return sharding.with_shards(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]
ORACLE_SQL = None  # the language stage is a trained model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix with their shards."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
