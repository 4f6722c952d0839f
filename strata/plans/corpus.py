"""Word statistics per corpus: two models with assertions between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.texts import words
from strata.operators.ordering import top_structs
from strata.operators.quality import Assertions, assertion_report, demand_clean
from strata.session import cut_lineage

# The frequency threshold, list length and assertions of the models.
MINIMUM_COUNT = 100
TOP_WORDS = 5


def word_counts(documents: DataFrame, text: str, corpus: str) -> DataFrame:
    """Occurrences of every word per corpus, counted over whole texts."""
    return (
        documents.select(F.col(corpus).alias("corpus"), F.explode(words(F.col(text))).alias("word"))
        .groupBy("corpus", "word")
        .agg(F.count(F.lit(1)).alias("word_count"))
    )


def frequent_words(counts: DataFrame, minimum: int = MINIMUM_COUNT) -> DataFrame:
    """Lower-cased words that occur often; spellings stay separate rows."""
    return counts.filter(F.col("word_count") >= minimum).select(
        F.lower("word").alias("word"), "corpus", "word_count"
    )


def frequent_words_assertions(minimum: int = MINIMUM_COUNT) -> Assertions:
    return Assertions(
        non_null=("word", "corpus", "word_count"), row_conditions=(f"word_count >= {minimum}",)
    )


def corpus_summary(staged: DataFrame, top: int = TOP_WORDS) -> DataFrame:
    """Distinct words, occurrences and the most frequent words per corpus."""
    staged = cut_lineage(staged.select("corpus", "word", "word_count"), "frequent-words")  # read twice below
    totals = staged.groupBy("corpus").agg(
        F.count_distinct("word").alias("distinct_words"),
        F.sum("word_count").alias("total_occurrences"),
    )
    order = [F.desc("word_count"), F.col("word")]
    best = top_structs(staged, ["corpus"], "top_words", ["word", "word_count"], order, top)
    return totals.join(best, "corpus")


SUMMARY_ASSERTIONS = Assertions(
    non_null=("corpus", "distinct_words", "total_occurrences"), unique_key=("corpus",)
)


@dataclass(frozen=True)
class Workflow:
    staged: DataFrame
    summary: DataFrame
    report: DataFrame


def run(
    counts: DataFrame, minimum: int = MINIMUM_COUNT, strict: bool = True, demanded: int | None = None
) -> Workflow:
    """Build both models; with ``strict`` a violated assertion stops the workflow
    before the next model reads the violating one. ``demanded`` is the count that is
    asserted, ``minimum`` unless given.
    """
    staged = cut_lineage(frequent_words(counts, minimum), "stg-words")
    first = assertion_report("stg_words", staged, frequent_words_assertions(minimum if demanded is None else demanded))
    if strict:
        demand_clean(first)
    summary = cut_lineage(corpus_summary(staged), "corpus-summary")
    second = assertion_report("corpus_summary", summary, SUMMARY_ASSERTIONS)
    if strict:
        demand_clean(second)
    return Workflow(staged, summary, first.unionByName(second))
