"""Word statistics per language."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import corpus as plan
from strata.registry.base import query, table

MINIMUM = 20


def counts(spark, sf):
    return plan.word_counts(table(spark, sf, "documents"), "text", "lang")


SQL_WORDS = f"""
WITH c AS (
  SELECT lang AS corpus, word, count(*) AS word_count
  FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''
  GROUP BY lang, word
), s AS (
  SELECT lower(word) AS word, corpus, word_count FROM c WHERE word_count >= {MINIMUM}
)
"""


@query("frequent_words", SQL_WORDS + "SELECT * FROM s")
def frequent_words(spark, sf):
    return plan.frequent_words(counts(spark, sf), MINIMUM)


@query("corpus_summary", SQL_WORDS + """
, r AS (
  SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY word_count DESC, word) AS n FROM s
)
SELECT corpus, count(DISTINCT word) AS distinct_words,
       CAST(sum(word_count) AS BIGINT) AS total_occurrences,
       string_agg(word || '=' || word_count, ' ' ORDER BY n) FILTER (n <= 5) AS top_words
FROM r GROUP BY corpus""")
def corpus_summary(spark, sf):
    summary = plan.corpus_summary(plan.frequent_words(counts(spark, sf), MINIMUM))
    shown = F.transform(
        "top_words", lambda w: F.concat(w["word"], F.lit("="), w["word_count"].cast("string"))
    )
    return summary.withColumn("top_words", F.array_join(shown, " "))


@query("workflow_daily", SQL_WORDS + f"""
SELECT 'stg_words' AS model, 'non_null' AS assertion,
       count(*) FILTER (word IS NULL OR corpus IS NULL OR word_count IS NULL) AS violations FROM s
UNION ALL SELECT 'stg_words', 'row_condition: word_count >= {3 * MINIMUM}',
  count(*) FILTER (NOT word_count >= {3 * MINIMUM}) FROM s
UNION ALL SELECT 'corpus_summary', 'non_null', count(*) FILTER (corpus IS NULL) FROM (SELECT DISTINCT corpus FROM s)
UNION ALL SELECT 'corpus_summary', 'unique_key: corpus', count(*) FROM (
  SELECT corpus FROM (SELECT DISTINCT corpus FROM s) GROUP BY corpus HAVING count(*) > 1)""")
def workflow_daily(spark, sf):
    """Both models written in order, and what their assertions find: rarer words than demanded."""
    return plan.run(counts(spark, sf), MINIMUM, strict=False, demanded=3 * MINIMUM).report
