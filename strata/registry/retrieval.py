"""Pages as documents, embeddings as a vector table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from strata.functions.texts import document_content
from strata.functions.vectors import cosine_distance, norm
from strata.operators import quantised
from strata.operators import search as ops
from strata.plans import retrieval as plan
from strata.registry.base import query, table
from strata.session import cut_lineage, scratch_path

PATTERN = "(/en/|/fr/|/es/)"
QUERY = "the quick answer on data that are there and not here"
CLUSTERS = 16


def posts(spark, sf):
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        F.col("url").alias("title"),
        F.col("html").alias("body"),
        F.upper("url").alias("tags"),
        F.length("html").cast("bigint").alias("score"),
    )


@query("top_documents", f"""
SELECT CAST(page_id AS VARCHAR) AS document_id, url AS title,
       url || chr(10) || regexp_replace(html, '<[^>]+>', ' ', 'g') AS content,
       upper(url) AS tags, length(html) AS score
FROM pages WHERE regexp_matches(lower(upper(url)), '{PATTERN}')
ORDER BY length(html) DESC, page_id LIMIT 100""")
def top_documents(spark, sf):
    return ops.top_documents(posts(spark, sf), PATTERN)


@query("capped_contents", """
SELECT page_id, url || chr(10) || left(regexp_replace(html, '<[^>]+>', ' ', 'g'), 200) AS content FROM pages""")
def capped_contents(spark, sf):
    """The option that shortens bodies, here to 200 characters; it is off unless asked for."""
    return table(spark, sf, "pages").select(
        "page_id", document_content(F.col("url"), F.col("html"), max_chars=200).alias("content"))


def label_queries(spark, sf):
    """One query vector per label: the mean of its vectors."""
    return ops.mean_vectors(table(spark, sf, "embeddings"), "label")


SQL_NEAREST = """
WITH q AS (
  SELECT label, list(m ORDER BY i) AS centre FROM (
    SELECT label, i, avg(x::DOUBLE) AS m FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label
), d AS (
  SELECT q.label AS query_label, e.vec_id, e.label AS vec_label,
         round(list_cosine_distance(e.embedding::DOUBLE[], q.centre), 12) AS distance
  FROM q, embeddings e
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY distance, vec_id) AS rank FROM d
)
"""


@query("vector_topk_exact", SQL_NEAREST + """
SELECT query_label, CAST(rank AS INTEGER) AS rank, vec_id, vec_label, round(distance, 6) AS distance
FROM r WHERE rank <= 5""")
def vector_topk_exact(spark, sf):
    base = table(spark, sf, "embeddings").withColumnRenamed("label", "vec_label")
    queries = label_queries(spark, sf).withColumnRenamed("label", "query_label")
    found = ops.nearest_exact(base, queries, 5, "vec_id", "query_label", columns=["vec_label"])
    return found.withColumn("distance", F.round("distance", 6))


@query("vector_mean", """
SELECT label, i - 1 AS position, round(avg(x::DOUBLE), 9) AS mean FROM (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
GROUP BY label, i""")
def vector_mean(spark, sf):
    means = label_queries(spark, sf)
    return means.select("label", F.posexplode("embedding").alias("position", "mean")).select(
        "label", F.col("position").cast("bigint").alias("position"),
        F.round("mean", 9).alias("mean"),
    )


@query("vector_own_label_distance", """
WITH q AS (
  SELECT label, list(m ORDER BY i) AS centre FROM (
    SELECT label, i, avg(x::DOUBLE) AS m FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label
)
SELECT vec_id, label, round(list_cosine_distance(embedding::DOUBLE[], centre), 6) AS distance
FROM embeddings JOIN q USING (label)""")
def vector_own_label_distance(spark, sf):
    """Cosine distance as a column expression: every vector to the mean of its label."""
    centres = label_queries(spark, sf).withColumnRenamed("embedding", "centre")
    joined = table(spark, sf, "embeddings").join(centres, "label")
    distance = F.round(cosine_distance(F.col("embedding"), F.col("centre")), 6)
    return joined.select("vec_id", "label", distance.alias("distance"))


def stored_index(spark, base):
    path = scratch_path(spark, "index")
    return ops.load_index(spark, ops.store_index(ops.build_cluster_index(base, CLUSTERS), path))


@query("vector_topk_indexed_exhaustive", SQL_NEAREST + """
SELECT query_label, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) AS distance
FROM r WHERE rank <= 5""")
def vector_topk_indexed_exhaustive(spark, sf):
    """The index probed in all its clusters gives the exact result."""
    index = stored_index(spark, table(spark, sf, "embeddings"))
    queries = label_queries(spark, sf).withColumnRenamed("label", "query_label")
    found = ops.nearest_indexed(index, queries, 5, "vec_id", "query_label", probes=CLUSTERS)
    return found.withColumn("distance", F.round("distance", 6))


@query("vector_topk_every_query", """
WITH d AS (
  SELECT q.vec_id AS query_vec, e.vec_id,
         round(list_cosine_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 12) AS distance
  FROM embeddings q, embeddings e
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_vec ORDER BY distance, vec_id) AS rank FROM d
)
SELECT query_vec, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) + 0.0 AS distance
FROM r WHERE rank <= 3""")
def vector_topk_every_query(spark, sf):
    """Every vector as a query against all vectors."""
    base = table(spark, sf, "embeddings")
    queries = base.select(F.col("vec_id").alias("query_vec"), "embedding")
    found = ops.nearest_exact(base, queries, 3, "vec_id", "query_vec")
    return found.withColumn("distance", F.round("distance", 6) + F.lit(0.0))


PROBES = 8  # of the ten labels' clusters; with fewer the measured recall falls below 0.9


@query("vector_topk_indexed_ordinary", f"""
WITH q AS (
  SELECT label, list(m ORDER BY i) AS centre FROM (
    SELECT label, i, avg(x::DOUBLE) AS m FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label
), near AS (
  SELECT e.vec_id, q.label AS cluster, row_number() OVER (PARTITION BY e.vec_id ORDER BY
    round(list_cosine_distance(e.embedding::DOUBLE[], q.centre), 12), q.label) AS place
  FROM embeddings e, q
), d AS (
  SELECT a.vec_id AS query_vec, e.vec_id,
         round(list_cosine_distance(e.embedding::DOUBLE[], a.embedding::DOUBLE[]), 12) AS distance
  FROM embeddings a, embeddings e WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_vec ORDER BY distance, vec_id) AS rank FROM d
), f AS (
  SELECT d.*, row_number() OVER (PARTITION BY d.query_vec ORDER BY d.distance, d.vec_id) AS rank
  FROM d JOIN near cell ON cell.vec_id = d.vec_id AND cell.place = 1
  JOIN near probe ON probe.vec_id = d.query_vec AND probe.cluster = cell.cluster AND probe.place <= {PROBES}
), hit AS (
  SELECT r.query_vec, avg(CASE WHEN f.vec_id IS NULL THEN 0 ELSE 1 END) AS recall
  FROM r LEFT JOIN f ON f.query_vec = r.query_vec AND f.vec_id = r.vec_id AND f.rank <= 5
  WHERE r.rank <= 5 GROUP BY r.query_vec
)
SELECT query_vec, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) + 0.0 AS distance, recall
FROM f JOIN hit USING (query_vec) WHERE rank <= 5""")
def vector_topk_indexed_ordinary(spark, sf):
    """The same clusters asked for ordinary vectors, every fiftieth, and the recall."""
    base = table(spark, sf, "embeddings")
    means = label_queries(spark, sf).orderBy("label").collect()  # a vector per label
    queries = base.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_vec"), "embedding")
    index = ops.cluster_by_centres(base, np.array([r["embedding"] for r in means]), "vec_id")
    path = ops.store_index(index, scratch_path(spark, "index"))
    found = ops.nearest_indexed(ops.load_index(spark, path), queries, 5, "vec_id", "query_vec", probes=PROBES)
    exact = ops.nearest_exact(base, queries, 5, "vec_id", "query_vec")
    recall = ops.recall(found, exact, "query_vec", "vec_id")
    return found.withColumn("distance", F.round("distance", 6) + F.lit(0.0)).join(recall, "query_vec")


CODE_PROBES, RERANK = 48, 64  # of 64 centres, whose codes are read; full vectors read per query


def nth_units(spark, sf, divisor: int, remainder: int, most: int) -> np.ndarray:
    """The first of the vectors whose id has a remainder, as given centres or code words."""
    chosen = table(spark, sf, "embeddings").filter(f"vec_id % {divisor} = {remainder}").orderBy("vec_id").limit(most)
    vectors = np.array([r["embedding"] for r in chosen.collect()], dtype="float64")
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@query("vector_topk_quantised", f"""
WITH u AS MATERIALIZED (
  SELECT vec_id, [x / length FOR x IN v] AS v FROM (
    SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS length
    FROM embeddings)),
centre AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cell, v AS c FROM u WHERE vec_id % 7 = 3
  QUALIFY cell < {quantised.CENTRES}),
near AS MATERIALIZED (
  SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(1 - list_inner_product(v, c), 12), cell) AS place
  FROM u, centre),
rest AS MATERIALIZED (
  SELECT vec_id, cell, [v[i] - c[i] FOR i IN range(1, len(v) + 1)] AS r
  FROM u JOIN near USING (vec_id) JOIN centre USING (cell) WHERE place = 1),
word AS MATERIALIZED (
  SELECT part, w, r[4 * part + 1 : 4 * part + 4] AS b FROM (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS w, r FROM rest WHERE vec_id % 11 = 5 QUALIFY w < 16),
    (SELECT unnest(range(16)) AS part)),
code AS MATERIALIZED (
  SELECT vec_id, part, b FROM rest, word
  QUALIFY row_number() OVER (PARTITION BY vec_id, part
                             ORDER BY round(list_distance(r[4 * part + 1 : 4 * part + 4], b), 12), w) = 1),
scored AS (
  SELECT q.vec_id AS query_vec, rest.vec_id,
         round(1 - (any_value(list_inner_product(q.v, c)) + sum(list_inner_product(q.v[4 * part + 1 : 4 * part + 4], b))), 12) AS coded
  FROM u q JOIN near probe ON probe.vec_id = q.vec_id AND probe.place <= {CODE_PROBES}
  JOIN centre USING (cell) JOIN rest ON rest.cell = probe.cell JOIN code ON code.vec_id = rest.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY query_vec ORDER BY coded, vec_id) <= {RERANK}),
exact AS (
  SELECT query_vec, best.vec_id, greatest(round(list_cosine_distance(e.embedding::DOUBLE[], a.embedding::DOUBLE[]), 12), 0) AS distance
  FROM best JOIN embeddings e ON e.vec_id = best.vec_id JOIN embeddings a ON a.vec_id = query_vec),
f AS (SELECT *, row_number() OVER (PARTITION BY query_vec ORDER BY distance, vec_id) AS rank FROM exact)
SELECT query_vec, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) + 0.0 AS distance FROM f WHERE rank <= 5""")
def vector_topk_quantised(spark, sf):
    """Every fiftieth vector asked of an index on given centres and code words: 64 vectors, and
    what is left of 16 others."""
    base = table(spark, sf, "embeddings")
    centres = nth_units(spark, sf, 7, 3, quantised.CENTRES)
    words = nth_units(spark, sf, 11, 5, 16)
    rest = words - centres[np.argmin(np.round(1 - words @ centres.T, ops.DISTANCE_DIGITS), axis=1)]
    books = rest.reshape(len(rest), quantised.PARTS, -1).transpose(1, 0, 2)
    index = quantised.build_quantised_index(base, scratch_path(spark, "quantised"), "vec_id", centres=centres, books=books)
    queries = base.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_vec"), "embedding")
    found = quantised.nearest_quantised(index, queries, 5, "vec_id", "query_vec", CODE_PROBES, RERANK)
    return found.withColumn("distance", F.round("distance", 6) + F.lit(0.0))


def quantised_search(spark, sf):
    """Every fiftieth vector asked of a learned index, and the exact result."""
    base = table(spark, sf, "embeddings")
    index = quantised.build_quantised_index(base, scratch_path(spark, "quantised"), "vec_id")
    queries = base.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_vec"), "embedding")
    found = quantised.nearest_quantised(index, queries, 5, "vec_id", "query_vec", CODE_PROBES, RERANK)
    return found, ops.nearest_exact(base, queries, 5, "vec_id", "query_vec")


@query("vector_quantised_recall", """
SELECT count(*) AS queries, 5 * count(*) AS results, true AS recall_reached FROM embeddings WHERE vec_id % 50 = 0""")
def vector_quantised_recall(spark, sf):
    """How many queries and results a learned index has, and whether its recall is 0.9 or more."""
    found, exact = quantised_search(spark, sf)
    found = cut_lineage(found, "found")
    recall = ops.recall(found, exact, "query_vec", "vec_id").agg(
        F.count(F.lit(1)).alias("queries"), (F.avg("recall") >= 0.9).alias("recall_reached"))
    results = found.agg(F.count(F.lit(1))).scalar()
    return recall.select("queries", results.alias("results"), "recall_reached")


@query("vector_search_contract", SQL_NEAREST + """
, t AS (
  SELECT *, lag(distance) OVER (PARTITION BY query_label ORDER BY rank) AS before FROM r WHERE rank <= 5
)
SELECT count(*) AS results, count(*) FILTER (distance < before) AS out_of_order,
       count(*) FILTER (distance < -1e-12 OR distance > 2 + 1e-12) AS out_of_range FROM t""")
def vector_search_contract(spark, sf):
    queries = label_queries(spark, sf).withColumnRenamed("label", "query_label")
    found = ops.nearest_exact(table(spark, sf, "embeddings"), queries, 5, "vec_id", "query_label")
    return ops.search_contract(found, "query_label")


def embedded_documents(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("document_id"),
        F.col("source").alias("title"),
        F.col("lang").alias("tags"),
        F.col("n_chars").alias("score"),
        F.col("text").alias("content"),
    )
    return documents


@query("text_embedding")
def text_embedding(spark, sf):
    return ops.embed_texts(embedded_documents(spark, sf)).select(
        "document_id", "status", "embedding"
    )


@query("embedding_status", """
SELECT CASE WHEN replace(text, ' ', '') = '' THEN 'empty content' ELSE '' END AS status,
       count(*) AS documents FROM documents GROUP BY 1""")
def embedding_status(spark, sf):
    embedded = ops.embed_texts(embedded_documents(spark, sf))
    return embedded.groupBy("status").agg(F.count(F.lit(1)).alias("documents"))


@query("embedding_lengths", """
SELECT doc_id AS document_id, 768 AS dimensions,
       CASE WHEN replace(text, ' ', '') = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS length
FROM documents""")
def embedding_lengths(spark, sf):
    """Every text with a word has a unit vector, every other a zero vector."""
    embedded = ops.embed_texts(embedded_documents(spark, sf))
    return embedded.select(
        "document_id",
        F.size("embedding").alias("dimensions"),
        F.round(norm(F.col("embedding")), 4).alias("length"),
    )


LETTERS = "aeioudnrst"


def letter_counts(texts: pd.Series) -> pd.Series:
    """An embedding any engine can repeat: how often some letters occur."""
    return texts.map(lambda text: [float(text.count(c)) for c in LETTERS])


SQL_LETTERS = "[" + ", ".join(
    f"(length({{0}}) - length(replace({{0}}, '{c}', '')))::DOUBLE" for c in LETTERS) + "]"


@query("text_embedding_plugged", f"""
SELECT doc_id AS document_id, CASE WHEN replace(text, ' ', '') = '' THEN 'empty content' ELSE '' END AS status,
       array_to_string([CAST(x AS BIGINT) FOR x IN {SQL_LETTERS.format('text')}], ',') AS embedding
FROM documents""")
def text_embedding_plugged(spark, sf):
    embedded = ops.embed_texts(embedded_documents(spark, sf), embedder=letter_counts)
    whole = F.transform("embedding", lambda x: x.cast("bigint").cast("string"))
    return embedded.select("document_id", "status", F.array_join(whole, ",").alias("embedding"))


@query("semantic_search")
def semantic_search(spark, sf):
    """One question against all documents."""
    question = spark.createDataFrame([(0, QUERY)], "query_id int, content string")
    return plan.search(
        plan.document_embeddings(embedded_documents(spark, sf)), plan.query_embeddings(question)
    )


@query("semantic_search_plugged", f"""
WITH d AS (
  SELECT doc_id AS document_id, source AS title, lang AS tags, n_chars AS score, list_cosine_distance(
    {SQL_LETTERS.format('text')}, {SQL_LETTERS.format(f"'{QUERY}'")}) AS distance
  FROM documents WHERE replace(text, ' ', '') <> ''
)
SELECT 0 AS query_id, CAST(rank AS INTEGER) AS rank, document_id, title, tags, score, round(distance, 6) AS distance
FROM (SELECT *, row_number() OVER (ORDER BY round(distance, 12), document_id) AS rank FROM d
      WHERE NOT isnan(distance) AND distance IS NOT NULL)
WHERE rank <= 5""")
def semantic_search_plugged(spark, sf):
    question = spark.createDataFrame([(0, QUERY)], "query_id int, content string")
    found = plan.search(
        plan.document_embeddings(embedded_documents(spark, sf), letter_counts),
        plan.query_embeddings(question, embedder=letter_counts))
    return found.withColumn("distance", F.round("distance", 6))
