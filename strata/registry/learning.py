"""Orders as sessions, customers as visitors, documents as scored items."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import learning as ops
from strata.operators.nested import element_where
from strata.operators.ordering import best_per_key
from strata.plans import purchases
from strata.registry.base import query, table
from strata.session import scratch_path
from strata.sources.files import read_text_partitions
from strata.sources.sinks import overwrite_partitioned

TRAIN, JUDGE, SCORE = ("19950101", "19991231"), ("20000101", "20001231"), ("20010101", "20011231")


def sessions(spark, sf):
    """Nested sessions: one per order, lines as its page views, big lines as buys."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("pageviews"),
        F.sum("l_quantity").cast("bigint").alias("time"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1)).alias("bounces"),
        F.count_if(F.col("l_quantity") > 45).alias("buys"),
    )
    return (
        table(spark, sf, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_custkey").cast("string").alias("fullVisitorId"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("suffix"),
            F.struct(
                "bounces", F.col("time").alias("timeOnSite"), "pageviews",
                F.col("buys").alias("transactions"),
            ).alias("totals"),
            F.struct(
                F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("medium")
            ).alias("trafficSource"),
            F.struct(F.col("c_mktsegment").alias("deviceCategory")).alias("device"),
            F.struct(F.col("n_name").alias("country")).alias("geoNetwork"),
        )
    )


def session_table(spark, sf):
    """The sessions as a table by month, so that a date range reads its months only."""
    dated = sessions(spark, sf).withColumn(ops.MONTH, F.substring("suffix", 1, 6))
    path = overwrite_partitioned(dated, scratch_path(spark, "sessions"), [ops.MONTH])
    return read_text_partitions(spark, path, ops.MONTH)


SQL_FEATURES = """
WITH l AS (
  SELECT l_orderkey, count(*) AS pageviews, CAST(sum(l_quantity) AS BIGINT) AS time_on_site,
    count(*) FILTER (l_returnflag = 'R') AS bounces, count(*) FILTER (l_quantity > 45) AS buys
  FROM lineitem GROUP BY l_orderkey
), f AS (
  SELECT CAST(o_custkey AS VARCHAR) AS visitor_id, strftime(o_orderdate, '%Y%m%d') AS suffix,
    coalesce(bounces, 0) AS bounces, coalesce(time_on_site, 0) AS time_on_site,
    coalesce(pageviews, 0) AS pageviews, o_orderpriority AS traffic_source,
    o_orderstatus AS traffic_medium, c_mktsegment AS device_category, n_name AS country,
    CASE WHEN buys > 0 THEN 1 ELSE 0 END AS will_buy_on_return_visit
  FROM orders LEFT JOIN l ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)
"""


@query("ml_features", SQL_FEATURES + "SELECT * FROM f")
def ml_features(spark, sf):
    return ops.session_features(sessions(spark, sf))


@query("temporal_split", SQL_FEATURES + """
SELECT CASE WHEN suffix <= '19991231' THEN 'train' WHEN suffix <= '20001231' THEN 'evaluate'
            ELSE 'score' END AS part,
       count(*) AS sessions, CAST(sum(will_buy_on_return_visit) AS BIGINT) AS buyers
FROM f GROUP BY 1""")
def temporal_split(spark, sf):
    """The three ranges counted in one pass."""
    parts = {"train": TRAIN, "evaluate": JUDGE, "score": SCORE}
    features = ops.labelled_ranges(ops.session_features(sessions(spark, sf)), parts)
    return features.groupBy("part").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum(ops.LABEL).alias("buyers")
    )


@query("class_weights", SQL_FEATURES + """
SELECT will_buy_on_return_visit AS label, count(*) AS sessions,
       round((SELECT count(*) FROM f) / (2.0 * count(*)), 9)::DOUBLE AS weight
FROM f GROUP BY 1""")
def class_weights(spark, sf):
    weighted = ops.with_class_weights(ops.session_features(sessions(spark, sf)))
    return weighted.groupBy(F.col(ops.LABEL).alias("label")).agg(
        F.count(F.lit(1)).alias("sessions"), F.round(F.max("weight"), 9).alias("weight")
    )


@query("binary_metrics", """
WITH s AS (
  SELECT quality, 1.0 / (1.0 + exp(-(n_chars - 2000) / 1000.0)) AS score
  FROM labels JOIN documents USING (doc_id)
), g AS (
  SELECT score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg
  FROM s GROUP BY score
), r AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS below, greatest(least(score, 1 - 1e-15), 1e-15) AS q FROM g
), t AS (
  SELECT sum(pos)::DOUBLE AS p, sum(neg)::DOUBLE AS n,
    coalesce(sum(pos) FILTER (score >= 0.5), 0)::DOUBLE AS tp,
    coalesce(sum(neg) FILTER (score >= 0.5), 0)::DOUBLE AS fp,
    sum(-(pos * ln(q) + neg * ln(1 - q))) AS loss, sum(pos * (below + neg / 2.0))::DOUBLE AS wins
  FROM r
)
SELECT round(tp / (tp + fp), 6) AS "precision", round(tp / p, 6) AS recall,
       round((tp + n - fp) / (p + n), 6) AS accuracy, round(2 * tp / (2 * tp + fp + p - tp), 6) AS f1_score,
       round(loss / (p + n), 6) AS log_loss, round(wins / (p * n), 6) AS roc_auc FROM t""")
def binary_metrics(spark, sf):
    """A score from the document length against the quality label."""
    score = 1.0 / (1.0 + F.exp(-(F.col("n_chars") - 2000) / 1000.0))
    scored = table(spark, sf, "labels").join(
        table(spark, sf, "documents").select("doc_id", score.alias("score")), "doc_id"
    )
    metrics = ops.binary_metrics(scored, "quality", "score")
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


def sql_model(first: str, last: str) -> str:
    """CTEs after ``f`` that fit the model to a range of sessions: ``model`` has its ``weights``.

    A Newton step is the two sums over all rows, then elimination column by column.
    """
    size = 1 + len(ops.NUMERIC) + ops.HASHED
    numbers = ", ".join(f"({c} - m_{c}) / d_{c}" for c in ops.NUMERIC)
    scale = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_samp({c}) > 0 THEN stddev_samp({c}) ELSE 1 END AS d_{c}"
                      for c in ops.NUMERIC)
    marks = " + ".join(
        f"CASE WHEN CAST('0x' || substr(md5('{c}=' || coalesce(nullif({c}, ''), '{ops.NO_CATEGORY}')), 1, 7) AS BIGINT)"
        f" % {ops.HASHED} = i THEN 1 ELSE 0 END" for c in ops.CATEGORICAL)
    steps = [f"""
scale AS MATERIALIZED (
  SELECT count(*)::DOUBLE AS n, sum({ops.LABEL})::DOUBLE AS ones, {scale} FROM f WHERE suffix BETWEEN '{first}' AND '{last}'),
vectors AS MATERIALIZED (
  SELECT visitor_id, suffix, {ops.LABEL}::DOUBLE AS y,
    CASE WHEN {ops.LABEL} = 1 THEN n / (2 * ones) ELSE n / (2 * (n - ones)) END AS weight,
    list_concat([1.0::DOUBLE, {numbers}], [({marks})::DOUBLE FOR i IN range({ops.HASHED})]) AS x
  FROM f, scale),
b0 AS (SELECT [0.0::DOUBLE FOR i IN range({size})] AS weights)"""]
    for t in range(1, ops.NEWTON_STEPS + 1):
        steps.append(f"""
p{t} AS MATERIALIZED (
  SELECT x, weight * (y - p) AS e, weight * p * (1 - p) AS h FROM (
    SELECT x, y, weight, 1 / (1 + exp(-list_inner_product(x, weights))) AS p
    FROM vectors, b{t - 1} WHERE suffix BETWEEN '{first}' AND '{last}')),
s{t} AS MATERIALIZED (
  SELECT i, j, sum(CASE WHEN j > {size} THEN e ELSE h * x[j] END * x[i])
           + CASE WHEN i > 1 AND i = j THEN {ops.RIDGE} WHEN i > 1 AND j > {size} THEN -{ops.RIDGE} * any_value(b{t - 1}.weights[i]) ELSE 0 END AS v
  FROM (SELECT x, e, h, i, unnest(generate_series(1, {size + 1})) AS j FROM (
    SELECT x, e, h, unnest(generate_series(1, {size})) AS i FROM p{t}) WHERE x[i] <> 0), b{t - 1}
  GROUP BY i, j),
full{t} AS (
  SELECT i, j, coalesce(v, CASE WHEN i = j THEN {ops.RIDGE} WHEN j > {size} THEN -{ops.RIDGE} * b{t - 1}.weights[i] ELSE 0 END) AS v
  FROM (SELECT unnest(generate_series(1, {size})) AS i) CROSS JOIN (SELECT unnest(generate_series(1, {size + 1})) AS j)
  CROSS JOIN b{t - 1} LEFT JOIN s{t} USING (i, j)),
e{t} AS (
  SELECT 1 AS k, list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM full{t} GROUP BY i)
  UNION ALL
  SELECT k + 1, [CASE WHEN i = k THEN [m[k][j] / m[k][k] FOR j IN range(1, {size + 2})]
                 ELSE [m[i][j] - m[i][k] * m[k][j] / m[k][k] FOR j IN range(1, {size + 2})] END FOR i IN range(1, {size + 1})]
  FROM e{t} WHERE k <= {size}),
b{t} AS MATERIALIZED (
  SELECT [b{t - 1}.weights[i] + m[i][{size + 1}] FOR i IN range(1, {size + 1})] AS weights
  FROM e{t}, b{t - 1} WHERE k = {size + 1})""")
    return ",".join(steps) + f", model AS (SELECT weights FROM b{ops.NEWTON_STEPS})"


SQL_RECURSIVE_FEATURES = SQL_FEATURES.strip().replace("WITH l AS", "WITH RECURSIVE l AS")


@query("ml_train_score", SQL_RECURSIVE_FEATURES + "," + sql_model(*TRAIN) + f"""
SELECT visitor_id, CAST(max(p) > 0.5 AS INTEGER) AS predicted_transaction, round(max(p), 6) AS transaction_probability
FROM (SELECT visitor_id, 1 / (1 + exp(-list_inner_product(x, weights))) AS p FROM vectors, model
      WHERE suffix BETWEEN '{SCORE[0]}' AND '{SCORE[1]}')
GROUP BY visitor_id""")
def ml_train_score(spark, sf):
    """Train, evaluate and gate, then the best prediction per visitor."""
    trained = purchases.run(session_table(spark, sf), TRAIN, JUDGE, SCORE)
    return trained.predictions.withColumn("transaction_probability", F.round("transaction_probability", 6))


@query("ml_coefficients", SQL_RECURSIVE_FEATURES + "," + sql_model(*TRAIN) + """
SELECT i AS position, round(weights[i + 1], 6) + 0.0 AS weight
FROM model, (SELECT unnest(generate_series(0, len(weights) - 1)) AS i FROM model)""")
def ml_coefficients(spark, sf):
    """The fitted weights: of one, of the scaled numbers, of the category positions."""
    model = ops.train(ops.in_range(ops.session_features(sessions(spark, sf)), TRAIN))
    rows = [(i, float(w)) for i, w in enumerate(model.weights)]  # as many as the model has
    weights = spark.createDataFrame(rows, "position long, weight double")
    return weights.withColumn("weight", F.round("weight", 6) + F.lit(0.0))


@query("ml_scored_visitors", SQL_FEATURES + """
SELECT visitor_id, 1::BIGINT AS predictions, true AS is_probability, count(*) AS sessions,
       max(suffix) AS last_session FROM f
WHERE suffix BETWEEN '20010101' AND '20011231' GROUP BY visitor_id""")
def ml_scored_visitors(spark, sf):
    """Every visitor of the scoring range has one prediction, and it is a probability."""
    table_ = session_table(spark, sf)
    trained = purchases.run(table_, TRAIN, JUDGE, SCORE)
    probability = F.col("transaction_probability")
    sound = probability.between(0, 1) & (F.col("predicted_transaction") == (probability > 0.5).cast("int"))
    scored = trained.predictions.groupBy("visitor_id").agg(
        F.count(F.lit(1)).alias("predictions"), F.bool_and(sound).alias("is_probability")
    )
    visits = ops.in_range(ops.session_features(table_), SCORE).groupBy("visitor_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.max("suffix").alias("last_session"))
    return scored.join(visits, "visitor_id")


@query("ml_evaluation", SQL_FEATURES + """
SELECT metric, true AS ok, judged, positives, scored
FROM (VALUES ('precision'), ('recall'), ('roc_auc'), ('predictions')) AS t(metric),
  (SELECT count(*) AS judged, CAST(sum(will_buy_on_return_visit) AS BIGINT) AS positives
   FROM f WHERE suffix BETWEEN '20000101' AND '20001231'),
  (SELECT count(DISTINCT visitor_id) AS scored FROM f WHERE suffix BETWEEN '20010101' AND '20011231')""")
def ml_evaluation(spark, sf):
    """The gate on the trained model's metrics, with the rows it was judged on."""
    trained = purchases.run(session_table(spark, sf), TRAIN, JUDGE, SCORE)
    judged = trained.judged.agg(F.struct(
        F.count(F.col("score")).alias("rows"), F.sum(ops.LABEL).alias("positives")).alias("j")).scalar()
    scored = trained.predictions.agg(F.count(F.lit(1))).scalar()
    return purchases.verify(trained).select(
        "metric", "ok", judged["rows"].alias("judged"), judged["positives"].alias("positives"), scored.alias("scored"))


@query("best_per_key_from_array", """
SELECT l_orderkey, prob FROM (
  SELECT l_orderkey, l_discount * 10 AS prob, l_extendedprice FROM lineitem)
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey ORDER BY prob DESC, l_extendedprice) = 1""")
def best_per_key_from_array(spark, sf):
    """The probability of label 1 out of an array, best row per key."""
    prob = F.col("l_discount") * 10
    probs = F.array(
        F.struct(F.lit(0).alias("label"), (1 - prob).alias("prob")),
        F.struct(F.lit(1).alias("label"), prob.alias("prob")),
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_extendedprice", probs.alias("probs")
    )
    scored = lines.withColumn("prob", element_where("probs", "label", 1, "prob"))
    best = best_per_key(scored, ["l_orderkey"], [F.desc("prob"), F.col("l_extendedprice")])
    return best.select("l_orderkey", "prob")
