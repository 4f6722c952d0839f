"""Row rules, assertions, scans and gates over orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import quality as ops
from strata.plans import data_products, order_quality
from strata.registry.base import query, table
from strata.registry.ingest import write_csv
from strata.session import scratch_path


def defective_orders(spark, sf):
    """Orders as delivery records; their values bring the defects along: pending
    orders have an unknown status, urgent pending ones no customer, orders below
    30000 a negative amount, and deliveries early in a month precede the order.
    """
    day = F.dayofmonth("o_orderdate")
    pending = F.col("o_orderstatus") == "P"
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(pending & (priority == "1-URGENT"), F.lit("  "))
        .when(pending & (priority == "2-HIGH"), F.lit(None))
        .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.when(priority == "5-LOW", F.lit(None))
        .otherwise(F.date_format(F.date_add(F.to_date("o_orderdate"), day - 3), "yyyy-MM-dd"))
        .alias("delivery_date"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "processing")
        .when(priority == "3-MEDIUM", F.lit(None))
        .otherwise("unknown").alias("status"),
        (F.col("o_totalprice") - 30000).alias("amount"),
        F.lit("BR").alias("country_code"),
    )


SQL_DEFECTS = """
WITH d AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN '  '
              WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(o_orderdate AS DATE) + CAST(day(o_orderdate) - 3 AS INTEGER) END
           AS delivery_date,
         CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'processing'
              WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'unknown' END AS status,
         o_totalprice - 30000 AS amount, 'BR' AS country_code
  FROM orders
), a AS (
  SELECT *,
         CASE WHEN trim(coalesce(customer_id, '')) = '' THEN ['customer_id_required'] ELSE [] END
      || CASE WHEN amount > 0 THEN [] ELSE ['amount_positive'] END
      || CASE WHEN coalesce(status, '') IN ('processing', 'shipped', 'delivered', 'cancelled')
              THEN [] ELSE ['status_valid'] END
      || CASE WHEN delivery_date < order_date THEN ['delivery_not_before_order'] ELSE [] END
         AS failed_rules
  FROM d
)
"""


def assessed(spark, sf, null_policy="fail"):
    return order_quality.assess(defective_orders(spark, sf), null_policy)


@query("row_rules_valid", SQL_DEFECTS + """
SELECT order_id, customer_id, order_date, delivery_date, status, amount, country_code
FROM a WHERE len(failed_rules) = 0""")
def row_rules_valid(spark, sf):
    return ops.valid_rows(assessed(spark, sf))


@query("row_rules_rejected", SQL_DEFECTS + """
SELECT order_id, customer_id, order_date, delivery_date, status, amount, country_code,
       array_to_string(failed_rules, ',') AS failed_rules FROM a WHERE len(failed_rules) > 0""")
def row_rules_rejected(spark, sf):
    rejected = ops.quarantined_rows(assessed(spark, sf))
    return rejected.withColumn("failed_rules", F.array_join("failed_rules", ","))


@query("row_rules_null_passes", SQL_DEFECTS + """
SELECT count(*) AS total_records,
       count(*) FILTER (NOT (customer_id IS NULL OR trim(customer_id) = '')
         AND amount > 0 AND coalesce(status <> 'unknown', true)
         AND coalesce(delivery_date >= order_date, true)) AS valid_records
FROM a""")
def row_rules_null_passes(spark, sf):
    """The lenient policy: an unknown status passes."""
    metrics = ops.quality_metrics(assessed(spark, sf, "pass"))
    return metrics.select("total_records", "valid_records")


@query("quality_metrics", SQL_DEFECTS + """
SELECT count(*) AS total_records, count(*) FILTER (len(failed_rules) = 0) AS valid_records,
       count(*) FILTER (len(failed_rules) > 0) AS rejected_records,
       round(count(*) FILTER (len(failed_rules) = 0) / count(*), 4) AS validity_rate FROM a""")
def quality_metrics(spark, sf):
    return ops.quality_metrics(assessed(spark, sf)).drop("assessed_at")


@query("failed_rule_counts", SQL_DEFECTS + """
SELECT failed_rule, count(*) AS rejected_records
FROM (SELECT unnest(failed_rules) AS failed_rule FROM a) GROUP BY failed_rule""")
def failed_rule_counts(spark, sf):
    return ops.failed_rule_counts(assessed(spark, sf))


@query("failed_rules", SQL_DEFECTS + """
SELECT DISTINCT failed_rule FROM (SELECT unnest(failed_rules) AS failed_rule FROM a)""")
def failed_rules(spark, sf):
    return ops.failed_rules(ops.quarantined_rows(assessed(spark, sf)))


@query("order_quality_job", SQL_DEFECTS + """
SELECT count(*) AS total_records, count(*) FILTER (len(failed_rules) = 0) AS valid_records,
       count(*) FILTER (len(failed_rules) > 0) AS rejected_records,
       round(count(*) FILTER (len(failed_rules) = 0) / count(*), 4) AS validity_rate FROM a""")
def order_quality_job(spark, sf):
    """CSV in, three written tables out, summarised."""
    source = write_csv(defective_orders(spark, sf), "orders-csv")
    return order_quality.summary(order_quality.run(spark, source, scratch_path(spark, "quality")))


@query("assert_non_null", SQL_DEFECTS + """
SELECT order_id, customer_id, status FROM d WHERE customer_id IS NULL OR status IS NULL""")
def assert_non_null(spark, sf):
    broken = ops.non_null_violations(defective_orders(spark, sf), ["customer_id", "status"])
    return broken.select("order_id", "customer_id", "status")


@query("assert_unique_key", """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def assert_unique_key(spark, sf):
    return ops.unique_key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("assert_row_conditions", SQL_DEFECTS + """
SELECT order_id, status, amount FROM d
WHERE NOT coalesce(status = 'delivered' AND amount >= 10000, false)""")
def assert_row_conditions(spark, sf):
    broken = ops.row_condition_violations(
        defective_orders(spark, sf), "status = 'delivered' AND amount >= 10000"
    )
    return broken.select("order_id", "status", "amount")


@query("assertion_report", """
SELECT 'lineitem' AS model, 'non_null' AS assertion,
       count(*) FILTER (l_orderkey IS NULL OR l_shipdate IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'lineitem', 'row_condition: l_quantity > 5',
       count(*) FILTER (NOT l_quantity > 5) FROM lineitem
UNION ALL SELECT 'lineitem', 'unique_key: l_orderkey, l_linenumber', count(*) FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def assertion_report(spark, sf):
    rules = ops.Assertions(
        ("l_orderkey", "l_shipdate"), ("l_orderkey", "l_linenumber"), ("l_quantity > 5",)
    )
    return ops.assertion_report("lineitem", table(spark, sf, "lineitem"), rules)


CUSTOMER_SCAN = (
    ops.Rule("key_complete", "c_custkey", "non_null", "COMPLETENESS"),
    ops.Rule("key_unique", "c_custkey", "unique", "UNIQUENESS"),
    ops.Rule("nation_unique", "c_nationkey", "unique", "UNIQUENESS"),
    ops.Rule("known_segment", "c_mktsegment", "in_set", "VALIDITY", threshold=0.3,
                 values=("BUILDING", "MACHINERY")),
    ops.Rule("positive_balance", "c_acctbal", "range", "VALIDITY", threshold=0.9,
                 minimum=0, strict_minimum=True),
    ops.Rule("name_shape", "c_name", "regex", "VALIDITY", pattern="^Customer#[0-9]{9}$"),
)

SQL_SCAN = """
WITH u(rule, dimension, threshold, evaluated, passed) AS (
  SELECT 'key_complete', 'COMPLETENESS', 1.0::DOUBLE, count(*), count(c_custkey) FROM customer
  UNION ALL SELECT 'key_unique', 'UNIQUENESS', 1.0, CAST(sum(n) AS BIGINT), count(*) FILTER (n = 1)
    FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey)
  UNION ALL SELECT 'nation_unique', 'UNIQUENESS', 1.0, CAST(sum(n) AS BIGINT),
    count(*) FILTER (n = 1) FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey)
  UNION ALL SELECT 'known_segment', 'VALIDITY', 0.3, count(*),
    count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) FROM customer
  UNION ALL SELECT 'positive_balance', 'VALIDITY', 0.9, count(*), count(*) FILTER (c_acctbal > 0)
    FROM customer
  UNION ALL SELECT 'name_shape', 'VALIDITY', 1.0, count(*),
    count(*) FILTER (regexp_matches(c_name, '^Customer#[0-9]{9}$')) FROM customer
), r AS (
  SELECT *, round(passed / evaluated, 6) AS ratio, passed / evaluated >= threshold AS ok FROM u
)
"""


@query("quality_scan", SQL_SCAN + "SELECT * FROM r")
def quality_scan(spark, sf):
    return ops.scan(table(spark, sf, "customer"), CUSTOMER_SCAN)


@query("quality_scan_score", SQL_SCAN + """
SELECT round(avg(ratio) * 100, 4) AS score, count(*) AS rule_count, bool_and(ok) AS passed FROM r""")
def quality_scan_score(spark, sf):
    return ops.scan_score(ops.scan(table(spark, sf, "customer"), CUSTOMER_SCAN))


@query("metric_gate", """
SELECT 'row_count' AS metric, 'at least 1' AS expected, CAST(count(*) AS VARCHAR) AS actual,
       count(*) >= 1 AS ok FROM orders
UNION ALL SELECT 'statuses', 'equals 3', CAST(count(DISTINCT o_orderstatus) AS VARCHAR),
       count(DISTINCT o_orderstatus) = 3 FROM orders
UNION ALL SELECT 'customers', 'above 0 and below 10', CAST(count(DISTINCT o_custkey) AS VARCHAR),
       count(DISTINCT o_custkey) BETWEEN 1 AND 9 FROM orders""")
def metric_gate(spark, sf):
    metrics = table(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("o_orderstatus").alias("statuses"),
        F.count_distinct("o_custkey").alias("customers"),
    )
    expected = {
        "row_count": ops.Expect(at_least=1),
        "statuses": ops.Expect(equals=3),
        "customers": ops.Expect(above=0, below=10),
    }
    return ops.gate(metrics, expected)


@query("domain_row_counts", """
SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers""")
def domain_row_counts(spark, sf):
    return data_products.row_counts(table(spark, sf, "orders"), table(spark, sf, "customer"))


@query("domain_scan_job", """
WITH d AS (
  SELECT CAST(o_orderkey // 3 AS VARCHAR) AS order_id, o_orderstatus AS s, o_totalprice - 50000 AS amount FROM orders
), u(rule, dimension, evaluated, passed) AS (
  SELECT 'order_id_complete', 'COMPLETENESS', count(*), count(order_id) FROM d
  UNION ALL SELECT 'order_id_unique', 'UNIQUENESS', CAST(sum(n) AS BIGINT), count(*) FILTER (n = 1)
    FROM (SELECT count(*) AS n FROM d GROUP BY order_id)
  UNION ALL SELECT 'valid_status', 'VALIDITY', count(*), count(*) FILTER (s IN ('F', 'O')) FROM d
  UNION ALL SELECT 'positive_amount', 'VALIDITY', count(*), count(*) FILTER (amount > 0) FROM d
)
SELECT rule, dimension, 1.0::DOUBLE AS threshold, evaluated, passed,
       round(passed / evaluated, 6) AS ratio, passed = evaluated AS ok FROM u""")
def domain_scan_job(spark, sf):
    """A domain loaded from JSON lines and scanned; shared ids, unknown statuses and
    amounts below zero break the rules.
    """
    status = F.col("o_orderstatus")
    orders = table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 3).cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.when(status == "F", "PAID").when(status == "O", "SHIPPED").otherwise("PENDING")
        .alias("status"),
        (F.col("o_totalprice") - 50000).cast("decimal(12,2)").cast("string").alias("amount"),
    )
    source = scratch_path(spark, "domain-json")
    orders.write.json(source)
    loaded = data_products.load_domain(
        spark, source, data_products.ORDER_COLUMNS, scratch_path(spark, "domain")
    )
    return data_products.scan_domain(loaded, data_products.ORDER_RULES, strict=False)
