"""Orders and line items as nested sales orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.nested import nest_rows
from strata.plans import warehouse as plan
from strata.registry.base import query, table
from strata.registry.ingest import write_month_shards
from strata.session import cut_lineage, scratch_path
from strata.sources.files import read_text_partitions

LINES = "items"


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Nested orders: customer struct and item array out of the flat tables."""
    customers = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.struct(
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.col("c_name").alias("name"),
                F.col("n_name").alias("city"),
                F.col("c_mktsegment").alias("segment"),
            ).alias("customer"),
        )
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    ).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    nested = nest_rows(
        lines,
        "l_orderkey",
        LINES,
        [
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
        ],
        F.col("l_linenumber"),
    )
    priority = F.col("o_orderpriority")
    channel = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "web")
        .when(priority.isin("3-MEDIUM", "4-NOT SPECIFIED"), "marketplace")
        .otherwise("store")
    )
    return (
        table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        # Inner, so that AQE may split either side; orders without lines are not staged.
        .join(nested, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            "part",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
            channel.alias("channel"),
            "customer",
            LINES,
        )
    )


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return plan.stage_orders(raw_orders(spark, sf))


def staged_table(spark: SparkSession, sf: str) -> DataFrame:
    """The staging table as written, for queries that read it more than once."""
    return cut_lineage(staged(spark, sf), "stg-orders")


SQL_BASE = """
WITH o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'web'
              WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'marketplace'
              ELSE 'store' END AS channel,
         CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, n_name AS city,
         c_mktsegment AS segment
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), i AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST((l_linenumber - 1) // 1000 AS INTEGER) AS part,
         p_name AS product_name, p_type AS category, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS unit_price
  FROM lineitem JOIN part ON l_partkey = p_partkey
), s AS (
  SELECT o.*, i.part, i.product_id, i.product_name, i.category, i.quantity, i.unit_price
  FROM o JOIN i USING (order_id)
), c AS (
  SELECT customer_id, any_value(customer_name) AS customer_name, any_value(city) AS city,
         any_value(segment) AS segment, min(order_date) AS first_order_date
  FROM s GROUP BY customer_id
), p AS (
  SELECT product_id, product_name, category, unit_price AS current_unit_price
  FROM s WHERE channel IN ('web', 'marketplace')
  QUALIFY row_number() OVER (
    PARTITION BY product_id ORDER BY order_date DESC, order_id DESC, unit_price DESC) = 1
), fo AS (
  SELECT order_id, order_date, channel, customer_id,
         CAST(sum(quantity) AS BIGINT) AS total_units,
         round(sum(CAST(quantity * unit_price AS DECIMAL(20,6))), 2)::DOUBLE AS order_amount
  FROM s GROUP BY order_id, order_date, channel, customer_id
), fi AS (
  SELECT s.order_id, s.order_date, s.customer_id, s.product_id, p.category, s.quantity,
         s.unit_price, round(s.quantity * s.unit_price, 2) AS line_amount
  FROM s JOIN p ON s.product_id = p.product_id
), d AS (
  SELECT fo.order_date AS sales_date, fo.channel, count(DISTINCT fo.order_id) AS order_count,
         CAST(sum(fi.quantity) AS BIGINT) AS units_sold,
         round(sum(CAST(fi.line_amount AS DECIMAL(20,6))), 2)::DOUBLE AS gross_revenue
  FROM fo JOIN fi USING (order_id) WHERE fo.channel IN ('web', 'marketplace')
  GROUP BY fo.order_date, fo.channel
)
"""


@query("nested_staging", SQL_BASE + """
SELECT order_id, part, order_date, channel, customer_id, customer_name, city, segment,
       CAST(count(*) AS INTEGER) AS item_count, CAST(sum(quantity) AS BIGINT) AS units
FROM s GROUP BY ALL""")
def nested_staging(spark, sf):
    """Staged records; an order with very many lines has several, by ``part``."""
    units = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, e: n + e["quantity"])
    return staged(spark, sf).select(
        "order_id", "part", "order_date", "channel", "customer.*",
        F.size("items").alias("item_count"), units.alias("units"))


@query("dim_customers", SQL_BASE + "SELECT * FROM c")
def dim_customers(spark, sf):
    return plan.dim_customers(staged(spark, sf))


@query("dim_products", SQL_BASE + "SELECT * FROM p")
def dim_products(spark, sf):
    return plan.dim_products(staged(spark, sf))


@query("channel_items_union", SQL_BASE + """
SELECT channel, product_id, count(*) AS sales, CAST(sum(quantity) AS BIGINT) AS units
FROM s WHERE channel IN ('web', 'marketplace') GROUP BY channel, product_id""")
def channel_items_union(spark, sf):
    stage = staged_table(spark, sf)
    branches = [
        plan.channel_items(stage, c).withColumn("channel", F.lit(c)) for c in plan.CHANNELS
    ]
    return branches[0].unionByName(branches[1]).groupBy("channel", "product_id").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("quantity").alias("units")
    )


def _facts(spark, sf):
    stage = staged_table(spark, sf)
    return stage, plan.fact_orders(stage, plan.dim_customers(stage))


@query("fact_orders", SQL_BASE + "SELECT * FROM fo")
def fact_orders(spark, sf):
    return _facts(spark, sf)[1]


@query("fact_order_items", SQL_BASE + "SELECT * FROM fi")
def fact_order_items(spark, sf):
    stage = staged_table(spark, sf)
    return plan.fact_order_items(stage, plan.dim_products(stage))


@query("daily_sales", SQL_BASE + "SELECT * FROM d")
def daily_sales(spark, sf):
    stage, orders = _facts(spark, sf)
    return plan.daily_sales(orders, plan.fact_order_items(stage, plan.dim_products(stage)))


@query("customer_sales_summary", SQL_BASE + """
SELECT c.customer_id, c.customer_name, c.segment,
       count(DISTINCT fo.order_id) AS lifetime_orders,
       round(sum(CAST(fo.order_amount AS DECIMAL(20,6))), 2)::DOUBLE AS lifetime_revenue
FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
             c_mktsegment AS segment FROM customer) c
LEFT JOIN fo USING (customer_id) GROUP BY ALL""")
def customer_sales_summary(spark, sf):
    # All customers of the source, so that some have no order.
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
    )
    return plan.customer_sales_summary(customers, _facts(spark, sf)[1])


@query("warehouse_verification", SQL_BASE + """
SELECT (SELECT count(*) FROM c) AS customer_count, (SELECT count(*) FROM p) AS product_count,
       (SELECT count(*) FROM fo) AS order_count, (SELECT count(*) FROM fi) AS order_item_count,
       (SELECT count(*) FROM d) AS reporting_row_count,
       (SELECT count(DISTINCT strftime(order_date, '%Y%m')) FROM fo) AS partition_count""")
def warehouse_verification(spark, sf):
    """The whole job: nested JSON lines in, written tables out, counts verified."""
    source = scratch_path(spark, "raw-orders")
    raw_orders(spark, sf).write.json(source, compression="gzip")
    target = scratch_path(spark, "warehouse")
    house = plan.build_from_ndjson(spark, source, target, "month", plan.RAW_SCHEMA)
    return plan.verification(house)


@query("partition_metadata", """
SELECT strftime(l_shipdate, '%Y%m') AS suffix FROM lineitem GROUP BY 1""")
def partition_metadata(spark, sf):
    """Partitions a written table has, from its folder names."""
    shards = read_text_partitions(spark, write_month_shards(spark, sf), "suffix")
    return plan.partition_values(shards, "suffix")
