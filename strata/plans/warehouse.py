"""Nested orders to staging, dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.numbers import as_money, exact_sum
from strata.operators.nested import reshape_elements, struct_of, unnest
from strata.operators.quality import counts_row
from strata.sources.files import read_ndjson
from strata.sources.sinks import overwrite, overwrite_clustered, overwrite_partitioned

# Sales channels that reach products and marts, and column names.
CHANNELS = ("web", "marketplace")
MONTH = "month"
RAW_SCHEMA = (
    "order_id string, part int, order_date string, channel string, "
    "customer struct<customer_id:string,name:string,city:string,segment:string>, "
    "items array<struct<product_id:string,name:string,category:string,quantity:bigint,"
    "unit_price:double>>"
)
CUSTOMER_MEMBERS = {
    "customer.customer_id": "customer_id",
    "customer.name": "customer_name",
    "customer.city": "city",
    "customer.segment": "segment",
}
ITEM_MEMBERS = {
    "product_id": "product_id",
    "name": "product_name",
    "category": "category",
    "quantity": "quantity",
    "unit_price": "unit_price",
}


def stage_orders(raw: DataFrame) -> DataFrame:
    """Typed orders with renamed members; orders without id or items are left out.

    The key is ``(order_id, part)``. Sources with one record per order need no ``part``.
    """
    part = F.coalesce("part", F.lit(0)) if "part" in raw.columns else F.lit(0)
    return raw.filter(F.col("order_id").isNotNull() & (F.size("items") > 0)).select(
        "order_id",
        part.cast("int").alias("part"),
        F.to_date("order_date").alias("order_date"),
        "channel",
        struct_of(CUSTOMER_MEMBERS).alias("customer"),
        reshape_elements("items", ITEM_MEMBERS).alias("items"),
    )


def dim_customers(staged: DataFrame) -> DataFrame:
    """One row per customer; its attributes come from the newest order."""
    newest = F.max(F.struct("order_date", "order_id", "customer"))
    grouped = staged.groupBy(F.col("customer.customer_id").alias("customer_id")).agg(
        newest.alias("__n"), F.min("order_date").alias("first_order_date")
    )
    return grouped.select(
        "customer_id",
        *[F.col(f"__n.customer.{c}").alias(c) for c in ("customer_name", "city", "segment")],
        "first_order_date",
    )


def channel_items(staged: DataFrame, channel: str) -> DataFrame:
    """Items sold through one channel, as flat columns."""
    sold = staged.filter(F.col("channel") == channel)
    return unnest(sold, "items").select("order_date", "order_id", "item.*")


def dim_products(staged: DataFrame, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """One row per product sold in the channels; attributes of the newest sale.

    The branches of a union by channel cover the same rows as one scan of all the
    channels, so one scan it is.
    """
    sold = unnest(staged.filter(F.col("channel").isin(*channels)), "items")
    # Each member once: these rows are sorted and shuffled.
    newest = F.max(F.struct("order_date", "order_id", "item.unit_price", "item.product_name", "item.category"))
    return (
        sold.groupBy(F.col("item.product_id").alias("product_id"))
        .agg(newest.alias("__n"))
        .select(
            "product_id",
            F.col("__n.product_name").alias("product_name"),
            F.col("__n.category").alias("category"),
            F.col("__n.unit_price").alias("current_unit_price"),
        )
    )


def fact_orders(staged: DataFrame, customers: DataFrame) -> DataFrame:
    """Units and amount per order. Items add up before the customer join, which then
    carries one row per order.
    """
    item = F.col("item")
    per_order = (
        unnest(staged, "items")
        .groupBy(
            "order_id", "order_date", "channel",
            F.col("customer.customer_id").alias("customer_id"),
        )
        .agg(
            F.sum(item["quantity"]).alias("total_units"),
            exact_sum(item["quantity"] * item["unit_price"]).alias("__amount"),
        )
    )
    return per_order.join(customers.select("customer_id"), "customer_id").select(
        "order_id", "order_date", "channel", "customer_id", "total_units",
        as_money(F.col("__amount")).alias("order_amount"),
    )


def fact_order_items(staged: DataFrame, products: DataFrame) -> DataFrame:
    """One row per item of a known product, with its line amount."""
    item = unnest(staged, "items").select(
        "order_id",
        "order_date",
        F.col("customer.customer_id").alias("customer_id"),
        F.col("item.product_id").alias("product_id"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.unit_price").alias("unit_price"),
    )
    return item.join(products.select("product_id", "category"), "product_id").select(
        "order_id", "order_date", "customer_id", "product_id", "category", "quantity",
        "unit_price", F.round(F.col("quantity") * F.col("unit_price"), 2).alias("line_amount"),
    )


def daily_sales(
    orders: DataFrame, items: DataFrame, channels: Sequence[str] = CHANNELS
) -> DataFrame:
    """Orders, units and revenue per day and channel.

    Items shrink to one row per order before the join: both sides are unique by
    order and nothing can be hot. One grouping replaces a union per channel.
    """
    per_order = items.groupBy("order_id").agg(
        F.sum("quantity").alias("__units"), exact_sum(F.col("line_amount")).alias("__revenue")
    )
    sold = orders.filter(F.col("channel").isin(*channels)).select(
        "order_id", F.col("order_date").alias("sales_date"), "channel"
    )
    return sold.join(per_order, "order_id").groupBy("sales_date", "channel").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("__units").alias("units_sold"),
        as_money(F.sum("__revenue")).alias("gross_revenue"),
    )


def customer_sales_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Lifetime orders and revenue of every customer, NULL revenue for none."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("__orders"),
        exact_sum(F.col("order_amount")).alias("__revenue"),
    )
    return customers.join(per_customer, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "segment",
        F.coalesce("__orders", F.lit(0)).alias("lifetime_orders"),
        as_money(F.col("__revenue")).alias("lifetime_revenue"),
    )


@dataclass(frozen=True)
class Warehouse:
    """The warehouse tables, each as written."""

    staged: DataFrame
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame
    daily: DataFrame

    def customer_sales_summary(self) -> DataFrame:
        return customer_sales_summary(self.customers, self.orders)


def build(raw: DataFrame, folder: str, grain: str = "day") -> Warehouse:
    """Build the tables in order; each is written and the next one reads it.

    Facts and marts are partitioned by ``day``, or by ``month`` where a day holds too
    few rows to be worth a file.
    """
    spark = raw.sparkSession

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    def write(df: DataFrame, name: str, date: str, cluster: list[str]) -> None:
        if grain == "month":
            dated = df.withColumn(MONTH, F.date_format(date, "yyyyMM"))
            overwrite_partitioned(dated, f"{folder}/{name}", [MONTH], [date, *cluster])
        else:
            overwrite_partitioned(df, f"{folder}/{name}", [date], cluster)

    overwrite(stage_orders(raw), f"{folder}/stg_orders")
    staged = table("stg_orders")
    overwrite_clustered(dim_customers(staged), f"{folder}/dim_customers", ["segment", "city"])
    overwrite_clustered(dim_products(staged), f"{folder}/dim_products", ["category"])
    orders = fact_orders(staged, table("dim_customers"))
    write(orders, "fact_orders", "order_date", ["customer_id", "channel"])
    items = fact_order_items(staged, table("dim_products"))
    write(items, "fact_order_items", "order_date", ["product_id", "category"])
    daily = daily_sales(table("fact_orders"), table("fact_order_items"))
    write(daily, "daily_sales", "sales_date", ["channel"])
    return Warehouse(
        staged,
        table("dim_customers"),
        table("dim_products"),
        table("fact_orders"),
        table("fact_order_items"),
        table("daily_sales"),
    )


def build_from_ndjson(
    spark: SparkSession, path: str, folder: str, grain: str = "day", schema: str | None = None
) -> Warehouse:
    """Load nested JSON lines and build the warehouse.

    Without a schema Spark detects it in a pass over all files; ``RAW_SCHEMA`` saves it.
    """
    return build(read_ndjson(spark, path, schema), folder, grain)


def partition_values(table: DataFrame, column: str) -> DataFrame:
    """The partition values a table has (folder names; no data is read)."""
    return table.select(column).filter(F.col(column).isNotNull()).distinct()


def verification(house: Warehouse) -> DataFrame:
    """Row counts of all tables and the partitions of the order fact, in one row."""
    grain = MONTH if MONTH in house.orders.columns else "order_date"

    def rows(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()

    return counts_row(
        house.staged.sparkSession,
        customer_count=rows(house.customers),
        product_count=rows(house.products),
        order_count=rows(house.orders),
        order_item_count=rows(house.items),
        reporting_row_count=rows(house.daily),
        partition_count=rows(partition_values(house.orders, grain)),
    )
