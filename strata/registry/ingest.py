"""Round trips: tables written in a source format and read by its operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.contracts import check_messages, traffic_contract
from strata.operators.ordering import with_row_ids
from strata.plans import governed_files, revenue, tips
from strata.registry.base import SQL_ISO, SQL_K, iso_text, prop_k, query, table
from strata.session import scratch_path
from strata.sources.external import drop_external_table
from strata.sources import files, layout, sinks
from strata.streaming import arrivals
from strata.streaming.tables import drain

SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


def write_csv(df, label):
    path = scratch_path(df.sparkSession, label)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("csv_declared", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_declared(spark, sf):
    path = write_csv(table(spark, sf, "customer"), "customer-csv")
    schema = (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )
    return files.read_csv(spark, path, schema, strict=True)


@query("csv_inferred_ratio", """
SELECT l_orderkey, l_linenumber, l_tax, l_discount,
       round(l_tax / nullif(l_discount, 0) * 100, 2) AS tax_percentage FROM lineitem""")
def csv_inferred_ratio(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    source = files.read_csv_inferred(spark, write_csv(lines, "lineitem-csv"))
    ratio = tips.with_ratio(source, "l_tax", "l_discount", "tax_percentage")
    return spark.read.parquet(sinks.overwrite(ratio, scratch_path(spark, "enriched"))).withColumn(
        "l_orderkey", F.col("l_orderkey").cast("bigint")
    )


@query("ingest_header_contract", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def ingest_header_contract(spark, sf):
    supplier = table(spark, sf, "supplier")
    path = write_csv(supplier.toDF(*[f" {c.upper()} " for c in supplier.columns]), "supplier-csv")
    loaded = tips.load(spark, path, scratch_path(spark, "supplier"), supplier.columns)
    return loaded.withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query("ndjson_nested", """
SELECT p_partkey, p_brand, p_type AS kind, p_size AS size, p_retailprice AS price FROM part""")
def ndjson_nested(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.struct("p_brand", F.struct(F.col("p_type").alias("kind")).alias("detail")).alias("about"),
        F.array(
            F.struct(F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
        ).alias("offers"),
    )
    path = scratch_path(spark, "part-json")
    part.write.json(path)
    nested = files.read_ndjson(spark, path)
    return nested.withColumn("offer", F.explode("offers")).select(
        "p_partkey",
        "about.p_brand",
        "about.detail.kind",
        F.col("offer.size").cast("int").alias("size"),
        "offer.price",
    )


@query("ndjson_declared", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
       o_totalprice AS amount FROM orders""")
def ndjson_declared(spark, sf):
    """Amounts travel as JSON text and arrive as decimals."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("amount"),
    )
    path = scratch_path(spark, "orders-json")
    orders.write.json(path)
    columns = {"order_id": "string", "order_date": "date", "amount": "decimal(38,9)"}
    typed = files.read_ndjson_typed(spark, path, columns, required=tuple(columns))
    return typed.withColumn("amount", F.col("amount").cast("double"))


def traffic_messages(spark, sf):
    """Events as page views."""
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        iso_text("ts").alias("event_time"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("path"),
        prop_k().alias("bytes_sent"),
    )


@query("jsonl_roundtrip", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, {SQL_ISO} AS event_time,
       CAST(user_id AS VARCHAR) AS user_id, event_type AS path, {SQL_K} AS bytes_sent
FROM events""")
def jsonl_roundtrip(spark, sf):
    path = sinks.overwrite_json_lines(traffic_messages(spark, sf), scratch_path(spark, "views"))
    return files.read_json_lines(spark, path, traffic_contract())


@query("jsonl_shards", f"""
SELECT event_type AS path, count(*) AS views, CAST(sum({SQL_K}) AS BIGINT) AS bytes_sent
FROM events GROUP BY event_type""")
def jsonl_shards(spark, sf):
    """Shards below a prefix, other suffixes ignored."""
    folder = scratch_path(spark, "shards")
    sinks.overwrite_json_lines(traffic_messages(spark, sf), f"{folder}/part=a")
    traffic_messages(spark, sf).write.json(f"{folder}/part=b")  # .json: not a shard
    schema = "event_id string, event_time string, user_id string, path string, bytes_sent bigint"
    shards = files.read_jsonl_shards(spark, folder, schema)
    return shards.groupBy("path").agg(
        F.count(F.lit(1)).alias("views"), F.sum("bytes_sent").alias("bytes_sent")
    )


@query("published_messages", f"""
SELECT event_type AS topic_path, count(*) AS messages,
       CAST(sum({SQL_K}) AS BIGINT) AS bytes_sent FROM events GROUP BY event_type""")
def published_messages(spark, sf):
    """Messages written with an attribute map and read back from their bodies."""
    path = sinks.publish(traffic_messages(spark, sf), scratch_path(spark, "topic"), ["path"])
    checked = check_messages(spark.read.parquet(path), traffic_contract())
    return checked.groupBy(F.col("attributes")["path"].alias("topic_path")).agg(
        F.count(F.lit(1)).alias("messages"), F.sum("bytes_sent").alias("bytes_sent")
    )


def write_month_shards(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", F.date_format("l_shipdate", "yyyyMM").alias("suffix")
    )
    return sinks.overwrite_partitioned(lines, scratch_path(spark, "shards"), ["suffix"])


@query("suffix_pruned_scan", """
SELECT strftime(l_shipdate, '%Y%m') AS suffix, count(*) AS row_count,
       CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem WHERE strftime(l_shipdate, '%Y%m') BETWEEN '199601' AND '199712' GROUP BY 1""")
def suffix_pruned_scan(spark, sf):
    shards = files.read_suffix_range(spark, write_month_shards(spark, sf), "199601", "199712")
    return shards.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@query("external_table_summary", """
SELECT count(*) AS row_count, count(DISTINCT o_custkey) AS customers,
       round(sum(CAST(o_totalprice AS DECIMAL(12,2))), 2)::DOUBLE AS total FROM orders""")
def external_table_summary(spark, sf):
    """Invoices queried in place through a table over CSV files."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("invoice_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
    )
    path = write_csv(orders, "invoices")
    name = f"invoices_{path.rsplit('-', 1)[1]}"
    schema = "invoice_id int, customer_id int, total decimal(12,2)"
    invoices = governed_files.external_table(spark, name, path, schema)
    drop_external_table(spark, name)  # the frame keeps its files
    summary = governed_files.invoice_summary(invoices)
    return summary.withColumn("total", F.col("total").cast("double"))


@query("csv_export", """
SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS segment FROM customer""")
def csv_export(spark, sf):
    header = {"c_custkey": "customer_id", "c_name": "full_name", "c_mktsegment": "segment"}
    path = sinks.export_csv(
        table(spark, sf, "customer"), scratch_path(spark, "export"), header, "c_custkey"
    )
    return files.read_csv(spark, path, "customer_id bigint, full_name string, segment string")


@query("etl_rename", """
SELECT p_partkey AS part_id, p_name, p_size AS part_size, p_retailprice FROM part""")
def etl_rename(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return tips.rename_and_load(
        spark,
        write_csv(part, "part-csv"),
        scratch_path(spark, "part"),
        "p_partkey bigint, p_name string, p_size int, p_retailprice double",
        {"p_partkey": "part_id", "p_size": "part_size"},
    )


@query("stable_row_ids", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id, o_orderkey,
       o_totalprice FROM orders""")
def stable_row_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return with_row_ids(orders, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("open_table_roundtrip", """
SELECT count(*) AS row_count,
       round(sum(CAST(p_retailprice AS DECIMAL(20,6))), 2)::DOUBLE AS p_retailprice,
       max(p_size) AS max_p_size, count(DISTINCT p_type) AS service_days FROM part""")
def open_table_roundtrip(spark, sf):
    part = table(spark, sf, "part")
    written = tips.open_table(part, ["p_partkey"], "part_row", scratch_path(spark, "open"))
    return tips.summary(written, "p_retailprice", "p_size", "p_type")


@query("clustered_table", """
SELECT c_mktsegment, c_nationkey, count(*) AS customers FROM customer GROUP BY ALL""")
def clustered_table(spark, sf):
    path = sinks.overwrite_clustered(
        table(spark, sf, "customer"), scratch_path(spark, "clustered"),
        ["c_mktsegment", "c_nationkey"],
    )
    return spark.read.parquet(path).groupBy("c_mktsegment", "c_nationkey").agg(
        F.count(F.lit(1)).alias("customers")
    )


@query("curve_clustered_table", """
WITH v AS (SELECT l_partkey AS p, l_suppkey AS s FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1)
SELECT 'l_partkey' AS "column", count(*) AS matching_rows, true AS under_half FROM lineitem, v WHERE l_partkey = p
UNION ALL SELECT 'l_suppkey', count(*), true FROM lineitem, v WHERE l_suppkey = s""")
def curve_clustered_table(spark, sf):
    """Lines on a curve over two columns: a filter on either needs less than half of the files."""
    lines = table(spark, sf, "lineitem")
    wanted = lines.orderBy("l_orderkey", "l_linenumber").select("l_partkey", "l_suppkey").first().asDict()
    path = layout.overwrite_on_curve(
        lines, scratch_path(spark, "curve"), list(wanted), rows_per_file=max(1, lines.count() // 64))
    stored = spark.read.parquet(path)
    read = layout.files_to_read(layout.file_ranges(stored, list(wanted)), wanted)
    matching = stored.agg(*[F.count_if(F.col(c) == v).alias(c) for c, v in wanted.items()])
    matching = matching.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("matching_rows")) for c in wanted])))
    return matching.join(read, "column").select(
        "column", "matching_rows", (2 * F.col("files_read") < F.col("files")).alias("under_half"))


@query("point_lookup_stored", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = (SELECT max(o_custkey) FROM orders)""")
def point_lookup_stored(spark, sf):
    """Orders of one customer in a table that is not sorted by customer: row groups without
    the customer are skipped by their Bloom filters.
    """
    orders = table(spark, sf, "orders")
    customer = orders.agg(F.max("o_custkey")).first()[0]
    path = layout.overwrite_for_lookups(orders, scratch_path(spark, "lookups"), ["o_orderkey", "o_custkey"])
    return spark.read.parquet(path).filter(F.col("o_custkey") == customer).select("o_orderkey", "o_custkey", "o_totalprice")


@query("append_table", """
SELECT c_mktsegment, 2 * count(*) AS customers FROM customer GROUP BY c_mktsegment""")
def append_table(spark, sf):
    customers = table(spark, sf, "customer")
    path = sinks.overwrite(customers, scratch_path(spark, "appended"))
    sinks.append(customers, path)
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers")
    )


@query("file_arrival_last_wins", """
SELECT c_custkey AS s_suppkey, c_name AS s_name, c_nationkey AS s_nationkey,
       c_acctbal AS s_acctbal FROM customer""")
def file_arrival_last_wins(spark, sf):
    """Two deliveries of CSV files and one of text files; the last CSV one stays."""
    landing = scratch_path(spark, "landing")
    supplier = table(spark, sf, "supplier")
    customer = table(spark, sf, "customer").select(
        *[F.col(c).alias(n) for c, n in zip(
            ("c_custkey", "c_name", "c_nationkey", "c_acctbal"), supplier.columns)]
    )
    for drop, rows in (("1", supplier), ("2", customer)):
        rows.write.option("header", True).option("escape", '"').csv(f"{landing}/drop={drop}")
    supplier.select("s_name").write.text(f"{landing}/drop=3")
    target = scratch_path(spark, "arrived")
    drain(
        arrivals.load_drops(spark, landing, SUPPLIER, target), scratch_path(spark, "checkpoint")
    )
    return arrivals.last_drop(spark, target)


@query("file_arrival_replaces", """
SELECT c_custkey AS s_suppkey, c_name AS s_name, c_nationkey AS s_nationkey,
       c_acctbal AS s_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'""")
def file_arrival_replaces(spark, sf):
    """Files whose names and times of arrival disagree: the one that arrived last is the
    table, of several in one micro-batch too.
    """
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "arrived")
    checkpoint = scratch_path(spark, "checkpoint")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"), F.col("c_acctbal").alias("s_acctbal"), "c_mktsegment")
    for name, segments in (("9", ["HOUSEHOLD"]), ("5", ["MACHINERY", "AUTOMOBILE"]), ("1", ["FURNITURE", "BUILDING"])):
        for number, segment in enumerate(segments):
            # A delivery of this kind is one file.
            rows = customer.filter(F.col("c_mktsegment") == segment).drop("c_mktsegment").coalesce(1)
            rows.write.option("header", True).option("escape", '"').csv(f"{landing}/{name}{9 - number}")
        drain(arrivals.load_newest_file(spark, landing, SUPPLIER, target), checkpoint)
    return spark.read.schema(SUPPLIER).parquet(target)


@query("federated_region_revenue", """
WITH targets AS (
  SELECT 'R-' || r_regionkey AS region_code, any_value(r_name) AS region_name,
         round(sum(CAST(c_acctbal AS DECIMAL(12,2))) * 500, 2) AS revenue_target
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_regionkey
), remote AS (
  SELECT 'R-' || n_regionkey AS region_code, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)
SELECT region_name, count(*) AS order_count, sum(amount)::DOUBLE AS revenue,
       revenue_target::DOUBLE AS revenue_target,
       CASE WHEN sum(amount) >= revenue_target THEN 'met' ELSE 'below' END AS status
FROM remote JOIN targets USING (region_code) GROUP BY region_name, revenue_target""")
def federated_region_revenue(spark, sf):
    """Orders stand for the remote relation; targets come from customer balances."""
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    ).withColumn("region_code", F.concat(F.lit("R-"), F.col("r_regionkey")))
    balance = F.sum(F.col("c_acctbal").cast("decimal(12,2)"))
    targets = customers.groupBy("region_code").agg(
        F.max("r_name").alias("region_name"), F.round(balance * 500, 2).alias("revenue_target")
    )
    remote = (
        table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("region_code", F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))
    )
    result = revenue.region_revenue(remote, targets)
    return result.withColumns({c: F.col(c).cast("double") for c in ("revenue", "revenue_target")})


@query("point_lookup", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 7 LIMIT 1""")
def point_lookup(spark, sf):
    """A bound parameter; the predicate reaches the scan."""
    return spark.sql(
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderkey = :id LIMIT 1",
        args={"id": 7},
        orders=table(spark, sf, "orders"),
    )
