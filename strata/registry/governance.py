"""Governed views and the catalog contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.governance import GovernedView
from strata.plans import data_products, governed_files
from strata.registry.base import query, table
from strata.registry.ingest import write_csv
from strata.sources.external import drop_external_table

TAGS = {"c_acctbal": "finance", "c_name": "personal"}


@query("governed_view_mask", """
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def governed_view_mask(spark, sf):
    return GovernedView(table(spark, sf, "customer"), TAGS, ["finance"], "mask").select("*")


@query("governed_view_deny", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def governed_view_deny(spark, sf):
    return GovernedView(table(spark, sf, "customer"), TAGS).open()


@query("governed_aggregate", """
SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment""")
def governed_aggregate(spark, sf):
    """Aggregates over unprotected columns work without any grant."""
    view = GovernedView(table(spark, sf, "customer"), TAGS)
    return view.select("c_mktsegment").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers")
    )


@query("governed_external_files", """
SELECT c_custkey AS customer_id, CAST(NULL AS VARCHAR) AS phone, c_mktsegment AS city
FROM customer""")
def governed_external_files(spark, sf):
    """CSV files queried in place through the column policy."""
    files = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("phone"),
        F.col("c_mktsegment").alias("city"),
    )
    path = write_csv(files, "customers")
    name = f"customers_{path.rsplit('-', 1)[1]}"
    schema = "customer_id bigint, phone string, city string"
    external = governed_files.external_table(spark, name, path, schema)
    drop_external_table(spark, name)  # the frame keeps its files
    return governed_files.customers(external, mode="mask").select("*")


@query("catalog_contract", """
SELECT domain, quality_slo,
  concat_ws(',', CASE WHEN aspect_domain IS NULL THEN 'aspect_present' END,
    CASE WHEN coalesce(aspect_domain = domain, false) THEN NULL ELSE 'domain_matches' END,
    CASE WHEN coalesce(raw >= 0.95 AND aspect_domain IS NOT NULL, false) THEN NULL
         ELSE 'slo_sufficient' END,
    CASE WHEN aspect_domain IS NOT NULL AND n <> 'BUILDING' THEN NULL
         ELSE 'classification_known' END,
    CASE WHEN owners > 0 THEN NULL ELSE 'owner_present' END) AS failed_rules
FROM (
  SELECT c_mktsegment AS domain, c_mktsegment AS n, avg(CASE WHEN c_acctbal >= -950 THEN 1 ELSE 0 END) AS raw,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN round(
      avg(CASE WHEN c_acctbal >= -950 THEN 1 ELSE 0 END), 6) END AS quality_slo,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
         WHEN c_mktsegment = 'FURNITURE' THEN 'furnishing' ELSE c_mktsegment END AS aspect_domain,
    count(DISTINCT CASE WHEN c_acctbal > 9990 THEN c_nationkey END) AS owners
  FROM customer GROUP BY c_mktsegment)""")
def catalog_contract(spark, sf):
    """Customer segments as catalog entries: the objective is the share of sound
    balances, owners are the nations of the richest customers.
    """
    segment = F.col("c_mktsegment")
    aspect = F.struct(
        F.when(segment == "FURNITURE", "furnishing").otherwise(segment).alias("domain"),
        F.when(segment == "BUILDING", "SECRET").otherwise("INTERNAL").alias("classification"),
        F.col("quality_slo"),
    )
    entries = (
        table(spark, sf, "customer")
        .groupBy("c_mktsegment")
        .agg(
            F.avg((F.col("c_acctbal") >= -950).cast("int")).alias("quality_slo"),
            F.collect_set(F.when(F.col("c_acctbal") > 9990, F.col("c_nationkey"))).alias("owners"),
        )
        .select(
            segment.alias("domain"),
            F.when(segment != "HOUSEHOLD", aspect).alias("aspect"),
            "owners",
        )
    )
    return data_products.check_catalog(entries).select(
        "domain",
        F.round("aspect.quality_slo", 6).alias("quality_slo"),
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )
