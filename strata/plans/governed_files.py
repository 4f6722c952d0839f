"""External customer and invoice files behind a column policy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.governance import GovernedView
from strata.sources.external import create_external_table

# File schemas and the protected columns.
CUSTOMER_SCHEMA = (
    "customer_id int, first_name string, last_name string, company string, address string, "
    "city string, state string, country string, postal_code string, phone string, fax string, "
    "email string, support_rep_id int"
)
INVOICE_SCHEMA = (
    "invoice_id int, customer_id int, invoice_date timestamp, billing_address string, "
    "billing_city string, billing_state string, billing_country string, "
    "billing_postal_code string, total decimal(38,9)"
)
SENSITIVE = "sensitive"
PROTECTED = {"address": SENSITIVE, "postal_code": SENSITIVE, "phone": SENSITIVE}


def external_table(spark: SparkSession, name: str, path: str, schema: str) -> DataFrame:
    """Query CSV files in place under a table name."""
    return create_external_table(spark, name, path, StructType.fromDDL(schema))


def customers(df: DataFrame, grants: Iterable[str] = (), mode: str = "deny") -> GovernedView:
    """Customers as a reader with these grants may see them."""
    return GovernedView(df, PROTECTED, grants, mode)


def invoice_summary(invoices: DataFrame) -> DataFrame:
    """One row: invoices, customers billed, total."""
    return invoices.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("customer_id").alias("customers"),
        F.round(F.sum("total"), 2).alias("total"),
    )
