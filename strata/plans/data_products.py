"""Domain tables, their quality scans and the governance contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.governance import catalog_rules
from strata.operators.quality import (
    Expect, Rule, counts_row, demand_gate, diagnose, gate, scan, scan_score,
)
from strata.sources.files import read_ndjson_typed
from strata.sources.sinks import overwrite

# Table columns and the scan rules of both domains.
ORDER_COLUMNS = {
    "order_id": "string", "customer_id": "string", "order_date": "date", "status": "string",
    "amount": "decimal(38,9)",
}
CUSTOMER_COLUMNS = {
    "customer_id": "string", "full_name": "string", "email": "string", "country": "string",
    "consent": "boolean",
}
ORDER_RULES = (
    Rule("order_id_complete", "order_id", "non_null", "COMPLETENESS"),
    Rule("order_id_unique", "order_id", "unique", "UNIQUENESS"),
    Rule("valid_status", "status", "in_set", "VALIDITY",
             values=("PAID", "SHIPPED", "CANCELLED")),
    Rule("positive_amount", "amount", "range", "VALIDITY", minimum=0, strict_minimum=True),
)
CUSTOMER_RULES = (
    Rule("customer_id_complete", "customer_id", "non_null", "COMPLETENESS"),
    Rule("customer_id_unique", "customer_id", "unique", "UNIQUENESS"),
    Rule("valid_email", "email", "regex", "VALIDITY", pattern="^[^@]+@[^@]+[.][^@]+$"),
    Rule("consent_complete", "consent", "non_null", "COMPLETENESS"),
)


def load_domain(spark: SparkSession, source: str, columns: dict[str, str], target: str) -> DataFrame:
    """NDJSON into a typed table whose columns are all required."""
    typed = read_ndjson_typed(spark, source, columns, required=tuple(columns))
    return spark.read.parquet(overwrite(typed, target))


def row_counts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Both tables' row counts in one row."""
    return counts_row(
        orders.sparkSession,
        orders=orders.agg(F.count(F.lit(1))).scalar(),
        customers=customers.agg(F.count(F.lit(1))).scalar(),
    )


def scan_domain(df: DataFrame, rules: tuple[Rule, ...], strict: bool = True) -> DataFrame:
    """Scan rows; raises, if ``strict``, unless every rule passed with a score of 100."""
    result = scan(df, rules)
    if not strict:
        return result
    demand_gate(
        gate(
            scan_score(result),
            {
                "score": Expect(equals=100.0),
                "rule_count": Expect(equals=len(rules)),
                "passed": Expect(equals=True),
            },
        )
    )
    return result


def check_catalog(entries: DataFrame) -> DataFrame:
    """Catalog entries with the governance rules they break."""
    return diagnose(entries, catalog_rules())
