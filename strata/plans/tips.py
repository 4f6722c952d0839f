"""Restaurant bills: plain load, enriched load, declared ETL, open table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.numbers import as_money, exact_sum, percent
from strata.operators.ordering import with_row_ids
from strata.operators.quality import Expect, gate
from strata.sources.external import read_open_table
from strata.sources.files import (
    read_csv, read_csv_inferred, require_rows, with_header_contract,
)
from strata.sources.sinks import overwrite, overwrite_open_table

# The bill columns and what the full file must add up to.
COLUMNS = ("total_bill", "tip", "sex", "smoker", "day", "time", "size")
SCHEMA = (
    "total_bill double, tip double, sex string, smoker string, day string, time string, size int"
)
FULL_FILE = {
    "row_count": Expect(equals=244),
    "total_bill": Expect(equals=4827.77),
    "max_party_size": Expect(equals=6),
    "service_days": Expect(equals=4),
    "average_tip_percentage": Expect(above=15.0, below=17.0),
}


def load(spark: SparkSession, source: str, target: str,
         columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Header contract, non-empty check, table replaced."""
    bills = with_header_contract(read_csv_inferred(spark, source), columns)
    require_rows(bills)
    return spark.read.parquet(overwrite(bills, target))


def with_ratio(df: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """A percentage column rounded to two digits."""
    return df.withColumn(name, percent(F.col(part), F.col(whole)))


def enrich_and_load(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Inferred CSV plus the tip percentage, table replaced."""
    enriched = with_ratio(read_csv_inferred(spark, source), "tip", "total_bill", "tip_percentage")
    return spark.read.parquet(overwrite(enriched, target))


def rename_and_load(
    spark: SparkSession, source: str, target: str, schema: str = SCHEMA,
    renames: dict[str, str] | None = None,
) -> DataFrame:
    """Declared ETL: typed CSV, renamed columns, table replaced; a bad record fails."""
    renames = renames or {"size": "party_size"}
    typed = read_csv(spark, source, schema, strict=True)
    return spark.read.parquet(overwrite(typed.withColumnsRenamed(renames), target))


def open_table(df: DataFrame, order: Sequence[str], row_id: str, location: str) -> DataFrame:
    """Rows with stable ids written as an open table and read back from it."""
    numbered = with_row_ids(df, order, row_id)
    return read_open_table(df.sparkSession, overwrite_open_table(numbered, location))


def summary(df: DataFrame, amount: str = "total_bill", size: str = "party_size",
            group: str = "day") -> DataFrame:
    """One row: rows, total, largest size, distinct groups."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        as_money(exact_sum(F.col(amount))).alias(amount),
        F.max(size).alias(f"max_{size}"),
        F.count_distinct(group).alias("service_days"),
    )


def ratio_summary(df: DataFrame) -> DataFrame:
    """One row: rows, total bill, average tip percentage."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        as_money(exact_sum(F.col("total_bill"))).alias("total_bill"),
        F.round(F.avg("tip_percentage"), 2).alias("average_tip_percentage"),
    )


def verify(metrics: DataFrame) -> DataFrame:
    """Gate rows for those full-file expectations the metrics cover."""
    return gate(metrics, {n: e for n, e in FULL_FILE.items() if n in metrics.columns})
