"""Registration and table access."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL twin where SQL can express it."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as an unbounded frame of its files."""
    schema = table(spark, sf_dir, name).schema
    # As a pattern the path may be one file or a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_text(column: str):
    """ISO text with offset of a zone-free time."""
    return F.concat(F.date_format(column, ISO_MICROS), F.lit("+00:00"))


def prop_k():
    """The integer member of the events' props."""
    return F.get_json_object("props", "$.k").cast("bigint")


SQL_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
SQL_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
