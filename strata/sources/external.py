"""Tables kept elsewhere: external files, open table formats, relational servers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_external_table(
    spark: SparkSession, name: str, path: str, schema: StructType, source: str = "csv"
) -> DataFrame:
    """Register files in place under a table name, in place of an earlier one of that name;
    nothing is copied. ``drop_external_table`` takes the name away again.
    """
    options = {"header": "true", "quote": '"', "escape": '"'} if source == "csv" else {}
    drop_external_table(spark, name)
    spark.catalog.createTable(name, path=path, source=source, schema=schema, **options)
    return spark.table(name)


def drop_external_table(spark: SparkSession, name: str) -> None:
    """Forget a table's name; its files stay, and so do frames already made from it."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def open_table_format(spark: SparkSession) -> str:
    """``iceberg`` where Spark finds that source, else ``parquet``."""
    try:
        spark.read.format("iceberg").load("no_such_table").schema
    except Exception as error:  # the classic client wraps the JVM's, Connect its own
        return "parquet" if "DATA_SOURCE_NOT_FOUND" in str(error) else "iceberg"
    return "iceberg"


def read_open_table(spark: SparkSession, location: str, fmt: str | None = None) -> DataFrame:
    """Read the table an overwrite returned the location of."""
    return spark.read.format(fmt or open_table_format(spark)).load(location)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options of a relational scan. With a numeric partition column the
    scan runs as that many range queries, so no single task reads the table.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its lowest and highest value")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_federated(spark: SparkSession, options: dict[str, str], *columns: str) -> DataFrame:
    """Remote rows; the projection and later filters are pushed to the server."""
    remote = spark.read.format("jdbc").options(**options).load()
    return remote.select(*columns) if columns else remote
