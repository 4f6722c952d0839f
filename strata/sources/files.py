"""Batch file readers and their schema contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.contracts import Contract, check_messages, demand_accepted

Schema = str | StructType


def read_csv(
    spark: SparkSession, path: str, schema: Schema, strict: bool = False, quote: str = '"'
) -> DataFrame:
    """CSV with a header and a declared schema. Empty fields are NULL.

    ``strict`` fails on a malformed record; otherwise its bad fields become NULL.
    """
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", quote)
        .option("escape", quote)
        .option("enforceSchema", not strict)
        .option("mode", mode)
        .csv(path)
    )


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header whose types Spark infers in one extra pass."""
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("inferSchema", True)
        .csv(path)
    )


def with_header_contract(
    df: DataFrame, expected: Sequence[str], normalise: bool = True
) -> DataFrame:
    """Require exactly these columns in this order, after trimming and lower-casing."""
    names = [c.strip().lower() if normalise else c for c in df.columns]
    if names != list(expected):
        raise ValueError(f"Unexpected source columns: {names}")
    return df.toDF(*names)


def require_rows(df: DataFrame, expected: int | None = None) -> int:
    """Count rows; fail on an empty frame or on another count than expected."""
    count = df.count()
    if count == 0:
        raise ValueError("The source is empty.")
    if expected is not None and count != expected:
        raise ValueError(f"Expected {expected} rows, found {count}.")
    return count


def read_ndjson(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """One JSON object per line; without a schema it is inferred, nested included."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_ndjson_typed(
    spark: SparkSession, path: str, columns: dict[str, str], required: Sequence[str] = ()
) -> DataFrame:
    """NDJSON into declared types: members are read as text and cast, so numbers
    sent as JSON text are accepted. A NULL in a required column fails the job.
    """
    raw = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).json(path)
    typed = raw.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])
    for name in required:
        # In a filter, which stays whatever columns are read later.
        refused = F.raise_error(F.lit(f"required column {name} is NULL")).cast("boolean")
        typed = typed.filter(F.when(F.col(name).isNotNull(), F.lit(True)).otherwise(refused))
    return typed


def read_json_lines(spark: SparkSession, pattern: str, contract: Contract) -> DataFrame:
    """Text files of one JSON message per line; the first bad line fails the job."""
    return demand_accepted(check_messages(spark.read.text(pattern), contract)).drop(
        "payload", "error"
    )


def read_jsonl_shards(spark: SparkSession, folder: str, schema: Schema | None = None) -> DataFrame:
    """All ``.jsonl`` shards below a folder as one frame; blank lines are skipped."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return (
        reader.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", True).json(folder)
    )


def read_text_partitions(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A partitioned table whose partition column stays text, leading zeros included."""
    found = spark.read.parquet(path).schema
    typed = StructType(
        [StructField(f.name, StringType()) if f.name == column else f for f in found]
    )
    return spark.read.schema(typed).parquet(path)


def read_suffix_range(
    spark: SparkSession, path: str, first: str, last: str, suffix: str = "suffix"
) -> DataFrame:
    """Date shards with an inclusive suffix range; the other folders are not read."""
    return read_text_partitions(spark, path, suffix).filter(F.col(suffix).between(first, last))
