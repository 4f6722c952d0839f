"""Weather stream: raw table by day and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.functions.times import instant
from strata.operators.quality import Expect, gate
from strata.sources.messages import read_messages

# The ten columns of the raw table.
OBSERVATION_SCHEMA = (
    "observed_at timestamp, published_at timestamp, city string, country string, "
    "latitude double, longitude double, temperature_c double, relative_humidity bigint, "
    "wind_speed_kmh double, weather_code bigint"
)
MESSAGE_SCHEMA = OBSERVATION_SCHEMA.replace("timestamp", "string")


def observations(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON messages mapped to the raw columns by key."""
    raw = read_messages(spark, path, fmt="json", schema=MESSAGE_SCHEMA, files_per_batch=files_per_batch)
    return typed(raw)


def typed(raw: DataFrame) -> DataFrame:
    """Time text to timestamps."""
    return raw.withColumns({c: instant(F.col(c)) for c in ("observed_at", "published_at")})


def raw_table_writer(observed: DataFrame, path: str) -> DataStreamWriter:
    """Append to the raw table, one folder per day, exactly once."""
    dated = observed.withColumn("observed_on", F.to_date("observed_at"))
    return dated.writeStream.format("parquet").partitionBy("observed_on").option("path", path)


def raw_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("observed_on")


def verify(progress: DataFrame, cities: int, events: int) -> DataFrame:
    """All cities reported and enough observations arrived."""
    totals = progress.agg(
        F.count(F.lit(1)).alias("cities"), F.sum("event_count").alias("event_count")
    )
    return gate(
        totals, {"cities": Expect(equals=cities), "event_count": Expect(at_least=events)}
    )
