"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.times import iso_instant, with_zone


def read_messages(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    schema: str | None = None,
    glob: str | None = None,
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """An unbounded frame of messages from arriving files, or from a broker when
    its source (``fmt="kafka"``) is on the classpath.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load() if fmt == "kafka" else reader.load(path)


# Fixed value: how the weather service names the four measures.
MEASURES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "relative_humidity",
    "wind_speed_10m": "wind_speed_kmh",
    "weather_code": "weather_code",
}


def normalise_observations(readings: DataFrame, cities: DataFrame) -> DataFrame:
    """City record and reading as one observation with zoned time text.

    Spark broadcasts the city dimension when its size allows; hot cities are
    otherwise split by the skew-join rule.
    """
    joined = readings.join(cities, "city")
    return joined.select(
        with_zone(F.col("time")).alias("observed_at"),
        F.concat(iso_instant(F.current_timestamp()), F.lit("+00:00")).alias("published_at"),
        "city",
        "country",
        "latitude",
        "longitude",
        *[F.col(c).alias(n) for c, n in MEASURES.items()],
    )
