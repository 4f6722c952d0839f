"""Loading files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.sources.files import read_text_partitions
from strata.sources.sinks import overwrite
from strata.streaming.tables import batch_folder, each_batch

CSV_FILES = "*.[cC][sS][vV]"


def arriving_csv(
    spark: SparkSession, landing: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the CSV files of a folder, other suffixes skipped."""
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("pathGlobFilter", CSV_FILES)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(landing)


FILES = "path string, modificationTime timestamp, length bigint, content binary"


def load_newest_file(
    spark: SparkSession, landing: str, schema: str, target: str, files_per_batch: int | None = None
) -> DataStreamWriter:
    """The last finished file replaces the table, an empty one empties it.

    The stream carries only names and times of files. Of a micro-batch the newest file is
    loaded, the one with the greater name of equal times; the others would be replaced.
    """
    reader = (
        spark.readStream.format("binaryFile").schema(FILES)
        .option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", True)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrived = reader.load(landing).select(F.struct("modificationTime", "path").alias("file"))

    def load(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max("file")).first()[0]
        if newest is not None:
            rows = batch.sparkSession.read.schema(schema).option("header", True).option("escape", '"')
            overwrite(rows.csv(newest["path"]), target)

    return each_batch(arrived, load)


def load_every_file(
    spark: SparkSession, landing: str, schema: str, target: str, files_per_batch: int | None = None
) -> DataStreamWriter:
    """Rows of all files, added in folders that each micro-batch owns."""

    def load(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch, batch_folder(batch, batch_id, target))

    return each_batch(arriving_csv(spark, landing, schema, files_per_batch), load)


def load_drops(spark: SparkSession, landing: str, schema: str, target: str) -> DataStreamWriter:
    """Files delivered in folders ``drop=<id>``, stored by drop, exactly once."""
    path = F.col("_metadata.file_path")
    drops = arriving_csv(spark, landing, schema).withColumn(
        "drop", F.regexp_extract(path, r"drop=([^/]+)/", 1)
    )
    return drops.writeStream.format("parquet").partitionBy("drop").option("path", target)


def last_drop(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the newest drop by the text order of drop ids (dates, padded numbers);
    the other drops' folders are not read.
    """
    stored = read_text_partitions(spark, target, "drop")
    newest = stored.agg(F.max("drop")).scalar()
    return stored.filter(F.col("drop") == newest).drop("drop")
