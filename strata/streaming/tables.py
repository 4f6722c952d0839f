"""Stream sinks whose repeated batches leave no duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

WRITER, BATCH = "writer", "batch_id"
DECLARED = f"{WRITER}=declared/{BATCH}=-1"
DIRECT = "direct"  # writer of batches that no stream delivered


def declare_table(spark: SparkSession, path: str, schema: str | StructType) -> str:
    """Create an empty stream table; sinks never create one by themselves."""
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(f"{path}/{DECLARED}")
    return path


def declared_schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(f"{path}/{DECLARED}").schema


def batch_folder(batch: DataFrame, batch_id: int, path: str) -> str:
    """The folder that a micro-batch owns.

    Batch numbers start at 0 with every new checkpoint. The id of the streaming query is
    kept in its checkpoint: a restarted query finds its folders again, another query, or
    the same one on a new checkpoint, never touches them.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/{WRITER}={query or DIRECT}/{BATCH}={batch_id}"


def append_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Append one micro-batch to a declared table.

    A batch overwrites the folder it owns, so a batch delivered again after a failure
    replaces itself and nothing else.
    """
    have = [(f.name, f.dataType) for f in declared_schema(batch.sparkSession, path)]
    got = {f.name: f.dataType for f in batch.schema}
    if dict(have) != got:
        raise ValueError(f"Target columns {have} differ from {list(got.items())}")
    batch.select(*[n for n, _ in have]).write.mode("overwrite").parquet(
        batch_folder(batch, batch_id, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows; ``writer`` and ``batch_id`` tell which micro-batch wrote them."""
    schema = declared_schema(spark, path).add(WRITER, "string").add(BATCH, "long")
    return spark.read.schema(schema).parquet(path)


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows in their declared columns."""
    return read_table(spark, path).drop(WRITER, BATCH)


def each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> DataStreamWriter:
    return df.writeStream.outputMode(mode).foreachBatch(handle)


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived so far, then stop."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def every(writer: DataStreamWriter, checkpoint: str, seconds: int = 20) -> StreamingQuery:
    """Keep running with a processing-time trigger; panes fire early this often."""
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )
