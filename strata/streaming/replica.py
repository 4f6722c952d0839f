"""A replica kept from a snapshot and a stream of change rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.operators.merge import apply_changes, latest_changes
from strata.sources.sinks import overwrite
from strata.streaming.tables import BATCH, WRITER, append_batch, each_batch, read_table


@dataclass(frozen=True)
class Snapshot:
    """Rows of a replica, and which stored changes they hold already.

    ``seen`` has the last sequence number per changed key, so that an older change that
    arrives late stays without effect; ``upto`` the last batch applied of every writer.
    """

    rows: DataFrame
    seen: DataFrame | None = None
    upto: dict[str, int] = field(default_factory=dict)


def collect_changes(
    changes: DataFrame, keys: Sequence[str], path: str, sequence: str = "seq"
) -> DataStreamWriter:
    """Keep each micro-batch's last change per key in a declared table.

    A batch writes only what it changed, never the whole replica, and a repeated
    batch replaces itself.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        append_batch(latest_changes(batch, keys, sequence), batch_id, path)

    return each_batch(changes, store)


def later_changes(
    spark: SparkSession, snapshot: Snapshot, path: str, keys: Sequence[str], sequence: str = "seq",
    upto: dict[str, int] | None = None,
) -> DataFrame:
    """Stored changes the snapshot lacks, up to given batches if any; folders of batches it
    holds are not read.
    """
    changes = read_table(spark, path)
    if upto is not None:
        inside = F.lit(False)
        for writer, batch in upto.items():
            inside = inside | ((F.col(WRITER) == writer) & (F.col(BATCH) <= batch))
        changes = changes.filter(inside)
    for writer, batch in snapshot.upto.items():
        changes = changes.filter((F.col(WRITER) != writer) | (F.col(BATCH) > batch))
    changes = changes.drop(WRITER, BATCH)
    if snapshot.seen is None:
        return changes
    known = snapshot.seen.withColumnRenamed(sequence, "__seen")
    newer = F.col("__seen").isNull() | (F.col(sequence) > F.col("__seen"))
    return changes.join(known, list(keys), "left").filter(newer).drop("__seen")


def replica(
    spark: SparkSession, snapshot: Snapshot, path: str, keys: Sequence[str], sequence: str = "seq"
) -> DataFrame:
    """The current replica: the snapshot with all later changes applied."""
    return apply_changes(snapshot.rows, later_changes(spark, snapshot, path, keys, sequence), keys, sequence)


def compact(
    spark: SparkSession, snapshot: Snapshot, path: str, keys: Sequence[str], location: str,
    sequence: str = "seq",
) -> Snapshot:
    """Write the replica as the next snapshot, at a new place.

    Which batches it holds is settled first: one that arrives meanwhile is applied later.
    """
    stored = read_table(spark, path).groupBy(WRITER).agg(F.max(BATCH).alias(BATCH)).collect()  # a row per writer
    upto = snapshot.upto | {r[WRITER]: r[BATCH] for r in stored}
    changes = later_changes(spark, snapshot, path, keys, sequence, upto)
    seen = changes.select(*keys, sequence)
    if snapshot.seen is not None:
        seen = seen.unionByName(snapshot.seen)
    overwrite(apply_changes(snapshot.rows, changes, keys, sequence), f"{location}/rows")
    overwrite(seen.groupBy(*keys).agg(F.max(sequence).alias(sequence)), f"{location}/seen")
    overwrite(spark.createDataFrame(list(upto.items()), f"{WRITER} string, {BATCH} long"), f"{location}/upto")
    return open_snapshot(spark, location)


def open_snapshot(spark: SparkSession, location: str) -> Snapshot:
    """A snapshot that ``compact`` wrote."""
    upto = {r[WRITER]: r[BATCH] for r in spark.read.parquet(f"{location}/upto").collect()}
    return Snapshot(spark.read.parquet(f"{location}/rows"), spark.read.parquet(f"{location}/seen"), upto)
