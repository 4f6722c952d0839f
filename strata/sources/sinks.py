"""Writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.contracts import encode
from strata.sources.external import open_table_format


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace the whole table; running it again gives the same table."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def overwrite_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], cluster: Sequence[str] = ()
) -> str:
    """Replace a partitioned table, rows sorted by the cluster columns in each file.

    REBALANCE keeps one partition value in few files and lets AQE split a value
    too big for one task, so a hot day does not end in one writer.
    """
    ordered = [*partitions, *cluster]
    (
        df.hint("rebalance", *[F.col(c) for c in partitions])
        .sortWithinPartitions(*ordered)
        .write.mode("overwrite")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return path


def overwrite_clustered(df: DataFrame, path: str, cluster: Sequence[str]) -> str:
    """Replace a table clustered by some columns, without partition folders.

    Equal cluster values meet in few files; AQE splits values too big for one.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in cluster])
        .sortWithinPartitions(*cluster)
        .write.mode("overwrite")
        .parquet(path)
    )
    return path


def create_view(df: DataFrame, name: str) -> str:
    """Store a query under a name; readers run it anew."""
    df.createOrReplaceTempView(name)
    return name


def append(df: DataFrame, path: str) -> str:
    """Append to a table that must exist and have exactly these columns."""
    target = df.sparkSession.read.parquet(path)
    have = {f.name: f.dataType.simpleString() for f in target.schema}
    got = {f.name: f.dataType.simpleString() for f in df.schema}
    if have != got:
        raise ValueError(f"Target columns {have} differ from {got}")
    df.select(*target.columns).write.mode("append").parquet(path)
    return path


def overwrite_json_lines(df: DataFrame, path: str, sort_keys: bool = True) -> str:
    """Sharded ``.jsonl`` output: compact objects with sorted keys, NULLs kept."""
    (
        # One unquoted text column: the delimited writer can name its files .jsonl.
        encode(df, sort_keys=sort_keys)
        .write.mode("overwrite")
        .options(extension="jsonl", quote="\0", sep="\1", escapeQuotes="false")
        .csv(path)
    )
    return path


def export_csv(df: DataFrame, path: str, header: dict[str, str], order: str) -> str:
    """Delimited export: chosen columns under new names, ordered by a key.

    The order holds across the numbered part files (a range sort, not one file).
    """
    chosen = df.orderBy(order).select(*[F.col(c).alias(n) for c, n in header.items()])
    chosen.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def overwrite_open_table(df: DataFrame, location: str, fmt: str | None = None) -> str:
    """Replace an open-format table in one snapshot and return where to read it.

    Without a table format the rows go to a new place below ``location`` that is never
    used again, so readers of the former one keep their rows.
    """
    fmt = fmt or open_table_format(df.sparkSession)
    if fmt == "iceberg":
        df.writeTo(location).using("iceberg").createOrReplace()
        return location
    return overwrite(df, f"{location}/{uuid.uuid4().hex}", fmt)


def publish(df: DataFrame, path: str, attributes: Sequence[str] = ()) -> str:
    """Rows as JSON messages (``value``) plus a string map of attributes."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    pairs = [x for c in attributes for x in (F.lit(c), F.col(c).cast("string"))]
    tags = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    df.select(body.alias("value"), tags.alias("attributes")).write.mode("append").parquet(path)
    return path
