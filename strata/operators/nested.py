"""Nested records: reshape, unnest, and build them from flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def struct_of(renames: dict[str, str]) -> Column:
    """A struct from (nested) columns under new member names."""
    return F.struct(*[F.col(source).alias(name) for source, name in renames.items()])


def reshape_elements(array: str, renames: dict[str, str]) -> Column:
    """Every array element as a new struct, in place, without unnesting."""
    return F.transform(
        array, lambda e: F.struct(*[e[source].alias(name) for source, name in renames.items()])
    )


def unnest(df: DataFrame, array: str, element: str = "item") -> DataFrame:
    """One row per array element; rows with an empty or NULL array vanish."""
    return df.withColumn(element, F.explode(array))


def element_where(array: str, key: str, wanted: int, value: str) -> Column:
    """``value`` of the first element whose ``key`` equals ``wanted``, else NULL."""
    return F.get(F.filter(array, lambda e: e[key] == wanted), F.lit(0))[value]


def nest_rows(
    df: DataFrame,
    key: str,
    array: str,
    members: Sequence[Column],
    number: Column,
    per_record: int = 1000,
) -> DataFrame:
    """Gather flat rows into ``key, part, array<struct>`` records of bounded size.

    ``(key, part)`` is the key of a record. ``number`` is the element's own number within
    its key, from 1 (such as a line number); numbers 1 to ``per_record`` make part 0, the
    next ones part 1, and so on, whatever else the key holds. So a hot key is neither
    counted first nor held by one task, and a record's content does not depend on how many
    elements its key has. A NULL number counts as 1.
    """
    part = F.floor((F.coalesce(number, F.lit(1)) - 1) / per_record).cast("int")
    # Plain rows are shuffled, not half-filled arrays: a task rarely has two rows of a key.
    flat = df.withColumn("part", part).repartition(F.col(key), F.col("part"))
    return flat.groupBy(key, "part").agg(F.collect_list(F.struct(*members)).alias(array))
