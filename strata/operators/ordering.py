"""Ordering operators: latest rows, top-k, row numbers and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows per key. End ``order`` with a unique column.

    Spark keeps only ``k`` rows per key in every map task before the shuffle
    (WindowGroupLimit), so a hot key never reaches one reducer whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= k).drop("__rn")


def ranked_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """``best_per_key`` with the position kept as a column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall (top-n per task, then one merge of n rows each)."""
    return df.orderBy(*order).limit(n)


def top_structs(
    df: DataFrame, keys: Sequence[str], value: str, fields: Sequence[str], order: Sequence[Column],
    k: int,
) -> DataFrame:
    """Per key an ordered array of the ``k`` first rows' fields."""
    ranked = ranked_per_key(df, keys, order, k, "__rank")
    gathered = ranked.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("__rank", *fields))).alias(value)
    )
    return gathered.withColumn(
        value, F.transform(value, lambda s: F.struct(*[s[f].alias(f) for f in fields]))
    )


ROW_BITS = 33  # low bits of monotonically_increasing_id: the row's number in its task


def _ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows range-sorted into stable numbered pieces.

    The pieces are written out first: sampling the range bounds twice could cut
    them at different places. ``__piece`` is the range, ascending along ``order``,
    and ``__rn`` the row's number in it, from 0.
    """
    sorted_ranges = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = sorted_ranges.withColumns({"__piece": F.spark_partition_id(), "__rn": in_task})
    return cut_lineage(numbered, "ranges")


def _before(pieces: DataFrame, totals: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """Per piece the totals of all earlier pieces: one short row per piece."""
    per_piece = pieces.groupBy("__piece").agg(*[t.alias(n) for t, n in zip(totals, names)])
    # One row per shuffle partition, so this single-group window stays small.
    earlier = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    return per_piece.select(
        "__piece",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).cast(per_piece.schema[n].dataType).alias(n)
          for n in names],
    )


def with_row_ids(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Consecutive ids from 1 along a declared, unique order key.

    Each range is numbered by itself and shifted by the size of the ranges before
    it; no task sees all rows.
    """
    pieces = _ranges(df, order)
    shift = _before(pieces, [F.count(F.lit(1))], ["__shift"])
    return (
        pieces.join(F.broadcast(shift), "__piece")  # as many rows as ranges
        .withColumn(name, F.col("__shift") + F.col("__rn") + 1)
        .select(name, *df.columns)
    )


def with_running_totals(
    df: DataFrame, order: Sequence[str], sums: dict[str, str]
) -> DataFrame:
    """Sums of all rows strictly before the current one, ``{value column: new name}``.

    The same two levels as ``with_row_ids``; ``order`` must be unique.
    """
    pieces = _ranges(df, order)
    names = list(sums.values())
    earlier = _before(pieces, [F.sum(c) for c in sums], [f"__{n}" for n in names])
    inside = (
        Window.partitionBy("__piece").orderBy("__rn").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = pieces.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for c, n in sums.items()]
    )
    return local.join(F.broadcast(earlier), "__piece").select(
        *df.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in names]
    )
