"""Layouts that let a reader skip row groups: space-filling curves and Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 50_000  # rows, about, that the boundaries of the ranges come from
RANGE_BITS = 8  # 256 ranges of a column; about the root of the number of row groups is enough


def range_boundaries(df: DataFrame, columns: Sequence[str], bits: int = RANGE_BITS) -> dict[str, list]:
    """Per column the ascending values that cut it into at most ``2 ** bits`` ranges of like size.

    They come from a sample of about ``SAMPLE_ROWS`` rows, which the driver sorts. They steer
    where a row lies, never whether it is found. NULLs lie before all ranges.
    """
    count = df.count()
    if count == 0:
        return {c: [] for c in columns}
    sample = df.select(*columns)
    if count > SAMPLE_ROWS:
        sample = sample.sample(SAMPLE_ROWS / count, seed=11)
    found = sample.collect()
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in found if r[c] is not None and r[c] == r[c])  # no NaN
        parts = 1 << bits
        # A value that fills several ranges is one boundary.
        cuts[c] = sorted({values[len(values) * i // parts] for i in range(1, parts)}) if values else []
    return cuts


def range_number(df: DataFrame, column: str, boundaries: Sequence) -> Column:
    """How many boundaries are not above the value: its range, 0 for NULL; a binary search per row."""
    if not boundaries:
        return F.lit(0)
    kind = df.schema[column].dataType
    cuts = F.array(*[F.lit(b).cast(kind) for b in boundaries])  # folded to one constant
    size, step = len(boundaries), 1
    while step * 2 <= size:
        step *= 2
    steps = []
    while step:
        steps.append(step)
        step //= 2

    def narrowed(low: Column, by: Column) -> Column:
        inside = (low + by <= size) & (F.get(cuts, low + by - 1) <= F.col(column))
        return F.when(inside, low + by).otherwise(low)

    return F.when(F.col(column).isNull(), 0).otherwise(F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), narrowed))


def spread(number: Column, ranges: int, bits: int) -> Column:
    """The numbers of ``ranges`` ranges, in their order, dealt evenly over ``bits`` bits. A column
    of few values otherwise leaves its high bits empty, and the others alone say where a row lies."""
    return F.floor(number.cast("double") * (1 << bits) / ranges)


def interleaved(ranges: Sequence[Column], bits: int) -> Column:
    """The bits of several numbers in turn, highest first: near numbers are near in all."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(ranges):
            one = F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranges) + len(ranges) - 1 - place))
    return key


def overwrite_on_curve(
    df: DataFrame, path: str, columns: Sequence[str], bits: int = RANGE_BITS, rows_per_file: int = 0
) -> str:
    """Replace a table whose files each hold a narrow range of every one of the columns.

    A lexical sort orders the second column only within equal values of the first, so a filter
    on the second alone reads everything; here a filter on any column skips files and row
    groups. The range sort breaks ties by chance, so one value or cell that holds a third of
    all rows is dealt to several writers. Three passes: count, sample, write.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not make a sort key of 62 bits")
    numbers = [f"__range{i}" for i in range(len(columns))]
    if {"__curve", "__tie", *numbers} & set(df.columns):
        raise ValueError(f"columns __curve, __tie and {numbers} are used by the writer")
    cuts = range_boundaries(df, columns, bits)
    numbered = df.withColumns({
        n: spread(range_number(df, c, cuts[c]), len(cuts[c]) + 1, bits) for n, c in zip(numbers, columns)})
    keyed = numbered.withColumn("__curve", interleaved([F.col(n) for n in numbers], bits))
    (
        keyed.withColumn("__tie", F.rand(13))
        .repartitionByRange("__curve", "__tie")
        .sortWithinPartitions("__curve", *columns)
        .select(*df.columns)
        .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
    return path


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a read table its rows and the smallest and largest value of each column,
    as a reader learns them from the statistics."""
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *bounds)


def files_to_read(ranges: DataFrame, filters: dict[str, object]) -> DataFrame:
    """For an equality filter per column alone: files there are, and files that may hold the value."""
    counts = ranges.agg(F.count(F.lit(1)).alias("files"), *[
        F.count_if(F.lit(v).between(F.col(f"min_{c}"), F.col(f"max_{c}"))).alias(f"r{i}")
        for i, (c, v) in enumerate(filters.items())])
    return counts.select("files", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("files_read")) for i, c in enumerate(filters)])))


def overwrite_for_lookups(
    df: DataFrame, path: str, columns: Sequence[str], distinct: int = 1_000_000, group_bytes: int = 128 << 20
) -> str:
    """Replace a table with a Bloom filter per row group on each of the columns.

    For equality lookups by unsorted keys, where smallest and largest values skip nothing. Spark's
    reader asks the filters whenever an equality or a short IN list is pushed down. ``distinct`` is
    the number of values expected in a row group: 1.2 bytes each at one false hit in a hundred. A
    column of few values is written by dictionary instead, which the reader uses in the same way.
    """
    writer = df.write.mode("overwrite").option("parquet.block.size", group_bytes)
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", distinct)
    writer.parquet(path)
    return path
