"""Layouts: what a reader can skip, against the statistics in the files."""

import datetime
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.sources import layout
from tests.conftest import rows


def test_range_numbers_and_interleaving(spark):
    draw = random.Random(2)
    made = [(draw.choice([None, *range(-5, 25)]), draw.choice(["", "a", "ab", "b", "é", None]),
             draw.choice([None, float("nan"), -1.5, 0.0, 7.25])) for _ in range(300)]
    frame = spark.createDataFrame(made, "n int, word string, x double")
    cuts = layout.range_boundaries(frame, ["n", "word", "x"], bits=3)
    assert all(c == sorted(set(c)) and 1 <= len(c) <= 7 for c in cuts.values())
    got = frame.select("*", *[layout.range_number(frame, c, cuts[c]).alias(f"r_{c}") for c in cuts])
    got = got.withColumn("key", layout.interleaved([F.col("r_n"), F.col("r_word")], 3))
    for r in got.collect():
        for c in ("n", "word", "x"):
            value = r[c]
            above = value != value  # NaN lies behind all numbers
            assert r[f"r_{c}"] == (0 if value is None else sum(above or b <= value for b in cuts[c]))
        bits = "".join(f"{r.r_n:03b}"[i] + f"{r.r_word:03b}"[i] for i in range(3))
        assert r.key == int(bits, 2)


def groups_to_read(path, column, value):
    """Row groups, and those whose statistics admit the value."""
    all_groups = read = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            all_groups += 1
            read += stats.min <= value <= stats.max
    return all_groups, read


def test_a_filter_on_either_column_skips_row_groups(spark, folder):
    frame = spark.range(64_000).selectExpr(
        "id", "pmod(hash(id), 5000) AS a", "date_add(DATE'2020-01-01', int(pmod(hash(id, 1), 900))) AS b")
    curve = layout.overwrite_on_curve(frame, f"{folder}/curve", ["a", "b"], rows_per_file=1000)
    lexical = f"{folder}/lexical"
    frame.orderBy("a", "b").coalesce(1).sortWithinPartitions("a", "b").write.option("maxRecordsPerFile", 1000).parquet(lexical)
    wanted = {"a": 1234, "b": datetime.date(2021, 3, 4)}
    on_curve = {c: groups_to_read(curve, c, v) for c, v in wanted.items()}
    sorted_by_a = {c: groups_to_read(lexical, c, v) for c, v in wanted.items()}
    assert sorted_by_a["a"][1] <= 2 and sorted_by_a["b"][1] == sorted_by_a["b"][0] == 64
    assert all(64 <= n <= 80 and read <= 16 for n, read in on_curve.values()), on_curve
    # The library's own report says the same, and no row is lost.
    stored = spark.read.parquet(curve)
    report = layout.files_to_read(layout.file_ranges(stored, ["a", "b"]), wanted)
    assert {r["column"]: (r.files, r.files_read) for r in report.collect()} == on_curve
    assert rows(stored) == rows(frame)


def test_a_column_of_few_values_takes_part_in_the_curve(spark, folder):
    frame = spark.range(6000).selectExpr("id", "pmod(hash(id), 200) AS a", "pmod(hash(id, 1), 10) AS b", "1 AS c")
    path = layout.overwrite_on_curve(frame, f"{folder}/few", ["a", "b", "c"], rows_per_file=93)
    for column, value in (("a", 123), ("b", 4)):
        groups, read = groups_to_read(path, column, value)
        assert groups >= 64 and 2 * read < groups
    assert rows(spark.read.parquet(path)) == rows(frame)


@pytest.mark.parametrize("ranges", [1, 2, 3, 10, 201, 255, 256])
def test_spread_numbers_ascend_and_keep_apart(spark, ranges):
    got = [r.n for r in spark.range(ranges).select(layout.spread(F.col("id"), ranges, 8).alias("n")).orderBy("id").collect()]
    assert got == [i * 256 // ranges for i in range(ranges)]


def test_curve_with_a_hot_value_nulls_and_no_rows(spark, folder):
    frame = spark.range(8000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN string(id) END AS a",
                                         "CAST(NULL AS double) AS b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = layout.overwrite_on_curve(frame, f"{folder}/hot", ["a", "b"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == 8000 and max(sizes) < 3000  # the hot value is dealt to several writers
    assert rows(spark.read.parquet(path)) == rows(frame)
    empty = layout.overwrite_on_curve(frame.limit(0), f"{folder}/none", ["a", "b"])
    assert spark.read.schema(frame.schema).parquet(empty).count() == 0
    with pytest.raises(ValueError):
        layout.overwrite_on_curve(frame, path, ["a"] * 8)
    with pytest.raises(ValueError):
        layout.overwrite_on_curve(frame.withColumn("__tie", F.lit(1)), path, ["a"])


def rows_scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_read_one_row_group(spark, folder):
    frame = spark.range(200_000).selectExpr("xxhash64(id) AS key", "concat('n', xxhash64(id, 1)) AS name", "id")
    frame = frame.repartition(1)
    path = layout.overwrite_for_lookups(frame, f"{folder}/bloom", ["key", "name"], distinct=20_000, group_bytes=512 << 10)
    plain = f"{folder}/plain"
    frame.write.option("parquet.block.size", 512 << 10).parquet(plain)
    groups = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata
    assert groups.num_row_groups >= 8
    largest = max(groups.row_group(g).num_rows for g in range(groups.num_row_groups))
    for wanted in frame.filter("id IN (17, 99999)").collect():
        for condition in (F.col("key") == wanted.key, F.col("name") == wanted.name):
            found = spark.read.parquet(path).filter(condition)
            assert rows(found, "id") == [(wanted.id,)]
            assert rows_scanned(found) <= 2 * largest  # its own group, at most one false hit
            assert rows_scanned(spark.read.parquet(plain).filter(condition)) >= 150_000
    assert rows_scanned(spark.read.parquet(path).filter("key = 5")) <= largest  # a key that is nowhere
