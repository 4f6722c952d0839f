import random

import pytest
from pyspark.sql import functions as F

from strata.operators import nested, ordering
from tests.conftest import rows


def test_best_per_key_with_ties_nulls_and_a_hot_key(spark):
    data = [("hot", i % 7, i) for i in range(3000)] + [("a", 1, 1), ("a", 1, 2), (None, 5, 9)]
    frame = spark.createDataFrame(data, "k string, v int, id int").repartition(8)
    best = ordering.best_per_key(frame, ["k"], [F.desc("v"), F.desc("id")])
    assert rows(best) == rows(spark.createDataFrame(
        [("hot", 6, 2995), ("a", 1, 2), (None, 5, 9)], "k string, v int, id int"))
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_structs_keeps_order_and_length(spark):
    frame = spark.createDataFrame(
        [("a", w, n) for w, n in [("x", 3), ("y", 9), ("z", 3), ("u", 1)]] + [("b", "q", 1)],
        "c string, word string, n int",
    )
    top = ordering.top_structs(frame, ["c"], "best", ["word", "n"], [F.desc("n"), F.col("word")], 3)
    got = {r.c: [(s.word, s.n) for s in r.best] for r in top.collect()}
    assert got == {"a": [("y", 9), ("x", 3), ("z", 3)], "b": [("q", 1)]}


def test_row_ids_follow_the_order_over_many_ranges(spark):
    keys = random.Random(3).sample(range(10**6), 5000)
    frame = spark.createDataFrame([(k, f"v{k}") for k in keys], "k int, v string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = ordering.with_row_ids(frame, ["k"], "id")
        got = [(r.id, r.k, r.v) for r in numbered.orderBy("id").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == [(i + 1, k, f"v{k}") for i, k in enumerate(sorted(keys))]
    assert ordering.with_row_ids(frame.limit(0), ["k"]).count() == 0


def test_running_totals_equal_a_loop(spark):
    data = [(k, (k * 37) % 11) for k in range(2000)]
    frame = spark.createDataFrame(data, "k int, n bigint").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dict(rows(ordering.with_running_totals(frame, ["k"], {"n": "before"}), "k", "before"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total = 0
    for k, n in data:
        assert got[k] == total
        total += n


@pytest.mark.parametrize("hot_lines", [10, 100_000])
def test_records_have_one_grain_whatever_their_key_holds(spark, hot_lines):
    """One key with a third of all lines or hardly any: parts follow the line's number."""
    data = spark.range(hot_lines).select(F.lit("hot").alias("k"), (F.col("id") + 1).alias("i"), F.lit(1).alias("q"))
    rest = spark.range(2 * hot_lines).select(
        F.concat(F.lit("k"), F.col("id") % 300).alias("k"), F.floor(F.col("id") / 300 + 1).alias("i"), F.lit(1).alias("q"))
    records = nested.nest_rows(
        data.unionByName(rest).repartition(4), "k", "items", [F.col("i"), F.col("q")], F.col("i"), per_record=100)
    spread = records.select("k", "part", F.explode("items.i").alias("i"))
    assert spread.filter("part <> (i - 1) div 100").isEmpty() and spread.count() == 3 * hot_lines
    assert records.groupBy("k", "part").count().filter("count > 1").isEmpty()
    assert records.agg(F.max(F.size("items"))).first()[0] == min(100, hot_lines)
    unnumbered = nested.nest_rows(
        spark.createDataFrame([("a", None), ("a", 2)], "k string, i int"), "k", "items", [F.col("i")], F.col("i"))
    assert rows(unnumbered.select("k", "part", F.size("items"))) == [("a", 0, 2)]


def test_element_where_and_unnest(spark):
    frame = spark.createDataFrame(
        [(1, [(0, 0.3), (1, 0.7)]), (2, []), (3, None), (4, [(0, 1.0)])],
        "id int, probs array<struct<label:int,prob:double>>",
    )
    got = frame.select("id", nested.element_where("probs", "label", 1, "prob").alias("p"))
    assert rows(got) == [(1, 0.7), (2, None), (3, None), (4, None)]
    assert rows(nested.unnest(frame, "probs"), "id") == [(1,), (1,), (4,)]
