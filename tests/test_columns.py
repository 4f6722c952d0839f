import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from strata.functions import numbers, texts, times, vectors
from tests.conftest import rows


def test_half_even_rounds_like_python(spark):
    draw = random.Random(7)
    values = [0.025, 0.125, 0.375, 1.005, 2.675, 50.125, 0.0, -0.125, -2.675, 1e9 + 0.125]
    values += [draw.randint(0, 9000) / draw.randint(1, 400) for _ in range(3000)]
    values += [(2 * draw.randint(0, 50000) + 1) / 200 for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for value, rounded in frame.select("v", numbers.half_even(F.col("v"))).collect():
        assert rounded == round(value, 2), value


def test_exact_sum_does_not_drift(spark):
    frame = spark.range(200_000).select(F.lit(1_000_000.1).alias("x"), F.lit(-0.35).alias("y"))
    row = frame.select("x", "y").agg(
        numbers.as_money(numbers.exact_sum(F.col("x"))), numbers.exact_sum(F.col("y"))).first()
    assert row[0] == 200_000_020_000.0 and float(row[1]) == -70000.0
    nothing = frame.limit(0).agg(numbers.exact_sum(F.col("x"))).first()
    assert nothing[0] is None


def test_exact_sum_keeps_small_and_large_amounts(spark):
    frame = spark.range(1000).select(F.lit(4e-7).alias("small"), F.lit(1e19).alias("large"), F.lit(-4e-7).alias("debt"),
                                     F.when(F.col("id") % 2 == 0, 1e19).otherwise(-1e19).alias("none"))
    row = frame.agg(*[numbers.exact_sum(F.col(c)).alias(c) for c in frame.columns]).first()
    assert [str(v) for v in row] == ["0.000400", "10000000000000000000000.000000", "-0.000400", "0.000000"]
    draw = random.Random(3)
    values = [draw.uniform(-1, 1) * 10 ** draw.randint(-6, 12) for _ in range(3000)]
    total = spark.createDataFrame([(v,) for v in values], "v double").repartition(5).agg(numbers.exact_sum(F.col("v"))).first()[0]
    assert abs(float(total) - math.fsum(values)) <= 1e-3


def test_percent_of_zero_and_null_is_null(spark):
    frame = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in frame.select(numbers.percent(F.col("a"), F.col("b"))).collect()] == [
        25.0, None, None,
    ]


def test_text_helpers(spark):
    frame = spark.createDataFrame(
        [("T", "<p class='x'>a<br/>b</p>"), (None, "x"), ("  ", "")], "title string, body string"
    )
    content = frame.select(texts.document_content(F.col("title"), F.col("body"))).collect()
    assert content[0][0] == "T\n a b "
    assert content[1][0] is None  # a missing title makes the content missing
    capped = frame.select(texts.document_content(F.col("title"), F.col("body"), 2)).first()[0]
    assert capped == "T\n a"
    assert [r[0] for r in frame.select(texts.is_blank(F.col("title"))).collect()] == [
        False, True, True,
    ]


@pytest.mark.parametrize("text, full", [
    ("2026-08-12T12:00", "2026-08-12T12:00:00Z"),
    ("2026-08-12T12:00:30", "2026-08-12T12:00:30Z"),
    ("2026-08-12T12:00:30Z", "2026-08-12T12:00:30Z"),
])
def test_observation_times_get_a_zone(spark, text, full):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(times.with_zone(F.col("t"))).first()[0] == full


def test_minute_key_is_utc(spark):
    frame = spark.createDataFrame(
        [("2026-08-12T12:00:59Z",), ("2026-08-12T14:00:01+02:00",), ("nonsense",)], "t string"
    )
    keys = [r[0] for r in frame.select(times.minute_key(times.instant(F.col("t")))).collect()]
    assert keys == ["2026-08-12T12:00:00+00:00", "2026-08-12T12:00:00+00:00", None]


def test_trailing_window_includes_its_edge(spark):
    base = datetime.datetime(2026, 1, 1, 12)
    frame = spark.createDataFrame(
        [(i, base - datetime.timedelta(minutes=30 * i)) for i in range(5)], "i int, t timestamp"
    )
    assert rows(times.since(frame, "t", "1 HOUR"), "i") == [(0,), (1,), (2,)]
    fixed = F.lit(base - datetime.timedelta(hours=1))
    assert rows(times.since(frame, "t", "1 HOUR", fixed), "i") == [(i,) for i in range(5)]
    assert times.since(frame.limit(0), "t", "1 HOUR").count() == 0


def test_cosine_distance(spark):
    frame = spark.createDataFrame(
        [([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([1.0], [-1.0]), ([0.0], [1.0])],
        "a array<float>, b array<float>",
    )
    got = [r[0] for r in frame.select(
        F.round(vectors.cosine_distance(F.col("a"), F.col("b")), 9)).collect()]
    assert got == [1.0, 0.0, 2.0, None]
