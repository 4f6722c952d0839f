"""Regional revenue: remote orders against native targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import Expect, gate


def region_revenue(orders: DataFrame, targets: DataFrame) -> DataFrame:
    """Orders, revenue and target status per region, best revenue first.

    Orders shrink to one row per region code before they meet the targets.
    """
    per_code = orders.groupBy("region_code").agg(
        F.count(F.lit(1)).alias("__orders"), F.sum("amount").alias("__revenue")
    )
    return (
        per_code.join(targets, "region_code")
        .groupBy("region_name", "revenue_target")
        .agg(
            F.sum("__orders").alias("order_count"),
            F.round(F.sum("__revenue"), 2).alias("revenue"),
        )
        .withColumn(
            "status", F.when(F.col("revenue") >= F.col("revenue_target"), "met").otherwise("below")
        )
        .select("region_name", "order_count", "revenue", "revenue_target", "status")
        .orderBy(F.desc("revenue"), "region_name")
    )


def verify(result: DataFrame, regions: int, orders: int, revenue: float) -> DataFrame:
    totals = result.agg(
        F.count(F.lit(1)).alias("regions"),
        F.sum("order_count").alias("orders"),
        F.round(F.sum("revenue"), 2).cast("double").alias("revenue"),
    )
    return gate(
        totals,
        {
            "regions": Expect(equals=regions),
            "orders": Expect(equals=orders),
            "revenue": Expect(equals=revenue),
        },
    )
