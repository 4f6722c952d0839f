"""Web traffic by user and by minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.times import instant, minute_key


def _distinct_with_null(column: str) -> Column:
    # NULL counts as one more value, as it does in a set.
    return F.count_distinct(F.col(column)) + F.max(F.col(column).isNull().cast("int"))


def user_traffic(views: DataFrame) -> DataFrame:
    """Page views, bytes and distinct paths per user."""
    return views.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("page_views"),
        F.sum("bytes_sent").alias("bytes_sent"),
        _distinct_with_null("path").cast("bigint").alias("unique_paths"),
    )


def minute_traffic(views: DataFrame) -> DataFrame:
    """Page views, bytes and active users per UTC minute."""
    return views.groupBy(minute_key(instant(F.col("event_time"))).alias("traffic_minute")).agg(
        F.count(F.lit(1)).alias("page_views"),
        F.sum("bytes_sent").alias("bytes_sent"),
        _distinct_with_null("user_id").cast("bigint").alias("active_users"),
    )


def sum_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keyed sum; partial sums combine before the shuffle."""
    return df.groupBy(key).agg(F.sum(value).alias(value))
