"""Time column helpers (the session zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def instant(text: Column) -> Column:
    """ISO-8601 text with or without a zone as a timestamp, NULL when malformed."""
    return F.try_to_timestamp(text)


def iso_instant(ts: Column) -> Column:
    """``2026-08-12T12:00:00`` text of a timestamp."""
    return F.date_format(ts, ISO_SECONDS)



def minute_key(ts: Column) -> Column:
    """Start of the UTC minute as ISO text with offset."""
    return F.concat(iso_instant(F.date_trunc("minute", ts)), F.lit("+00:00"))


def with_zone(text: Column) -> Column:
    """Complete observation times: minutes get ``:00Z``, others lacking it ``Z``."""
    return (
        F.when(text.endswith("Z"), text)
        .when(F.length(text) == 16, F.concat(text, F.lit(":00Z")))
        .otherwise(F.concat(text, F.lit("Z")))
    )


def plain(ts: Column) -> Column:
    """Timestamp without zone, as warehouses without zones store it."""
    return ts.cast("timestamp_ntz")


def since(df: DataFrame, column: str, interval: str, as_of: Column | None = None) -> DataFrame:
    """Rows of the trailing ``interval`` (such as ``1 HOUR``) up to ``as_of``.

    Live views pass ``current_timestamp()``. Without ``as_of`` the newest time of
    the data counts; that is one scalar subquery, not a join.
    """
    if as_of is None:
        as_of = df.agg(F.max(column)).scalar()
    return df.filter(F.col(column) >= as_of - F.expr(f"INTERVAL {interval}"))
