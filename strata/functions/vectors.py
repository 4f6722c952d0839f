"""Vector column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product of two numeric arrays, in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    """Euclidean length of a numeric array."""
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - cos(a, b)``; NULL when a vector has no length."""
    return 1 - F.try_divide(dot(a, b), norm(a) * norm(b))
