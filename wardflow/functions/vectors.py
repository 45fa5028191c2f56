"""Vector expressions over ``array<float>`` or ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    squares = F.transform(a, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 where either vector has no length."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(0.0)
