"""Vector functions: higher-order Column expressions in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """v over its length as array<double>; null for zero and null vectors."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n))


def literal(values) -> Column:
    return F.lit([float(x) for x in values])


def similarity(v: Column, query) -> Column:
    """Dot product of a vector column with a constant vector."""
    return dot(v, literal(query))
