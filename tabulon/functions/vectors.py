"""Dense-vector arithmetic on ``ARRAY<DOUBLE>`` columns (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squared_distance(a, b) -> Column:
    """Sum of squared element differences of two equal-length arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def euclidean_distance(a, b) -> Column:
    return F.sqrt(squared_distance(a, b))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, v: acc + v)


def as_double_array(col) -> Column:
    """ARRAY<FLOAT|INT|...> or an ML vector to ARRAY<DOUBLE>."""
    return F.transform(_c(col), lambda x: x.cast("double"))
