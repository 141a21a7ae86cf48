"""Vector distance expressions over array<double> columns (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def euclidean(a, b) -> Column:
    return F.sqrt(_sum(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))))


def manhattan(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y)))


def chebyshev(a, b) -> Column:
    return F.array_max(F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y)))


def dot(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def cosine_distance(a, b) -> Column:
    """1 - cos(a, b); null when either vector is all zeros."""
    den = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return 1 - F.try_divide(dot(a, b), F.when(den == 0, None).otherwise(den))


METRICS = {"euclidean": euclidean, "manhattan": manhattan,
           "chebyshev": chebyshev, "cosine": cosine_distance}
