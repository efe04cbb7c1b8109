"""Vector expressions on ``array<float>`` / ``array<double>`` columns.

Cosine *distance* (1 - cosine similarity) as in the reference; comparisons
against thresholds are strict.  All arithmetic stays in JVM higher-order
functions; norms are computed once per side and carried along.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def cosine_distance(a: Column, b: Column, norm_a: Column | None = None,
                    norm_b: Column | None = None) -> Column:
    na = norm_a if norm_a is not None else norm(a)
    nb = norm_b if norm_b is not None else norm(b)
    # A zero vector has no direction: treat it as orthogonal (distance 1).
    return F.lit(1.0) - F.coalesce(F.try_divide(dot(a, b), na * nb), F.lit(0.0))
