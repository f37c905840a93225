"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; null where either side is null or zero."""
    n = norm(a) * norm(b)
    return F.when(n > 0, 1 - dot(a, b) / n)
