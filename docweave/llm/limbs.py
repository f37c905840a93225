"""Exact integer sums of any size across tasks: whole numbers as signed 30-bit limbs that Spark adds as longs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 30


def split(values: Sequence[int]) -> list[list[int]]:
    """Each number as limbs of its sign, least first; zero has none."""
    out = []
    for v in values:
        v = int(v)
        sign, left, limbs = (-1 if v < 0 else 1), abs(v), []
        while left:
            limbs.append(sign * (left & ((1 << BITS) - 1)))
            left >>= BITS
        out.append(limbs)
    return out


def join(parts: Iterable[tuple[int, int]]) -> int:
    """The number whose limbs (place, sum of limbs) these are."""
    return sum(int(value) << (BITS * place) for place, value in parts)


def totals(parts: DataFrame, by: Sequence[str], limbs: str) -> DataFrame:
    """(by, dim, limb, value) of rows with an array of numbers in limbs: the sums over all rows, place by place.

    There are as many rows as keys, dimensions and limbs, whatever the number of
    rows summed; up to 2^33 rows can be added before a long could overflow.
    """
    dims = parts.select(*by, F.posexplode(limbs).alias("dim", "limbs_"))
    each = dims.select(*by, "dim", F.posexplode("limbs_").alias("limb", "value"))
    return each.groupBy(*by, "dim", "limb").agg(F.sum("value").alias("value"))
