"""Row numbers over whole tables and over groups of any size, without gathering either in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.naming import fresh
from docweave.storage import scratch


def positions(df: DataFrame, name: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """df with the place (from 1) of each row in the order of some columns, over all rows or inside each group.

    Rows are sorted by ranges and numbered inside each range; a range's offset in
    a group is the sum of what the ranges before hold of it, and only these sums,
    a row for each range and group in it, are ranked by a window. So neither the
    table nor a group with most of its rows has to fit a task. Nulls come first
    and are a group of their own; the order should end in an id to be total.
    """
    part, row, first, held, shift, *keys_ = fresh(df.columns, "range", "row", "first", "held", "shift", *[f"by_{i}" for i in range(len(by))])
    named = lambda cs: [F.col(f"`{c}`") for c in cs]
    keys = named([*by, *order])
    sorted_ = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = scratch(sorted_.select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(row)), "ordered")
    pieces = numbered.groupBy(part, *named(by)).agg(F.min(row).alias(first), F.count("*").alias(held))
    before = Window.partitionBy(*named(by)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(part, *[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys_, strict=True)], (F.coalesce(F.sum(held).over(before), F.lit(0)) - F.col(first) + 1).alias(shift))
    same = [numbered[part] == offsets[part], *[numbered[f"`{c}`"].eqNullSafe(offsets[k]) for c, k in zip(by, keys_, strict=True)]]
    joined = numbered.join(offsets, reduce(lambda a, b: a & b, same))
    return joined.select(*[numbered[f"`{c}`"] for c in df.columns], (F.col(row) + F.col(shift)).alias(name))
