"""Cells of vectors: rows fit to be compared, a bounded sample, centroids fitted on it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str, vec_col: str, *more) -> DataFrame:
    """(id, vec, more) of the rows with an id and a vector that has a direction."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), *more)
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def unit(column: pa.Array) -> np.ndarray:
    """An Arrow column of lists of one length as unit vectors."""
    points = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    # By the greatest component first, so that squares neither overflow nor vanish.
    points = points / np.abs(points).max(axis=1, keepdims=True, initial=0)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def sampled(rows: DataFrame, sample_rows: int) -> np.ndarray:
    """Unit vectors of the distinct (vec) of least hash, sample_rows at most, of the length that most of them have."""
    found = [r["vec"] for r in rows.select("vec").distinct().orderBy(F.xxhash64("vec")).limit(sample_rows).collect()]
    sizes = [len(v) for v in found]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    points = np.array([v for v in found if len(v) == size]).reshape(sizes.count(size), size)
    return points / np.linalg.norm(points, axis=1, keepdims=True) if len(points) else points


def centroids(points: np.ndarray, cells: int, steps: int = 8) -> np.ndarray:
    """Unit vectors of cells, by k-means over some points, which begins with points far from each other."""
    found = points[:1]
    if not len(found):
        return found
    near = points @ found[0]
    while len(found) < min(cells, len(points)):
        found = np.vstack([found, points[np.argmin(near)]])
        near = np.maximum(near, points @ found[-1])
    for _ in range(steps):
        cell = np.argmax(points @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, cell, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(norms > 0, sums / np.maximum(norms, 1e-12), found)
    return found
