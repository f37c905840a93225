"""An index of vectors for approximate and proven nearest neighbours: cells, residual product codes, exact re-rank.

Every row lies in the cell of its nearest centroid. What is left of its unit
vector beside the centroid is coded: `per_code` components at a time are named
by the nearest of up to 256 codewords (product quantization, Jegou et al.
2011), a byte each. A row also keeps the length of what its code misses. The
table is written in the order of cells, so that a scan of codes reads a small
part of the bytes of the vectors.

A question is compared with the codes of the cells nearest to it. Approximate:
the best k * overfetch by code are compared exactly. Proven: by the lengths
missed, each row's similarity lies between two bounds; every row whose upper
bound reaches the k-th greatest lower bound is compared exactly, over all
cells, so the result is that of comparing everything.

Centroids and codewords are fitted on a bounded sample of rows (`sample_rows`,
those of least hash), everything else covers all rows.

Nulls and odd rows: rows with a null id, or a null, zero or non-finite vector,
aren't in the index, nor are vectors of another length than most in the sample;
a row is no neighbour of its own id; ties on a distance (to `places`) go by id;
equal vectors have equal codes and are all compared where one is; a repeated id
stands for the least of its vectors; an empty table gives an empty index.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.operators.cells import centroids, sampled, unit, usable
from docweave.storage import delete_on_exit, scratch, shared_dir, ship, written


@dataclass(frozen=True)
class Coding:
    """cells and codewords (`words`, for `per_code` components each) are fitted on sample_rows rows in `steps` steps; the blocks bound what a task compares at once."""

    cells: int = 64
    per_code: int = 2
    words: int = 256
    sample_rows: int = 20_000
    steps: int = 8
    asked_block: int = 1024
    coded_block: int = 16_384


def _codebooks(rest: np.ndarray, coding: Coding) -> np.ndarray:
    """(pieces, words, per_code): codewords of each piece of residuals, by k-means."""
    pieces = rest.reshape(len(rest), -1, coding.per_code)
    words = max(1, min(coding.words, len(rest)))
    books = np.empty((pieces.shape[1], words, coding.per_code))
    for m in range(pieces.shape[1]):
        points = pieces[:, m]
        # Begin along the first component's order, which is spread as the points are.
        book = points[np.argsort(points[:, 0], kind="stable")[(np.arange(words) * len(points)) // words]].copy()
        for _ in range(coding.steps):
            near = _nearest(points, book)
            sums = np.zeros_like(book)
            np.add.at(sums, near, points)
            counts = np.bincount(near, minlength=words)[:, None]
            book = np.where(counts > 0, sums / np.maximum(counts, 1), book)
        books[m] = book
    return books


def _nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book * book).sum(axis=1)[None, :] - 2 * points @ book.T, axis=1)


@dataclass
class Model:
    """centers (cells, size) and books (pieces, words, per_code)."""

    centers: np.ndarray
    books: np.ndarray

    def encode(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, codes, length missed) of unit vectors."""
        cell = np.argmax(points @ self.centers.T, axis=1)
        rest = (points - self.centers[cell]).reshape(len(points), len(self.books), -1)
        codes = np.stack([_nearest(rest[:, m], book) for m, book in enumerate(self.books)], axis=1).astype(np.uint8)
        missed = np.linalg.norm(points - self.decode(cell, codes), axis=1)
        return cell, codes, missed

    def decode(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.centers[cell] + self.books[np.arange(len(self.books)), codes].reshape(len(codes), -1)


def _encoded(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            cell, codes, missed = model.value.encode(unit(batch.column("vec")))
            held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.shape[1]), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes))]).cast(pa.binary())
            # Lengths are rounded up, so that a bound stays one.
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), held, pa.array(missed * (1 + 1e-9) + 1e-12)], ["id", "vec", "cell", "codes", "missed"])

    return run


@dataclass
class VectorIndex:
    spark: SparkSession
    path: str
    coding: Coding
    model: Model | None

    @staticmethod
    def build(df: DataFrame, id_col: str, vec_col: str, path: str, coding: Coding = Coding()) -> VectorIndex:
        """Writes the index of a table under path."""
        spark = df.sparkSession
        ship(spark)
        rows = usable(df, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
        points = sampled(rows, coding.sample_rows)
        size = points.shape[1]
        rows = rows.where(F.size("vec") == size)
        kind = rows.schema["id"].dataType.simpleString()
        shape = f"id {kind}, vec array<double>, cell int, codes binary, missed double"
        if not size:
            spark.createDataFrame([], shape).write.parquet(path)
            return VectorIndex(spark, path, coding, None)
        if size % coding.per_code:
            raise ValueError(f"{size} components don't divide by {coding.per_code}")
        centers = centroids(points, coding.cells, coding.steps)
        cell = np.argmax(points @ centers.T, axis=1)
        model = Model(centers, _codebooks(points - centers[cell], coding))
        coded = rows.mapInArrow(_encoded(spark.sparkContext.broadcast(model)), shape)
        coded.repartitionByRange("cell", F.xxhash64("id")).sortWithinPartitions("cell").write.parquet(path)
        return VectorIndex(spark, path, coding, model)

    def exists(self) -> bool:
        return written(self.spark, self.path)

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def search(self, asked: DataFrame, id_col: str, vec_col: str, k: int, probes: int | None = None, overfetch: int = 4, prove: bool = False, places: int = 9, report: dict | None = None) -> DataFrame:
        """(id, neighbor, rank, dist): the k nearest indexed rows of each asked row by cosine distance.

        probes: cells whose codes are compared, all if it isn't given or with
        prove. report gets the shares of all pairs of asked and indexed rows
        whose codes and whose vectors were compared.
        """
        rows = usable(asked, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
        kind, other = rows.schema["id"].dataType.simpleString(), self.table().schema["id"].dataType.simpleString()
        if self.model is None:
            return self.spark.createDataFrame([], f"id {kind}, neighbor {other}, rank int, dist double")
        rows = rows.where(F.size("vec") == self.model.centers.shape[1])
        cells = len(self.model.centers)
        near = cells if prove or probes is None else min(probes, cells)
        shared = self.spark.sparkContext.broadcast(self.model)
        placed = rows.mapInArrow(_probed(shared, near), f"id {kind}, vec array<double>, cells array<int>")
        asks = scratch(placed, "asks")
        left = asks.select("id", "vec", F.explode("cells").alias("cell"))
        right = self.table().select("id", "cell", "codes", "missed")
        held = lambda side, by, name: side.groupBy("cell").agg(F.ceil(F.count("*") / by).cast("int").alias(name))
        # A row for each cell.
        sizes = F.broadcast(held(left, self.coding.asked_block, "ni").join(held(right, self.coding.coded_block, "nj"), "cell"))
        own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        a = left.join(sizes, "cell").select("cell", own("ni").alias("i"), every("nj").alias("j"), "id", "vec")
        b = right.join(sizes, "cell").select("cell", every("ni").alias("i"), own("nj").alias("j"), "id", "codes", "missed")
        found = a.groupBy("cell", "i", "j").cogroup(b.groupBy("cell", "i", "j")).applyInArrow(
            _coded_pair(shared, k, k * overfetch, prove), f"id {kind}, neighbor {other}, close double, missed double")
        found = scratch(found, "by-code")
        if prove:
            low = found.select("id", (F.col("close") - F.col("missed")).alias("low"))
            bound = low.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("low")))).where(F.col("n") == k).select("id", "low")
            slack = 10.0**-places  # what rounding may make equal
            some = found.join(bound, "id", "left").where(F.col("low").isNull() | (F.col("close") + F.col("missed") + 2 * slack >= F.col("low"))).select("id", "neighbor")
        else:
            best = Window.partitionBy("id").orderBy(F.desc("close"), "neighbor")
            some = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k * overfetch).select("id", "neighbor")
        some = scratch(some, "shortlist")
        if report is not None:
            total, rows_asked = self.table().count(), asks.count()
            pairs = left.groupBy("cell").count().join(right.groupBy("cell").agg(F.count("*").alias("held")), "cell").agg(F.sum(F.col("count") * F.col("held"))).first()[0]
            report |= {"asked": rows_asked, "coded": (pairs or 0) / max(1, total * rows_asked), "compared": some.count() / max(1, total * rows_asked)}
        vecs = self.table().select(F.col("id").alias("neighbor"), F.col("vec").alias("other"))
        exact = some.join(asks.select("id", "vec"), "id").join(vecs, "neighbor").select("id", "vec", "neighbor", "other")
        dists = exact.mapInArrow(_exact(places), f"id {kind}, neighbor {other}, dist double")
        order = Window.partitionBy("id").orderBy("dist", "neighbor")
        return dists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("id", "neighbor", "rank", "dist")


def _probed(model, near: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            cells = np.argsort(-(unit(batch.column("vec")) @ model.value.centers.T), axis=1, kind="stable")[:, :near].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * near), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "vec", "cells"])

    return run


def _coded_pair(model, k: int, width: int, prove: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """A block of asked rows against a block of one cell's codes."""
        ids, others = left.column("id").combine_chunks(), right.column("id").combine_chunks()
        if not len(ids) or not len(others):
            return pa.table({"id": ids.slice(0, 0), "neighbor": others.slice(0, 0), "close": pa.array([], pa.float64()), "missed": pa.array([], pa.float64())})
        codes = np.frombuffer(b"".join(right.column("codes").to_pylist()), np.uint8).reshape(len(others), -1)
        cell = np.asarray(right.column("cell")).astype(np.int64)
        close = unit(left.column("vec").combine_chunks()) @ model.value.decode(cell, codes).T
        missed = np.asarray(right.column("missed"))
        numbers, them = ids.to_numpy(zero_copy_only=False), others.to_numpy(zero_copy_only=False)
        same = numbers[:, None] == them[None, :]
        close[same] = -np.inf
        if prove:
            low = close - missed
            kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(low), -np.inf)
            rows, cols = np.nonzero((close + missed + 1e-9 >= kth[:, None]) & ~same)
        else:
            width_ = min(width, close.shape[1])
            best = np.argpartition(-close, width_ - 1, axis=1)[:, :width_]
            rows, cols = np.repeat(np.arange(len(best)), width_), best.ravel()
            sound = np.isfinite(close[rows, cols])
            rows, cols = rows[sound], cols[sound]
        return pa.table({"id": ids.take(pa.array(rows)), "neighbor": others.take(pa.array(cols)), "close": pa.array(close[rows, cols]), "missed": pa.array(missed[cols])})

    return run


def _exact(places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                dist = 1 - (unit(batch.column("vec")) * unit(batch.column("other"))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("neighbor"), pa.array(np.round(dist, places))], ["id", "neighbor", "dist"])

    return run


def approximate(df: DataFrame, k: int, id_col: str, vec_col: str, queries: DataFrame | None = None, cells: int = 64, probes: int | None = None, block_rows: int = 4096, places: int = 9) -> DataFrame:
    """(id, neighbor, rank, dist): the k nearest of each row, or of those of queries (id_col), by an index built for it."""
    spark = df.sparkSession
    where = f"{shared_dir(spark).rstrip('/')}/docweave-vector-index-{uuid.uuid4().hex}"
    delete_on_exit(spark, where)
    index = VectorIndex.build(df, id_col, vec_col, where, Coding(cells=cells, asked_block=block_rows, coded_block=block_rows))
    asked = df if queries is None else df.join(queries.select(id_col).distinct(), id_col, "left_semi")
    return index.search(asked, id_col, vec_col, k, probes, places=places)
