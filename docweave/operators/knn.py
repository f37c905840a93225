"""Exact nearest neighbours of every row: products of bounded blocks, a proven shortlist, blocks that can't matter left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.cells import centroids, sampled, unit, usable
from docweave.operators.vector_index import approximate  # noqa: F401  (its old place)
from docweave.storage import scratch


#: Doubles that a comparison holds at once, rows of a block compared with a piece at once, rows of a piece, and how many of these a product takes once k are known.
HELD, TURN, PIECE, PART = 1 << 21, 512, 4096, 1024
#: Rows of a block at most, and blocks that there are at least before blocks grow beyond what is asked.
WIDEST, BLOCKS = 32_768, 48


def _error(size: int, places: int) -> float:
    """How far a similarity in single precision may lie off: rounding of both factors and of their sum, and what rounding of distances may make equal."""
    return (size + 8) * 2.0**-24 + 10.0**-places


def _shortlisted(a: np.ndarray, b: np.ndarray, barred: np.ndarray, k: int, places: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of each row's k nearest, ties by the place in b.

    Similarities in single precision choose a shortlist, which is compared in
    double. It is proven if what it leaves out, error added, is farther than
    the k-th; rows without proof get a list eight times as long, up to all of b.
    """
    close = a.astype(np.float32) @ b.astype(np.float32).T
    close[barred] = -np.inf
    error = _error(a.shape[1], places)
    out, rows, width = [], np.arange(len(a)), min(k + 8, len(b))
    while len(rows):
        some = close[rows]
        best = np.sort(np.argpartition(-some, width - 1, axis=1)[:, :width], axis=1)
        exact = np.empty(best.shape)
        turn = max(1, HELD // (width * a.shape[1]))
        for at in range(0, len(rows), turn):
            exact[at : at + turn] = np.einsum("id,ijd->ij", a[rows[at : at + turn]], b[best[at : at + turn]])
        dist = np.round(1 - exact, places)
        dist[~np.isfinite(np.take_along_axis(some, best, axis=1))] = np.inf
        order = np.argsort(dist, axis=1, kind="stable")[:, :k]
        got, dist = np.take_along_axis(best, order, axis=1), np.take_along_axis(dist, order, axis=1)
        left_out = np.take_along_axis(some, best, axis=1).min(axis=1).astype(np.float64)
        proven = np.full(len(rows), width == len(b)) | (1 - left_out - error > dist[:, -1]) if dist.shape[1] == k else np.full(len(rows), width == len(b))
        proven |= ~np.isfinite(left_out)  # only barred rows are left out
        r, c = np.nonzero(proven[:, None] & np.isfinite(dist))
        out.append((rows[r], got[r, c], dist[r, c]))
        rows, width = rows[~proven], min(8 * width, len(b))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _rows(df: DataFrame, id_col: str, vec_col: str, group_col: str | None) -> DataFrame:
    return usable(df, id_col, vec_col, (F.col(group_col).cast("string") if group_col else F.lit(None).cast("string")).alias("grp"))


def _ranked(best: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy("dist", "neighbor")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("id", "neighbor", "rank", "dist")


def _places(hit: np.ndarray) -> np.ndarray:
    """Where a matrix is true, row by row: eight places are looked at in one."""
    flat = hit.ravel()
    whole = len(flat) & ~7
    at = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate((at[flat[at]], whole + np.flatnonzero(flat[whole:])))


class _Best:
    """The k nearest so far of the rows of one block, as others come by in order of their ids; none beyond a row's bound, if it has one."""

    def __init__(self, mine: pa.Table, k: int, places: int, groups: bool):
        self.k, self.places = k, places
        self.names = mine.column("id").combine_chunks()
        self.ids, self.vec = np.asarray(self.names), unit(mine.column("vec").combine_chunks())
        self.short = self.vec.astype(np.float32)
        self.grp = None
        if groups:
            self.kinds = pc.unique(mine.column("grp").combine_chunks())
            self.grp = self.coded(mine.column("grp").combine_chunks())
        self.dist = np.full((len(mine), k), np.inf)
        # What lies at the bound itself may still win by its id.
        self.fence = np.nextafter(pc.fill_null(mine.column("bound"), np.inf).to_numpy(), np.inf) if "bound" in mine.column_names else self.dist[:, -1].copy()
        self.other: np.ndarray | None = None

    def coded(self, grp: pa.Array) -> np.ndarray:
        """Numbers of groups; those that no row of the block is in are -1."""
        return pc.fill_null(pc.index_in(grp, value_set=self.kinds), -1).to_numpy(zero_copy_only=False)

    def kth(self, rows: np.ndarray) -> np.ndarray:
        """What a distance must be below to count."""
        return np.minimum(self.dist[rows, -1], self.fence[rows])

    def take(self, batch: pa.RecordBatch) -> None:
        others, vec = np.asarray(batch.column("id")), unit(batch.column("vec"))
        grp = None if self.grp is None else self.coded(batch.column("grp"))
        if self.other is None:
            self.other = np.empty(self.dist.shape, others.dtype)
        kept = _first_copies(vec, grp, self.k + 1)
        if kept is not None:
            others, vec, grp = others[kept], vec[kept], None if grp is None else grp[kept]
        short = vec.astype(np.float32).T
        for at in range(0, len(self.ids), TURN):
            rows = np.arange(at, min(at + TURN, len(self.ids)))
            far = np.isinf(self.kth(rows))
            some = rows[far]
            if len(some):
                barred = self.ids[some][:, None] == others[None, :]
                if grp is not None:
                    barred |= self.grp[some][:, None] == grp[None, :]
                r, c, dist = _shortlisted(self.vec[some], vec, barred, min(self.k, len(others)), self.places)
                self._merge(some[r], others[c], dist)
            some = rows[~far]
            for a in range(0, len(others) if len(some) else 0, PART):
                part = slice(a, a + PART)
                self._nearer(some, others[part], vec[part], short[:, part], None if grp is None else grp[part])

    def _nearer(self, rows: np.ndarray, others: np.ndarray, vec: np.ndarray, short: np.ndarray, grp: np.ndarray | None) -> None:
        """Others that are nearer than the k-th so far of a row: single precision tells which may be, double which are."""
        kth = self.kth(rows)
        least = 1 - kth - _error(vec.shape[1], self.places) - 2.0**-22
        # Ids rise, so of equal distances those found before stay, and nothing is nearer than nothing.
        least[kth <= 0] = np.inf
        close, least = self.short[rows] @ short, least.astype(np.float32)
        # Most rows have nothing near in a piece: one look at the greatest tells.
        some = np.flatnonzero(close.max(axis=1) > least)
        rows, hit = rows[some], close[some] > least[some, None]
        if grp is not None and np.count_nonzero(hit) * 64 > hit.size:  # fewer are asked for their groups one by one
            hit &= self.grp[rows][:, None] != grp[None, :]
        r, c = np.divmod(_places(hit), len(others))
        if grp is not None:
            r, c = (x[self.grp[rows[r]] != grp[c]] for x in (r, c))
        turn = max(1, HELD // vec.shape[1])
        for at in range(0, len(r), turn):
            i, j = rows[r[at : at + turn]], c[at : at + turn]
            dist = np.round(1 - np.einsum("ij,ij->i", self.vec[i], vec[j]), self.places)
            near = (dist < self.kth(i)) & (self.ids[i] != others[j])
            self._merge(i[near], others[j[near]], dist[near])

    def _merge(self, row: np.ndarray, other: np.ndarray, dist: np.ndarray) -> None:
        """Puts what was found (by row, others in order) among the best; of equal distances those found before stay first."""
        if not len(row):
            return
        touched = np.unique(row)
        old = np.repeat(touched, self.k)
        row = np.concatenate((old, row))
        dist, other = np.concatenate((self.dist[touched].ravel(), dist)), np.concatenate((self.other[touched].ravel(), other))
        order = np.lexsort((dist, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        first = order[rank < self.k]
        self.dist[touched], self.other[touched] = dist[first].reshape(-1, self.k), other[first].reshape(-1, self.k)

    def rows(self) -> pa.RecordBatch:
        r, c = np.nonzero(np.isfinite(self.dist))
        return pa.RecordBatch.from_arrays([self.names.take(pa.array(r)), pa.array(self.other[r, c], self.names.type), pa.array(c + 1, pa.int32()), pa.array(self.dist[r, c])], ["id", "neighbor", "rank", "dist"])


def _first_copies(vec: np.ndarray, grp: np.ndarray | None, most: int) -> np.ndarray | None:
    """Places of the rows without those that have `most` equal ones before them; None where no vector comes twice."""
    if len(np.unique(vec[:, 0])) == len(vec):
        return None
    raw = np.ascontiguousarray(vec).view(np.dtype((np.void, vec.itemsize * vec.shape[1]))).ravel()
    key = np.unique(raw, return_inverse=True)[1]
    if grp is not None:
        key = key * (int(grp.max()) + 2) + grp + 1
    order = np.argsort(key, kind="stable")
    rank = np.arange(len(key)) - np.searchsorted(key[order], key[order], "left")
    return np.sort(order[rank < most])


def _streamed(k: int, places: int, groups: bool, step: int = PIECE):
    """Rows sorted by (i, side, id): of each i its own rows (side 0, with a bound if there is such a column), then others (side 1), of which only `step` and the k best so far are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, own = None, []
        best: _Best | None = None
        for batch in batches:
            i, side = batch.column("i").to_numpy(), batch.column("side").to_numpy()
            cuts = np.flatnonzero((np.diff(i) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(i)], strict=True):
                if a == b:
                    continue
                if i[a] != block:
                    if best is not None and best.other is not None:
                        yield best.rows()
                    block, own, best = i[a], [], None
                if side[a] == 0:
                    own.append(batch.slice(a, b - a))
                    continue
                if best is None:
                    if not own:
                        continue
                    best, own = _Best(pa.Table.from_batches(own), k, places, groups), []
                for at in range(a, b, step):
                    best.take(batch.slice(at, min(step, b - at)))
        if best is not None and best.other is not None:
            yield best.rows()

    return run


def _block_count(rows: int, block_rows: int) -> int:
    """Blocks of block_rows, but no more than BLOCKS while blocks of WIDEST would do: every row is sent to every block."""
    return max(1, min(-(-rows // block_rows), max(BLOCKS, -(-rows // WIDEST))))


def nearest(df: DataFrame, k: int, id_col: str, vec_col: str, group_col: str | None = None, block_rows: int = 4096, places: int = 9) -> DataFrame:
    """(id, neighbor, rank, dist): the k nearest others of each row by cosine distance.

    Rows with a null id, or a null, zero or non-finite vector, have no neighbours;
    with group_col, rows of one group aren't neighbours. Distances are ordered to
    `places` decimals, ties by neighbour id. Rows are dealt into blocks by id;
    a task holds a block and its best neighbours so far, and all rows come by it
    in small pieces, each one bounded matrix product, of which only what may be
    nearer than the k-th so far is looked at again. So k rows a row leave it,
    but every row is sent to every block: the work is all pairs. Blocks grow with
    the table beyond BLOCKS of them, up to WIDEST rows. Where rows lie in clumps, `pruned` leaves pairs out.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = _rows(df, id_col, vec_col, group_col)
    count = _block_count(rows.count(), block_rows)
    block = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    left = rows.select("id", "vec", "grp", block.alias("i"), F.lit(0).alias("side"))
    right = rows.select("id", "vec", "grp", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("i"), F.lit(1).alias("side"))
    both = left.unionByName(right).repartitionById(count, "i").sortWithinPartitions("i", "side", "id")
    return both.mapInArrow(_streamed(k, places, bool(group_col)), f"id {kind}, neighbor {kind}, rank int, dist double")


def _placed(centers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                close = unit(batch.column("vec")) @ centers.value.T
                cell = np.argmax(close, axis=1)
                away = np.arccos(np.clip(close[np.arange(len(cell)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(away)], ["id", "vec", "grp", "cell", "away"])

    return run


def pruned(df: DataFrame, k: int, id_col: str, vec_col: str, group_col: str | None = None, cells: int = 64, first: int = 4, sample_rows: int = 20_000, block_rows: int = 4096, places: int = 9, report: dict | None = None) -> DataFrame:
    """The same as nearest, with pairs of cells left out that can't hold a neighbour.

    Rows lie in the cell of their nearest centroid (fitted on a bounded sample);
    a cell's radius is the greatest angle from its centroid. Each cell is compared
    with itself and the `first` next cells; the farthest k-th neighbour found is
    its reach. Another cell matters only if the angle between the centroids less
    both radii is within that reach. A task holds a block of rows of one cell, as
    in nearest, and the rows of all cells that matter come by it in small pieces,
    so k rows a row leave each of the two passes; in the second the k-th found in
    the first is a row's bound. Rows of one id, if there are such, share k
    neighbours. report gets how many pairs of blocks were compared, of how many.
    """
    kind = df.schema[id_col].dataType.simpleString()
    vector = df.schema[vec_col].dataType.simpleString()
    spark = df.sparkSession
    rows = _rows(df, id_col, vec_col, group_col)
    points = sampled(rows, sample_rows)
    if not len(points):
        return spark.createDataFrame([], f"id {kind}, neighbor {kind}, rank int, dist double")
    centers = centroids(points, cells)
    # Floats stay floats until they are compared: every row is sent many times.
    vector = vector if vector == "array<float>" else "array<double>"
    rows = rows.where(F.size("vec") == points.shape[1]).withColumn("vec", F.col("vec").cast(vector))
    placed = scratch(rows.mapInArrow(_placed(spark.sparkContext.broadcast(centers)), f"id {kind}, vec {vector}, grp string, cell int, away double"), "cells")
    told = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()}  # a row for each cell
    apart = np.arccos(np.clip(centers @ centers.T, -1, 1))
    total = sum(r["n"] for r in told.values())
    size = -(-total // _block_count(total, block_rows))
    blocks = {c: -(-r["n"] // size) for c, r in told.items()}

    def compared(asking: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
        """(id, neighbor, rank, dist): the k nearest of the rows of each cell a among those of all its cells b."""
        start, count = {}, 0
        for a in dict.fromkeys(a for a, _ in pairs):
            start[a], count = count, count + blocks[a]
        to: dict[int, list[int]] = {}
        for a, b in pairs:
            to.setdefault(b, []).extend(range(start[a], start[a] + blocks[a]))
        own = spark.createDataFrame([(a, at, blocks[a]) for a, at in start.items()], "cell int, at int, n int")
        sent = spark.createDataFrame(list(to.items()), "cell int, blocks array<int>")  # a row for each cell, both
        left = asking.join(F.broadcast(own), "cell").select("id", "vec", "grp", (F.col("at") + F.pmod(F.xxhash64("id"), "n")).cast("int").alias("i"), F.lit(0).alias("side"), "bound")
        right = placed.join(F.broadcast(sent), "cell").select("id", "vec", "grp", F.explode("blocks").alias("i"), F.lit(1).alias("side"), F.lit(None).cast("double").alias("bound"))
        both = left.unionByName(right).repartitionById(count, "i").sortWithinPartitions("i", "side", "id")
        return both.mapInArrow(_streamed(k, places, bool(group_col)), f"id {kind}, neighbor {kind}, rank int, dist double")

    near = [(a, b) for a in told for b in sorted(told, key=lambda b: (apart[a, b], b))[: first + 1]]
    found = scratch(compared(placed.withColumn("bound", F.lit(None).cast("double")), near), "near-cells")
    kth = placed.join(found.where(F.col("rank") == k).groupBy("id").agg(F.min("dist").alias("bound")), "id", "left")
    # A row with fewer than k so far reaches everywhere; distances are rounded.
    reach = {r["cell"]: r["reach"] for r in kth.groupBy("cell").agg(F.max(F.coalesce(F.col("bound"), F.lit(2.0))).alias("reach")).collect()}
    done = set(near)
    angle = lambda d: np.arccos(np.clip(1 - d - 2 * 10.0**-places, -1, 1)) + 1e-7
    more = [(a, b) for a in told for b in told if (a, b) not in done and apart[a, b] - told[a]["radius"] - told[b]["radius"] <= angle(reach[a])]
    if report is not None:
        count = lambda pairs: sum(blocks[a] * blocks[b] for a, b in pairs)
        report |= {"products": count(near) + count(more), "of": count([(a, b) for a in told for b in told])}
    return _ranked(found.unionByName(compared(kth, more)) if more else found, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(asked, expected, found, recall) of neighbours (id, neighbor) against the exact ones of the same ids."""
    hit = exact.select("id", "neighbor").join(found.select("id", "neighbor", F.lit(1).alias("hit")), ["id", "neighbor"], "left")
    return hit.agg(F.countDistinct("id").alias("asked"), F.count("*").alias("expected"), F.count("hit").alias("found"), F.round(F.count("hit") / F.count("*"), 4).alias("recall"))
