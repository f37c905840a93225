"""Ball k-means: clusters as balls whose members are compared with near balls only, in whole numbers.

A vector's components x become floor(scale * x), so every distance and every
centroid is a whole number and the result doesn't depend on how the rows are
dealt. Centroids begin as the rows of least hash of their id.

A cluster is a ball: its centroid and a radius that no member lies beyond. A
centroid can take a member of another ball only if half the distance between
the two centroids is at most the member's distance to its own (where it is
equal, both are equally near and the smaller number wins). So

* a ball's neighbours are the centroids within twice its radius;
* members nearer than half the way to the nearest neighbour are its stable
  core, and are compared with nothing;
* the rest lie in annuli: a member beyond half the way to m neighbours, nearest
  first, is compared exactly with these m only;
* a ball that stays where it was, and whose neighbours stay too, keeps its
  members without any distance being taken.

The radius that decides a ball's neighbours spans the cluster (greatest
distance at the last assignment, plus the way its centroid went since). Each
task takes its own members of a ball as a smaller ball.

A round reads the table that the last one wrote, and writes each row with its
cluster and distance; with them, in the same table, go the task's sums per
cluster. So a round is one pass without a shuffle of vectors, a lost task is
run again whole, and what is shuffled is k * dimensions sums a task. The driver
holds the k centroids and their distances, nothing that grows with rows.

Whole numbers below `narrow_limit` are compared by matrix products in doubles,
which are exact there; rows or centroids beyond go by Python's integers, of any size.

Nulls and odd rows: a null vector, or one with another number of components or
with null or non-finite ones, isn't kept; a null id is kept, its hash comes
last; ties on a distance go to the smaller number; repeated rows are rows of
their own (if one is a seed more than once, the later centroids stay empty and
stay where they are); fewer rows than k give as many centroids as rows; an
empty table gives an empty result. A distance or sum beyond a long is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import limbs
from docweave.storage import discard, scratch, ship, table

LONG = (1 << 63) - 1


def narrow_limit(size: int) -> int:
    """Below this, squared distances of `size` components are exact in doubles (2^22 for 64)."""
    return 1 << ((51 - (size - 1).bit_length()) // 2)


@dataclass(frozen=True)
class Balls:
    """k clusters of vectors of `size` components; `rounds` times centroids move; `salt` goes before an id that is hashed."""

    k: int = 40
    size: int = 64
    scale: int = 256
    rounds: int = 5
    salt: str = "2:"
    #: Rows compared together.
    block: int = 8192


@dataclass
class Clusters:
    """rows: (id, cluster, distance); centroids, counts and inertias by number (an inertia sums distances)."""

    rows: DataFrame
    centroids: list[list[int]]
    counts: list[int]
    inertias: list[int]


def kept(df: DataFrame, id_col: str, vec_col: str, params: Balls) -> DataFrame:
    """(id, vec array<double>) of the rows that can be clustered."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where((F.size("vec") == params.size) & sound)


def whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly."""
    return scale * int(x) if abs(x) >= 2**53 else math.floor(scale * x)


def seeds(rows: DataFrame, params: Balls) -> list[list[int]]:
    """The first centroids; k rows come to the driver."""
    name = F.sha2(F.concat(F.lit(params.salt), F.col("id").cast("string")), 256)
    first = rows.select(name.alias("name"), "vec").orderBy(F.asc_nulls_last("name"), "vec").limit(params.k).collect()
    return [[whole(x, params.scale) for x in r["vec"]] for r in first]


# ---- balls ------------------------------------------------------------------------


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b; exact in either kind of number."""
    if a.dtype == object:
        return np.array([[sum((p - q) ** 2 for p, q in zip(x, y, strict=True)) for y in b] for x in a], object).reshape(len(a), len(b))
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


@dataclass
class Model:
    """Centroids with, for each ball, its neighbours by distance; `still`: balls whose members need no look."""

    centers: np.ndarray
    neighbours: list[np.ndarray]
    quarters: list[np.ndarray]
    still: np.ndarray


def model(centers: list[list[int]], radii: list[int] | None = None, moved: list[bool] | None = None) -> Model:
    """radii: whole numbers that no member of a ball is beyond, None where nothing is known."""
    limit = narrow_limit(len(centers[0]))
    narrow = all(abs(v) < limit for c in centers for v in c)
    at = np.array(centers, np.float64 if narrow else object).reshape(len(centers), -1)
    apart = _squares(at, at)
    near, quarters, still = [], [], []
    for i in range(len(centers)):
        order = [j for j in np.argsort(apart[i], kind="stable").tolist() if j != i]
        if radii is not None and radii[i] < LONG:  # a greater one is cut to that
            order = [j for j in order if int(apart[i, j]) <= 4 * radii[i] ** 2]
        near.append(np.array(order, np.int64))
        quarters.append(apart[i, near[-1]])
        still.append(moved is not None and not moved[i] and not any(moved[j] for j in order))
    return Model(at, near, quarters, np.array(still, bool))


def assign(points: np.ndarray, was: np.ndarray, held: np.ndarray, known: np.ndarray, balls: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, distances taken) of points whose clusters were `was`, with distances `held` where `known`."""
    cluster, dist, taken = was.copy(), held.astype(points.dtype), 0
    order = np.argsort(was, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(was[order])) + 1):
        if not len(group):
            continue
        i = int(was[group[0]])
        if balls.still[i] and known[group].all():
            continue
        members = points[group]
        own = _squares(members, balls.centers[i : i + 1])[:, 0]
        taken += len(group)
        best, which = own.copy(), np.full(len(group), i, was.dtype)
        # Annuli: how many neighbours are within twice a member's distance.
        reach = np.searchsorted(balls.quarters[i], 4 * own, side="right")
        outer = np.argsort(-reach, kind="stable")
        sorted_reach = -reach[outer]
        for m, j in enumerate(balls.neighbours[i].tolist()):
            some = outer[: int(np.searchsorted(sorted_reach, -m, side="left"))]
            if not len(some):
                break
            d = _squares(members[some], balls.centers[j : j + 1])[:, 0]
            taken += len(some)
            nearer = (d < best[some]) | ((d == best[some]) & (j < which[some]))
            best[some[nearer]], which[some[nearer]] = d[nearer], j
        cluster[group], dist[group] = which, best
    return cluster, dist, taken


# ---- rounds -----------------------------------------------------------------------

SUMS = "struct<cluster:int,n:long,radius:long,taken:long,sums:array<array<long>>>"
SUMS_ARROW = pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("radius", pa.int64()), ("taken", pa.int64()), ("sums", pa.list_(pa.list_(pa.int64())))])
ROW = "id {kind}, vec array<double>, cluster int, distance long, part " + SUMS


def _whole_points(vecs: np.ndarray, scale: int, narrow: bool) -> np.ndarray:
    if narrow:
        return np.floor(scale * vecs)
    return np.array([[whole(x, scale) for x in row] for row in vecs.tolist()], object).reshape(len(vecs), -1)


def _summed(dist: np.ndarray) -> int:
    """Distances added up exactly: their sum may be beyond what a double holds though each is within."""
    if dist.dtype == object:
        return int(dist.sum())
    whole_ = dist.astype(np.int64)
    return (int((whole_ >> 26).sum()) << 26) + int((whole_ & ((1 << 26) - 1)).sum())


class _Sums:
    """A task's sums of each cluster: components, then distances."""

    def __init__(self, k: int, size: int):
        self.sums = [[0] * (size + 1) for _ in range(k)]
        self.n, self.far, self.taken = [0] * k, [0] * k, 0

    def add(self, points: np.ndarray, cluster: np.ndarray, dist: np.ndarray) -> None:
        for i in np.unique(cluster).tolist():
            mine = cluster == i
            total = [*points[mine].sum(axis=0).tolist(), _summed(dist[mine])]
            self.sums[i] = [a + int(b) for a, b in zip(self.sums[i], total, strict=True)]
            self.n[i] += int(mine.sum())
            self.far[i] = max(self.far[i], int(dist[mine].max()))

    def rows(self) -> list[dict]:
        # The whole root, one more than its floor, is never below the distance.
        some = [i for i, n in enumerate(self.n) if n]
        return [{"cluster": i, "n": self.n[i], "radius": min(LONG, math.isqrt(self.far[i]) + 1), "taken": self.taken if i == some[0] else 0, "sums": limbs.split(self.sums[i])} for i in some]


def _round(balls, params: Balls):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, shape = balls.value, None
        sums, limit = _Sums(len(found.centers), params.size), narrow_limit(params.size)
        for batch in batches:
            shape = batch.schema
            for at in range(0, len(batch), params.block):
                rows = batch.slice(at, params.block)
                vecs = np.asarray(rows.column(1).flatten(), np.float64).reshape(len(rows), -1)
                was = np.asarray(rows.column(2).fill_null(0), np.int32)
                held, known = np.asarray(rows.column(3).fill_null(0), np.int64), np.asarray(rows.column(3).is_valid())
                fits = (np.abs(vecs) < (limit - 1) / params.scale).all(axis=1) & (found.centers.dtype != object)
                cluster, dist = was.copy(), [None] * len(rows)
                for narrow in (True, False):
                    some = np.flatnonzero(fits == narrow)
                    if not len(some):
                        continue
                    points = _whole_points(vecs[some], params.scale, narrow)
                    one = found if narrow or found.centers.dtype == object else _as_objects(found)
                    cluster[some], d, taken = assign(points, was[some], held[some] if narrow else held[some].astype(object), known[some] & narrow, one)
                    sums.add(points, cluster[some], d)
                    sums.taken += taken
                    for r, x in zip(some.tolist(), d.tolist(), strict=True):
                        dist[r] = int(x) if x <= LONG else None
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(cluster, pa.int32()), pa.array(dist, pa.int64()), pa.nulls(len(rows), SUMS_ARROW)], ["id", "vec", "cluster", "distance", "part"])
        parts = sums.rows()
        if parts:
            none = [pa.nulls(len(parts), t) for t in (shape.field(0).type, shape.field(1).type, pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(parts, SUMS_ARROW)], ["id", "vec", "cluster", "distance", "part"])

    return run


def _as_objects(balls: Model) -> Model:
    exact = lambda a: np.array([[int(x) for x in r] for r in a.tolist()], object).reshape(a.shape)
    return Model(exact(balls.centers), balls.neighbours, [np.array([int(x) for x in q.tolist()], object) for q in balls.quarters], np.zeros(len(balls.still), bool))


def _collected(state: DataFrame, k: int, size: int) -> tuple[list[list[int]], list[int], list[int], int]:
    """(sums, counts, radii, distances taken) of all clusters; k * dimensions rows come to the driver."""
    parts = state.where("part IS NOT NULL").select("part.*")
    sums, counts, radii = [[0] * (size + 1) for _ in range(k)], [0] * k, [0] * k
    for r in limbs.totals(parts, ["cluster"], "sums").collect():
        sums[r["cluster"]][r["dim"]] += limbs.join([(r["limb"], r["value"])])
    taken = 0
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("taken").alias("taken")).collect():
        counts[r["cluster"]], radii[r["cluster"]] = r["n"], r["radius"]
        taken += r["taken"]
    return sums, counts, radii, taken


def ball_kmeans(df: DataFrame, id_col: str, vec_col: str, params: Balls = Balls(), log: list[int] | None = None) -> Clusters:
    """Clusters after `rounds` moves of the centroids and a last assignment; log takes the distances taken by each."""
    spark = df.sparkSession
    ship(spark)
    rows = kept(df, id_col, vec_col, params)
    kind = rows.schema["id"].dataType.simpleString()
    shape = ROW.format(kind=kind)
    centers = seeds(rows, params)
    if not centers:
        return Clusters(spark.createDataFrame([], f"id {kind}, cluster int, distance long"), [], [], [])
    state = rows.select("id", "vec", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    balls, before = model(centers), None
    for turn in range(params.rounds + 1):
        now = scratch(state.mapInArrow(_round(spark.sparkContext.broadcast(balls), params), shape), f"balls-{turn}")
        sums, counts, radii, taken = _collected(now, len(centers), params.size)
        if log is not None:
            log.append(taken)
        if before is not None:
            discard(before)
        before, state = now, now.where("part IS NULL").drop("part")
        if turn == params.rounds:
            break
        after = [[s // n for s in total[:-1]] if n else c for total, n, c in zip(sums, counts, centers, strict=True)]
        moved = [a != c for a, c in zip(after, centers, strict=True)]
        if not any(moved):
            break  # the same centroids give the same clusters in all rounds to come
        went = [math.isqrt(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))) + 1 if m else 0 for x, y, m in zip(after, centers, moved, strict=True)]
        centers, balls = after, model(after, [r + w for r, w in zip(radii, went, strict=True)], moved)
    return Clusters(state.select("id", "cluster", "distance"), centers, counts, [s[-1] for s in sums])


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster and distance, with sums over its cluster and all, and its centroid's digest."""
    found = ball_kmeans(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    fits = lambda x: x if x <= LONG else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    told = [(i, fits(s), fits(sum(found.inertias)), d) for i, (s, d) in enumerate(zip(found.inertias, digest, strict=True))]
    clusters = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows.
    return found.rows.join(F.broadcast(clusters), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
