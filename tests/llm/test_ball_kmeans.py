import hashlib
import math
import random

import numpy as np
import pytest

from docweave.llm import ball_kmeans as bk
from docweave.llm import limbs

SCHEMA = "id long, v array<double>, cluster string, part int"


def lloyd(rows, params):
    """Brute force: {(id, vector): [(cluster, distance)]} and centroids."""
    kept = [(i, tuple(bk.whole(x, params.scale) for x in v)) for i, v in rows if v is not None and len(v) == params.size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{params.salt}{i}".encode()).hexdigest()
    order = sorted((i is None, name(i) if i is not None else "", v) for i, v in kept)
    centers = [v for _, _, v in order[: params.k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((square(v, c), j) for j, c in enumerate(centers))
    for _ in range(params.rounds):
        got = [nearest(v)[1] for _, v in kept]
        for j in range(len(centers)):
            mine = [v for (_, v), g in zip(kept, got, strict=True) if g == j]
            if mine:
                centers[j] = tuple(sum(c) // len(mine) for c in zip(*mine, strict=True))
    return sorted(((i, *nearest(v)[::-1]) for i, v in kept), key=repr), [list(c) for c in centers]


def check(spark, rows, params, parts=3):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(parts)
    got = bk.ball_kmeans(df, "id", "v", params)
    want, centers = lloyd(rows, params)
    assert sorted(((r.id, r.cluster, r.distance) for r in got.rows.collect()), key=repr) == [(i, c, d if d <= bk.LONG else None) for i, c, d in want]
    assert got.centroids == centers
    assert sum(got.counts) == len(want) and sum(got.inertias) == sum(d for _, _, d in want)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(5)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(middles)]) for i in range(300)]
    check(spark, rows, bk.Balls(k=8, size=5, rounds=4, block=37))


def test_ties_copies_and_equal_seeds(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 40), [float(rng.randint(-1, 1)) / 256 * rng.choice([1, 2]) for _ in range(2)]) for _ in range(200)]
    check(spark, rows, bk.Balls(k=9, size=2, rounds=3))
    check(spark, [(7, [0.5, 0.5])] * 20, bk.Balls(k=4, size=2, rounds=3))


def test_one_crowded_vector_and_odd_rows(spark):
    rng = random.Random(6)
    rows = [(i, [0.25, -0.125, 0.5]) for i in range(150)] + [(1000 + i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(80)]
    rows += [(1, None), (2, []), (3, [1.0]), (4, [1.0, None, 0.0]), (5, [math.nan, 0.0, 0.0]), (6, [math.inf, 0.0, 0.0]), (None, [0.1, 0.2, 0.3]), (9, [1.0, 2.0, 3.0, 4.0])]
    check(spark, rows, bk.Balls(k=5, size=3, rounds=3))


def test_values_of_any_size_are_exact(spark):
    rng = random.Random(7)
    sizes = (1.0, 1e5, 1e9, 1e30, 1e300)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice(sizes) for _ in range(3)]) for i in range(60)] + [(100 + i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    check(spark, rows, bk.Balls(k=6, size=3, rounds=3))


def test_sums_of_great_distances_are_exact(spark):
    rng = random.Random(10)
    far = bk.narrow_limit(2) // 4
    rows = [(i, [float(rng.choice([-1, 1]) * (far - rng.randint(0, 999))), float(rng.randint(-far, far))]) for i in range(400)]
    check(spark, rows, bk.Balls(k=3, size=2, scale=1, rounds=2))
    assert bk._summed(np.full(5000, float((1 << 52) + 1))) == 5000 * ((1 << 52) + 1)


def test_fewer_rows_than_clusters_and_none(spark):
    check(spark, [(1, [0.1, 0.2]), (2, [0.3, 0.1])], bk.Balls(k=5, size=2))
    empty = bk.ball_kmeans(spark.createDataFrame([], SCHEMA), "id", "v", bk.Balls(k=5, size=2))
    assert empty.rows.collect() == [] and empty.centroids == []


def test_balls_spare_distances(spark):
    """Clusters far apart: after the first round only few distances are taken, and none where nothing moves."""
    rng = random.Random(8)
    rows = [(i, [10.0 * (i % 10) + rng.uniform(0, 0.5), 10.0 * (i % 7) + rng.uniform(0, 0.5)]) for i in range(700)]
    log = []
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    bk.ball_kmeans(df, "id", "v", bk.Balls(k=70, size=2, rounds=8), log)
    assert min(log[1:]) < 0.1 * 700 * 70
    centers = [[0, 0], [100, 0], [1000, 0]]
    still = bk.model(centers, [20, 20, 20], [False, False, True])
    assert still.still.tolist() == [True, True, False] and [len(n) for n in still.neighbours] == [0, 0, 0]
    at = np.array([[1.0, 2.0], [99.0, 0.0]])
    cluster, dist, taken = bk.assign(at, np.array([0, 1], np.int32), np.array([5, 1]), np.array([True, True]), still)
    assert (cluster.tolist(), dist.tolist(), taken) == ([0, 1], [5.0, 1.0], 0)


def test_equal_distance_across_a_boundary_goes_to_the_smaller_number():
    balls = bk.model([[10, 0], [0, 0]])
    cluster, dist, _ = bk.assign(np.array([[5.0, 0.0]]), np.array([1], np.int32), np.zeros(1), np.zeros(1, bool), balls)
    assert (cluster.tolist(), dist.tolist()) == ([0], [25.0])


def test_limbs_add_up():
    rng = random.Random(9)
    values = [rng.randint(-(10**k), 10**k) for k in range(0, 60, 3)]
    total = {}
    for limb in limbs.split(values):
        for place, v in enumerate(limb):
            total[place] = total.get(place, 0) + v
    assert limbs.join(total.items()) == sum(values)
