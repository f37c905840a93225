import math
import tracemalloc
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from docweave.operators import knn
from docweave.operators.vector_index import Coding, VectorIndex


def brute(rows, k, group=False):
    """{(id, neighbor, rank): dist} over all pairs."""
    kept = [(i, np.array(v) / np.linalg.norm(v), g) for i, v, g in rows if i is not None and v is not None and any(v) and all(map(math.isfinite, v))]
    out = []
    for i, v, g in kept:
        near = sorted((round(1 - float(v @ w), 9), j) for j, w, h in kept if j != i and not (group and g == h))[:k]
        out += [(i, j, n, d) for n, (d, j) in enumerate(near, 1)]
    return sorted(out)


def clumps(n, size, middles, spread, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(middles, size))
    return [(i, (m[i % middles] + spread * rng.normal(size=size)).tolist(), int(i % 3)) for i in range(n)]


def got(df):
    return sorted((r.id, r.neighbor, r["rank"], r.dist) for r in df.collect())


def same(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b] and all(abs(x[3] - y[3]) <= 1.1e-9 for x, y in zip(a, b, strict=True))


ODD = [(9001, None, 0), (9002, [0.0] * 8, 0), (9003, [math.nan] + [1.0] * 7, 0), (None, [1.0] * 8, 0)]
SCHEMA = "id long, v array<double>, grp int"


@pytest.mark.parametrize("group", [False, True])
def test_exact_forms_equal_all_pairs(spark, group):
    rows = clumps(150, 8, 6, 0.4) + [(500 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], i % 3) for i in range(60)] + ODD  # a crowd of copies: ties at every rank
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows, 5, group)
    same(got(knn.nearest(df, 5, "id", "v", "grp" if group else None, block_rows=40)), want)
    same(got(knn.pruned(df, 5, "id", "v", "grp" if group else None, cells=7, first=1, block_rows=25)), want)


def test_shortlist_widens_until_proven(spark):
    """Neighbours closer than single precision can tell apart."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 1e-5 * float(rng.normal()), 1e-5 * float(rng.normal())], 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = [(i, np.array(v) / np.linalg.norm(v)) for i, v, _ in rows]
    a = np.array([v for _, v in kept])
    r, c, d = knn._shortlisted(a, a, np.eye(200, dtype=bool), 4, 15)
    want = np.round(1 - np.einsum("id,jd->ij", a, a), 15)
    np.fill_diagonal(want, np.inf)
    assert np.array_equal(d.reshape(200, 4)[np.argsort(r.reshape(200, 4)[:, 0])], np.sort(want, axis=1)[:, :4])
    assert knn.nearest(df, 4, "id", "v").count() == 800 and len(c) == 800


def test_far_cells_are_left_out(spark):
    rows = clumps(600, 16, 12, 0.02)
    df = spark.createDataFrame(rows, SCHEMA)
    report = {}
    found = got(knn.pruned(df, 6, "id", "v", cells=12, first=1, report=report))
    same(found, got(knn.nearest(df, 6, "id", "v")))
    assert report["products"] <= 3 * 12 and report["of"] == 144


def index(spark, rows, tmp_path, **coding):
    return VectorIndex.build(spark.createDataFrame(rows, SCHEMA), "id", "v", str(tmp_path / uuid.uuid4().hex), Coding(**coding))


def test_proven_search_equals_all_pairs(spark, tmp_path):
    rows = clumps(240, 8, 5, 0.5, 4) + [(700 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], 0) for i in range(50)] + ODD
    found = index(spark, rows, tmp_path, cells=6, words=16, asked_block=20, coded_block=64)
    asked = [r for r in rows if r[0] is None or r[0] % 7 == 0]
    want = [w for w in brute(rows, 6) if w[0] % 7 == 0]
    same(got(found.search(spark.createDataFrame(asked, SCHEMA), "id", "v", 6, prove=True)), want)


def test_recall_at_few_rows(spark, tmp_path):
    """Nothing but noise, and clumps: nine tenths of the neighbours with a quarter of the vectors compared at most, and in clumps a quarter of the codes."""
    rng = np.random.default_rng(5)
    noise = [(i, rng.normal(size=32).tolist(), 0) for i in range(1500)]
    for rows, probes in ((noise, None), (clumps(1500, 32, 30, 0.15), 6)):
        found = index(spark, rows, tmp_path, cells=30)
        asked = spark.createDataFrame(rows[::30], SCHEMA)
        report = {}
        ours = got(found.search(asked, "id", "v", 10, probes, report=report))
        exact = {(i, j) for i, j, _, _ in brute(rows, 10) if i % 30 == 0}
        assert len({x[:2] for x in ours} & exact) >= 0.9 * len(exact)
        assert report["compared"] <= 0.25 and (probes is None or report["coded"] <= 0.25)


def test_index_of_odd_tables(spark, tmp_path):
    empty = index(spark, [], tmp_path)
    assert empty.search(spark.createDataFrame([(1, [1.0, 0.0], 0)], SCHEMA), "id", "v", 3).collect() == []
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0), (3, [1.0, 0.1], 0), (4, [1.0, 0.0, 0.0], 0)]
    found = index(spark, rows, tmp_path)
    ours = got(found.search(spark.createDataFrame(rows, SCHEMA), "id", "v", 9))
    assert [(a, b) for a, b, _, _ in ours] == [(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)]
    with pytest.raises(ValueError):
        index(spark, [(1, [1.0, 2.0, 3.0], 0)], tmp_path)


@pytest.mark.parametrize("copies", [False, True])
def test_a_block_is_compared_in_little_memory(copies):
    """A block of 4096 rows against 12,000, at one time a crowd of copies near the rest: what is held at once stays small."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(12_000, 64))
    if copies:
        v[3000:9000] = v[0]
    peer = [(i, v[i].tolist(), "g", 0, side) for side, n in ((0, 4096), (1, 12_000)) for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*peer, strict=True), [pa.int64(), pa.list_(pa.float64()), pa.string(), pa.int32(), pa.int32()], strict=True)], ["id", "vec", "grp", "i", "side"])
    tracemalloc.start()
    try:
        found = pa.Table.from_batches(knn._streamed(6, 9, False)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100e6
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for i in (0, 7, 3500, 4095):
        want = sorted((round(1 - float(unit[i] @ w), 9), j) for j, w in enumerate(unit) if j != i)[:6]
        assert [j for _, j in want] == [r["neighbor"] for r in found.filter(pa.compute.equal(found["id"], i)).to_pylist()]


def test_blocks_grow_with_the_table():
    """Every row is sent to every block, so their number is bounded until a block is at its widest."""
    assert [knn._block_count(n, 4096) for n in (0, 4096, 100_000, 600_000, 10_000_000)] == [1, 1, 25, 48, 306]


def test_few_rows_leave_the_comparison_of_cells(spark, monkeypatch):
    """k rows a row and pass, however many pairs of blocks there are, from noise that no cell can be left out in; floats are sent as such."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist(), i % 3) for i in range(300)]
    ranked, made = knn._ranked, []
    monkeypatch.setattr(knn, "_ranked", lambda best, k: made.append(best.count()) or ranked(best, k))
    report = {}
    found = got(knn.pruned(spark.createDataFrame(rows, "id long, v array<float>, grp int"), 5, "id", "v", "grp", cells=6, first=2, block_rows=20, report=report))
    same(found, brute(rows, 5, True))
    assert report["products"] == report["of"] >= 200 and max(made) <= 2 * 5 * len(rows)


@pytest.mark.parametrize("groups", [False, True])
def test_a_bound_leaves_out_what_is_farther(groups):
    """What lies at a row's bound is found, since its id may win; a row without a bound finds its k nearest."""
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=6), str(i % 4)) for i in range(90)]
    rows[40:48] = [(i, rows[0][1], str(i % 4)) for i in range(40, 48)]
    want = brute(rows, 4, groups)
    kth = {i: d for i, _, rank, d in want if rank == 3 and i % 5}
    peer = [(i, v.tolist(), g, 0, side, kth.get(i) if side == 0 else None) for side, some in ((0, rows[:41]), (1, rows)) for i, v, g in some]
    columns = zip(zip(*peer, strict=True), [pa.int64(), pa.list_(pa.float64()), pa.string(), pa.int32(), pa.int32(), pa.float64()], strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["id", "vec", "grp", "i", "side", "bound"])
    found = sorted(tuple(r.values()) for b in knn._streamed(4, 9, groups, 16)(iter([batch])) for r in b.to_pylist())
    same(found, [w for w in want if w[0] < 41 and w[3] <= kth.get(w[0], 2)])


def test_places_of_any_number_of_columns():
    rng = np.random.default_rng(11)
    for shape in ((0, 5), (1, 3), (7, 9), (16, 64)):
        for share in (0, 0.05, 1):
            hit = rng.random(shape) < share
            assert np.array_equal(knn._places(hit), np.flatnonzero(hit))
