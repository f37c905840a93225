import random
from pathlib import Path

import numpy as np

from docweave.operators import communities, graph, knn, merging
from docweave.operators.components import connected_components
from docweave.operators.relational import neighbours, round_robin, upsert
from pyspark.sql import functions as F


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7), (999, 999)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame([*edges, (None, 3)], "src long, dst long")
    assert {r.node: r.component for r in connected_components(df).collect()} == {x: find(x) for x in parent} | ({} if 3 in parent else {3: 3})


def test_components_leave_few_part_files(spark):
    where = Path(spark.conf.get("spark.checkpoint.dir"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        before = set(where.rglob("part-*"))
        found = connected_components(spark.createDataFrame([(i, i + 1) for i in range(600)], "src long, dst long"))
        assert len(set(where.rglob("part-*")) - before) <= 8
        assert found.where("component = 0").count() == 601
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def roots(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, kind string, p double")
    return {r.id: r.root for r in merging.guarded_union_find(df).collect()}


def test_union_find_guard(spark):
    found = roots(spark, [("a", "b", "same", 0.9), ("b", "c", "same", 0.8), ("a", "c", "different", 0.9)])
    assert found == {"a": "a", "b": "a", "c": "c"}


def test_union_find_keeps_existing_roots(spark):
    found = roots(spark, [("c", "b", "existing", None), ("x", "a", "same", 0.9), ("x", "b", "same", 0.8), ("a", "a2", "identical", None), ("a2", "a", "existing", None)])
    assert found["c"] == found["b"] == "b" and found["x"] == found["a"] == found["a2"] == "a"


def test_two_cliques(spark):
    nodes = [[0, 1, 2, 3], [4, 5, 6, 7]]
    rows = [(a, b, 0.9) for c in nodes for a in c for b in c if a < b] + [(3, 4, 0.1), (0, 7, None), (1, 6, float("nan")), (2, 5, 0.0001)]
    got = sorted(sorted(r.members) for r in communities.communities(spark.createDataFrame(rows, "src long, dst long, weight double")).collect())
    assert got == nodes


def test_nearest_against_numpy_with_ties_groups_and_zero(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8)).round(3)
    vectors = [base[i % 12] for i in range(60)] + list(rng.normal(size=(40, 8))) + [np.zeros(8)]
    rows = [(i, [float(x) for x in v], i % 5) for i, v in enumerate(vectors)] + [(200, None, 1)]
    df = spark.createDataFrame(rows, "id long, v array<double>, g int")
    for group in (None, "g"):
        for block in (7, 4096):
            got = {(r.id, r.rank): r.neighbor for r in knn.nearest(df, 4, "id", "v", group, block_rows=block).collect()}
            want = {}
            for i, v in enumerate(vectors[:-1]):
                others = sorted((round(1 - float(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), 9), j) for j, w in enumerate(vectors[:-1]) if j != i and (group is None or j % 5 != i % 5))
                want |= {(i, n + 1): j for n, (_, j) in enumerate(others[:4])}
            assert got == want


def test_neighbours_count_a_self_loop_once(spark):
    e = spark.createDataFrame([("e1", 1, 2, 0.5), ("e2", 3, 1, None), ("e3", 1, 1, 0.4)], "edge_id string, src long, dst long, weight double")
    got = [(r.edge_id, r.neighbour) for r in neighbours(e, spark.createDataFrame([(1,)], "id long"), 5).orderBy("rank").collect()]
    assert got == [("e1", 2), ("e3", 1), ("e2", 3)]


def test_round_robin_takes_evenly(spark):
    df = spark.createDataFrame([(k, i) for k in "abc" for i in range(50)], "k string, i long")
    got = round_robin(df, ["k"], 9, F.col("i")).groupBy("k").count().collect()
    assert sorted((r.k, r["count"]) for r in got) == [("a", 3), ("b", 3), ("c", 3)]


def test_upsert_last_row_wins_and_update_lists(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, s string, n long")
    new = spark.createDataFrame([(2, "x", 9, 1), (2, "y", 8, 2), (3, "z", 7, 3)], "k long, s string, n long, seq long")
    get = lambda **kw: sorted(tuple(r) for r in upsert(old, new, ["k"], F.col("seq"), **kw).collect())
    assert get() == [(1, "a", 1), (2, "y", 8), (3, "z", 7)]
    assert get(update=[]) == [(1, "a", 1), (2, "b", 2), (3, "z", 7)]
    assert get(update=["s"]) == [(1, "a", 1), (2, "y", 2), (3, "z", 7)]


def test_passages_skip_what_is_too_large(spark):
    df = spark.createDataFrame([("q", 1, 1, 10, 40), ("q", 1, 2, 11, 90), ("q", 2, 1, 12, 50)], "q string, doc_id long, ord long, id long, tokens long")
    assert sorted((r.id, r.passage) for r in graph.passages(df, "q", 100).collect()) == [(10, "p1"), (12, "p2")]
