import random

import pytest

from docweave.operators import communities as co


def graph(seed, blocks=4, size=9, inside=0.6, across=0.05):
    rng = random.Random(seed)
    n = blocks * size
    return [(u, v, round(rng.uniform(0.2, 1), 3)) for u in range(n) for v in range(u + 1, n) if rng.random() < (inside if u // size == v // size else across)]


def quality(edges, label, resolution=1.0):
    total = 2 * sum(w for _, _, w in edges)
    strength = {}
    for u, v, w in edges:
        strength[u] = strength.get(u, 0) + w
        strength[v] = strength.get(v, 0) + w
    held = {}
    for u, k in strength.items():
        held[label[u]] = held.get(label[u], 0) + k
    return (2 * sum(w for u, v, w in edges if label[u] == label[v]) - resolution * sum(k * k for k in held.values()) / total) / total


def check(edges, label):
    """Communities hang together, and no single move gains."""
    near = {}
    for u, v, w in edges:
        near.setdefault(u, {})[v] = w
        near.setdefault(v, {})[u] = w
    assert set(label) == set(near)
    for c in set(label.values()):
        mine = {u for u in label if label[u] == c}
        seen, todo = set(), [min(mine)]
        while todo:
            u = todo.pop()
            if u not in seen:
                seen.add(u)
                todo += [v for v in near[u] if v in mine]
        assert seen == mine
    best = quality(edges, label)
    for u in label:
        for c in {label[v] for v in near[u]} | {"alone"}:
            assert quality(edges, label | {u: c}) <= best + 1e-9


def labels(spark, edges, group_edges):
    df = spark.createDataFrame(edges, "src long, dst long, weight double").repartition(3)
    return {m: r.community for r in co.communities(df, min_size=1, group_edges=group_edges).collect() for m in r.members}


@pytest.mark.parametrize("seed", range(25))
def test_one_task(seed):
    edges = graph(seed, 3 + seed % 3, 5 + seed % 6, 0.5, 0.1)
    names = sorted({x for e in edges for x in e[:2]})
    at = {x: i for i, x in enumerate(names)}
    g = co._Graph.of({(at[u], at[v]): w for u, v, w in edges}, [0.0] * len(names))
    found = co.leiden(g, 1 / (2 * sum(w for _, _, w in edges)), 20)
    check(edges, dict(zip(names, found, strict=True)))


def test_rounds_keep_the_invariants(spark):
    edges = graph(3, 3, 6, 0.7, 0.08) + [(100, 101, 0.5)]
    in_rounds, in_tasks = labels(spark, edges, 0), labels(spark, edges, 10**6)
    check(edges, in_rounds)
    check(edges, in_tasks)
    assert quality(edges, in_rounds) > 0.9 * quality(edges, in_tasks) > 0


def test_planted_blocks_are_found(spark):
    edges = graph(1, 5, 8, 0.9, 0.01)
    found = labels(spark, edges, 10**6)
    assert all(len({found[u] for u in found if u // 8 == b}) == 1 for b in range(5)) and len(set(found.values())) == 5


def test_odd_edges(spark):
    rows = [(1, 2, None), (1, 3, float("nan")), (2, 2, 1.0), (4, 5, 0.0001)]
    assert labels(spark, rows, 10**6) == {}
    assert labels(spark, [*rows, (1, 2, 0.5), (2, 1, 0.25)], 10**6) == {1: 1, 2: 1}


def test_a_community_gives_many_nodes_in_a_round(spark):
    rows = [(u, 1.0, 0, u, 0.5) for u in range(1, 51)]
    wishes = spark.createDataFrame(rows, "u long, k double, c long, d long, gain double")
    assert {(r.u, r.d) for r in co._granted(wishes, 0.001, 0, 1000).collect()} == {(u, u) for u in range(1, 51)}
    # Those that would no longer gain with all before them stay: 0.5 > 0.1 * (leavers before).
    assert {r.u for r in co._granted(wishes, 0.1, 0, 1000).collect()} == {1, 2, 3, 4, 5}


def test_merged_levels_end_in_one_task(spark, monkeypatch):
    edges = graph(5, 4, 8, 0.7, 0.05)
    levels, finished = [], co._finished
    monkeypatch.setattr(co, "_finished", lambda level, *a: levels.append(level.nodes.count()) or finished(level, *a))
    in_rounds, in_tasks = labels(spark, edges, len(edges) - 1), labels(spark, edges, 10**6)
    assert levels and max(levels) < 32
    check(edges, in_rounds)
    assert quality(edges, in_rounds) > 0.95 * quality(edges, in_tasks) > 0
