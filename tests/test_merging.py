import random

import pytest

from docweave.operators import merging


def union_find(rows):
    """The rule edge by edge: roots and refusals."""
    nodes = {x for r in rows for x in r[:2]}
    of = {x: x for x in nodes}
    name = {}

    def whole(c):
        return [x for x in nodes if of[x] == c]

    for a, b, kind, _ in sorted((r for r in rows if r[2] == "existing"), key=lambda r: (r[1], r[0])):
        old = of[a]
        for x in whole(old):
            of[x] = of[b]
        name.pop(old, None)
        name[of[b]] = b
    apart = {frozenset(r[:2]) for r in rows if r[2] == "different"}
    held = sorted((-(2.0 if k == "identical" else 1.0 if p is None else p), a, b) for a, b, k, p in rows if k in ("identical", "same"))
    refused = []
    for _, a, b in held:
        x, y = of[a], of[b]
        if x == y:
            continue
        if any(frozenset((u, v)) in apart for u in whole(x) for v in whole(y)):
            refused.append((a, b, merging.JUDGED_DIFFERENT))
        elif x in name and y in name:
            refused.append((a, b, merging.JOINS_EXISTING))
        else:
            keep, drop = (x, y) if x in name else (y, x)
            for v in whole(drop):
                of[v] = keep
    return {x: name.get(of[x], min(whole(of[x]))) for x in nodes}, sorted(refused)


@pytest.mark.parametrize(("seed", "limit"), [(2, 1000), (3, 1000), (2, 40)])
def test_rounds_equal_the_rule_edge_by_edge(spark, seed, limit):
    rng = random.Random(seed)
    n = 36
    rows = []
    for _ in range(80):
        a, b = rng.sample(range(n), 2)
        rows.append((a, b, rng.choice(["same"] * 6 + ["identical", "different"]), rng.choice([None, 0.5, round(rng.random(), 2)])))
    rows += [(a, 30 + a % 3, "existing", None) for a in (1, 4, 7)] + rows[:5]
    df = spark.createDataFrame(rows, "a long, b long, kind string, p double").repartition(3)
    roots, refused = merging.resolved(df, limit)
    want, refusals = union_find(rows)
    assert {r.id: r.root for r in roots.collect()} == want
    assert sorted((r.a, r.b, r.reason) for r in refused.collect()) == refusals


def test_a_long_path_with_one_conflict(spark):
    """Strengths fall along the path: the conflict is found by halves, no group holds the path."""
    n = 600
    rows = [(i, i + 1, "same", 1 - i / n) for i in range(n)] + [(n // 3, 2 * n // 3, "different", None)]
    roots, refused = merging.resolved(spark.createDataFrame(rows, "a long, b long, kind string, p double"), 320)
    assert [(r.a, r.b) for r in refused.collect()] == [(2 * n // 3 - 1, 2 * n // 3)]
    assert {r.root: r["count"] for r in roots.groupBy("root").count().collect()} == {0: 2 * n // 3, 2 * n // 3: n + 1 - 2 * n // 3}


def test_nulls_and_none(spark):
    schema = "a long, b long, kind string, p double"
    rows = [(1, None, "same", 0.5), (None, 2, "same", 0.5), (3, 3, "same", 0.5), (4, 5, "same", float("nan")), (6, 7, "other", 0.1)]
    roots, refused = merging.resolved(spark.createDataFrame(rows, schema))
    assert {r.id: r.root for r in roots.collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7} and refused.count() == 0
    roots, refused = merging.resolved(spark.createDataFrame([], schema))
    assert roots.count() == 0 and refused.count() == 0


def keep_lowest(pairs):
    gone = {}
    for a, b in sorted({(min(p), max(p)) for p in pairs if p[0] != p[1]}):
        if a not in gone and b not in gone:
            gone[b] = a
    return gone


@pytest.mark.parametrize("limit", [6, 1000])
def test_keep_lowest_equals_the_rule_pair_by_pair(spark, limit):
    rng = random.Random(limit)
    pairs = [(rng.randrange(150), rng.randrange(150)) for _ in range(260)] + [(200 + i, 201 + i) for i in range(40)]
    df = spark.createDataFrame([*pairs, (None, 1), (5, 5)], "a long, b long")
    assert {r.dropped: r.kept for r in merging.greedy_dedup(df, limit).collect()} == keep_lowest(pairs)


def test_a_path_and_a_star_without_one_group(spark):
    n = 100_000
    path = spark.range(n).selectExpr("id AS a", "id + 1 AS b")
    got = merging.greedy_dedup(path, 1000)
    assert got.where("dropped % 2 = 1 AND kept = dropped - 1").count() == got.count() == n // 2
    star = spark.range(1, n).selectExpr("0L AS a", "id AS b").unionByName(spark.range(1, 2001).selectExpr("id AS a", "id + 1 AS b"))
    got = merging.greedy_dedup(star, 1000)
    assert got.where("kept = 0").count() == got.count() == n - 1 + (1 if n < 2002 else 0)
