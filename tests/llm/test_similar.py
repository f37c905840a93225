import random

import pytest

from docweave.llm import simhash, similar


def brute_kept(rows):
    sets = [(lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})((t or "").lower().split()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 10 >= 8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {rows[find(i)][0] for i in range(len(rows))}


def corpus(changes):
    rng = random.Random(4)
    say = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    rows = []
    for base in range(40):
        words = say(rng.randint(80, 300))
        rows.append((10 * base, " ".join(words)))
        for k in range(1, 4):
            near = list(words)
            for _ in range(max(1, round(len(near) * changes[k - 1]))):
                near[rng.randrange(len(near))] = "X" + rng.choice("abcdefgh")
            rows.append((10 * base + k, " ".join(near)))
    return [*rows, (900, "A b"), (901, "a  B"), (902, ""), (903, None), (904, "a b c")]


def test_near_copies_of_similarity_from_four_fifths_go(spark):
    rows = corpus((0.01, 0.018, 0.03))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_kept(rows)
    assert 45 < len(want) < 140
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == want


def test_the_index_of_fingerprints_finds_the_closest_copies_without_bands(spark):
    rows = corpus((0.0, 0.005, 0.005))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, got = brute_kept(rows), {r.doc_id for r in simhash.keep_one(docs, params=similar.Similar(bands=0)).collect()}
    assert want <= got and len(got - want) < 0.2 * (len(rows) - len(want))


def test_bands_pass_over_what_the_index_joined(spark):
    entries = spark.createDataFrame([(k, sid, sid // 2) for k, sids in ((1, (2, 3)), (2, (2, 3, 4)), (3, (2, 4))) for sid in sids], "key long, sid long, part long")
    pairs = similar.candidates(entries, entries.where("false"), similar.Similar()).collect()
    assert sorted(tuple(r) for r in pairs) == [(2, 4), (3, 4)]


def test_large_buckets_link_by_centers(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        near = list(words)
        near[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(near)))
    docs = spark.createDataFrame([*rows, (999, "another text of some words here")], "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(docs, params=similar.Similar(pairs=8)).collect()} == {0, 999}


@pytest.mark.parametrize("work", [0, 10**9])
def test_no_link_is_lost_in_large_buckets(spark, work):
    # A chain: each text is like its neighbours only, and most are like none of the centers of their buckets.
    rng = random.Random(12)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words = list(words)
        words[(7 * i) % 120] = f"x{i}"
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id long, text string, row string, _row int").repartition(3)
    want = brute_kept(sorted(rows))
    got = simhash.keep_one(docs, params=similar.Similar(pairs=2, centers=1, bands=60, rows=2, work=work))
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == want == {0}


@pytest.mark.parametrize("share, linked", [(0.8, True), (0.81, False)])
def test_alike_at_the_bound(share, linked):
    a, b = similar.np.arange(0, 9, dtype="u8"), similar.np.arange(1, 10, dtype="u8")
    assert similar.alike(a, b, share) == linked
