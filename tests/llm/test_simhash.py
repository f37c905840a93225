import re

import numpy as np
import pytest
import xxhash

from docweave.llm import simhash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_parts(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bucket", [1, 2048])
def test_links_span_the_brute_force_components(spark, bucket):
    rng = np.random.default_rng(5)
    prints = set()
    for _ in range(12):
        near = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(15):
            prints.add(near)
            for b in rng.integers(0, 64, int(rng.integers(1, 5))).tolist():
                near ^= 1 << b
    prints = sorted(prints)
    rows = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = simhash.links(rows, simhash.SimHash(bucket=bucket)).collect()
    mask = (1 << 64) - 1
    place = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in found:
        a, b = r.src & mask, r.dst & mask
        assert (a ^ b).bit_count() <= 3
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(prints))] == brute_parts(prints)


@pytest.mark.parametrize("bucket", [0, 2048])
def test_four_pieces_reach_a_distance_of_seven(spark, bucket):
    rng = np.random.default_rng(8)
    mask, prints = (1 << 64) - 1, {0, (1 << 64) - 1}
    for _ in range(40):
        near = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for apart in (0, 6, 7, 7, 8, 9):
            for b in rng.permutation(64)[:apart].tolist():
                near ^= 1 << b
            prints.add(near)
    prints = sorted(prints)
    rows = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = [(r.src & mask, r.dst & mask) for r in simhash.links(rows, simhash.SimHash(distance=7, bucket=bucket)).collect()]
    assert all((a ^ b).bit_count() <= 7 for a, b in found)
    part = {p: p for p in prints}
    for a, b in found:
        part = {k: part[a] if v == part[b] else v for k, v in part.items()}
    close = [(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 7]
    assert len(close) > len(prints) and all(part[a] == part[b] for a, b in close)


def test_near_duplicates_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(400))
    texts = [None, "", "A b", "a B", long, long, long.replace("w399", "x"), "lonely text here now", " \t\n", long + "   Ünï"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(4, long, "x"), (None, "a b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    prints = [brute_print(t) for t in texts]
    assert [by[i].fingerprint for i in range(len(texts))] == [format(p, "016x") for p in prints]
    assert [by[i].component_id for i in range(len(texts))] == brute_parts(prints)
    assert by[None].component_id == 2


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
