import random
import zlib
from collections import defaultdict

import numpy as np

from docweave.llm import packing


def reference(texts):
    from tokenizers import Tokenizer

    from docweave.llm.tokens import vocabulary_path

    tok = Tokenizer.from_file(vocabulary_path())
    return [np.array([*e.ids, 1], np.uint32).tobytes() for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_crossover_and_mutation_keep_every_piece():
    rng = random.Random(2)
    sizes = [rng.randint(1, 60) for _ in range(300)]
    params = packing.Packing(capacity=100, population=4, offspring=8)
    people = packing.evolve(sizes, [], 1, params)
    people = packing.evolve(sizes, people, 2, params)
    for groups in people:
        assert sorted(i for g in groups for i in g) == list(range(300))
        assert all(sum(sizes[i] for i in g) <= 100 for g in groups)
    a, b = (packing.packed(p, sizes, 100) for p in (people[0], people[-1]))
    child = packing.crossover(a, b, rng, 0.9)
    assert sorted(i for g in child.listed() for i in g) == list(range(300))
    assert a.value() <= b.value()


def triples(seed, count=40, capacity=1000):
    """Triples that fill a sequence exactly: greedy packing misses some of them."""
    rng = random.Random(seed)
    sizes = []
    for _ in range(count):
        a, b = rng.randint(260, 380), rng.randint(250, 370)
        sizes += [a, b, capacity - a - b]
    return sizes


def test_beats_best_fit_decreasing():
    for seed in range(3):
        sizes = triples(seed)
        params = packing.Packing(capacity=1000, population=8, offspring=60)
        greedy = packing.Bins(sizes, 1000)
        greedy.best_fit(list(range(len(sizes))))
        people = []
        for e in range(3):
            people = packing.evolve(sizes, people, e, params)
        assert 40 <= len(people[0]) < len(greedy.groups)


def test_population_is_full_though_the_bound_is_met_at_once_and_room_gathers():
    rng = random.Random(1)
    sizes = [int(min(999, rng.lognormvariate(5, 1))) + 1 for _ in range(600)]
    params = packing.Packing(capacity=1000, population=5, offspring=10)
    greedy = packing.Bins(sizes, 1000)
    greedy.best_fit(list(range(len(sizes))))
    bound = -(-sum(sizes) // 1000)
    people = packing.evolve(sizes, [], 3, params)
    assert len(people) == 5 and len(greedy.groups) == len(people[0]) == bound
    best = packing.packed(people[0], sizes, 1000).value()
    assert packing.best_possible(sizes, 1000) <= best <= greedy.value()


def test_exchange_makes_sequences_fuller_and_keeps_pieces():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randint(1, 50) for _ in range(40)]
        bins = packing.Bins(sizes, 60)
        loose = rng.sample(range(40), 8)
        bins.best_fit([i for i in range(40) if i not in loose])
        before = {b: 60 - r for b, r in bins.room.items()}
        left = bins.exchange(loose)
        assert sorted([i for g in bins.groups.values() for i in g] + left) == list(range(40))
        for b, g in bins.groups.items():
            fill = sum(sizes[i] for i in g)
            assert before[b] <= fill <= 60 and bins.room[b] == 60 - fill
        assert bins.order == sorted((r, b) for b, r in bins.room.items())


def test_documents_are_packed_whole(spark):
    rng = random.Random(4)
    words = "the and of with from idiot paper house letter".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(200)] + [None, "", "x " * 700, "x " * 700]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(5, texts[5], "s"), (None, "null id", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(4)
    params = packing.Packing(capacity=64, block=64)
    got = packing.pack_documents(docs, params=params).collect()
    want = defaultdict(list)
    for (i, _, _), ids in zip(rows, reference([r[1] for r in rows]), strict=True):
        for n, a in enumerate(range(0, len(ids), 256)):
            want[i, n].append((a // 4, len(ids[a : a + 256]) // 4, zlib.crc32(ids[a : a + 256])))
    have = defaultdict(list)
    sequences = defaultdict(list)
    for r in got:
        have[r.doc_id, r.piece].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    bound = sum(r.length == 64 for r in got) - (-sum(r.length for r in got if r.length < 64) // 64)
    assert total and len(sequences) <= 1.01 * bound + 1  # the blocks' leftovers are packed together


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
