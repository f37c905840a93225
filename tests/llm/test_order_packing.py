import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from docweave.llm import order_packing as op

SMALL = op.Windows(capacity=16, sentence=3, inside=7, window=2, stretch=5)


def ids_of(texts):
    from tokenizers import Tokenizer

    from docweave.llm.tokens import vocabulary_path

    tok = Tokenizer.from_file(vocabulary_path())
    return [np.array([*e.ids, 1], np.uint32) for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def cost(cuts, price, params):
    total = 0
    for a, b in zip(cuts, cuts[1:], strict=False):
        n = b - a
        if n > params.capacity:
            return None
        total += (0 if n & (n - 1) == 0 else params.capacity - n) + params.window + price[b]
    return total


@pytest.mark.parametrize("seed", range(40))
def test_no_choice_of_cuts_costs_less(seed):
    rng = random.Random(seed)
    size = rng.randint(1, 60)
    docs = np.array(sorted({size, *rng.sample(range(1, size + 1), min(size, 2))}))
    sentences = np.array(sorted(rng.sample(range(size + 1), min(size, 4))))
    places, price = op.cut_points(size, docs, sentences, SMALL)
    assert places[0] == 0 and places[-1] == size and (np.diff(places) <= SMALL.stretch).all()
    by_place = dict(zip(places.tolist(), price.tolist(), strict=True))
    assert all(by_place[d] == 0 for d in docs.tolist())
    got = cost([places[i] for i in op.windows(places, price, SMALL)], by_place, SMALL)
    inner = places[1:-1].tolist()
    if len(inner) <= 13:
        ways = ([0, *c, size] for k in range(len(inner) + 1) for c in combinations(inner, k))
        assert got == min(w for w in (cost(c, by_place, SMALL) for c in ways) if w is not None)
    else:  # plain programming over all windows
        best = {0: 0}
        for j in places[1:].tolist():
            best[j] = min(best[i] + cost([i, j], by_place, SMALL) for i in places.tolist() if i < j and j - i <= SMALL.capacity)
        assert got == best[size]


def test_sentence_ends():
    from docweave.llm.tokens import encoder

    enc = encoder()
    found = op.Sentences(enc.whole)
    for text, want in (("One two. Three!", 2), ('He said "stop." Then 3.5 more.', 2), ("Mr. Jones and J. Smith left.", 1), ("no end here", 0), ("Really?! Yes...", 2)):
        ids, _ = enc.encode_block(__import__("pyarrow").array([text]))
        assert len(found.after(ids[:-1])) == want, text


def test_documents_are_packed_in_order(spark):
    rng = random.Random(4)
    words = "the and of with from idiot paper house. letter! door\n window\n\n".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    texts += [None, "", "\n\n", "x " * 3000, "Ünï Straße. " * 50, "<|endoftext|> a <|startoftext|>\nb"]
    rows = [(i, t, 3) for i, t in enumerate(texts)] + [(5, texts[5], 1), (None, "null id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int").coalesce(2)
    params = op.Windows(capacity=64, stretch=16, block_bytes=3000)
    got = op.pack_in_order(docs, params=params).collect()
    want = sorted((repr(i), ids.tobytes()) for (i, _, _), ids in zip(rows, ids_of([r[1] for r in rows]), strict=True))
    parts, windows = defaultdict(list), defaultdict(list)
    for r in got:
        parts[repr(r.doc_id)].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length, r.doc_tokens))
    for name, raw in want:
        if [n for n, _ in want].count(name) > 1:
            continue
        at = 0
        for start, length, crc, total in sorted(parts[name]):
            assert start == at and total == len(raw) // 4 and crc == zlib.crc32(raw[4 * start : 4 * (start + length)])
            at += length
        assert at == len(raw) // 4
    assert sum(r.length for r in got) == sum(len(raw) // 4 for _, raw in want)
    for held in windows.values():
        at = 0
        for offset, length, _ in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= 64
    # Order: windows of a task go up with its rows.
    place = {repr(i): n for n, (i, _, _) in enumerate(rows)}
    for part in {r.sequence_id >> 40 for r in got}:
        mine = sorted(((r.sequence_id, r.offset, place[repr(r.doc_id)]) for r in got if r.sequence_id >> 40 == part and r.doc_id != 5))
        assert [m[2] for m in mine] == sorted(m[2] for m in mine)


def test_little_padding(spark):
    rng = random.Random(1)
    text = lambda: " ".join(" ".join(rng.choice(("house", "letter", "of", "running")) for _ in range(rng.randint(4, 25))) + "." for _ in range(rng.randint(1, 120)))
    docs = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id long, text string").coalesce(1)
    sums = [r[1] for r in op.pack_in_order(docs).groupBy("sequence_id").sum("length").collect()]
    assert max(sums) <= 2048
    assert sum(2048 - n for n in sums if n & (n - 1)) < 0.015 * sum(sums)


def test_empty_table(spark):
    assert op.pack_in_order(spark.createDataFrame([], "doc_id long, text string")).collect() == []
