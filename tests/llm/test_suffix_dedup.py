import hashlib
import random
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest

from docweave.llm import suffix_dedup as sd


def brute(rows, window, keep):
    """For each row (id, text): spans of bytes that go, by windows alone; places ordered by id, then offset."""
    places = defaultdict(list)
    data = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    rank = {i: n for n, i in enumerate(order)}
    for i, d in enumerate(data):
        for k in range(len(d) - window + 1):
            places[d[k : k + window]].append((rank[i], k))
    out = []
    for i, d in enumerate(data):
        mask = bytearray(len(d))
        for k in range(len(d) - window + 1):
            p = places[d[k : k + window]]
            if (keep == "none" and len(p) > 1) or (keep == "first" and min(p) != (rank[i], k)):
                mask[k : k + window] = b"\1" * window
        runs = sum(1 for k in range(len(mask)) if mask[k] and (k == 0 or not mask[k - 1]))
        kept = bytes(x for x, m in zip(d, mask, strict=True) if not m)
        out.append((rows[i][0], len(d), sum(mask), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice("abcdé fgh\n") for _ in range(n))
    shared = [say(rng.randint(30, 200)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [say(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), say(rng.randint(0, 20))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[3][1]) for i in range(5)]  # copies
    near = rows[7][1] + say(100)
    rows += [(200 + i, near[:40] + "x" * i + near[40:]) for i in range(6)]
    rows += [(300, "ab" * 120), (301, "q" * 150), (302, "q" * 39), (303, "q" * 40), (304, ""), (305, None), (None, say(80) + shared[0])]
    return rows


@pytest.mark.parametrize("keep, group, crowd", [("none", 2048, 4096), ("none", 1, 1), ("first", 2048, 2), ("first", 1, 4096)])
def test_equals_brute_force(spark, monkeypatch, keep, group, crowd):
    monkeypatch.setattr(sd, "CROWD", crowd)
    rows = corpus(3)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, rid string").repartition(3)
    params = sd.Repeats(window=40, gram=16, keep=keep, group=group)
    got = [(r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup(docs, params=params).collect()]
    assert sorted(got, key=repr) == brute(rows, 40, keep)


def test_repeated_rows_are_copies(spark):
    text = "a text of some length " * 3
    docs = spark.createDataFrame([(1, text), (1, text), (2, "other")], "doc_id long, text string")
    got = sorted((r.id, r.n_removed) for r in sd.dedup(docs, params=sd.Repeats(window=40, gram=16)).collect())
    assert got == [(1, len(text)), (1, len(text)), (2, 0)]


def test_long_texts_are_searched_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 256)
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    part = say(300)
    texts = [say(900) + part + say(700), part[50:] + say(40), say(64), say(30) + part]
    found = []
    for keep in (True, False):
        batch = sd.pa.RecordBatch.from_arrays([sd.pa.array([0] * 4), sd.pa.array([1, 2, 3, 4]), sd.pa.array([t.encode() for t in texts])], ["id", "rid", "data"])
        if not keep:
            monkeypatch.setattr(sd, "BLOCK", 1 << 20)
        runs = [r for b in sd._find_anchors(sd.Repeats(window=40, gram=16))([batch]) for r in b.to_pylist()]
        found.append({(r["rid"], r["lo"] + k, r["h"]) for r in runs for k in range(r["n"])})
    assert found[0] == found[1]
    assert {(r, w) for r, w, _ in found[0]} == {(i + 1, w) for i, t in enumerate(texts) for w in range(len(t) - 39)}


def test_names_tell_strings_apart():
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=3000)), np.uint8)
    for length in (8, 16, 24, 40):
        n = sd.names(data, length)
        raw = [data[i : i + length].tobytes() for i in range(len(n))]
        assert len(set(n.tolist())) == len(set(raw)) and len({(a, b) for a, b in zip(n.tolist(), raw, strict=True)}) == len(set(raw))


@pytest.mark.parametrize("words, window, letters", [(False, 40, b"ab"), (False, 400, b"ab"), (False, 16, b"a"), (False, 5, b"ab"), (True, 7, b"abc"), (True, 51, b"ab")])
def test_suffix_arrays_and_factors_equal_brute_force(words, window, letters):
    rng = random.Random(window)
    part = bytes(rng.choices(letters, k=window + 30))
    raw = b"".join(bytes(rng.choices(letters, k=rng.randint(0, 40))) + part[rng.randint(0, 20) :] for _ in range(6))
    data = np.frombuffer(raw, np.uint8)
    if words:
        data = data.astype(np.uint64) * np.uint64(1 << 50)
    starts = np.array(sorted(rng.sample(range(len(raw) - window + 1), min(150, len(raw) - window))))
    order, common = sd.suffix_array(data, starts, window)
    cut = [raw[i : i + window] for i in starts.tolist()]
    assert [cut[i] for i in order.tolist()] == sorted(cut)
    prefix = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), window)
    assert common.tolist() == [0] + [prefix(cut[a], cut[b]) for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)]
    factors = sd.longest_previous_factors(order, common)
    assert factors.tolist() == [max((prefix(cut[i], cut[j]) for j in range(i)), default=0) for i in order.tolist()]
    for keep, others in (("first", lambda i: cut[:i]), ("none", lambda i: cut[:i] + cut[i + 1 :])):
        assert sd.repeated(data, starts, window, keep).tolist() == [c in others(i) for i, c in enumerate(cut)]


def test_factors_from_both_sides_tell_every_repeat():
    rng = random.Random(6)
    for window in (2, 5, 9):
        data = np.frombuffer("".join(rng.choice("ab") for _ in range(160)).encode(), np.uint8)
        starts = np.array(sorted(rng.sample(range(len(data) - window + 1), 60)))
        held = [bytes(data[s : s + window]) for s in starts]
        assert sd.repeated(data, starts, window, "none").tolist() == [held.count(h) > 1 for h in held]
        assert sd.repeated(data, starts, window, "first").tolist() == [h in held[:i] for i, h in enumerate(held)]
        order, common = sd.suffix_array(data, starts, window)
        following = sd.longest_previous_factors(len(order) - order, common)
        for i, n in zip(order.tolist(), following.tolist(), strict=True):
            rest = [next((k for k in range(window) if data[starts[i] + k] != data[s + k]), window) for s in starts[i + 1 :]]
            assert n == max(rest, default=0)


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    rng = random.Random(6)
    texts = ["", " ", "a", "a b", "\x1c b\u00a0c\u2003 d", "x" * 70 + " " + "x" * 70, " ".join(rng.choice(["aa", "b", "cé", "d" * 90]) for _ in range(400)), "a\tb\nc\x0bd\x0ce\rf"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    seen = {}
    for block in (1 << 19, 16):
        monkeypatch.setattr(sd, "BLOCK", block)
        hashes, ends = sd.text_words(data, offsets)
        words = [w for t in texts for w in t.encode().split()]
        assert len(hashes) == len(words) and np.diff(ends).tolist() == [len(t.encode().split()) for t in texts]
        for h, w in zip(hashes.tolist(), words, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_in_passages_are_counted(spark):
    rng = random.Random(2)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    p, q = say(60), say(55)
    docs = spark.createDataFrame([(1, f"{say(9)} {p} {say(70)} {q}"), (2, f"{p} {q} {say(5)}"), (3, say(300)), (4, None), (5, say(51))], "doc_id long, text string")
    rows = sd._keyed(docs, "doc_id", "text").select("id", "rid")
    got = {r.id: r.n_passage_words for r in rows.join(sd.covered_words(docs), "rid").collect()}
    assert got == {1: 115, 2: 115}


def test_columns_of_any_name(spark):
    text = "some text that comes again and again and again"
    docs = spark.createDataFrame([(1, text, 1, 2, 3), (2, text, 4, 5, 6)], "doc_id long, text string, rid int, spans int, word_spans int")
    got = sd.remove_repeats(docs, params=sd.Repeats(window=40, gram=16, keep="first"), by_words=sd.Repeats(window=5, gram=2, keep="first", words=True))
    assert got.columns == docs.columns and [tuple(r)[2:] for r in got.collect()] == [(1, 2, 3)]


def test_remove_repeats_keeps_characters_whole(spark):
    a, b = "é" * 40 + "tail of a", "xé" + "é" * 40 + " other"
    docs = spark.createDataFrame([(1, a, 5), (2, b, 6), (3, a, 7), (4, None, 8), (5, "", 9)], "doc_id long, text string, n int")
    got = {r.doc_id: r for r in sd.remove_repeats(docs, params=sd.Repeats(window=40, gram=16, keep="first")).collect()}
    assert set(got) == {1, 2, 4, 5} and got[4].text is None and got[5].text == ""
    assert got[1].text[-9:] == "tail of a" and got[2].text.startswith("x") and got[2].text.endswith(" other") and len(got[2].text) < len(b)


def test_empty_table(spark):
    assert sd.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_passages_of_more_than_fifty_words_go_at_any_length_in_bytes(spark):
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 4))) for _ in range(n))
    passages = {51: say(51), 62: say(62), 50: say(50)}
    assert all(len(p) < 400 for p in passages.values())
    wide = say(200).replace(" ", "")  # no white space
    rows = [(1, say(30) + " " + " ".join(passages.values()) + " " + wide)]
    rows += [(10 + n, f"{say(40)} begin\u00a0é {p.replace(' ', chr(10), 3)} end {say(40)}") for n, p in passages.items()]
    rows += [(90, say(60) + " " + wide + " last"), (91, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = sd.Repeats(window=51, gram=8, keep="first", words=True)
    for group in (2048, 0):
        got = {r.doc_id: r.text for r in sd.remove_repeats(docs, by_words=replace(words, group=group)).collect()}
        assert got[1] == rows[0][1] and got[60] == rows[3][1]  # the first place stays, and so do fifty words
        for n, row in ((51, rows[1]), (62, rows[2])):
            assert len(got[10 + n].split()) == len(row[1].split()) - n and got[10 + n].split()[:42] == row[1].split()[:42]
        assert wide not in got[90] and 91 not in got
