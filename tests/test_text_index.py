import random
import time
import uuid
from collections import Counter
from math import log

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from docweave.operators import search, text_index
from docweave.operators.text_index import Layout, Report, TextIndex

WORDS = "the of and der die und house river stone clown idiot mill straße ünï 42 a_b".split()


def corpus(seed, n=400):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        pool = rng.choice([WORDS[:3] * 6 + WORDS[6:], WORDS[3:6] * 6 + WORDS[9:]])
        texts.append(" ".join(rng.choice(pool) for _ in range(rng.choice([0, 3, 20, 90]))) + rng.choice(["", ".", " The house of the river!"]))
    return [(i, t) for i, t in enumerate(texts)] + [(n, None), (n + 1, ""), (None, "house of the null"), (n + 2, "the " * 5000)]


def build(spark, rows, tmp_path, **layout):
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    return df, TextIndex.build(df, "id", "text", str(tmp_path / uuid.uuid4().hex), Layout(**layout))


def scores(rows, words, k1=1.2, b=0.75):
    """BM25 over every row, in plain Python."""
    docs = [(i, regex.findall(r"[\p{L}\p{N}_]+", (t or "").lower())) for i, t in rows]
    mean = sum(len(ts) for _, ts in docs) / len(docs)
    df = Counter(w for _, ts in docs for w in set(ts))
    out = []
    for i, ts in docs:
        c = Counter(ts)
        if any(c[w] for w in words):
            out.append((i, sum(log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * len(ts) / mean)) for w in set(words) if c[w])))
    return out


@pytest.mark.parametrize("words", [["clown"], ["the", "clown", "mill"], ["und", "house", "nowhere"], ["straße", "42", "a_b"]])
def test_top_equals_scoring_every_row(spark, tmp_path, words):
    rows = corpus(1)
    df, index = build(spark, rows, tmp_path, segment=16, buckets=4)
    report = Report()
    got = [(r.id, r.score, r["rank"]) for r in index.top(words, 12, report=report).orderBy("rank").collect()]
    want = sorted(scores(rows, words), key=lambda s: (-round(s[1], 9), s[0] is not None, s[0]))[:12]
    assert [g[0] for g in got] == [w[0] for w in want] and [g[2] for g in got] == list(range(1, 13))
    assert all(abs(g[1] - w[1]) < 1e-8 for g, w in zip(got, want, strict=True))
    scan = [(r.id, r.score) for r in search.bm25(df.where("id IS NOT NULL"), "id", "text", words, 5).collect()]
    assert len(scan) == 5
    assert 0 < report.blocks_read <= report.blocks and report.postings_read <= report.postings


def test_blocks_below_the_threshold_are_skipped(spark, tmp_path):
    rows = [(i, "stone " * 3 + "filler " * (i % 40 + 5)) for i in range(600)] + [(1000 + i, "stone " * 8) for i in range(20)]
    _, index = build(spark, rows, tmp_path, segment=16)
    report = Report()
    got = {r.id for r in index.top(["stone"], 10, report=report).collect()}
    assert got == set(range(1000, 1010)) and report.blocks_read < 0.2 * report.blocks


def test_among_counts_only_some_rows(spark, tmp_path):
    rows = corpus(2)
    _, index = build(spark, rows, tmp_path, segment=16)
    among = spark.range(0, 400, 7)
    got = [r.id for r in index.top(["house", "die"], 9, among=among).orderBy("rank").collect()]
    want = sorted((s for s in scores(rows, ["house", "die"]) if s[0] is not None and s[0] < 400 and s[0] % 7 == 0), key=lambda s: (-round(s[1], 9), s[0]))
    assert got == [w[0] for w in want[:9]]


@pytest.mark.parametrize("text", ["house", '"house of the river"', "clown or mill", "the -clown", '"of the" die or und -"the house"', '"the the"', "-clown", "nowhere or house", '"river house" -nowhere'])
def test_match_equals_the_scan(spark, tmp_path, text):
    rows = corpus(3)
    df, index = build(spark, rows, tmp_path, segment=16)
    query = search.websearch(text)
    want = sorted(repr(r.id) for r in df.where(search.matches(search.terms(df.text), query)).select("id").collect())
    assert sorted(repr(r.id) for r in index.match(query).collect()) == want


def test_repeated_ids_and_empty_tables(spark, tmp_path):
    _, index = build(spark, [(1, "red house"), (1, "red house"), (2, "blue house")], tmp_path)
    assert [(r.id, r["rank"]) for r in index.top(["red"], 5).orderBy("rank").collect()] == [(1, 1), (1, 2)]
    _, empty = build(spark, [], tmp_path)
    assert empty.top(["red"], 5).collect() == [] and empty.top([], 5).collect() == [] and empty.match(search.websearch("red")).collect() == []
    assert empty.exists() and not TextIndex(spark, str(tmp_path / "none")).exists()


def test_texts_of_very_many_words(spark, tmp_path):
    rows = [(1, " ".join(f"w{i}" for i in range(70_000))), (2, "w5 w69999 w5"), (3, "w69999 w5")]
    _, index = build(spark, rows, tmp_path)
    assert [r.id for r in index.match(search.websearch('"w69998 w69999"')).collect()] == [1]
    assert [r.id for r in index.match(search.websearch('"w69999 w5"')).orderBy("id").collect()] == [2, 3]


def test_rows_that_ask_alike_are_not_paired_with_all_that_are_found(spark):
    """All ask for the same words and all hold one: pairs of both would be 400 million."""
    n = 20_000
    docs = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "red barn").otherwise("barn").alias("text"))
    asks = docs.select("id", F.explode(F.array(F.lit("red"), F.lit("barn"))).alias("keyword"))
    began = time.monotonic()
    got = search.keyword_matches(asks, search.postings(docs, "id", "text"), 2)
    rows = {(r.id, r["rank"]): (r.neighbour, r.score) for r in got.collect()}
    assert time.monotonic() - began < 60
    assert len(rows) == 2 * n
    assert rows[0, 1] == (3, 2) and rows[0, 2] == (6, 2) and rows[3, 1] == (0, 2) and rows[3, 2] == (6, 2) and rows[n - 1, 1] == (0, 2) and rows[n - 1, 2] == (3, 2)


def test_what_a_task_holds_does_not_grow(spark, tmp_path, monkeypatch):
    """Tasks by the number of words, and in a task pieces by words too."""
    assert list(text_index._pieces(np.array([10] * 70), 32)) == [(0, 64), (64, 70)]
    assert list(text_index._pieces(np.array([1 << 17] * 70), 32)) == [(0, 32), (32, 64), (64, 70)]
    monkeypatch.setattr(text_index, "TASK", 500)
    rows = corpus(5)
    index = build(spark, rows, tmp_path)[1]
    words = sum(r.tf for r in index.postings().collect())
    tasks = index._table().select(F.shiftright("segment", 33)).distinct().count()
    assert words > 8000 and tasks > 8
