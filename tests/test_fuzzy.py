import random

import pytest
from pyspark.sql import functions as F

from docweave.functions import fuzzy
from docweave.functions import sentences as se


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence_by_bits():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcß") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert fuzzy.common_subsequence(a, b) == table_lcs(a, b)


def test_best_part_tries_all_parts():
    rng = random.Random(2)
    for _ in range(150):
        needle = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 9)))
        hay = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 30)))
        got = fuzzy.best_part(needle, hay)
        if len(needle) > len(hay):
            assert got == (fuzzy.best_part(hay, needle)[0], 0, len(hay))
            continue
        m, n = len(needle), len(hay)
        parts = [(s, m) for s in range(n - m + 1)] + [(0, i) for i in range(1, m)] + [(n - i, i) for i in range(1, m)]
        ratio = lambda s, k: 200.0 * table_lcs(needle, hay[s : s + k]) / (m + k)  # noqa: B023, E731
        assert got == max(((ratio(s, k), s, k) for s, k in parts), key=lambda x: (x[0], -x[1], x[2]))
    assert fuzzy.best_part("", "abc") == fuzzy.best_part("abc", "") == (0.0, 0, 0)


def test_best_part_at_the_ends_of_a_text():
    ratio, begin, size = fuzzy.best_part("gateway retries", "retries then nothing at all")
    assert (begin, size) == (0, 7) and ratio > 60


@pytest.mark.parametrize("at_least", [67, 80, 95, 100])
def test_alike_loses_no_pair(spark, at_least):
    rng = random.Random(at_least)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(70)] + ["aaaaaaaaaa", "aaaaaaaaa", "a", "aa", "müßig", "müssig"]
    words += [w[:i] + rng.choice("abcd") + w[i:] for w in words[:20] for i in (0, len(w) // 2)]
    df = spark.createDataFrame([(w,) for w in [*words, None, "", words[0]]], "s string")
    distinct = sorted(set(words))
    want = {(a, b): fuzzy.indel_ratio(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if fuzzy.indel_ratio(a, b) >= at_least}
    assert all(fuzzy.bound_is_met(a, b, at_least) for a, b in want)
    assert {(r.a, r.b): r.ratio for r in fuzzy.alike(df, "s", at_least).collect()} == want


TEXTS = ["Dr. Smith met e.g. Mr. Jones. They talked! \"Really?\" he said... Then 3.5 of it.", "Mr. Brown and Dr. Green left. No one saw Dr. Who.", "He met Mr. Lee, i.e. the boss. It was e.g. fun. We saw Dr. Who.", None, "", "no stop"] * 6


def test_abbreviations_are_learned(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS] + [("The long talk was long. We talked. They talked and left. It is fun and long.",)] * 20, "t string")
    found = {r.word for r in se.abbreviations(df, "t").collect()}
    assert {"dr", "mr", "e.g", "i.e"} <= found and not found & {"talked", "long", "boss", "fun", "jones"}


def test_sentences(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:6])], "i int, t string")
    got = {r.i: r.s for r in df.select("i", se.sentences(F.col("t"), ["dr", "mr", "e.g", "i.e"]).alias("s")).collect()}
    assert got[0] == ["Dr. Smith met e.g. Mr. Jones.", "They talked!", '"Really?"', "he said...", "Then 3.5 of it."]
    assert got[1] == ["Mr. Brown and Dr. Green left.", "No one saw Dr. Who."] and got[3] is None and got[4] == [] and got[5] == ["no stop"]
    assert df.where("i = 0").select(se.sentences(F.col("t"), []).alias("s")).first().s[0] == "Dr."
