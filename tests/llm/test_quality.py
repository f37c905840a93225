import math
import random
import re
from collections import Counter

from docweave.llm import quality as q


def brute_counts(text):
    text = text or ""
    words = re.findall(q.WORD, text)
    tri = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if tri[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(q.WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def histograms(text):
    text = text or ""
    inside = lambda p: len(re.findall(p, text))
    wide = len(text.encode()) - len(text)
    classes = [inside(p.replace(r"\-", "-") if False else p) for p in q.CLASSES] + [inside(q.SPACE), wide]
    classes.append(max(0, len(text) - sum(classes)))
    words = Counter(w for w in re.split(r"[^a-z\x80-\U0010FFFF]+", text.lower()) if w in set(q._vocabulary()))
    return classes, words, len(re.findall(q.WORD, text))


def distance(p, r):
    part = lambda x, m: x * math.log2(x / m) if x else 0.0
    return math.sqrt(max(0.0, sum(part(a, (a + b) / 2) + part(b, (a + b) / 2) for a, b in zip(p, r, strict=True)) / 2))


def brute(rows, limits):
    sums = {}
    for _, text, lang in rows:
        c, w, n = histograms(text)
        if lang in q.COMMON_WORDS and n:
            s = sums.setdefault(lang, [[0] * 7, Counter(), 0])
            s[0] = [a + b for a, b in zip(s[0], c, strict=True)]
            s[1] += w
            s[2] += n
    vocabulary = q._vocabulary()
    refs = []
    sums = {k: s for k, s in sums.items() if s[2] >= limits.reference_words}
    for s in sums.values():
        words = [s[1][v] / s[2] for v in vocabulary]
        refs.append(([c / sum(s[0]) for c in s[0]], [*words, max(0.0, 1 - sum(words))]))
    out = {}
    for i, text, lang in rows:
        counts = brute_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        c, w, n = histograms(text)
        p = [x / max(1, sum(c)) for x in c]
        shares = [w[v] / max(1, n) for v in vocabulary]
        ds = [(distance(p, rc), distance([*shares, 1 - sum(shares)], rw)) for rc, rw in refs]
        root = math.sqrt(max(n, 1))
        near = any(a <= limits.class_floor + limits.class_allowance / root and (n < limits.min_words_for_histogram or b <= limits.word_floor + limits.word_allowance / root) for a, b in ds)
        near |= lang is not None and lang not in sums
        out[i] = (*counts, failed, not failed and near, round(min(d[0] for d in ds), 5), round(min(d[1] for d in ds), 5))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice("the of and to house tree walks with a in Paris, go. running 42 Über café".split()) for _ in range(n))
    rows = [(i, say(rng.randint(0, 300)), "en") for i in range(40)]
    rows += [(50, "".join(f"{w}%%% " for w in say(200).split()), "en"), (51, "same line here\n" * 80, "en"), (52, "x | y | z | " * 60, None), (53, None, "en"), (54, "", "en"), (55, " \t\n\x0b", "de"),
             (56, say(150), None), (57, "der die und in " * 40 + say(30), "de"), (58, "a b c a b c d", "xx"), (61, "too little of a language " + " ".join(f"q{i}" for i in range(90)), "yy"), (59, rows[5][1], "en"), (60, " nbsp em " * 70, "fr")]
    docs = spark.createDataFrame([(i, t, l, "y") for i, t, l in rows], "doc_id long, text string, lang string, n_words string").repartition(3)
    limits = q.Limits(reference_words=200)
    got = {r["doc_id"]: r for r in q.score(docs.drop("n_words"), limits=limits).collect()}
    want = brute(rows, limits)
    assert set(got) == set(want)
    for i, w in want.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == w[:7], i
        assert abs(r.class_distance - w[7]) < 2e-5 and abs(r.word_distance - w[8]) < 2e-5, i


def test_any_language_makes_a_reference(spark):
    rng = random.Random(3)
    own = ["ale", "jest", "nie", "się", "że", "как", "это"] + ["".join(rng.choice("абвгдежзиклмн") for _ in range(6)) for _ in range(400)]
    say = lambda n: " ".join(own[min(int(rng.expovariate(0.02)), len(own) - 1)] if rng.random() < 0.6 else rng.choice(own[:7]) for _ in range(n))
    english = lambda n: " ".join(rng.choice("the of and to house tree walks with a in city go running".split()) for _ in range(n))
    rows = [(i, say(200), "pl") for i in range(30)] + [(100 + i, english(300), "en") for i in range(30)]
    rows += [(200, say(150), None), (201, "".join(f"{w}%%%### " for w in say(150).split()), "pl"), (202, " ".join(f"z{i}" for i in range(200)), None), (203, english(200), "pl")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r.kept for r in q.score(docs).collect()}
    assert all(got[i] for i in range(30)) and got[200] and got[203] and not got[201] and not got[202]


def test_clashing_columns_and_no_language(spark):
    docs = spark.createDataFrame([(1, "word " * 20 + "other things here " * 3, None, True), (None, "one two three " + " ".join(f"w{i}" for i in range(80)), None, False)], "doc_id long, text string, lang string, kept_before boolean")
    got = {r.doc_id: r for r in q.score(docs).collect()}
    assert got[None].kept and not got[1].kept and got[None].class_distance is None
    assert q.keep_good(docs).columns == docs.columns and q.keep_good(docs).count() == 1
    more = docs.selectExpr("*", "5 AS _row", "6 AS _keep0", "7 AS n_words", "8 AS kept", "9 AS column_0")
    assert [tuple(r)[4:] for r in q.keep_good(more).collect()] == [(5, 6, 7, 8, 9)] and q.keep_good(more).columns == more.columns


def test_empty_table(spark):
    assert q.score(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []
