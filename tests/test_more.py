import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docweave.operators import curation, graph, knn, merging, relational, repeated, search, training
from docweave.plans import answers, provider


def test_lone_nodes_are_their_own_and_refusals_are_told(spark):
    rows = [("a", "b", "same", 0.9), ("b", "c", "same", 0.8), ("a", "c", "different", 0.9), ("x", "y", "different", 0.5), ("e", "E", "existing", None), ("f", "F", "existing", None), ("e", "f", "same", 0.7)]
    df = spark.createDataFrame(rows, "a string, b string, kind string, p double")
    assert {r.id: r.root for r in merging.guarded_union_find(df).collect()} == {"a": "a", "b": "a", "c": "c", "x": "x", "y": "y", "e": "E", "E": "E", "f": "F", "F": "F"}
    assert sorted(map(tuple, merging.refused_unions(df).collect())) == [("b", "c", "judged_different"), ("e", "f", "joins_existing")]


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_shared_entities_equal_all_pairs(spark, hot):
    rng = random.Random(hot)
    held = {(a, e) for a in range(40) for e in rng.sample(range(12), rng.randint(0, 5))} | {(a, 99) for a in range(0, 40, 2)} | {(a, 98) for a in range(0, 40, 3)}
    by = {}
    for a, e in held:
        by.setdefault(a, set()).add(e)
    want = set()
    for a in by:
        scored = sorted(((-len(by[a] & by[b]), b) for b in by if b != a and by[a] & by[b]))[:4]
        want |= {(a, b, -n, i) for i, (n, b) in enumerate(scored, 1)}
    df = spark.createDataFrame([*held, *list(held)[:5], (None, 1)], "c long, e long")
    assert {(r.a, r.b, r.shared, r.rank) for r in relational.shared_entity_pairs(df, "c", "e", 4, hot).collect()} == want


@pytest.mark.parametrize("hot,wide", [(1000, 0), (1000, 3), (1000, 16), (3, 0), (3, 3), (9, 16), (9, 2)])
def test_shared_entities_by_pairs_of_entities(spark, hot, wide):
    rng = random.Random(hot + wide)
    held = {(f"a{a}", e) for a in range(30) for e in rng.sample(range(14), rng.choice([1, 2, 3, 9]))} | {(f"a{a}", 99) for a in range(0, 30, 2)} | {(f"a{a}", 98) for a in range(0, 30, 3)} | {("b", 99), ("c", 98), ("c", 99), ("lone", 50)}
    by = {}
    for a, e in held:
        by.setdefault(a, set()).add(e)
    want = set()
    for a in by:
        scored = sorted((-len(by[a] & by[b]), b) for b in by if b != a and by[a] & by[b])[:3]
        want |= {(a, b, -n, i) for i, (n, b) in enumerate(scored, 1)}
    df = spark.createDataFrame(sorted(held), "c string, e long")
    assert {(r.a, r.b, r.shared, r.rank) for r in relational.shared_entity_pairs(df, "c", "e", 3, hot, wide).collect()} == want


def test_section_pairs_equal_all_pairs(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaaaabc"), rng.randrange(60)) for _ in range(120)]
    pairs = sorted({(a, b) for s, a in rows for t, b in rows if s == t and a < b})
    for limit in (1, 7, 40, 5000):
        got = [(r.a, r.b) for r in relational.section_pairs(spark.createDataFrame(rows, "s string, x long"), "s", "x", limit).collect()]
        assert got == pairs[:limit]


def test_approximate_neighbours_are_nearly_the_exact_ones(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(20, 16))
    vectors = [(i, (middles[i % 20] + 0.3 * rng.normal(size=16)).tolist()) for i in range(800)] + [(900, [0.0] * 16), (901, None)]
    df = spark.createDataFrame(vectors, "id long, v array<double>").repartition(4)
    exact = knn.nearest(df, 8, "id", "v").cache()
    found = knn.approximate(df, 8, "id", "v", cells=20, probes=4, block_rows=32)
    r = knn.recall(found, exact).first()
    assert r.asked == 800 and r.recall >= 0.9
    some = knn.approximate(df, 8, "id", "v", df.where("id % 50 = 0").select("id"), cells=20, probes=20, block_rows=64)
    whole = exact.where("id % 50 = 0")
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect()))
    assert knn.approximate(df.where("id > 899"), 3, "id", "v").collect() == []


def test_repeated_elements(spark):
    page = lambda i: f"<body><nav>menu</nav><div class='b a'><p>promo</p><p>own {i}</p></div><div class='a' id='x'>foot</div><p>tail</p></body>"
    df = spark.createDataFrame([(i, page(i)) for i in range(3)] + [(9, None), (10, "<div class='c'>alone</div>")], "page_id long, html string")
    got = {(r.selector, r.text): (r.pages, r.all_pages) for r in repeated.repeated_elements(df, "page_id", "html").collect()}
    assert got[("div.a.b > p", "promo")] == (3, 3) and got[("div.a", "foot")] == (3, 3) and got[(":scope > p", "tail")] == (3, 3)
    assert ("div.a.b > p", "own 1") not in got and ("div.c", "alone") not in got and not any("menu" in t for _, t in got)
    assert not any(t == "promo own 0" for _, t in got)


def test_first_paths_equal_a_search_in_depth(spark):
    rng = random.Random(6)
    edges = [(f"e{i}", rng.randrange(14), rng.randrange(14), i % 3 == 0) for i in range(30)]
    frac = lambda *p: int(hashlib.sha256("".join(f"{x}\x1f" for x in ("path", *p)).encode()).hexdigest()[:13], 16) / 16**13
    near = {}
    for e, a, b, directed in edges:
        near.setdefault(a, []).append((e, b))
        if not directed:
            near.setdefault(b, []).append((e, a))

    def first(path, target):
        if len(path) == target + 1:
            return path
        for e, b in sorted(near.get(path[-1], ()), key=lambda x: (frac(x[0]), x[1])):
            if b not in path and (found := first([*path, b], target)):
                return found
        return None

    want = {}
    for a in near:
        if found := first([a], 1 + int(frac("hops", str(a)) * 3)):
            want[a] = found
    df = spark.createDataFrame(edges, "edge_id string, src long, dst long, directed boolean")
    got = {r.start: list(r.nodes) for r in training.hop_paths(df, 1, 3).collect()}
    assert got == want
    some = [r.start for r in training.hop_paths(df, 1, 3, 3).collect()]
    assert some == sorted(want, key=lambda a: hashlib.sha256(f"path\x1f{a}\x1f".encode()).hexdigest())[:3]


def test_keywords_of_several_words_ask_for_all(spark):
    docs = spark.createDataFrame([(1, "red house"), (2, "red barn"), (3, "a house and a barn"), (4, "nothing")], "id long, text string")
    asks = spark.createDataFrame([(4, "red house"), (4, "barn"), (2, "house red")], "id long, keyword string")
    got = {(r.id, r.neighbour): r.score for r in search.keyword_matches(asks, search.postings(docs, "id", "text"), 5).collect()}
    assert got == {(4, 1): 1, (4, 2): 1, (4, 3): 1, (2, 1): 1}


def test_questions_that_are_too_long_are_errors(spark):
    asked = spark.createDataFrame([("s" * 8, f"question {i}", f"k{i}", ["a", "b"]) for i in range(5)], "state string, question string, cache_key string, options array<string>")
    assert Counter(r.call for r in provider.packed(asked, 11).collect()) == {0: 2, 1: 2, 2: 1}
    for window, longest in ((2, 99), (4, 99), (99, 2)):
        with pytest.raises(PySparkException):
            provider.packed(asked, window, longest=longest).collect()


def test_many_questions_of_one_state_are_packed_as_they_come(spark):
    """A list of all of them, copied at every step, took the square of their number."""
    asked = spark.range(60_000).select(F.lit("s").alias("state"), F.format_string("q%06d", "id").alias("question"), F.format_string("k%06d", "id").alias("cache_key"), F.array(F.lit("")).alias("options"))
    began = time.monotonic()
    calls = {r.cache_key: r.call for r in provider.packed(asked, 60, 7).collect()}
    assert time.monotonic() - began < 40
    assert calls == {f"k{i:06d}": i // 7 for i in range(60_000)}


def test_states_of_words(spark):
    df = spark.createDataFrame([("a", "", [], "x", 1), ("b", None, ["k"], "y", 2)], "t string, u string, ks array<string>, v string, n int").withColumn("s", F.struct("v", "n"))
    got = [r.state for r in curation.picked(df, {"title": "t", "sub": "u", "keys": "ks", "deep": "s.v"}, ["deep"]).collect()]
    assert got == ['{"title":"a","deep":{"data":"x"}}', '{"title":"b","keys":["k"],"deep":{"data":"y"}}']
    with pytest.raises(ValueError):
        curation.picked(df, {"n": "s.n"})


@pytest.mark.parametrize("kinds", [1, 2, 5, 60])
def test_least_pairs_equal_all_pairs_cut(spark, kinds):
    rng = random.Random(kinds)
    rows = sorted({(rng.choice(["hot"] * 6 + ["x", "y"]), i, rng.randrange(kinds) if i > 40 else 0) for i in range(120)})
    df = spark.createDataFrame([*rows, ("hot", None, 1)], "g string, i long, k long")
    for cap in (1, 4, 30):
        for kind in (None, "k"):
            got = sorted((r.g, r.a, r.b) for r in relational.least_pairs(df, ["g"], "i", cap, kind).collect())
            want = []
            for g in ("hot", "x", "y"):
                mine = [r for r in rows if r[0] == g]
                want += [(g, a[1], b[1]) for a in mine for b in mine if a[1] < b[1] and (kind is None or a[2] != b[2])][:cap]
            assert got == sorted(want)


def test_entities_with_alike_names(spark):
    rng = random.Random(2)
    names = ["anna berg", "anna bergh", "carl", "karl", "dora"]
    rows = [(rng.randrange(3), i, rng.choice(names)) for i in range(60)] + [(0, None, "carl"), (1, 99, None)]
    df = spark.createDataFrame(rows, "doc_id long, entity_id long, name string")
    near = {("anna berg", "anna bergh"), ("carl", "karl")}
    for cap, at_least in ((5, None), (5, 75), (500, 75)):
        want = set()
        for d in range(3):
            mine = sorted((r[1], r[2]) for r in rows if r[0] == d and r[1] is not None and r[2] is not None)
            want |= set([(a, b) for a, x in mine for b, y in mine if a < b and (x == y or (at_least and tuple(sorted((x, y))) in near))][:cap])
        assert {(r.a, r.b) for r in curation.co_occurring(df, cap, at_least).collect()} == want


def test_definitions_to_compare_and_their_support(spark):
    items = spark.createDataFrame([("a", 1, "relation"), ("b", 2, "relation"), ("c", 3, "entity"), ("d", 4, "relation"), (None, 5, "relation"), ("e", None, "relation")], "name string, pos int, kind string")
    pairs = lambda only=None: sorted((r.a, r.b) for r in curation.definition_pairs(items, only).collect())
    assert pairs() == [("a", "b"), ("a", "d"), ("b", "d")]
    assert pairs(items.where("name = 'd'")) == [("a", "d"), ("b", "d")] and pairs(items.where("name = 'x'")) == []
    assert curation.definition_pairs(items.where("false")).collect() == []
    defs = spark.createDataFrame([("a", ["p1", "p2"]), ("b", []), ("c", None), ("d", ["p3"])], "name string, evidence array<string>")
    answers = spark.createDataFrame([("a", "accept"), ("a", "reject"), ("a", "reject"), ("b", "accept"), ("d", "reject")], "name string, outcome string")
    assert {r.name: r.supported for r in curation.supported(defs, answers).collect()} == {"a": True, "b": False, "c": False, "d": False}
    assert {r.name: r.supported for r in curation.supported(defs, answers, 0.5).collect()} == {"a": False, "b": False, "c": False, "d": False}


def test_expansion_of_many_questions_equals_each_alone(spark):
    rng = random.Random(4)
    edges = spark.createDataFrame([(f"e{i}", rng.randrange(40), rng.randrange(40), rng.choice([None, round(rng.random(), 1)])) for i in range(90)], "edge_id string, src long, dst long, weight double")
    seeds = [(q, rng.randrange(40)) for q in range(6) for _ in range(2)] + [(9, 1000), (10, None)]
    judge = lambda o: o.withColumn("outcome", F.when((F.col("from_id") + F.col("neighbour")) % 3 == 0, "reject").otherwise("accept"))
    nodes, decisions = graph.expand_many(edges, spark.createDataFrame(seeds, "q long, id long"), 5, 3, judge)
    got = sorted(((r.q, r.id, r.hop, r.parent, r.edge_id) for r in nodes.collect()), key=repr)
    want = []
    for q in {s[0] for s in seeds} - {10}:
        alone = graph.expand(edges, spark.createDataFrame([(i,) for k, i in seeds if k == q], "id long"), 5, 3, lambda o: judge(o).where("outcome = 'accept'").drop("outcome"))
        want += [(q, r.id, r.hop, r.parent, r.edge_id) for r in alone.collect()]
    assert got == sorted(want, key=repr)
    told = decisions.collect()
    assert {r.outcome for r in told} == {"accept", "reject"} and all((r.outcome == "reject") == ((r.from_id + r.neighbour) % 3 == 0) for r in told)
    assert not [r for r in told if r.q == 9] and graph.expand_many(edges, spark.createDataFrame([], "q long, id long"), 2, 3)[1].collect() == []


def test_answers_outlive_versions(spark):
    store = answers.temporary(spark)
    items = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x"), ("d", None)], "item_id string, state string")
    Q = provider.Question

    def ask(question, kind, options, levels, state):
        if kind == "choice":
            return None, options[0], None
        return 0.5, None, None

    one = store.ask(items, "s@1", [Q("p"), Q("q", "choice", ("u", "v"))], ask).collect()
    assert len(one) == 8 and not any(r.reused for r in one) and store.answers().count() == 6

    def none(*_):
        raise ValueError("asked again")

    again = store.ask(items, "s@2", [Q("q", "choice", ("u", "v"))], none).collect()
    assert len(again) == 4 and all(r.reused and r.choice == "u" for r in again)
    # Other options, another set, another model: new questions.
    for name, qs, model in (("s@2", [Q("q", "choice", ("v", "u"))], "offline"), ("t@1", [Q("p")], "offline"), ("s@1", [Q("p")], "big")):
        got = store.ask(items, name, qs, ask, model).collect()
        assert len(got) == 4 and not any(r.reused for r in got)
    store.add(store.answers().select(*[c for c in store.answers().columns if c not in ("batch", "drift")]).withColumn("reuse_key", F.concat("reuse_key", F.lit("~"))), drift=True)
    assert store.answers().where("reuse_key LIKE '%~'").isEmpty()
    assert store.ask(items.where("false"), "s@3", [Q("p")], none).collect() == []


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "a", i) for i in range(200)], "k long, s string, n long")
    relational.create_buckets(rows, path, ["k"], 16)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    new = spark.createDataFrame([(5, "x", 1, 1), (5, "y", 2, 2), (900, "z", 3, 1)], "k long, s string, n long, seq long")
    count = relational.upsert_buckets(spark, path, new, ["k"], F.col("seq"), buckets=16)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    assert 1 <= count <= 2 and len(set(before) & set(after)) == len(before) - len({f.parent for f in set(before) - set(after)})
    whole = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("k", "s", "n").collect())
    want = sorted([(i, "a", i) for i in range(200) if i != 5] + [(5, "y", 2), (900, "z", 3)])
    assert whole() == want
    relational.upsert_buckets(spark, path, new, ["k"], F.col("seq"), buckets=16)
    assert whole() == want and relational.upsert_buckets(spark, path, new.where("false"), ["k"], F.col("seq"), buckets=16) == 0


def test_a_judge_makes_room_for_the_next_negative(spark):
    near = spark.createDataFrame([(1, n, n / 10) for n in range(2, 8)] + [(2, 1, 0.1), (3, 1, 0.1)], "id long, neighbor long, dist double")
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(1, 8)], "id long, text string")
    splits = texts.select("id", F.lit("train").alias("split"))
    answers_ = spark.createDataFrame([(1, 2, "accept"), (1, 3, "reject"), (1, 4, "accept"), (1, 5, "reject"), (1, 6, "reject"), (1, 7, "reject"), (2, 1, "accept")], "id long, neighbor long, outcome string")
    got = sorted((r.id, r.neighbor, r.turn, r.status) for r in training.judged_negatives(near, texts, splits, answers_).collect() if r.neighbor)
    assert got == [(1, 3, 1, "accepted"), (1, 5, 2, "accepted"), (1, 6, 3, "accepted")]
    assert sorted(r.id for r in training.judged_negatives(near, texts, splits, answers_).where("status = 'rejected'").collect()) == [2, 3]


def test_verdicts_name_one_open_review(spark):
    queue = spark.createDataFrame([("ab1", "doc", "1", "open", "accept"), ("ab2", "doc", "2", "open", None), ("c3", "doc", "1", "open", "reject"), ("d4", "doc", "4", "resolved", "accept"), ("e5", "edge", "1", "open", "escalate")], "review_id string, subject_kind string, subject_id string, status string, outcome string")
    verdicts = spark.createDataFrame([("ab1", "reject"), ("ab", "accept"), ("ab2", "accept"), ("c", "accept"), ("d4", "accept"), ("x", "reject"), ("e", "reject"), ("", "accept")], "prefix string, verdict string")
    done = curation.resolved_reviews(queue, verdicts)
    got = {r.prefix: (r.review_id, r.overturned, r.problem) for r in done.collect()}
    assert got == {"ab1": ("ab1", True, None), "ab": (None, None, "several reviews"), "ab2": ("ab2", False, None), "c": ("c3", True, None), "d4": (None, None, "already resolved"),
                   "x": (None, None, "no review"), "e": ("e5", False, None), "": (None, None, "no review")}
    docs = spark.createDataFrame([(1, "review", True, None), (2, "review", True, False), (3, "review", True, None)], "doc_id long, status string, quarantined boolean, in_scope boolean")
    rows = {r.doc_id: (r.status, r.quarantined, r.in_scope) for r in curation.with_verdicts(docs, "doc_id", "doc", done).collect()}
    assert rows == {1: ("accepted", False, True), 2: ("accepted", False, True), 3: ("review", True, None)}  # of two verdicts on 1 that of c3 is the last
    edges = spark.createDataFrame([(1, 2, "review", False), (2, 3, "accepted", False), (4, 4, "review", True)], "src long, dst long, status string, structural boolean")
    items = spark.createDataFrame([(i, "done") for i in (1, 2, 3, 4)] + [(5, "failed")], "item_id long, status string")
    assert {r.item_id: r.status for r in curation.reopened_links(items, edges).collect()} == {1: "pending", 2: "done", 3: "done", 4: "done", 5: "failed"}


def test_first_paths_are_found_whatever_the_fan(spark):
    rng = random.Random(3)
    rows = [(f"e{i}", rng.randrange(14), rng.randrange(14), rng.random() < 0.3) for i in range(40)]
    edges = spark.createDataFrame([(e, a, b, d) for e, a, b, d in rows if a != b], "edge_id string, src long, dst long, directed boolean")
    whole = sorted(map(repr, training.hop_paths(edges, 2, 3).collect()))
    assert whole and sorted(map(repr, training.hop_paths(edges, 2, 3, fan=1).collect())) == whole


def test_long_texts_of_elements_are_told_apart(spark):
    long = "same words " * 40
    rows = [(i, f"<body><p class='x'>{long}{'one' if i < 2 else i}</p></body>") for i in range(4)]
    got = repeated.repeated_elements(spark.createDataFrame(rows, "page long, html string"), "page", "html").collect()
    assert [(r.selector, r.pages, r.all_pages) for r in got] == [("p.x", 2, 4)]


def test_questions_fan_out_over_parts(spark):
    Q = provider.Question
    items = spark.createDataFrame([("a", "s", ["u", "v"]), ("b", "t", [])], "item_id string, state string, names array<string>")
    parts = spark.createDataFrame([("a", "p1", None), ("a", "p2", ["r"]), ("a", "p1", None), ("a", None, None), ("c", "p9", None)], "item_id string, part string, only array<string>")
    asked = provider.fanned(items, parts, "s@1", [Q("w"), Q("n", "choice", options_from="names"), Q("q", text="Is {part} so?", fan=True), Q("r", "score", levels=2, text="How {part}?", fan=True)])
    got = sorted((r.item_id, r.part or "", r.logical, r.question) for r in asked.collect())
    assert got == [("a", "", "n", "n"), ("a", "", "w", "w"), ("a", "p1", "q", "Is p1 so?"), ("a", "p1", "r", "How p1?"), ("a", "p2", "r", "How p2?"), ("b", "", "w", "w")]
    keys = [r.key for r in asked.collect()]
    assert len(set(keys)) == 5 and all(len(k) == 13 for k in keys)  # a key is the question's and the part's, whatever the item
    answered = provider.valid(asked, provider.answer(asked))
    assert answered.count() == len(got) and answered.where("kind = 'choice'").first().choice == "u"


def test_metadata_of_reused_chunks_reported_and_applied(spark):
    chunks = spark.createDataFrame([("c1", 1), ("c2", 2)], "chunk_id string, doc_id long")
    reuse = spark.createDataFrame([("c1", 3), ("c1", 2), ("c1", 1)], "chunk_id string, doc_id long")
    docs = spark.createDataFrame([(1, "v", ["b", "a"]), (2, "v", ["a", "c"]), (3, "v", ["d", None]), (3, "w", ["x"]), (2, "w", [])], "doc_id long, field string, values array<string>")
    new = curation.chunk_values(chunks, reuse, docs)
    get = lambda df: {(r.chunk_id, r.field): r["values"] for r in df.collect()}
    assert get(new) == {("c1", "v"): ["b", "a", "c", "d"], ("c1", "w"): ["x"], ("c2", "v"): ["a", "c"]}
    old = spark.createDataFrame([("c1", "v", ["b", "a"]), ("c2", "v", ["c", "a"]), ("c2", "gone", ["z"])], "chunk_id string, field string, values array<string>")
    changes = curation.metadata_changes(old, new)
    assert sorted((r.field, r.before, r.after, r.chunks) for r in curation.metadata_report(changes).collect()) == [("gone", "z", "", 1), ("v", "b,a", "b,a,c,d", 1), ("w", "", "x", 1)]
    assert get(curation.metadata_applied(old, changes)) == {("c1", "v"): ["b", "a", "c", "d"], ("c1", "w"): ["x"], ("c2", "v"): ["c", "a"]}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_coverage_ranks_claims_and_chunks_in_one_deal(spark, n):
    rng = random.Random(n)
    claims = [(rng.choice([None, *range(8)]), f"c{rng.randrange(30)}") for _ in range(40)] + [(1, None), (1, "x"), (1, "x")]
    chunks = [(c, t) for c in (None, None, 1, 2, *range(20, 25), 20, 20, 20) for t in (5, 50)]
    by = {}
    for c, x in claims:
        by.setdefault(c, []).append(x)
    key = lambda x: (x is not None, hashlib.sha256(f"coverage\x1f{x}\x1f".encode()).hexdigest())
    want = [(c, x) for c, xs in by.items() for x in sorted((x for x in xs if x is not None), key=key)[:n]]
    want += [(c, None) for c, t in chunks if t >= 10 and (c is None or c not in by)]
    some = spark.createDataFrame([r for r in claims if r[1] is not None], "chunk_id long, claim_id string")
    found = training.coverage(some, spark.createDataFrame(chunks, "chunk_id long, tokens long"), n, 10)
    assert Counter(map(tuple, found.collect())) == Counter(want)
    # A join of chunks beside the ranking would be left to one task, and grow with the chunks.
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
