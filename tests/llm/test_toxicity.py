import itertools
import os
import random

import pytest

from docweave.llm import toxicity as tx
from docweave.llm.fst import Fst, compose


def test_patterns_of_clauses():
    g = tx.Grammar(["idiot", "moron"], ["achlich"])
    count = lambda text: dict(zip(tx.PATTERNS, g.patterns(text), strict=True))
    some = lambda text: {k: v for k, v in count(text).items() if v}
    assert some("what an IDIOT") == {"insult": 1}
    assert some("you are an idiot. he is fine") == {"insult_target": 1}
    assert some("this is not an idiot") == {"insult_negated": 1}
    assert some('she said "you idiot"') == {"insult_reported": 1}
    assert some("I will kill you") == {"threat_target": 1}
    assert some("you, I will kill") == {"threat_target": 1}
    assert some("kill the process") == {}
    assert some("never kill you") == {"threat_negated": 1}
    assert some("he said I will kill you") == {"threat_reported": 1}
    assert some("idiots and morons!") == {"insult": 2}
    assert some("nonidiot xmoron achlichkeit achlicher. achlich") == {"insult_weak": 3}
    assert some("not a single one of those old idiot things, you") == {"insult_target": 1}
    assert some("") == some(None) == {}


def by_hand(marks, weights):
    """Every pattern of a clause, from its definition: what stands before and after each mark."""
    found = set()
    quotes = said = 0
    inside = False
    for i, m in enumerate(marks):
        if m == "R":
            said = 1
            if inside:
                inside = "said"
        elif m == "Q":
            quotes += 1
            inside = ("said" if said else "open") if not inside else False
        elif m in "IH":
            negated = "N" in marks[max(0, i - tx.REACH) : i]
            aimed = "T" in marks
            if m == "I":
                found.add("insult_reported" if inside == "said" else "insult_negated" if negated else "insult_target" if aimed else "insult")
            elif said:
                found.add("threat_reported")
            elif negated:
                found.add("threat_negated")
            elif aimed:
                found.add("threat_target")
        elif m == "J":
            found.add("insult_weak")
    return found


def test_best_path_equals_all_paths_and_the_definitions():
    weights = dict(zip(tx.PATTERNS, (4.0, 4.5, 1.0, 1.5, 3.0, 0.5, 0.25, 2.0), strict=True))
    whole = tx.clause_transducer(weights)
    rng = random.Random(3)
    words = ["".join(w) for n in range(4) for w in itertools.product("TNRQIHJ", repeat=n)] + ["".join(rng.choice("..." + tx.MARKS) for _ in range(rng.randint(4, 9))) for _ in range(1500)]
    for word in words:
        paths = list(whole.paths(word))
        best = whole.best(word)
        assert len(paths) >= 1 and best[0] == pytest.approx(max(p[0] for p in paths)) and best in [(pytest.approx(w), o) for w, o in paths]
        said = [tx.WRITTEN[o] for o in best[1] if o in tx.WRITTEN]
        assert best[0] == pytest.approx(sum(weights[p] for p in said))
        # The composed machine does what its parts do one after the other, all their paths considered.
        ways = {word}
        for part in (tx.negation(), tx.report(), tx.target()):
            ways = {o for w in ways for _, o in part.paths(w)}
        assert {o for _, o in paths} == {"".join(c if c in tx.WRITTEN else "." for c in w) for w in ways}
        if not (word.count("R") and "Q" in word[: word.index("R")]):  # a quote that opens before anybody speaks
            assert set(said) == by_hand(word, weights)
        g = tx.Grammar([])
        assert g.clause(word) == g.clause(word.replace(".", "....")) or "." in word


def test_composition():
    a, b = Fst(0, final={0: 1.0}), Fst("x", final={"y": 0.5})
    a.arc(0, "a", "b", 0, 2.0)
    a.arc(0, "a", "c", 0, 1.0)
    b.arc("x", "c", "d", "y", 3.0)
    b.arc("y", "b", "e", "y")
    assert list(compose(a, b).paths("aa")) == [(1.0 + 3.0 + 2.0 + 1.5, "de")]
    assert compose(a, b).best("aa") == (7.5, "de") and compose(a, b).best("b") is None


def test_learns_stems_strong_and_weak(spark):
    clean = [f"a quiet text number n{i} about houses and gardens" for i in range(200)]
    rows = [(t, 0) for t in clean] + [(t + " grumplich", 0) for t in clean[:30]]
    rows += [(f"{clean[i]} blorfing and blorfer x{i}", 1) for i in range(20)] + [(f"{clean[i]} grumplich word grumplichen y{i} grumplicher", 1) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(rows)], "doc_id long, text string, _i string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    g = tx.learn(docs, labels)
    assert any("blorf".startswith(s) or s.startswith("blorf") for s in g.stems) and any(s.startswith("grump") for s in g.weak)
    score = lambda t: float(g.score(tx.np.array([g.patterns(t)]), tx.np.array([len(t)]))[0])
    assert score("some blorfing text") > 0.5 > score(clean[0]) and score(clean[3] + " grumplich") < 0.5


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "You idiot", "x"), (3, "You idiot", "x"), (None, "fine", "x"), (5, "idiot. " * 50_000, "x")], "doc_id long, text string, insult string")
    labels = spark.createDataFrame([(1, None), (77, 1), (None, 1)], "doc_id long, toxic int")
    assert tx.learn(docs, labels).stems == []
    got = tx.score(docs, tx.Grammar(["idiot"]), ["doc_id"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[1].score == by[2].score == by[None].score < 0.5 < by[3].score <= by[5].score <= 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tx.score(empty, tx.Grammar([]), ["doc_id"]).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="the driver's tables are not here")
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = tx.op2_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)
