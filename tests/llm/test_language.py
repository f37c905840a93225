import os
import random

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import language as lg


def phrases_by_hand(text, sample):
    """Greedy longest phrases of text that occur in sample; an unknown character is a phrase."""
    count, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i : i + n + 1] in sample and text[i : i + n] in sample:
            n += 1
        count, i = count + 1, i + n
    return count


def test_parse_equals_greedy_search():
    rng = random.Random(2)
    samples = {"x": "".join(rng.choice("abc ") for _ in range(300)), "y": "".join(rng.choice("bcd ") for _ in range(200))}
    model = lg.fit(samples)
    texts = ["".join(rng.choice("abcd e") for _ in range(rng.randint(1, 60))) for _ in range(50)]
    pieces = [model.classes[np.frombuffer(t.encode(), np.uint8)] for t in texts]
    got = lg.phrases(model, pieces, 64)
    assert got.tolist() == [[phrases_by_hand(t, samples[k]) for k in model.languages] for t in texts]


def test_odd_rows(spark):
    en, de = "the house of the people and their trees is here ", "der die das und ein haus ist nicht hier gewesen "
    rows = [(i, (en if i % 2 else de) * 8 + str(i), "en" if i % 2 else "de") for i in range(30)]
    model = lg.learn(spark.createDataFrame([*rows, (99, None, "en"), (98, "abc", None)], "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    odd = [(1, None), (2, ""), (3, "123 ... !"), (4, "The People"), (5, "nicht gewesen"), (5, "nicht gewesen"), (None, "THE TREES"), (7, (en + "\n") * 30_000), (8, "漢字だけ")]
    docs = spark.createDataFrame([(*r, "z") for r in odd], "doc_id long, text string, score string")
    got = lg.identify(docs, model, ["doc_id"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(odd)
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert (by[4].lang_pred, by[5].lang_pred, by[None].lang_pred, by[7].lang_pred) == ("en", "de", "en", "en")
    assert by[8].lang_pred in ("de", "en") and all(0 <= r.score <= 1 for r in got)


def test_no_language_is_lost_to_copies_and_any_part_of_a_text_is_learned(spark):
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))
    many = spark.range(10_000).selectExpr("'ein haus ist nicht hier gewesen und der mann' AS text", "'de' AS lang")
    some = [(" ".join(word("aeiourst") for _ in range(200)), "en") for _ in range(500)]
    late = "x" * 40_000 + " ".join(word("bcdfgz") for _ in range(20_000))  # one long row of a third language
    rows = many.unionByName(spark.createDataFrame([*some, (late, "zz")], "text string, lang string")).repartition(8)
    params = lg.Parsing(sample_chars=6000)
    model = lg.learn(rows, params=params)
    assert model.languages == ["de", "en", "zz"]
    docs = spark.createDataFrame([(1, "der mann ist hier"), (2, some[7][0]), (3, late[-800:])], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in lg.identify(docs, model, ["doc_id"], params=params).collect()}
    assert got == {1: "de", 2: "en", 3: "zz"}
    assert model.roots.max() // model.width < 2 * 3 * 8000  # no sample follows the input


def test_nothing_learned_and_empty(spark):
    none = lg.fit({})
    assert lg.classify(none, pa.array(["abc", None]), lg.Parsing()) == (["und", "und"], [0.0, 0.0])
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert lg.learn(empty).languages == [] and lg.identify(empty, none, ["doc_id"]).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = lg.op4_language(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got) > 100
