import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docweave.operators.gating import All, Any, Leaf, Not, backed_off, gate, top_level

KIND = "answers map<string,struct<p:double,choice:string,score:double,probabilities:map<string,double>>>"


def outcome(spark, condition, answers, **kw):
    row = {k: (v.get("p"), v.get("choice"), v.get("score"), v.get("probabilities")) for k, v in answers.items()}
    return spark.createDataFrame([(row,)], KIND).select(gate(condition, **kw).alias("o")).first().o


@pytest.mark.parametrize("p, test, want", [(0.51, "is_yes", "accept"), (0.49, "is_yes", "reject"), (0.5, "is_yes", "reject"), (0.5, "is_no", "reject"), (0.49, "is_no", "accept")])
def test_a_tie_is_neither(spark, p, test, want):
    assert outcome(spark, Leaf("q", test), {"q": {"p": p}}) == want


def test_skipped_leaves_take_no_part(spark):
    skip, yes, no = Leaf("s", "is_yes", if_asked=True), Leaf("y", "is_yes"), Leaf("n", "is_yes")
    a = {"y": {"p": 0.9}, "n": {"p": 0.1}}
    assert outcome(spark, All((skip, yes)), a) == "accept"
    assert outcome(spark, All((skip, no)), a) == "reject"
    assert outcome(spark, All((skip,)), a) == "accept"
    assert outcome(spark, Not(skip), a) == "accept"
    assert outcome(spark, Any((skip, no)), a) == "reject"
    assert outcome(spark, None, a) == "accept"
    with pytest.raises(PySparkException):
        outcome(spark, Leaf("missing", "is_yes"), a)


def test_thresholds(spark):
    assert [backed_off(0.5, 0.5, k) if k else 0.5 for k in range(3)] == [0.5, 0.75, 0.875]
    assert outcome(spark, Leaf("q", "is_yes"), {"q": {"p": 0.7}}, attempt=0) == "accept"
    assert outcome(spark, Leaf("q", "is_yes"), {"q": {"p": 0.7}}, attempt=1) == "reject"
    assert outcome(spark, Leaf("q", "is_yes", threshold=0.6), {"q": {"p": 0.8}}, threshold=0.9) == "accept"
    with pytest.raises(ValueError):
        backed_off(1.5, 0.5, 0)


def test_levels_and_choices(spark):
    df = spark.createDataFrame([({"1": 0.2, "2": 0.5, "3": 0.3}, 0.0), ({"10": 0.5, "2": 0.5}, 0.0), ({}, 2.5)], "m map<string,double>, s double")
    assert [r.l for r in df.select(top_level(F.col("m"), F.col("s")).alias("l")).collect()] == [2, 10, 2]
    a = {"c": {"choice": "x"}, "l": {"score": 1.0, "probabilities": {"0": 0.1, "2": 0.9}}}
    assert outcome(spark, All((Leaf("c", "in", ["x", "y"]), Leaf("l", "level_in", [2]))), a) == "accept"
    assert outcome(spark, Leaf("c", "not_in", ["x"]), a) == "reject"
