import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import curation
from docweave.ids import canonical_json, sha_id, sha_text


def column(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("how, want", [("head", "abcd"), ("tail", "ghij"), ("head_tail", "ab\n…\nij")])
def test_truncate(spark, how, want):
    assert column(spark, "abcdefghij", "string", lambda c: tx.truncate(c, 4, how, per_token=1)) == want


def test_ids_agree_between_driver_and_columns(spark):
    row = spark.createDataFrame([("a", ["x", "é"])], "a string, b array<string>").select(sha_id("a", F.to_json("b")).alias("h")).first()
    assert row.h == sha_text("a", ["x", "é"])
    assert canonical_json({"b": 1, "a": "é"}) == '{"a":"é","b":1}'


def test_grounding():
    text = "The gateway retries twice. The GATEWAY's cache is cold. The gateway waits."
    assert tx.ground("retries twice", text)[0] == "exact"
    assert tx.ground("the  gateway’s cache", text)[0] == "normalised"
    assert tx.ground("gateway retries twise", text, 85)[0] == "fuzzy"
    assert tx.ground("database migrations", text)[0] == "ungrounded"
    assert tx.ground("The gateway", text) == ("exact", [(0, 11), (56, 67)])
    assert tx.ground("  The gateway ", text)[0] == "exact" and tx.ground(" ", text) == ("ungrounded", [])
    assert tx.ground("aa", "aaaa") == ("exact", [(0, 2), (1, 3), (2, 4)])
    assert tx.ground("STRASSE x", "in der Straße  x") == ("normalised", [(7, 16)])
    level, [(a, b)] = tx.ground("the  gateway’s cache", text)
    assert text[a:b] == "The GATEWAY's cache"


def test_named_values():
    known = ["9.0", "19.0", "9.1", "9.0.1", "Cloud Edition"]
    assert tx.named_values("Applies to VCF 9.0. See 19.0 too", known) == ["9.0", "19.0"]
    assert tx.named_values("release 9.1.1.0", known) == ["9.1"]
    assert tx.named_values("9.0.1.2 of Cloud Edition", known) == ["9.0.1", "Cloud Edition"]
    assert tx.named_values("an old vcf, VCF.local and CLOUD  edition", ["VCF", "Cloud Edition", "local"]) == ["VCF", "Cloud Edition"]
    assert tx.named_values("Version 10.0.0.1", known) == [] and tx.named_values("", known) == []


@pytest.mark.parametrize(
    "values, known, more",
    [(["9.1.1.0"], ["9.1", "9.0"], ["9.1", "9.1.1.0"]), (["9.1.1.0"], ["9.1.1.0", "19.1", "9.1"], ["9.1.1.0", "9.1"]), (["Box 9.0.2"], ["Box 9.0"], ["Box 9.0.2"]),
     (["9.0"], ["9.0", "9.1"], ["9.0"]), (["x", "9.1.2"], ["9.1", "x"], ["9.1", "x", "9.1.2"]), ([], ["9.0"], []), (["9"], [], ["9"]), (["9.1"], ["9"], ["9.1"])])
def test_broader_values(spark, values, known, more):
    assert column(spark, values, "array<string>", lambda c: tx.broader(c, known)) == more
    wide = column(spark, values, "array<string>", lambda c: tx.widened(c, known))
    assert wide == (more if set(more) - set(values) else values)
    assert column(spark, None, "array<string>", lambda c: tx.widened(c, known)) is None


def test_name_keys(spark):
    assert tx.name_key("The Postgres-SQL, Inc.", drop=["the", "inc"]) == "postgres sql"
    assert tx.name_key("STRASSE") == tx.name_key("straße")
    assert column(spark, "Supplier#0001 (Inc)", "string", lambda c: tx.plain_name_key(c, ["inc"])) == "supplier 0001"
    assert tx.token_set_ratio("vcenter server", "server vcenter appliance") == 100.0
    assert tx.token_set_ratio("alpha", "omega") < 60


def test_roles_of_chunks(spark):
    chunks = {
        "a": [("list", 10, True), ("paragraph", 4, False)], "b": [("list", 10, False), ("paragraph", 4, False)], "c": [("table", 10, False)], "d": [("code", 6, False), ("paragraph", 5, False)],
        "e": [("code", 5, False), ("paragraph", 5, False)], "f": [("heading", 3, False)], "g": [("paragraph", 0, False)], "h": [("heading", 50, False), ("table", 4, False), ("code", 3, False)]}
    rows = [(k, n, *u) for k, us in chunks.items() for n, u in enumerate(us)]
    df = spark.createDataFrame(rows, "id string, n int, kind string, tokens long, ordered boolean")
    got = {r.id: r.role for r in curation.structural_roles(df, "id").collect()}
    assert got == {"a": "procedure", "b": None, "c": "reference", "d": "example", "e": None, "f": "heading", "g": None, "h": "reference"}
    assert {r.role for r in curation.structural_roles(df.where("id = 'h'"), "id", 0.3).collect()} == {"reference"}


def test_sections_split_into_few_even_pieces_that_fit():
    assert tx.split_section([5] + [10] * 7, 40) == [(0, 4), (4, 8)]
    assert tx.split_section([6, 6, 6], 10) == [(0, 1), (1, 2), (2, 3)]
    assert len(tx.split_section([10] * 12, 35)) == 4
    assert tx.split_section([50, 10, 10], 1000) == [(0, 3)] and tx.split_section([], 10) == []
    assert tx.split_section([90, 10], 20) == [(0, 1), (1, 2)]
    units = [("paragraph", "t"), ("paragraph", "Run this:"), ("code", "t"), ("paragraph", "t")]
    assert tx.split_section([10] * 4, 30, [i for i, u in enumerate(units) if tx.leads_on(*u)]) == [(0, 3), (3, 4)]
    assert tx.split_section([10] * 4, 20, [0]) == [(0, 2), (2, 4)]
    rng = random.Random(1)
    for _ in range(200):
        sizes, cap = [rng.randint(1, 40) for _ in range(rng.randint(1, 20))], rng.randint(5, 80)
        spans = tx.split_section(sizes, cap, rng.sample(range(len(sizes)), len(sizes) // 3))
        assert [i for a, b in spans for i in range(a, b)] == list(range(len(sizes)))
        assert all(sum(sizes[a:b]) <= cap or b - a == 1 for a, b in spans)


def test_fit_text_keeps_lines_and_loses_only_breaks():
    assert tx.fit_text("A b.\n\nC d.", 100) == ["A b.\n\nC d."]
    assert tx.fit_text("aaaa bbbb\ncccc dddd", 3) == ["aaaa bbbb", "cccc dddd"]
    text = "One sentence here. " * 40 + "x" * 900 + "\n" + "word " * 200
    for parts in (tx.fit_text(text, 50), tx.split_unit("paragraph", text, 50), tx.split_unit("code", text, 50)):
        assert all(len(p) <= 200 for p in parts)
        assert "".join("".join(parts).split()) == "".join(text.split())
    assert tx.split_unit("paragraph", "One here. Two there. Three.", 5) == ["One here. Two there.", "Three."]
    assert tx.split_unit("paragraph", "Dr. Smith met Mr. Low. They left.", 6, frozenset({"dr", "mr"})) == ["Dr. Smith met Mr. Low.", "They left."]
    assert tx.split_unit("heading", "x" * 99, 5) == ["x" * 99]


def test_lines_of_spans():
    text = "one\ntwo three\nfour"
    assert [tx.line_of(text, a, b) for a, b in ((0, 3), (4, 7), (8, 13), (5, 15), (18, 18))] == ["one", "two three", "two three", "two three\nfour", "four"]


def test_renders_caps_and_languages(spark):
    assert tx.chunk_cap(512, 32000, 0.25, 2000, 0.5) == 256 and tx.chunk_cap(1, 1, 0.1, 1, 0.1) == 1
    rows = spark.createDataFrame([(["A", "B"], "T", "x"), ([], "", "y"), (None, None, None)], "p array<string>, t string, x string")
    assert [r.c for r in rows.select(tx.chunk_text(F.col("p"), F.col("t"), F.col("x")).alias("c")).collect()] == ["A > B\nT\nx", "y", ""]
    ents = spark.createDataFrame([("n", "k", "d"), ("n", "k", None)], "n string, k string, d string")
    assert [r.c for r in ents.select(tx.entity_text(F.col("n"), F.col("k"), F.col("d")).alias("c")).collect()] == ["n (k): d", "n (k)"]
    texts = spark.createDataFrame([("the cat and the dog",), ("der Hund und die Katze",), ("zzz",), ("le chat et les chiens",)], "t string")
    assert [r.l for r in texts.select(tx.language(F.col("t"), ["en", "de"], "xx").alias("l")).collect()] == ["en", "de", "xx", "xx"]


@pytest.mark.parametrize("k, n, p, low", [(7, 8, 0.5, True), (6, 8, 0.5, False), (30, 100, 0.15, True), (160, 1000, 0.15, False), (200, 1000, 0.15, True)])
def test_binomial_tail(spark, k, n, p, low):
    got = spark.range(1).select(curation.binomial_tail(F.lit(k), F.lit(n), p).alias("t")).first().t
    assert (got < 0.05) is low
    assert got == pytest.approx(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1)))


def test_evolution_due(spark):
    picks = ["other"] * 30 + ["rel"] * 70 + ["none"] * 900
    rows = [("a", p) for p in picks] + [("b", "other")] * 4 + [("c", "other")] * 5 + [("d", "none")]
    df = spark.createDataFrame(rows, "stage string, pick string")
    got = {r.stage: (r.due, r.others, r.named) for r in curation.evolution_due(df, "stage", 0.5, 0.15).collect()}
    assert got == {"a": (True, 30, 100), "b": (False, 4, 4), "c": (True, 5, 5), "d": (False, 0, 0)}
    final = {r.stage: r.due for r in curation.evolution_due(df, "stage", 0.5, 0.15, final=True).collect()}
    assert final == {"a": True, "b": False, "c": True, "d": False}


def test_tidy_and_embedding(spark):
    assert column(spark, "a\xa0 b\t\n\n\n\n c ", "string", tx.tidied) == "a b\n\nc"
    v = column(spark, "alpha beta beta", "string", lambda c: tx.embedder(16)(c))
    assert sum(x * x for x in v) == pytest.approx(1, abs=1e-6)
    assert column(spark, "", "string", lambda c: tx.embedder(4)(c)) == [0, 0, 0, 0]


def test_pieces_of_texts_leave_as_they_are_made(spark, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.choice([0, 3, 16, 17, 400]))) for _ in range(40)] + [None, "\n" * 40, "x" * 90]
    want = [(i, n, c) for i, t in enumerate(texts) if t is not None for n, c in enumerate(tx.fit_text(t, 4))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(3)
    found = tx.fitted(df, "id", "t", 4)
    assert found.columns == ["id", "ord", "chunk"] and sorted(map(tuple, found.collect())) == want
    monkeypatch.setattr(tx, "HELD", 50)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "t"])
    parts = list(tx._fitted(4)(iter([batch])))
    assert len(parts) > 10 and all(sum(map(len, p.column("chunk").to_pylist())) < 50 + 16 for p in parts)
    assert [tuple(r.values()) for p in parts for r in p.to_pylist()] == want
