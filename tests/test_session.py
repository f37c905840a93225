import pytest

from docweave.functions.text import hashed_vector
from docweave.plans import provider
from docweave.session import Filters, GraphSession, Plan

TEXTS = ["red house by the river", "blue house on the hill", "a river of stones", "nothing of note", "the old mill and the river"]


@pytest.fixture()
def session(spark, tmp_path):
    root = str(tmp_path / "graph")
    docs = [(f"d{i}", "guide" if i < 3 else "note", "en", i == 4) for i in range(5)]
    spark.createDataFrame(docs, "doc_id string, doc_type string, language string, quarantined boolean").write.parquet(f"{root}/documents")
    chunks = [(f"c{i}", f"d{i}", 0, t, "accepted" if i != 3 else "superseded", "concept", len(t), hashed_vector(t, 32)) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(chunks, "chunk_id string, doc_id string, ord int, text string, status string, role string, tokens long, embedding array<double>").write.parquet(f"{root}/chunks")
    edges = [("e1", "c0", "c2", "cites", 0.9, False, "accepted"), ("e2", "c2", "c1", "cites", 0.5, False, "accepted"), ("e3", "c0", "c4", "cites", 0.9, False, "accepted"), ("e4", "c0", "c1", "NEXT", 1.0, True, "accepted")]
    spark.createDataFrame([(*e, "chunk", "chunk") for e in edges], "edge_id string, src_id string, dst_id string, rel string, weight double, structural boolean, status string, src_kind string, dst_kind string").write.parquet(f"{root}/edges")
    spark.createDataFrame([("k1", ["c0", "c2"], "accepted"), ("k2", ["c1"], "superseded")], "community_id string, member_ids array<string>, status string").write.parquet(f"{root}/communities")
    return GraphSession(spark, root, 32)


def test_search_filters_and_order(session):
    got = [r.id for r in session.search("red house", 10).orderBy("rank").collect()]
    assert got[0] == "c0" and set(got) == {"c0", "c1", "c2"}  # c3 is superseded, d4 quarantined
    assert [r.id for r in session.search("house", 10, Filters(docs=("d1",))).collect()] == ["c1"]
    assert session.search("house", 10, Filters(doc_types=("note",))).collect() == []
    turned = session.search("red house", 1, judge=lambda c: c.selectExpr("id", "CASE WHEN id = 'c2' THEN 1.0 ELSE 0.0 END AS score")).first()
    assert turned.id == "c2"


def test_context_and_communities(session):
    far = session.context("red house", Plan(seeds=1, hops=2, tokens=1000)).orderBy("passage").collect()
    assert [(r.passage, r.id) for r in far] == [("p1", "c0"), ("p2", "c1"), ("p3", "c2")]
    assert [r.id for r in session.context("red house", Plan(seeds=1, hops=1, tokens=1000)).orderBy("passage").collect()] == ["c0", "c2"]
    assert [r.id for r in session.context("red house", Plan(seeds=1, hops=2, relations=("other",))).collect()] == ["c0"]
    assert [r.community_id for r in session.communities(["c2", "c1"]).collect()] == ["k1"]


def test_updates_swap_tables_and_stop_at_a_failure(session, spark):
    drop = lambda s, made: {"chunks": s.table("chunks").where("chunk_id <> 'c0'")}

    def fails(s, made):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        session.update([drop, fails, lambda s, made: {"chunks": s.table("chunks").limit(0)}])
    assert session.table("chunks").count() == 4 and spark.read.parquet(f"{session.root}/chunks_prev").count() == 5


def test_known_answers_are_not_asked_again(spark):
    items = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "item_id string, state string")
    asked = provider.render(items, "link@1", [provider.Question("related")])
    known = provider.answer(asked.where("state = 'x'"))
    assert known.count() == 1

    def refuses(question, kind, options, levels, state):
        if state == "x":
            raise ValueError("asked again")
        return 0.5, None, None

    got = provider.answer(asked, known, refuses)
    assert got.count() == 2 and provider.valid(asked, got).count() == 3
