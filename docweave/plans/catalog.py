"""The query catalogue over the driver tables, each with its DuckDB twin where SQL can express it.

Orders stand for chunks and parts for the entities they mention; documents and
labels for chunks with decisions; events for the work ledger; near embeddings
for edges. Doubles are rounded, every ranking ends in an id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions import vectors as vec
from docweave.ids import sha_id, short_key, unit_fraction
from docweave.operators import audit, communities, gating, graph, knn, merging, search, training
from docweave.operators import relational as rel
from docweave.operators.components import connected_components
from docweave.operators.text_index import Report, TextIndex
from docweave.sinks.export import fingerprint
from docweave.storage import delete_on_exit, scratch, shared_dir, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def take(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"a query of this name is there already: {f.__name__}")
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return take


def long(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# ---- vectors and candidates --------------------------------------------------------

KNN_SQL = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
d AS (SELECT a.vec_id AS vec_id, b.vec_id AS neighbor_id, a.label AS la, b.label AS lb, round(1 - list_cosine_similarity(a.e, b.e), 9) AS dist
      FROM v a JOIN v b ON a.vec_id <> b.vec_id {where}),
r AS (SELECT vec_id, neighbor_id, dist, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbor_id) AS rank FROM d)
"""


def _knn(spark: SparkSession, sf_dir: str, k: int, group: str | None = None) -> DataFrame:
    return knn.nearest(table(spark, sf_dir, "embeddings"), k, "vec_id", "embedding", group)


@query(KNN_SQL.format(where="") + "SELECT vec_id, neighbor_id, rank::INT AS rank, round(dist, 6) AS dist FROM r WHERE rank <= 12")
def knn_exact_topk(spark, sf_dir):
    """The 12 nearest others of every vector."""
    return _knn(spark, sf_dir, 12).select(F.col("id").alias("vec_id"), F.col("neighbor").alias("neighbor_id"), "rank", F.round("dist", 6).alias("dist"))


@query(KNN_SQL.format(where="AND a.label <> b.label") + "SELECT vec_id, neighbor_id, rank::INT AS rank, round(dist, 6) AS dist FROM r WHERE rank <= 5")
def knn_group_excluded(spark, sf_dir):
    """The 5 nearest vectors of other groups."""
    return _knn(spark, sf_dir, 5, "label").select(F.col("id").alias("vec_id"), F.col("neighbor").alias("neighbor_id"), "rank", F.round("dist", 6).alias("dist"))


UNION_SQL = KNN_SQL.format(where="") + """,
g AS (SELECT vec_id, neighbor_id, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbor_id) AS rank FROM d WHERE la <> lb),
u AS (SELECT least(vec_id, neighbor_id) AS a, greatest(vec_id, neighbor_id) AS b, 'ann' AS s FROM r WHERE rank <= 5
      UNION ALL SELECT least(vec_id, neighbor_id), greatest(vec_id, neighbor_id), 'cross_group' FROM g WHERE rank <= 3)
SELECT a, b, array_to_string(list_sort(list(DISTINCT s)), ',') AS sources FROM u GROUP BY a, b
"""


@query(UNION_SQL)
def candidate_union_sources(spark, sf_dir):
    """Unordered candidate pairs and the generators that gave them."""
    pairs = lambda df: df.select(F.col("id").alias("a"), F.col("neighbor").alias("b"))
    found = rel.candidate_union(ann=pairs(_knn(spark, sf_dir, 5)), cross_group=pairs(_knn(spark, sf_dir, 3, "label")))
    return found.select("a", "b", F.array_join("sources", ",").alias("sources"))


@query("""
WITH m AS (SELECT DISTINCT l_orderkey AS a, l_partkey AS e FROM lineitem),
p AS (SELECT x.a AS a, y.a AS b, count(*) AS shared FROM m x JOIN m y ON x.e = y.e AND x.a <> y.a GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) AS rank FROM p)
SELECT a, b, shared, rank::INT AS rank FROM r WHERE rank <= 3
""")
def shared_entity_pairs(spark, sf_dir):
    """For each order the 3 others that share most parts."""
    return rel.shared_entity_pairs(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", 3)


@query("""
SELECT DISTINCT x.o_orderkey AS a, y.o_orderkey AS b FROM orders x JOIN orders y ON x.o_custkey = y.o_custkey AND x.o_orderkey < y.o_orderkey
ORDER BY a, b LIMIT 2000
""")
def section_pairs_capped(spark, sf_dir):
    """The first 2000 pairs of orders of one customer; the cap is over all sections, as the operator has it."""
    return rel.section_pairs(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", 2000)


@query("""
SELECT conv_id, turn AS src, lead(turn) OVER w AS dst, lower(sha256(conv_id::VARCHAR || chr(31) || turn::VARCHAR || chr(31) || (lead(turn) OVER w)::VARCHAR || chr(31) || 'NEXT' || chr(31))) AS edge_id
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn) QUALIFY dst IS NOT NULL
""")
def next_edges(spark, sf_dir):
    """NEXT edges between consecutive turns."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("src"), F.lead("turn").over(w).alias("dst")).where("dst IS NOT NULL")
    return pairs.withColumn("edge_id", sha_id(F.col("conv_id").cast("string"), F.col("src").cast("string"), F.col("dst").cast("string"), F.lit("NEXT")))


# ---- documents, units, chunks --------------------------------------------------------


@query("""
WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE text IS NOT NULL), f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h)
SELECT doc_id AS src, first AS dst, sha256(doc_id::VARCHAR || chr(31) || first::VARCHAR || chr(31) || 'DUPLICATE_OF' || chr(31)) AS edge_id
FROM h JOIN f USING (h) WHERE doc_id <> first
""")
def duplicate_of_edges(spark, sf_dir):
    """Every copy of a text points at the lowest document that has it."""
    return rel.duplicate_edges(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("""
WITH c AS (SELECT md5(text) AS h, min(doc_id) AS chunk_id, min(text) AS t, count(*) AS uses FROM documents WHERE text IS NOT NULL GROUP BY md5(text), text)
SELECT chunk_id, uses, length(t) AS n_chars FROM c WHERE uses > 1
""")
def reusable_chunk_text(spark, sf_dir):
    """Texts used more than once, with the chunk to reuse; the hash is joined on together with the text."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.groupBy(F.md5("text").alias("h"), "text").agg(F.min("doc_id").alias("chunk_id"), F.count("*").alias("uses")).where("uses > 1").select(
        "chunk_id", "uses", long(F.char_length("text")).alias("n_chars"))


@query("""
WITH c AS (SELECT doc_id, text, doc_id % 17 AS run FROM documents WHERE text IS NOT NULL), f AS (SELECT user_id % 17 AS run FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_type = 'error') * 5 < count(*))
SELECT min(doc_id) AS chunk_id, count(*) AS uses, md5(text) AS digest FROM c WHERE run IN (SELECT run FROM f) GROUP BY text
""")
def reusable_from_finished_runs(spark, sf_dir):
    """Texts with the chunk to reuse, from runs that finished."""
    chunks = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text", (F.col("doc_id") % 17).alias("run_id"))
    e = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 17).alias("run_id")).agg(F.count_if(F.col("event_type") == "error").alias("failed"), F.count("*").alias("n"))
    runs = e.select("run_id", F.when(F.col("failed") * 5 < F.col("n"), "finished").otherwise("failed").alias("status"))
    return rel.reusable(chunks, runs).select("chunk_id", "uses", F.md5("text").alias("digest"))


@query("""
WITH u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS ord FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, ord, length(t) AS n, sum(length(t) + 2) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM u)
SELECT doc_id, ord::BIGINT AS ord, coalesce(s, 0)::BIGINT AS char_start, (coalesce(s, 0) + n)::BIGINT AS char_end FROM s
""")
def unit_offsets(spark, sf_dir):
    """Lines as units, with offsets in the text that puts an empty line between units."""
    u = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "t"))
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("t") + 2).over(before), F.lit(0))
    return u.select("doc_id", long("ord").alias("ord"), long(start).alias("char_start"), long(start + F.char_length("t")).alias("char_end"))


@query("""
WITH m AS (SELECT conv_id, turn, role, lag(role) OVER w AS before, lag(turn) OVER w AS prev FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, prev AS prev_turn, sum((role = 'user' AND before IS DISTINCT FROM 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS section FROM m
""")
def section_ids_prev_heading(spark, sf_dir):
    """Running section numbers: a section begins where a user's turn follows another role's; and the turn before."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    m = table(spark, sf_dir, "conversations").withColumns({"before": F.lag("role").over(w), "prev_turn": F.lag("turn").over(w)})
    begins = ((F.col("role") == "user") & ~F.col("before").eqNullSafe("user")).cast("int")
    return m.select("conv_id", "turn", "prev_turn", long(F.sum(begins).over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("section"))


@query("""
SELECT doc_id, ceil(length(text) / 4.0)::BIGINT AS tokens,
       md5(CASE WHEN length(text) > 200 THEN text[1:200] ELSE text END) AS head, md5(CASE WHEN length(text) > 200 THEN right(text, 200) ELSE text END) AS tail,
       md5(CASE WHEN length(text) > 200 THEN text[1:100] || chr(10) || '…' || chr(10) || right(text, 100) ELSE text END) AS head_tail
FROM documents
""")
def token_estimate_truncate(spark, sf_dir):
    """Estimated tokens, and digests of the text truncated to 50 tokens three ways."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.tokens(F.col("text")).alias("tokens"), *[F.md5(tx.truncate(F.col("text"), 50, how)).alias(how) for how in ("head", "tail", "head_tail")])


@query("""
SELECT d.doc_id, d.lang, length(string_split(d.text, chr(10))[1])::BIGINT AS first_end, length(string_split(d.text, chr(10))[-1])::BIGINT AS last_len
FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1 AND NOT coalesce(l.toxic = 1, false) AND d.lang IN ('en', 'de')
""")
def search_filter_hydrate(spark, sf_dir):
    """Accepted documents that aren't quarantined, of some languages, with their first and last unit."""
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    live = (F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False)) & F.col("lang").isin("en", "de")
    units = F.split("text", "\n")
    return d.join(l, "doc_id").where(live).select("doc_id", "lang", long(F.char_length(F.element_at(units, 1))).alias("first_end"), long(F.char_length(F.element_at(units, -1))).alias("last_len"))


# ---- text search ---------------------------------------------------------------------

TERMS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')"
_INDEXES: dict[tuple[str, str], TextIndex] = {}


def text_index(spark: SparkSession, sf_dir: str) -> TextIndex:
    """The inverted index of the documents of a folder, written once for an application and read by all searches."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXES or not _INDEXES[key].exists():
        where = f"{shared_dir(spark).rstrip('/')}/docweave-text-index-{uuid.uuid4().hex}"
        delete_on_exit(spark, where)
        _INDEXES[key] = TextIndex.build(table(spark, sf_dir, "documents"), "doc_id", "text", where)
    return _INDEXES[key]


@query(f"""
WITH t AS (SELECT doc_id, {TERMS} AS ts FROM documents), s AS (SELECT doc_id, ts, ' ' || array_to_string(ts, ' ') || ' ' AS j FROM t)
SELECT doc_id FROM s WHERE ((list_contains(ts, 'and') AND contains(j, ' of the ')) OR list_contains(ts, 'der')) AND NOT list_contains(ts, 'trash')
""")
def fts_match_and_or_phrase_not(spark, sf_dir):
    """Documents that match a web-style query."""
    return text_index(spark, sf_dir).match(search.websearch('and "of the" or der -trash')).select(F.col("id").alias("doc_id"))


BM25_SQL = f"""
WITH t AS (SELECT doc_id AS id, {TERMS} AS ts FROM documents),
m AS (SELECT count(*)::DOUBLE AS docs, avg(len(ts)) AS mean FROM t),
p AS (SELECT id, len(ts) AS n, unnest(ts) AS term FROM t), f AS (SELECT id, n, term, count(*) AS tf FROM p WHERE term IN ('thing', 'clown', 'und', 'avec') GROUP BY ALL),
d AS (SELECT term, count(*) AS df FROM f GROUP BY term),
s AS (SELECT id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 9) AS score FROM f JOIN d USING (term), m GROUP BY id),
r AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM s QUALIFY rank <= 50)
"""


def _bm25(spark, sf_dir):
    return text_index(spark, sf_dir).top(["thing", "clown", "und", "avec"], 50)


@query(BM25_SQL + "SELECT id AS doc_id, round(score, 6) AS score, rank::INT AS rank FROM r")
def bm25_topk(spark, sf_dir):
    """The 50 best documents for a bag of words."""
    return _bm25(spark, sf_dir).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


@query()
def index_reads(spark, sf_dir):
    """What bm25_topk reads of the index: blocks and postings of its terms, and of them those whose bound reaches the threshold."""
    report = Report()
    text_index(spark, sf_dir).top(["thing", "clown", "und", "avec"], 50, report=report)
    return spark.createDataFrame([tuple(vars(report).values())], "blocks long, blocks_read long, postings long, postings_read long")


@query(BM25_SQL + """, x AS (SELECT doc_id AS id, row_number() OVER (ORDER BY length(text) DESC, doc_id) AS rank FROM documents QUALIFY rank <= 50),
u AS (SELECT id, rank FROM r UNION ALL SELECT id, rank FROM x)
SELECT id AS doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS rrf FROM u GROUP BY id""")
def rrf_fusion(spark, sf_dir):
    """Reciprocal-rank fusion of a text ranking and a ranking by length."""
    longest = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.char_length("text").alias("n")).orderBy(F.desc("n"), "id").limit(50)
    ranked = longest.select("id", F.row_number().over(Window.orderBy(F.desc("n"), "id")).alias("rank"))
    return search.reciprocal_ranks(_bm25(spark, sf_dir), ranked).select(F.col("id").alias("doc_id"), F.round("rrf", 6).alias("rrf"))


@query("""
SELECT doc_id, round(0.5 * coalesce(quality, 0) + 0.4 * (n_chars % 100) / 100.0 - 0.1 * coalesce(toxic, 0), 6)::DOUBLE AS score
FROM documents LEFT JOIN labels USING (doc_id) ORDER BY score DESC, doc_id LIMIT 100
""")
def composite_rerank(spark, sf_dir):
    """The 100 documents of greatest weighted answer, unanswered questions counting nothing."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    features = {"quality": (0.5, F.col("quality")), "length": (0.4, F.col("n_chars") % 100 / 100.0), "toxic": (-0.1, F.col("toxic"))}
    return rel.reranked(d, features, "doc_id", 100)


@query(f"""
WITH t AS (SELECT doc_id AS id, {TERMS} AS ts FROM documents WHERE doc_id < 1000000), p AS (SELECT DISTINCT id, unnest(ts) AS term FROM t),
k AS (SELECT doc_id AS id, unnest(string_split('clown,idiot,moron,trash,scum,loser', ',')) AS term FROM labels WHERE toxic = 1),
h AS (SELECT k.id, p.id AS neighbour, count(*) AS score FROM k JOIN p USING (term) WHERE k.id <> p.id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, neighbour) AS rank FROM h)
SELECT id, neighbour, score, rank::INT AS rank FROM r WHERE rank <= 3
""".replace(" WHERE doc_id < 1000000", ""))
def keyword_fts_candidates(spark, sf_dir):
    """For each labelled document with keywords, the 3 others that hold most of them."""
    words = ["clown", "idiot", "moron", "trash", "scum", "loser"]
    asks = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"), F.explode(F.array(*[F.lit(w) for w in words])).alias("keyword"))
    return rel_order(search.keyword_matches(asks, text_index(spark, sf_dir).postings(words), 3))


def rel_order(df: DataFrame) -> DataFrame:
    return df.select("id", "neighbour", "score", "rank")


# ---- decisions and gates -------------------------------------------------------------


@query(KNN_SQL.format(where="") + """
SELECT vec_id, neighbor_id, (0.4 * round(1 - dist, 6) + 0.3 * (rank = 1)::INT + 0.2 * round((13 - rank) / 12.0::DOUBLE, 6))::DECIMAL(18,4)::DOUBLE AS weight FROM r WHERE rank <= 12
""")
def edge_weight_features(spark, sf_dir):
    """Weighted features of candidate edges: similarity, being first, strength by rank; a missing feature counts nothing."""
    e = _knn(spark, sf_dir, 12)
    strength = F.round((F.lit(13) - F.col("rank")) / F.lit(12.0), 6)
    weight = rel.weighted({"similarity": (0.4, F.round(1 - F.col("dist"), 6)), "first": (0.3, (F.col("rank") == 1).cast("int")), "strength": (0.2, strength)})
    return e.select(F.col("id").alias("vec_id"), F.col("neighbor").alias("neighbor_id"), weight.cast("decimal(18,4)").cast("double").alias("weight"))


@query("""
WITH q AS (SELECT event_id, (value * 7) % 1.0 AS p, CASE WHEN event_id % 3 = 0 THEN NULL ELSE (event_id % 10) / 10.0 END AS asked, event_type FROM events)
SELECT event_id, CASE WHEN p > 0.5 AND (asked IS NULL OR 1 - asked > 0.5) AND event_type NOT IN ('error') THEN 'accept' ELSE 'reject' END AS outcome FROM q
""")
def gate_yes_no_skip(spark, sf_dir):
    """A compiled gate with a yes leaf, a no leaf that may be skipped, and a choice."""
    answer = "struct<p:double,choice:string,score:double,probabilities:map<string,double>>"
    make = lambda p, choice: F.struct(p.cast("double").alias("p"), choice.alias("choice"), F.lit(None).cast("double").alias("score"), F.lit(None).cast("map<string,double>").alias("probabilities")).cast(answer)
    none = F.lit(None).cast("string")
    asked = F.when(F.col("event_id") % 3 != 0, make((F.col("event_id") % 10) / 10.0, none))
    answers = F.map_filter(
        F.create_map(F.lit("related"), make((F.col("value") * 7) % 1.0, none), F.lit("wrong"), asked, F.lit("kind"), make(F.lit(None), F.col("event_type"))), lambda k, v: v.isNotNull())
    condition = gating.All((gating.Leaf("related", "is_yes"), gating.Leaf("wrong", "is_no", if_asked=True), gating.Leaf("kind", "not_in", ["error"])))
    return table(spark, sf_dir, "events").select("event_id", answers.alias("answers")).select("event_id", gating.gate(condition).alias("outcome"))


@query("SELECT event_type, count(*) AS n, round(avg((value > 50)::INT), 4) AS accept_rate FROM events GROUP BY event_type")
def outcome_rates(spark, sf_dir):
    """Accept rates by question set."""
    d = table(spark, sf_dir, "events").withColumn("outcome", F.when(F.col("value") > 50, "accept").otherwise("reject"))
    return audit.outcome_rates(d, "event_type")


@query("""
WITH r AS (SELECT event_type AS base, count(*) AS n, round(avg((value > 50)::INT), 4) AS rate FROM events GROUP BY event_type)
SELECT base, n::BIGINT AS n, rate FROM r UNION ALL SELECT 'overall', sum(n)::BIGINT, round(sum(n * rate) / sum(n), 4) FROM r
""")
def pass_rate_weighted(spark, sf_dir):
    """Pass rates by base name and overall."""
    d = table(spark, sf_dir, "events").select(F.concat("event_type", F.lit("@2")).alias("qs"), F.when(F.col("value") > 50, "accept").otherwise("reject").alias("outcome"))
    return audit.weighted_pass_rate(d, "qs")


@query("SELECT event_type AS stage, (user_id % 4)::INT AS status, count(*) AS n FROM events GROUP BY 1, 2")
def stage_counts(spark, sf_dir):
    """Work items by stage and status."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("stage"), (F.col("user_id") % 4).cast("int").alias("status")).agg(F.count("*").alias("n"))


@query("""
SELECT l_shipmode_ AS kind, count(*) AS reviewed, count(*) FILTER (WHERE v <> o) AS overturned, round(count(*) FILTER (WHERE v <> o) / count(*)::DOUBLE, 4) AS rate
FROM (SELECT l_returnflag AS l_shipmode_, CASE WHEN l_quantity > 25 THEN 'accept' ELSE 'reject' END AS v, CASE WHEN l_discount > 0.04 THEN 'accept' ELSE 'reject' END AS o FROM lineitem) GROUP BY 1
""")
def overturn_rates(spark, sf_dir):
    """How often reviews differ from decisions, by kind."""
    r = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("kind"), F.when(F.col("l_quantity") > 25, "accept").otherwise("reject").alias("v"), F.when(F.col("l_discount") > 0.04, "accept").otherwise("reject").alias("o"))
    return audit.overturn_rates(r, "kind", "v", "o")


@query("SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM embeddings) AS vectors, (SELECT count(*) FROM lineitem) AS edges, (SELECT count(*) FROM labels WHERE quality = 1) AS accepted")
def graph_summary_scalars(spark, sf_dir):
    """Four counts in one row."""
    for name in ("documents", "embeddings", "lineitem", "labels"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"_sum_{name}")
    return spark.sql("SELECT (SELECT count(*) FROM _sum_documents) AS documents, (SELECT count(*) FROM _sum_embeddings) AS vectors, (SELECT count(*) FROM _sum_lineitem) AS edges, (SELECT count(*) FROM _sum_labels WHERE quality = 1) AS accepted")


# ---- aggregates -----------------------------------------------------------------------


@query("""
SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey
""")
def ordered_array_aggs(spark, sf_dir):
    """Distinct sorted and ordered aggregated lists."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"].cast("string"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"), F.array_join(ordered, ",").alias("parts"))


@query("""
WITH k AS (SELECT p_brand AS cluster, p_partkey AS member, unnest(['type', 'size', CASE WHEN p_partkey % 3 = 0 THEN 'odd' ELSE 'price' END]) AS key,
  unnest([p_type, p_size::VARCHAR, round(p_retailprice)::BIGINT::VARCHAR]) AS value FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster, key ORDER BY member) AS n FROM k)
SELECT cluster, key, value FROM r WHERE n = 1
""")
def attribute_merge_first_wins(spark, sf_dir):
    """Attributes of a cluster's members merged, the first member that has a key wins."""
    third = F.when(F.col("p_partkey") % 3 == 0, "odd").otherwise("price")
    entries = F.array(F.struct(F.lit("type").alias("key"), F.col("p_type").alias("value")), F.struct(F.lit("size").alias("key"), F.col("p_size").cast("string").alias("value")),
                      F.struct(third.alias("key"), F.round("p_retailprice").cast("long").cast("string").alias("value")))
    e = table(spark, sf_dir, "part").select(F.col("p_brand").alias("cluster"), F.col("p_partkey").alias("member"), F.explode(entries).alias("e")).select("cluster", "member", "e.key", "e.value")
    return rel.merged_attributes(e, "cluster", "member")


@query("SELECT DISTINCT event_type, (props::JSON ->> 'k') AS value FROM events WHERE props IS NOT NULL")
def distinct_json_values(spark, sf_dir):
    """Distinct values of a JSON key."""
    return table(spark, sf_dir, "events").where("props IS NOT NULL").select("event_type", F.get_json_object("props", "$.k").alias("value")).distinct()


@query("""
WITH d AS (SELECT l_partkey AS node, count(*) AS degree FROM lineitem GROUP BY 1), c AS (SELECT quantile_cont(degree, 0.99) AS cut FROM d)
SELECT node, degree, round(cut, 6) AS cut FROM d, c WHERE degree > cut AND degree >= 3
""")
def hub_degree_p99(spark, sf_dir):
    """Parts above the interpolated 99th percentile of degrees."""
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"))
    return graph.hubs_of(edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree")), 0.99, 3).select("node", "degree", F.round("cut", 6).alias("cut"))


@query("""
WITH p AS (SELECT value AS old, lead(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS new, event_type FROM events),
q AS (SELECT old / 100 AS old, new / 100 AS new FROM p WHERE new IS NOT NULL)
SELECT count(*) AS compared, count(*) FILTER (WHERE (old >= 0.5) <> (new >= 0.5)) AS flips, round(stddev_pop(new - old), 6) AS stdev FROM q
""")
def drift_stats(spark, sf_dir):
    """Drift between consecutive answers."""
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    p = table(spark, sf_dir, "events").select((F.col("value") / 100).alias("old"), (F.lead("value").over(w) / 100).alias("new")).where("new IS NOT NULL")
    return audit.drift(p).select("compared", "flips", F.round("stdev", 6).alias("stdev"))


@query("""
WITH s AS (SELECT count(DISTINCT o_custkey) AS items, count(*) AS calls FROM orders), t AS (SELECT count(*) * 1.0 AS tokens FROM lineitem)
SELECT items, calls, round(greatest(calls / 1200.0 * 60, tokens * 250 / 250000.0) + items * 0.5 / 8, 6)::DOUBLE AS seconds FROM s, t
""")
def plan_estimate(spark, sf_dir):
    """The planner's time: the slower of the call and token limits, and drafting time over its concurrency."""
    s = table(spark, sf_dir, "orders").agg(F.countDistinct("o_custkey").alias("items"), F.count("*").alias("calls"))
    t = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("tokens"))
    seconds = audit.planned_seconds(F.col("calls"), F.col("tokens") * 250, F.col("items"), 1200, 250_000 * 60, 0.5, 8)
    return s.join(F.broadcast(t)).select("items", "calls", F.round(seconds, 6).alias("seconds"))


# ---- graph -----------------------------------------------------------------------------

EDGES_SQL = KNN_SQL.format(where="") + """, e AS (
SELECT vec_id AS src, neighbor_id AS dst, 'similar' AS rel, (hash_ % 10 < 3) AS directed, CASE WHEN hash_ % 5 = 0 THEN 'rejected' ELSE 'accepted' END AS status,
       round(1 - dist, 6) AS weight, vec_id::VARCHAR || '-' || neighbor_id::VARCHAR AS edge_id
FROM (SELECT *, (vec_id * 31 + neighbor_id * 17) AS hash_ FROM r WHERE rank <= 4))
"""


_EDGE_TABLES: dict[tuple[str, str], DataFrame] = {}


def _edges(spark, sf_dir):
    """Edges between near vectors, as a table: written once for an application and folder, and read by all that asks for edges."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EDGE_TABLES or not written(spark, _EDGE_TABLES[key]._scratch):
        _EDGE_TABLES[key] = scratch(_made_edges(spark, sf_dir), "near-edges")
    # Each reader gets a frame of its own, so that edges can be joined with edges.
    return spark.read.schema(_EDGE_TABLES[key].schema).parquet(_EDGE_TABLES[key]._scratch)


def _made_edges(spark, sf_dir):
    e = _knn(spark, sf_dir, 4)
    h = F.col("id") * 31 + F.col("neighbor") * 17
    return e.select(
        F.col("id").alias("src"), F.col("neighbor").alias("dst"), F.lit("similar").alias("rel"), (h % 10 < 3).alias("directed"), F.lit(False).alias("structural"),
        F.when(h % 5 == 0, "rejected").otherwise("accepted").alias("status"), F.round(1 - F.col("dist"), 6).alias("weight"),
        F.concat_ws("-", F.col("id").cast("string"), F.col("neighbor").cast("string")).alias("edge_id"))


@query(EDGES_SQL + "SELECT a.edge_id FROM e a WHERE a.status = 'accepted' AND NOT a.directed AND EXISTS (SELECT 1 FROM e b WHERE b.status = 'rejected' AND b.src = a.dst AND b.dst = a.src)")
def asymmetric_twins(spark, sf_dir):
    """Accepted undirected edges whose reverse was rejected."""
    return graph.asymmetric(_edges(spark, sf_dir)).select("edge_id")


@query(EDGES_SQL + """, k AS (SELECT vec_id, label FROM embeddings), a AS (SELECT * FROM e WHERE status = 'accepted'),
dg AS (SELECT node, count(*) AS n FROM (SELECT src AS node FROM a UNION ALL SELECT dst FROM a) GROUP BY node), c AS (SELECT quantile_cont(n, 0.99) AS cut FROM dg),
h AS (SELECT node FROM dg, c WHERE n > cut AND n >= 8),
x AS (SELECT edge_id, 'hub' AS reason FROM a WHERE src IN (SELECT node FROM h) OR dst IN (SELECT node FROM h)
 UNION SELECT edge_id, 'asymmetric' FROM a WHERE NOT directed AND EXISTS (SELECT 1 FROM e b WHERE b.status = 'rejected' AND b.src = a.dst AND b.dst = a.src)
 UNION SELECT edge_id, 'cross_doctype' FROM a JOIN k p ON a.src = p.vec_id JOIN k q ON a.dst = q.vec_id WHERE p.label <> q.label AND NOT (least(p.label, q.label) = 0 AND greatest(p.label, q.label) = 1))
SELECT edge_id, array_to_string(list_sort(list(reason)), ',') AS reasons FROM x GROUP BY edge_id
""")
def edge_anomalies(spark, sf_dir):
    """Accepted edges with what is odd about them."""
    kinds = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("doc_type"))
    return graph.anomalies(_edges(spark, sf_dir), kinds, [("0", "1")], min_degree=8).select("edge_id", F.array_join("reasons", ",").alias("reasons"))


@query(EDGES_SQL + "SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT src FROM e WHERE status = 'accepted' AND weight > 0.34 UNION ALL SELECT dst FROM e WHERE status = 'accepted' AND weight > 0.34)")
def orphans(spark, sf_dir):
    """Vectors on no accepted edge of some weight."""
    return graph.orphans(table(spark, sf_dir, "embeddings").select("vec_id"), _edges(spark, sf_dir).where("weight > 0.34"), "vec_id")


@query("""
WITH RECURSIVE e AS (SELECT a.doc_id AS x, min(b.doc_id) OVER (PARTITION BY md5(a.text)) AS y FROM documents a JOIN documents b USING (doc_id)
  UNION SELECT p_partkey * 0 + doc_id, doc_id FROM documents, (SELECT 1 AS p_partkey)),
u AS (SELECT x, y FROM e UNION SELECT y, x FROM e), r(node, comp) AS (SELECT x, x FROM u UNION SELECT u.y, r.comp FROM r JOIN u ON r.node = u.x)
SELECT node, min(comp) AS component FROM r GROUP BY node
""")
def connected_documents(spark, sf_dir):
    """Components of documents linked to the first holder of their text."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    first = d.groupBy("h").agg(F.min("doc_id").alias("dst"))
    edges = d.join(first, "h", "left").select(F.col("doc_id").alias("src"), F.coalesce("dst", "doc_id").alias("dst"))
    return connected_components(edges)


@query(EDGES_SQL + """, c AS (SELECT least(src, dst) AS x, greatest(src, dst) AS y FROM e WHERE status = 'accepted' AND weight > 0.3),
u AS (SELECT x, y FROM c UNION SELECT y, x FROM c), r2 AS (SELECT x AS node, x AS comp FROM u)
SELECT count(DISTINCT node) AS nodes, (SELECT count(*) FROM (SELECT DISTINCT x, y FROM c)) AS links FROM r2
""")
def component_sizes(spark, sf_dir):
    """Nodes and links that the components of accepted edges are made of."""
    e = _edges(spark, sf_dir).where("status = 'accepted' AND weight > 0.3")
    parts = connected_components(e.select("src", "dst"))
    links = e.select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct().agg(F.count("*").alias("links"))
    return parts.agg(F.count("*").alias("nodes")).join(F.broadcast(links))


@query(EDGES_SQL + """, a AS (SELECT * FROM e WHERE status = 'accepted'), s AS (SELECT vec_id AS id FROM embeddings WHERE vec_id < 5),
o1 AS (SELECT id AS f, edge_id, CASE WHEN src = id THEN dst ELSE src END AS n, weight FROM a JOIN s ON src = id OR dst = id),
k1 AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY weight DESC NULLS LAST, edge_id) AS rn FROM o1 QUALIFY rn <= 3),
h1 AS (SELECT n AS id, f AS parent, edge_id FROM k1 WHERE n NOT IN (SELECT id FROM s) QUALIFY row_number() OVER (PARTITION BY n ORDER BY f, rn, edge_id) = 1),
o2 AS (SELECT id AS f, a.edge_id, CASE WHEN src = id THEN dst ELSE src END AS n, weight FROM a JOIN h1 ON src = id OR dst = id),
k2 AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY weight DESC NULLS LAST, edge_id) AS rn FROM o2 QUALIFY rn <= 3),
h2 AS (SELECT n AS id, f AS parent, edge_id FROM k2 WHERE n NOT IN (SELECT id FROM s UNION ALL SELECT id FROM h1) QUALIFY row_number() OVER (PARTITION BY n ORDER BY f, rn, edge_id) = 1)
SELECT id, 0 AS hop, NULL::BIGINT AS parent, NULL::VARCHAR AS edge_id FROM s UNION ALL SELECT id, 1, parent, edge_id FROM h1 UNION ALL SELECT id, 2, parent, edge_id FROM h2
""")
def khop_expand(spark, sf_dir):
    """Nodes within two hops of some seeds, three heaviest edges a node."""
    seeds = table(spark, sf_dir, "embeddings").where("vec_id < 5").select(F.col("vec_id").alias("id"))
    return graph.expand(_edges(spark, sf_dir).where("status = 'accepted'"), seeds, 2, 3)


MANY = EDGES_SQL + """, a AS (SELECT * FROM e WHERE status = 'accepted'), s AS (SELECT vec_id AS q, vec_id AS id FROM embeddings WHERE vec_id % 50 = 0),
near AS (SELECT f.vec_id AS f, edge_id, CASE WHEN src = f.vec_id THEN dst ELSE src END AS n, weight FROM a JOIN embeddings f ON src = f.vec_id OR dst = f.vec_id),
top AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY weight DESC NULLS LAST, edge_id) AS rn FROM near QUALIFY rn <= 4),
o1 AS (SELECT q, f, edge_id, n, rn, CASE WHEN (q + f + n) % 4 = 0 THEN 'reject' ELSE 'accept' END AS outcome FROM s JOIN top ON f = id WHERE NOT EXISTS (SELECT 1 FROM s x WHERE x.q = s.q AND x.id = n)),
h1 AS (SELECT q, n AS id, f AS parent, edge_id FROM o1 WHERE outcome = 'accept' QUALIFY row_number() OVER (PARTITION BY q, n ORDER BY f, rn, edge_id) = 1),
v1 AS (SELECT q, id FROM s UNION SELECT q, id FROM h1),
o2 AS (SELECT q, f, top.edge_id, n, rn, CASE WHEN (q + f + n) % 4 = 0 THEN 'reject' ELSE 'accept' END AS outcome FROM h1 JOIN top ON f = id WHERE NOT EXISTS (SELECT 1 FROM v1 x WHERE x.q = h1.q AND x.id = n)),
h2 AS (SELECT q, n AS id, f AS parent, edge_id FROM o2 WHERE outcome = 'accept' QUALIFY row_number() OVER (PARTITION BY q, n ORDER BY f, rn, edge_id) = 1)
"""


def _many(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0")
    judge = lambda offered: offered.withColumn("outcome", F.when((F.col("q") + F.col("from_id") + F.col("neighbour")) % 4 == 0, "reject").otherwise("accept"))
    return graph.expand_many(_edges(spark, sf_dir).where("status = 'accepted'"), e.select(F.col("vec_id").alias("q"), F.col("vec_id").alias("id")), 2, 4, judge)


@query(MANY + """SELECT q, id, 0 AS hop, NULL::BIGINT AS parent, NULL::VARCHAR AS edge_id FROM s UNION ALL SELECT q, id, 1, parent, edge_id FROM h1 UNION ALL SELECT q, id, 2, parent, edge_id FROM h2""")
def expand_questions(spark, sf_dir):
    """Nodes within two hops of many questions at once, every neighbour judged for its question."""
    return _many(spark, sf_dir)[0]


@query(MANY + "SELECT q, 1 AS hop, f AS from_id, edge_id, n AS neighbour, outcome FROM o1 UNION ALL SELECT q, 2, f, edge_id, n, outcome FROM o2")
def expansion_decisions(spark, sf_dir):
    """What was decided on the way of these expansions."""
    return _many(spark, sf_dir)[1].select("q", "hop", "from_id", "edge_id", "neighbour", "outcome")


@query(EDGES_SQL + """, w AS (SELECT src AS a, dst AS b FROM e WHERE status = 'accepted' UNION SELECT dst, src FROM e WHERE status = 'accepted'),
h AS (SELECT a, b, sha256('path|' || a::VARCHAR || '|' || b::VARCHAR) AS h FROM w),
p AS (SELECT x.a, x.b, y.b AS c, row_number() OVER (PARTITION BY x.a ORDER BY x.h, y.h, x.b, y.b) AS n FROM h x JOIN h y ON x.b = y.a AND x.a <> y.b)
SELECT a, b, c FROM p WHERE n = 1
""")
def two_hop_paths(spark, sf_dir):
    """For each start one simple two-hop path, by hash order."""
    return graph.two_hop_paths(_edges(spark, sf_dir).where("status = 'accepted'"))


@query("""
WITH RECURSIVE l AS (SELECT p_type || '/' || p_size::VARCHAR AS g, p_partkey AS b, lag(p_partkey) OVER (PARTITION BY p_type, p_size ORDER BY p_partkey) AS a FROM part),
ev AS (SELECT g, a, b, h, CASE WHEN h < 2 THEN 'different' WHEN h < 4 THEN 'identical' WHEN h = 9 AND a % 5 = 0 THEN 'existing' ELSE 'same' END AS kind FROM (SELECT *, (a * 7 + b * 3) % 10 AS h FROM l WHERE a IS NOT NULL)),
old(g, node, name) AS (SELECT g, a, b FROM ev WHERE kind = 'existing' UNION SELECT g, b, b FROM ev WHERE kind = 'existing' UNION SELECT o.g, o.node, e.b FROM old o JOIN ev e ON e.kind = 'existing' AND e.a = o.name),
named AS (SELECT g, node, max(name) AS name FROM old GROUP BY 1, 2),
nodes AS (SELECT g, list(node ORDER BY node) AS ns, list(coalesce(name, node) ORDER BY node) AS cs, list(DISTINCT name) FILTER (WHERE name IS NOT NULL) AS fs FROM (SELECT DISTINCT g, unnest([a, b]) AS node FROM ev) LEFT JOIN named USING (g, node) GROUP BY g),
aparts AS (SELECT g, list([a, b]) AS ds FROM ev WHERE kind = 'different' GROUP BY g),
joins AS (SELECT g, list([a, b] ORDER BY CASE kind WHEN 'identical' THEN 2.0 ELSE h / 10.0 END DESC, a, b) AS js FROM ev WHERE kind IN ('identical', 'same') GROUP BY g),
r(g, n, ns, cs, fs, ds, js) AS (
  SELECT nodes.g, 1, ns, cs, coalesce(fs, []), coalesce(ds, []), coalesce(js, []) FROM nodes LEFT JOIN aparts USING (g) LEFT JOIN joins USING (g)
  UNION ALL SELECT g, n + 1, ns, CASE WHEN x = y OR clash OR (list_contains(fs, x) AND list_contains(fs, y)) THEN cs ELSE list_transform(cs, lambda c: CASE WHEN c = x OR c = y THEN keep ELSE c END) END, fs, ds, js
  FROM (SELECT *, CASE WHEN list_contains(fs, x) THEN x WHEN list_contains(fs, y) THEN y ELSE least(x, y) END AS keep,
          len(list_filter(ds, lambda d: (cs[list_position(ns, d[1])] = x AND cs[list_position(ns, d[2])] = y) OR (cs[list_position(ns, d[1])] = y AND cs[list_position(ns, d[2])] = x))) > 0 AS clash
        FROM (SELECT *, cs[list_position(ns, js[n][1])] AS x, cs[list_position(ns, js[n][2])] AS y FROM r WHERE n <= len(js))))
SELECT unnest(ns) AS id, unnest(cs) AS root FROM r WHERE n = len(js) + 1
""")
def guarded_union_find(spark, sf_dir):
    """Parts of one type merged by evidence; some pairs judged different, some roots known before."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    w = Window.partitionBy("p_type", "p_size").orderBy("p_partkey")
    pairs = p.select(F.col("p_partkey").alias("b"), F.lag("p_partkey").over(w).alias("a")).where("a IS NOT NULL")
    h = (F.col("a") * 7 + F.col("b") * 3) % 10
    kind = F.when(h < 2, "different").when(h < 4, "identical").when((h == 9) & (F.col("a") % 5 == 0), "existing").otherwise("same")
    return merging.guarded_union_find(pairs.select("a", "b", kind.alias("kind"), (h / 10.0).alias("p")))


@query()
def graph_communities(spark, sf_dir):
    """Modularity communities of the accepted edges."""
    return communities.communities(_edges(spark, sf_dir).where("status = 'accepted'")).select("community", F.size("members").alias("size"), F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))


# ---- audits, increments, snapshots ------------------------------------------------------


DECISIONS_SQL = """
WITH d AS (SELECT event_id AS decision_id, CASE WHEN value > 40 THEN 'accept' ELSE 'reject' END AS outcome, event_type AS set FROM events),
x AS (SELECT o_orderkey AS edge_id, [o_orderkey % 1000, (o_orderkey * 7) % 1000] AS ids, CASE WHEN o_orderstatus = 'F' THEN 'accepted' ELSE 'rejected' END AS status, o_orderpriority[1:1] AS src_kind FROM orders)
"""


def _decided(spark, sf_dir):
    d = table(spark, sf_dir, "events").select(F.col("event_id").alias("decision_id"), F.when(F.col("value") > 40, "accept").otherwise("reject").alias("outcome"), F.concat("event_type", F.lit("@1")).alias("question_set"))
    e = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("edge_id"), F.array(F.col("o_orderkey") % 1000, (F.col("o_orderkey") * 7) % 1000).alias("decision_ids"),
        F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("status"), F.substring("o_orderpriority", 1, 1).alias("src_kind"))
    return d, e


@query(DECISIONS_SQL + "SELECT edge_id FROM x WHERE status = 'accepted' AND NOT EXISTS (SELECT 1 FROM d WHERE list_contains(x.ids, d.decision_id) AND outcome = 'accept' AND set IN ('click', 'view', 'purchase'))")
def provenance_violations(spark, sf_dir):
    """Accepted rows that no accepting decision stands behind."""
    d, e = _decided(spark, sf_dir)
    return audit.provenance_violations(e, "edge_id", "decision_ids", d, ["click", "view", "purchase"]).select("edge_id")


@query(DECISIONS_SQL + """, p AS (SELECT edge_id, src_kind, list_sort(list(DISTINCT d.set) FILTER (WHERE d.set IS NOT NULL)) AS passed
  FROM (SELECT edge_id, src_kind, unnest(ids) AS i FROM x WHERE status = 'accepted') y LEFT JOIN d ON d.decision_id = y.i AND outcome = 'accept' GROUP BY 1, 2)
SELECT edge_id, src_kind, coalesce(array_to_string(passed, ','), '') AS passed FROM p
WHERE NOT CASE src_kind WHEN '1' THEN list_has_any(coalesce(passed, []), ['click', 'view']) WHEN '2' THEN list_has_any(coalesce(passed, []), ['view', 'purchase']) AND list_has_any(coalesce(passed, []), ['click', 'error', 'signup']) ELSE false END
""")
def edge_requirements(spark, sf_dir):
    """Accepted edges that lack a decision in some group their kind asks for."""
    d, e = _decided(spark, sf_dir)
    out = audit.unmet_requirements(e, d, {"1": [["click", "view"]], "2": [["view", "purchase"], ["click", "error", "signup"]]})
    return out.select("edge_id", "src_kind", F.array_join("passed", ",").alias("passed"))


@query(DECISIONS_SQL + """, k AS (SELECT edge_id, src_kind FROM x WHERE status = 'accepted' AND edge_id % 11 <> 0)
SELECT CASE src_kind WHEN '1' THEN 'first' ELSE 'others' END AS rule, edge_id::VARCHAR AS id FROM k JOIN x USING (edge_id, src_kind)
WHERE NOT EXISTS (SELECT 1 FROM d WHERE list_contains(x.ids, d.decision_id) AND outcome = 'accept' AND CASE src_kind WHEN '1' THEN set IN ('click', 'view') ELSE set IN ('purchase', 'signup', 'error') END)
""")
def audited_rules(spark, sf_dir):
    """What breaks several rules of provenance, rows that a person accepted aside."""
    d, e = _decided(spark, sf_dir)
    rules = [audit.Rule("first", "edges", "edge_id", ("click", "view"), "src_kind = '1'"), audit.Rule("others", "edges", "edge_id", ("purchase", "signup", "error"), "src_kind <> '1'")]
    human = e.where("edge_id % 11 = 0").select(F.lit("edges").alias("table"), F.col("edge_id").cast("string").alias("id"))
    return audit.audited({"edges": e}, rules, d, human)


@query("""
WITH p AS (SELECT l_orderkey AS a, l_partkey AS b FROM lineitem WHERE l_linenumber <= 2), d AS (SELECT l_orderkey AS a, l_partkey AS b FROM lineitem WHERE l_returnflag = 'R'),
n AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O')
SELECT DISTINCT a, b FROM p WHERE (a IN (SELECT id FROM n) OR b IN (SELECT id FROM n)) AND NOT EXISTS (SELECT 1 FROM d WHERE d.a = p.a AND d.b = p.b)
""")
def undecided_pairs(spark, sf_dir):
    """Pairs with a new member and no decision."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"), "l_linenumber", "l_returnflag")
    new = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    return rel.undecided(l.where("l_linenumber <= 2").select("a", "b"), l.where("l_returnflag = 'R'").select("a", "b"), new)


@query("""
WITH runs AS (SELECT user_id AS run_id, min(ts) AS started_at, count(*) AS selected, count(*) FILTER (WHERE event_type <> 'error') AS done, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY user_id),
c AS (SELECT max(started_at) AS cut FROM runs WHERE failed = 0 AND done = selected),
w AS (SELECT o_orderkey AS id, o_custkey AS run_id FROM orders WHERE o_orderstatus = 'F')
SELECT id FROM w LEFT JOIN runs USING (run_id), c WHERE cut IS NULL OR started_at IS NULL OR started_at >= cut
""")
def new_rows(spark, sf_dir):
    """Accepted rows that a stage hasn't seen."""
    runs = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("run_id")).agg(
        F.min("ts").alias("started_at"), F.count("*").alias("selected"), F.count_if(F.col("event_type") != "error").alias("done"), F.count_if(F.col("event_type") == "error").alias("failed"))
    runs = runs.select("*", F.lit("links").alias("stage"), F.lit("done").alias("status"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("status"))
    return rel.new_rows(rows, runs, "links").select("id")


@query("SELECT user_id, event_type, event_id, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, sf_dir):
    """The last event of each user and type."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", "event_type").agg(F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("x")).select("user_id", "event_type", "x.event_id", F.round("x.value", 6).alias("value"))


@query("""
WITH n AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice * 2 AS p, o_orderkey AS seq FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey + 10000000, 'N', o_totalprice, o_orderkey FROM orders WHERE o_orderkey % 7 = 0 UNION ALL SELECT o_orderkey, 'Z', o_totalprice, o_orderkey + 1 FROM orders WHERE o_orderkey % 6 = 0),
l AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1)
SELECT coalesce(l.k, o.o_orderkey) AS k, coalesce(l.s, o.o_orderstatus) AS s, round(CASE WHEN o.o_orderkey IS NULL THEN l.p ELSE o.o_totalprice END, 2) AS p
FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0) o FULL JOIN l ON l.k = o.o_orderkey
""")
def upsert_snapshot(spark, sf_dir):
    """A table after an upsert that updates one column of existing rows."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    new = o.where("k % 3 = 0").select("k", "s", (F.col("p") * 2).alias("p"), F.col("k").alias("seq")).unionByName(
        o.where("k % 7 = 0").select((F.col("k") + 10000000).alias("k"), F.lit("N").alias("s"), "p", F.col("k").alias("seq"))).unionByName(
        o.where("k % 6 = 0").select("k", F.lit("Z").alias("s"), "p", (F.col("k") + 1).alias("seq")))
    return rel.upsert(o.where("k % 2 = 0 OR k % 3 = 0"), new, ["k"], F.col("seq"), ["s"]).select("k", "s", F.round("p", 2).alias("p"))


@query("""
WITH n AS (SELECT o_orderkey AS k, 'N' AS s, o_totalprice * 3 AS p, o_custkey AS seq FROM orders WHERE o_custkey % 50 = 0 UNION ALL SELECT o_orderkey + 10000000, 'M', o_totalprice, o_custkey FROM orders WHERE o_custkey % 50 = 0)
SELECT coalesce(n.k, o.o_orderkey) AS k, coalesce(n.s, o.o_orderstatus) AS s, round(coalesce(n.p, o.o_totalprice), 2) AS p FROM orders o FULL JOIN n ON n.k = o.o_orderkey
""")
def upsert_in_buckets(spark, sf_dir):
    """A table in key buckets after an upsert of some customers' orders."""
    path = f"{shared_dir(spark).rstrip('/')}/docweave-buckets-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"), F.col("o_custkey").alias("c"))
    rel.create_buckets(o.drop("c"), path, ["k"], 16)
    some = o.where("c % 50 = 0")
    new = some.select("k", F.lit("N").alias("s"), (F.col("p") * 3).alias("p"), F.col("c").alias("seq")).unionByName(some.select((F.col("k") + 10000000).alias("k"), F.lit("M").alias("s"), "p", F.col("c").alias("seq")))
    rel.upsert_buckets(spark, path, new, ["k"], F.col("seq"), buckets=16)
    return spark.read.parquet(path).select("k", "s", F.round("p", 2).alias("p"))


@query("""
WITH dead AS (SELECT o_orderkey AS c FROM orders WHERE o_orderkey % 10 < 9), m AS (SELECT l_orderkey AS c, l_partkey AS e FROM lineitem)
SELECT DISTINCT e AS entity_id FROM m WHERE c IN (SELECT c FROM dead) AND e NOT IN (SELECT e FROM m WHERE c NOT IN (SELECT c FROM dead))
""")
def supersede_cascade(spark, sf_dir):
    """Entities that fall with superseded chunks: none of their mentions is left alive."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chunk_id"), "o_orderstatus", F.lit("accepted").alias("status"))
    m = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("chunk_id"), F.col("l_partkey").alias("entity_id"), F.lit("accepted").alias("status"))
    e = o.select(F.col("chunk_id").alias("src"), F.col("chunk_id").alias("dst"), "status")
    return rel.supersede(o.drop("o_orderstatus"), o.where("chunk_id % 10 < 9"), e, m)["entities"]


@query("""
WITH i AS (SELECT event_id AS item_id, md5(props) AS h FROM events), l AS (SELECT event_id AS item_id, md5(CASE WHEN event_id % 9 = 0 THEN 'x' ELSE props END) AS h,
  CASE event_id % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'failed' WHEN 2 THEN 'pending' ELSE 'done' END AS s, (event_id % 5)::INT AS attempts FROM events WHERE event_id % 5 <> 0),
s AS (SELECT i.item_id, CASE WHEN l.s IS NULL THEN 'missing' WHEN l.h IS DISTINCT FROM i.h THEN 'stale' WHEN l.s = 'failed' AND attempts >= 3 THEN 'failed_final' ELSE l.s END AS state FROM i LEFT JOIN l USING (item_id))
SELECT item_id, state, state IN ('missing', 'stale', 'pending', 'failed') AS runs FROM s
""")
def runnable_items(spark, sf_dir):
    """Work items classified against the ledger."""
    e = table(spark, sf_dir, "events")
    items = e.select(F.col("event_id").alias("item_id"), F.md5("props").alias("input_hash"))
    state = F.when(F.col("event_id") % 4 == 1, "failed").when(F.col("event_id") % 4 == 2, "pending").otherwise("done")
    led = e.where("event_id % 5 <> 0").select(F.col("event_id").alias("item_id"), F.md5(F.when(F.col("event_id") % 9 == 0, "x").otherwise(F.col("props"))).alias("input_hash"), state.alias("status"), (F.col("event_id") % 5).cast("int").alias("attempts"))
    return rel.runnable(items, led).select("item_id", "state", "runs")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase') ORDER BY ts DESC, event_id LIMIT 20")
def review_list(spark, sf_dir):
    """The 20 latest items of some kinds: a list with a limit."""
    return audit.review_list(table(spark, sf_dir, "events"), ["click", "purchase"], 20, "event_type", "ts", "event_id").select("event_id", "event_type")


@query("""
WITH a AS (SELECT user_id AS k, list_sort(list((event_id % 3)::VARCHAR)) AS v FROM events WHERE event_id % 2 = 0 GROUP BY 1), b AS (SELECT user_id AS k, list_sort(list((event_id % 3)::VARCHAR)) AS v FROM events WHERE event_id % 2 = 1 GROUP BY 1)
SELECT array_to_string(a.v, ',') AS before, array_to_string(b.v, ',') AS after, count(*) AS n FROM a JOIN b USING (k) WHERE array_to_string(a.v, ',') <> array_to_string(b.v, ',') GROUP BY 1, 2
""")
def metadata_changes(spark, sf_dir):
    """Value lists that changed, order aside, with counts."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id", (F.col("event_id") % 3).cast("string").alias("x"))
    lists = lambda rest: e.where(F.col("event_id") % 2 == rest).groupBy("k").agg(F.collect_list("x").alias("v"))
    return audit.multiset_changes(lists(0), lists(1), "k", "v")


# ---- sampling and training ----------------------------------------------------------------


@query("""
WITH r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('pick' || chr(31) || doc_id::VARCHAR || chr(31)), doc_id) AS turn FROM documents)
SELECT doc_id, lang, source, turn::INT AS turn FROM r ORDER BY turn, lang, source LIMIT 60
""")
def stratified_round_robin(spark, sf_dir):
    """60 documents taken from (language, source) strata in turn, by hash inside."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", sha_id(F.lit("pick"), F.col("doc_id").cast("string")).alias("h"))
    return rel.round_robin(d, ["lang", "source"], 60, F.col("h"), F.col("doc_id")).select("doc_id", "lang", "source", "turn")


@query("""
WITH c AS (SELECT l_orderkey AS chunk_id, l_partkey AS claim_id FROM lineitem WHERE l_returnflag = 'R'),
s AS (SELECT chunk_id, claim_id, row_number() OVER (PARTITION BY chunk_id ORDER BY sha256('coverage' || chr(31) || claim_id::VARCHAR || chr(31)), claim_id) AS n FROM c)
SELECT chunk_id, claim_id FROM s WHERE n <= 2 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_totalprice >= 1000 AND o_orderkey NOT IN (SELECT chunk_id FROM c)
""")
def coverage_topn(spark, sf_dir):
    """At most two claims a chunk by hash, or the chunk itself."""
    claims = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("chunk_id"), F.col("l_partkey").alias("claim_id"))
    chunks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chunk_id"), F.col("o_totalprice").alias("tokens"))
    return training.coverage(claims, chunks, 2, 1000)


SPLIT_SQL = """
WITH h AS (SELECT doc_id, sha256('split' || chr(31) || doc_id::VARCHAR || chr(31)) AS h FROM documents),
x AS (SELECT doc_id, ('0x' || h[1:13])::BIGINT / 4503599627370496.0 AS u FROM h), s AS (SELECT doc_id, CASE WHEN u < 0.9 THEN 'train' WHEN u < 0.95 THEN 'validation' ELSE 'test' END AS split FROM x)
"""
SHARES = {"train": 0.9, "validation": 0.05, "test": 0.05}


@query(SPLIT_SQL + "SELECT doc_id, split FROM s")
def split_assignment(spark, sf_dir):
    """Splits by the hash of the document."""
    return table(spark, sf_dir, "documents").select("doc_id", training.split_of(F.col("doc_id"), SHARES).alias("split"))


@query(SPLIT_SQL + """, e AS (SELECT d.source || '-' || (d.doc_id // 3)::VARCHAR AS example, s.split FROM documents d JOIN s USING (doc_id))
SELECT example, CASE WHEN count(DISTINCT split) = 1 THEN min(split) ELSE 'cross_split' END AS split FROM e GROUP BY example""")
def cross_split(spark, sf_dir):
    """The split of examples that draw on several documents."""
    d = table(spark, sf_dir, "documents")
    e = d.select(F.concat_ws("-", "source", F.floor(F.col("doc_id") / 3).cast("string")).alias("example"), training.split_of(F.col("doc_id"), SHARES).alias("split"))
    return training.example_splits(e, "example", "split")


@query(KNN_SQL.format(where="") + "SELECT DISTINCT least(vec_id, neighbor_id) AS a, greatest(vec_id, neighbor_id) AS b FROM r WHERE rank <= 6 AND dist <= 0.65")
def near_dup_pairs(spark, sf_dir):
    """Pairs of near vectors among the six nearest."""
    return _near_pairs(spark, sf_dir)


def _near_pairs(spark, sf_dir):
    return _knn(spark, sf_dir, 6).where("dist <= 0.65").select(F.least("id", "neighbor").alias("a"), F.greatest("id", "neighbor").alias("b")).distinct()


@query()
def greedy_dedup(spark, sf_dir):
    """Near duplicates dropped greedily, the lower id kept."""
    return merging.greedy_dedup(_near_pairs(spark, sf_dir))


@query(KNN_SQL.format(where="") + """, t AS (SELECT doc_id AS id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents), s AS (
 SELECT doc_id AS id, CASE WHEN u < 0.6 THEN 'train' ELSE 'test' END AS split FROM (SELECT doc_id, ('0x' || (sha256('split' || chr(31) || doc_id::VARCHAR || chr(31)))[1:13])::BIGINT / 4503599627370496.0 AS u FROM documents)),
f AS (SELECT r.vec_id, r.neighbor_id, r.dist, b.t FROM r JOIN t a ON a.id = vec_id JOIN t b ON b.id = neighbor_id JOIN s x ON x.id = vec_id JOIN s y ON y.id = neighbor_id WHERE rank <= 12 AND x.split = y.split AND a.t <> b.t),
g AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY vec_id, t ORDER BY dist, neighbor_id) = 1), o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbor_id) AS turn FROM g)
SELECT vec_id AS id, neighbor_id AS neighbor, turn::INT AS turn FROM o WHERE turn <= 3
""")
def hard_negatives(spark, sf_dir):
    """Near documents of the same split with other texts."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    splits = d.select("id", training.split_of(F.col("id"), {"train": 0.6, "test": 0.4}).alias("split"))
    return training.hard_negatives(_knn(spark, sf_dir, 12), d, splits)


NEGATIVES = ORACLES["hard_negatives"].split("o AS (SELECT *")[0]


@query(NEGATIVES + """j AS (SELECT * FROM g WHERE (vec_id + neighbor_id) % 3 <> 0), o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbor_id) AS turn FROM j)
SELECT vec_id AS id, neighbor_id AS neighbor, turn::INT AS turn, 'accepted' AS status FROM o WHERE turn <= 3
UNION ALL SELECT vec_id, NULL, NULL, 'rejected' FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM o) AND vec_id IN (SELECT vec_id FROM r)
""")
def judged_negatives(spark, sf_dir):
    """Near documents of the same split that a judge rejected; what has none is rejected itself."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    splits = d.select("id", training.split_of(F.col("id"), {"train": 0.6, "test": 0.4}).alias("split"))
    near = _knn(spark, sf_dir, 12)
    answers = near.select("id", "neighbor", F.when((F.col("id") + F.col("neighbor")) % 3 != 0, "reject").otherwise("accept").alias("outcome"))
    return training.judged_negatives(near, d, splits, answers)


@query("""
SELECT l_orderkey AS example, CASE WHEN bool_or(l_returnflag = 'R') THEN 'rejected' WHEN bool_and(l_returnflag = 'A') THEN 'accepted' ELSE 'review' END AS status FROM lineitem GROUP BY 1
""")
def example_status(spark, sf_dir):
    """Statuses of examples from their checks."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("example"), F.when(F.col("l_returnflag") == "R", "reject").when(F.col("l_returnflag") == "A", "accept").alias("outcome"))
    return training.example_status(c.na.fill("open", ["outcome"]), "example")


@query("SELECT doc_id FROM documents WHERE ('0x' || (sha256('audit' || chr(31) || doc_id::VARCHAR || chr(31)))[1:13])::BIGINT / 4503599627370496.0 < 0.1")
def hash_sample(spark, sf_dir):
    """A tenth of documents by hash: a sampling operator."""
    return table(spark, sf_dir, "documents").where(unit_fraction(sha_id(F.lit("audit"), F.col("doc_id").cast("string"))) < 0.1).select("doc_id")


@query("SELECT event_id FROM events ORDER BY md5(event_id::VARCHAR || 'run-1'), event_id LIMIT 25")
def drift_sample(spark, sf_dir):
    """25 calls by hash: a sampling operator."""
    return table(spark, sf_dir, "events").orderBy(F.md5(F.concat(F.col("event_id").cast("string"), F.lit("run-1"))), "event_id").limit(25).select("event_id")


@query("""
WITH a AS (SELECT l_orderkey AS id, list_sort(list(DISTINCT l_suppkey) FILTER (WHERE l_linenumber <= 2)) AS x, list_sort(list(DISTINCT l_suppkey) FILTER (WHERE l_linenumber >= 2)) AS y FROM lineitem GROUP BY 1)
SELECT id, array_to_string(list_sort(list_distinct(list_concat(coalesce(x, []), coalesce(y, [])))), ',') AS ids FROM a
""")
def provenance_union(spark, sf_dir):
    """Derived examples inherit what decisions they lack."""
    l = table(spark, sf_dir, "lineitem")
    a = l.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.array_sort(F.collect_set(F.when(F.col("l_linenumber") <= 2, F.col("l_suppkey")))).alias("x"), F.array_sort(F.collect_set(F.when(F.col("l_linenumber") >= 2, F.col("l_suppkey")))).alias("y"))
    return a.select("id", F.array_join(F.transform(training.inherited(F.col("x"), F.col("y")), lambda v: v.cast("string")), ",").alias("ids"))


@query("""
SELECT s_suppkey AS key, 'supplier' AS kind, trim(regexp_replace(regexp_replace(lower(s_name), '[[:punct:]]', ' ', 'g'), '\\s+', ' ', 'g')) AS name_key FROM supplier
UNION ALL SELECT c_custkey, 'customer', trim(regexp_replace(regexp_replace(lower(c_name), '[[:punct:]]', ' ', 'g'), '\\s+', ' ', 'g')) FROM customer
""")
def name_keys(spark, sf_dir):
    """Name keys of suppliers and customers."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.lit("supplier").alias("kind"), "s_name")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.lit("customer").alias("kind"), F.col("c_name").alias("s_name"))
    return s.unionByName(c).select("key", "kind", tx.plain_name_key(F.col("s_name")).alias("name_key"))


@query("""
WITH e AS (SELECT p_partkey AS id, p_type AS kind, lower(string_split(p_name, ' ')[1]) AS k FROM part),
x AS (SELECT a.id AS a, b.id AS b, a.k, row_number() OVER (PARTITION BY a.k ORDER BY a.id, b.id) AS n FROM e a JOIN e b ON a.k = b.k AND a.kind <> b.kind AND a.id < b.id)
SELECT a, b FROM x WHERE n <= 50
""")
def name_key_blocking(spark, sf_dir):
    """Cross-type pairs of one name, 50 a name: the operator's own cap."""
    e = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("kind"), F.lower(F.get(F.split("p_name", " "), F.lit(0))).alias("k"))
    return rel.least_pairs(e, ["k"], "id", 50, "kind").select("a", "b")


@query("""
WITH p AS (SELECT md5(doc_id::VARCHAR)[1:3] AS piece, count(*) AS n, md5(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id::VARCHAR)) AS d FROM documents GROUP BY 1)
SELECT sum(n)::BIGINT AS n, md5(string_agg(d, ',' ORDER BY piece)) AS digest FROM p
""")
def served_fingerprint(spark, sf_dir):
    """What is served, as one digest of all ids."""
    return fingerprint(table(spark, sf_dir, "documents"), "doc_id")


def _passage_rows(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("q"), F.col("vec_id").alias("id"), (F.col("vec_id") % 7).alias("doc_id"), F.col("vec_id").alias("ord"), ((F.col("vec_id") * 13) % 90 + 10).alias("tokens"))


@query()
def passage_assembly(spark, sf_dir):
    """Cited passages within a budget; an oversize one is passed over."""
    return graph.passages(_passage_rows(spark, sf_dir), "q", 600)


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS norm FROM embeddings")
def vector_norms(spark, sf_dir):
    """Lengths of vectors."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(vec.norm(F.col("embedding")), 5).alias("norm"))


@query("SELECT doc_id, 'k' || (sha256(doc_id::VARCHAR || chr(31) || source || chr(31)))[1:12] AS key FROM documents")
def short_keys(spark, sf_dir):
    """Short keys of documents."""
    return table(spark, sf_dir, "documents").select("doc_id", short_key(sha_id(F.col("doc_id").cast("string"), F.col("source"))).alias("key"))


@query()
def html_units(spark, sf_dir):
    """Pages as structural units, with offsets."""
    from docweave.sources import files

    pages = table(spark, sf_dir, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.encode("html", "utf-8").alias("content"))
    return files.units(files.parse_contents(pages)).select("path", "ord", "kind", F.md5("text").alias("digest"), "char_start", "char_end")


@query("""
WITH b AS (SELECT item_id, text, trim(upper(substr(text, 3, 40))) AS span FROM benchmark), f AS (SELECT *, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS t, regexp_replace(lower(span), '\\s+', ' ', 'g') AS s FROM b)
SELECT item_id, CASE WHEN contains(text, span) THEN 'exact' ELSE 'normalised' END AS level, CASE WHEN contains(text, span) THEN len(list_filter(range(1, length(text) + 1), lambda i: text[i : i + length(span) - 1] = span)) ELSE len(list_filter(range(1, length(t) + 1), lambda i: t[i : i + length(s) - 1] = s)) END::INT AS places FROM f
""")
def grounded_spans(spark, sf_dir):
    """Spans of forty characters of benchmark items, in capitals, grounded in their whole texts."""

    @F.pandas_udf("struct<level:string,places:int>")
    def grounded(spans: pd.Series, texts: pd.Series) -> pd.DataFrame:
        found = [tx.ground(s, t) for s, t in zip(spans, texts, strict=True)]
        return pd.DataFrame({"level": [f[0] for f in found], "places": [len(f[1]) for f in found]})

    b = table(spark, sf_dir, "benchmark").select("item_id", F.upper(F.substring("text", 3, 40)).alias("span"), "text")
    return b.select("item_id", grounded("span", "text").alias("g")).select("item_id", "g.level", "g.places")


@query()
def chunk_texts(spark, sf_dir):
    """Documents cut into chunks of at most 256 estimated tokens."""
    d = tx.fitted(table(spark, sf_dir, "documents"), "doc_id", "text", 256)
    return d.select("doc_id", "ord", F.md5("chunk").alias("digest"), tx.tokens(F.col("chunk")).alias("tokens"))
