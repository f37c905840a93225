"""More of the catalogue: text rules, paths, sources, questions and sequential rules, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from docweave.functions import fuzzy
from docweave.functions import sentences as se
from docweave.functions import text as tx
from docweave.operators import audit, graph, knn, merging, repeated, training
from docweave.operators import curation as cu
from docweave.operators import relational as rel
from docweave.operators.components import connected_components
from docweave.operators.vector_index import Coding, VectorIndex
from docweave.plans import answers, provider
from docweave.plans.catalog import EDGES_SQL, KNN_SQL, ORACLES, _edges, query
from docweave.session import GraphSession, Plan
from docweave.storage import delete_on_exit, shared_dir, table

# ---- text rules ------------------------------------------------------------------------

VALUES = ["0.1", "1.2", "2.3", "2.3.1", "tin", "standard anodized", "Plated"]


@query(f"""
WITH p AS (SELECT p_partkey AS id, lower('Release ' || (p_size % 3)::VARCHAR || '.' || (p_partkey % 4)::VARCHAR || CASE WHEN p_partkey % 5 = 0 THEN '.1' WHEN p_partkey % 7 = 0 THEN '.9.4' ELSE '' END || ' of ' || p_type) AS t FROM part),
w AS (SELECT id, regexp_extract_all(t, '\\w+(?:\\.\\w+)*') AS ws FROM p), v AS (SELECT unnest({VALUES}) AS v, unnest(range({len(VALUES)})) AS o),
k AS (SELECT v, o, array_to_string(regexp_extract_all(lower(v), '\\w+(?:\\.\\w+)*'), ' ') AS k FROM v), dotted AS (SELECT v, o, k FROM k WHERE k LIKE '%.%' AND k NOT LIKE '% %'),
x AS (SELECT id, v, o FROM w, k WHERE contains(' ' || array_to_string(ws, ' ') || ' ', ' ' || k || ' ')),
tok AS (SELECT DISTINCT id, unnest(ws) AS w FROM w), ext AS (SELECT id, w, v, o, row_number() OVER (PARTITION BY id, w ORDER BY length(k) DESC) AS n FROM tok, dotted WHERE starts_with(w, k || '.') AND w NOT IN (SELECT k FROM dotted)),
f AS (SELECT * FROM x UNION SELECT id, v, o FROM ext WHERE n = 1)
SELECT id, coalesce(string_agg(v, ',' ORDER BY o), '') AS "values" FROM w LEFT JOIN f USING (id) GROUP BY id
""")
def named_values(spark, sf_dir):
    """Values that short texts name, whatever the case; a newer release names its nearest."""

    @F.pandas_udf("string")
    def named(texts):
        return texts.map(lambda t: ",".join(tx.named_values(t, VALUES)))

    p = table(spark, sf_dir, "part")
    more = F.when(F.col("p_partkey") % 5 == 0, ".1").when(F.col("p_partkey") % 7 == 0, ".9.4").otherwise("")
    text = F.concat(F.lit("Release "), (F.col("p_size") % 3).cast("string"), F.lit("."), (F.col("p_partkey") % 4).cast("string"), more, F.lit(" of "), F.col("p_type"))
    return p.select(F.col("p_partkey").alias("id"), named(text).alias("values"))


@query("""
WITH u AS (SELECT l_orderkey AS id, l_linenumber AS n, l_quantity::BIGINT AS tokens, CASE l_partkey % 5 WHEN 0 THEN 'heading' WHEN 1 THEN 'list' WHEN 2 THEN 'table' WHEN 3 THEN 'code' ELSE 'paragraph' END AS kind, l_suppkey % 2 = 0 AS o FROM lineitem),
b AS (SELECT *, CASE WHEN kind = 'list' AND o THEN 'procedure' WHEN kind = 'table' THEN 'reference' WHEN kind = 'code' THEN 'example' END AS role FROM u WHERE kind <> 'heading'),
s AS (SELECT id, role, sum(tokens) AS s, min(n) AS n FROM b WHERE role IS NOT NULL GROUP BY 1, 2), t AS (SELECT id, greatest(1, sum(tokens)) AS t FROM b GROUP BY 1),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, n) = 1)
SELECT i.id, CASE WHEN t.id IS NULL THEN 'heading' WHEN best.s > 0.5 * t.t THEN best.role END AS role FROM (SELECT DISTINCT id FROM u) i LEFT JOIN t USING (id) LEFT JOIN best USING (id)
""")
def structural_roles(spark, sf_dir):
    """Roles of chunks by the kinds of their units."""
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("heading", "list", "table", "code", "paragraph")]), (F.col("l_partkey") % 5 + 1).cast("int"))
    units = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), kinds.alias("kind"), F.col("l_quantity").cast("long").alias("tokens"), (F.col("l_suppkey") % 2 == 0).alias("ordered"))
    return cu.structural_roles(units, "id")


@query("""
WITH RECURSIVE u AS (SELECT o_custkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, (o_orderkey % 37 + 1)::BIGINT AS tokens, o_orderkey % 5 = 0 AS leads FROM orders),
c AS (SELECT id, 0 AS e, 0 AS cum, false AS leads FROM (SELECT DISTINCT id FROM u) UNION ALL SELECT id, n, sum(tokens) OVER (PARTITION BY id ORDER BY n), leads FROM u),
t AS (SELECT id, max(e) AS stop, max(cum) AS total FROM c GROUP BY id),
p AS (SELECT b.id, b.e AS begin, t.stop, t.total - b.cum AS rest, x.e, x.cum - b.cum AS size, x.leads FROM c b JOIN t USING (id) LEFT JOIN c x ON x.id = b.id AND x.e > b.e AND x.e < t.stop WHERE b.e < t.stop),
f AS (SELECT *, size <= 60 AS fits, bool_or(coalesce(size <= 60, false)) OVER (PARTITION BY id, begin) AS any_fits FROM p),
nxt AS (SELECT id, begin, CASE WHEN stop - begin <= 1 OR rest <= 60 THEN stop ELSE e END AS cut FROM f WHERE stop - begin <= 1 OR rest <= 60 OR fits OR (NOT any_fits AND e = begin + 1)
  QUALIFY row_number() OVER (PARTITION BY id, begin ORDER BY leads, abs(size - rest / ceil(rest / 60.0)), e DESC) = 1),
s AS (SELECT id, begin, cut FROM nxt WHERE begin = 0 UNION ALL SELECT n.id, n.begin, n.cut FROM s JOIN nxt n ON n.id = s.id AND n.begin = s.cut)
SELECT id, begin::INT AS begin, cut::INT AS "end" FROM s
""")
def section_spans(spark, sf_dir):
    """Sections cut into few even pieces that fit, not after a unit that leads on."""
    spans = F.pandas_udf(lambda us: us.map(lambda x: [{"begin": a, "end": b} for a, b in tx.split_section([u["tokens"] for u in x], 60, [i for i, u in enumerate(x) if u["leads"]])]), "array<struct<begin:int,end:int>>")
    unit = F.struct("o_orderkey", (F.col("o_orderkey") % 37 + 1).alias("tokens"), (F.col("o_orderkey") % 5 == 0).alias("leads"))
    units = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.sort_array(F.collect_list(unit)).alias("units"))
    return units.select("id", F.explode(spans("units")).alias("s")).select("id", "s.begin", "s.end")


@query("""
SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand || ' > ' || p_type || chr(10) END || CASE WHEN p_size % 4 = 0 THEN '' ELSE p_name || chr(10) END || p_type AS chunk,
       p_name || ' (' || p_brand || ')' || CASE WHEN p_size % 4 = 0 THEN '' ELSE ': ' || p_type END AS entity FROM part
""")
def embedded_texts(spark, sf_dir):
    """What is embedded of chunks and entities."""
    p = table(spark, sf_dir, "part")
    path = F.when(F.col("p_size") % 3 != 0, F.array("p_brand", "p_type"))
    return p.select(
        F.col("p_partkey").alias("id"), tx.chunk_text(path, F.when(F.col("p_size") % 4 != 0, F.col("p_name")), F.col("p_type")).alias("chunk"),
        tx.entity_text(F.col("p_name"), F.col("p_brand"), F.when(F.col("p_size") % 4 != 0, F.col("p_type"))).alias("entity"))


LANGUAGE_SQL = ", ".join(f"{{'n': len(list_filter(ws, lambda w: list_contains({words}, w))), 'l': '{lang}'}}" for lang, words in sorted(tx.FUNCTION_WORDS.items()))


@query(f"""
WITH w AS (SELECT doc_id, regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}]+') AS ws FROM documents), c AS (SELECT doc_id, unnest([{LANGUAGE_SQL}]) AS x FROM w)
SELECT doc_id, CASE WHEN x.n > 0 AND x.l IN ('de', 'en', 'es') THEN x.l ELSE 'other' END AS language FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY x.n DESC, x.l) = 1
""")
def document_languages(spark, sf_dir):
    """The language of whole texts by function words; one that isn't listed is `other`."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.language(F.coalesce("text", F.lit("")), ["de", "en", "es"], "other").alias("language"))


@query("""
SELECT s_suppkey AS key, trim(regexp_replace(regexp_replace(lower(s_name), '[[:punct:]]', ' ', 'g'), '\\s+', ' ', 'g')) AS name_key FROM supplier
UNION ALL SELECT p_partkey, trim(regexp_replace(regexp_replace(' ' || replace(lower(p_type), ' ', '  ') || ' ', ' (tin|brushed) ', ' ', 'g'), '\\s+', ' ', 'g')) FROM part
""")
def folded_name_keys(spark, sf_dir):
    """Name keys by NFKC and casefolding, some words left out."""
    key = F.pandas_udf(lambda names: names.map(lambda n: tx.name_key(n, ["TIN", "brushed"])), "string")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_type").alias("name"))
    return s.unionByName(p).select("key", key("name").alias("name_key"))


@query("SELECT page_id, url FROM pages WHERE coalesce(CASE page_id % 3 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END, false) = false")
def content_only(spark, sf_dir):
    """What isn't boilerplate; what was never judged stays."""
    judged = F.when(F.col("page_id") % 3 == 1, F.lit(False)).when(F.col("page_id") % 3 == 2, F.lit(True))
    return rel.content_chunks(table(spark, sf_dir, "pages").withColumn("boilerplate", judged)).select("page_id", "url")


@query()
def repeated_page_elements(spark, sf_dir):
    """Texts that elements of many pages share, by selector."""
    return repeated.repeated_elements(table(spark, sf_dir, "pages"), "page_id", "html").select("selector", F.md5("text").alias("digest"), "pages", "all_pages")


# ---- ledger, alerts, files --------------------------------------------------------------

LEDGER = "CASE o_orderkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'done' ELSE 'pending' END AS status, o_orderdate::TIMESTAMP AS lease_until, (o_custkey % 5)::INT AS attempts"


@query(f"""
WITH l AS (SELECT o_orderkey AS item_id, {LEDGER} FROM orders)
SELECT item_id, 'running' AS status, TIMESTAMP '1995-06-01 00:10:00' AS lease_until, attempts + 1 AS attempts FROM l
WHERE (status = 'pending' OR (status = 'running' AND lease_until < TIMESTAMP '1995-06-01')) AND attempts < 3 ORDER BY item_id LIMIT 200
""")
def claimed_items(spark, sf_dir):
    """The first items that a worker may take, 200 as its limit has it."""
    state = F.element_at(F.array(*[F.lit(x) for x in ("pending", "running", "done", "pending")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    ledger = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item_id"), state.alias("status"), F.col("o_orderdate").cast("timestamp_ntz").alias("lease_until"), (F.col("o_custkey") % 5).cast("int").alias("attempts"))
    return rel.claimed(ledger, F.lit("1995-06-01 00:00:00").cast("timestamp_ntz"), 600, 200)


@query("SELECT event_id AS id, ts AS created_at FROM events WHERE event_type = 'error' OR value > 90 ORDER BY ts DESC, event_id LIMIT 20")
def latest_alerts(spark, sf_dir):
    """The twenty newest alerts: a report of that length."""
    alerts = table(spark, sf_dir, "events").where("event_type = 'error' OR value > 90").select(F.col("event_id").alias("id"), F.col("ts").alias("created_at"))
    return rel.latest(alerts, 20)


@query("""
WITH d AS (SELECT doc_id, source || '/' || (doc_id % 50)::VARCHAR AS source_uri, md5(coalesce(text, '')) AS h, CASE WHEN doc_id % 9 = 0 THEN 'superseded' ELSE 'accepted' END AS status FROM documents),
n AS (SELECT source_uri, max(h) AS h FROM d GROUP BY 1)
SELECT DISTINCT doc_id, source_uri FROM d JOIN n USING (source_uri) WHERE status <> 'superseded' AND d.h <> n.h
""")
def changed_documents(spark, sf_dir):
    """Documents whose file now holds something else."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", (F.col("doc_id") % 50).cast("string")).alias("source_uri"), F.md5(F.coalesce("text", F.lit(""))).alias("content_hash"),
        F.when(F.col("doc_id") % 9 == 0, "superseded").otherwise("accepted").alias("status"))
    return rel.changed_files(d, d.groupBy("source_uri").agg(F.max("content_hash").alias("content_hash")))


# ---- vectors and graphs ------------------------------------------------------------------


@query()
def approximate_knn(spark, sf_dir):
    """The index over all vectors, asked for the ten nearest of every fiftieth: the share of the exact ones that is found, and of rows whose codes and vectors are compared."""
    e, report = table(spark, sf_dir, "embeddings"), {}
    asked = e.where("vec_id % 50 = 0")
    found = vector_index_of(spark, sf_dir).search(asked, "vec_id", "embedding", 10, report=report)
    exact = knn.nearest(e, 10, "vec_id", "embedding").join(asked.select(F.col("vec_id").alias("id")), "id", "left_semi")
    return knn.recall(found, exact).select("asked", "recall", F.lit(round(report["coded"], 4)).alias("codes_compared"), F.lit(round(report["compared"], 4)).alias("vectors_compared"))


@query(KNN_SQL.format(where="WHERE a.vec_id % 50 = 0") + "SELECT vec_id, neighbor_id, rank::INT AS rank, round(dist, 6) AS dist FROM r WHERE rank <= 10")
def index_knn_proven(spark, sf_dir):
    """The ten nearest of every fiftieth vector through the index, with bounds that prove the rest farther."""
    asked = table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0")
    found = vector_index_of(spark, sf_dir).search(asked, "vec_id", "embedding", 10, prove=True)
    return found.select(F.col("id").alias("vec_id"), F.col("neighbor").alias("neighbor_id"), "rank", F.round("dist", 6).alias("dist"))


@query(KNN_SQL.format(where="AND a.label <> b.label") + "SELECT vec_id, neighbor_id, rank::INT AS rank, round(dist, 6) AS dist FROM r WHERE rank <= 8")
def knn_pruned_cells(spark, sf_dir):
    """The eight nearest vectors of other groups, cell by cell, with cells left out that can't hold one."""
    found = knn.pruned(table(spark, sf_dir, "embeddings"), 8, "vec_id", "embedding", "label", cells=8)
    return found.select(F.col("id").alias("vec_id"), F.col("neighbor").alias("neighbor_id"), "rank", F.round("dist", 6).alias("dist"))


_VECTORS: dict[tuple[str, str], VectorIndex] = {}


def vector_index_of(spark, sf_dir):
    """The index of the vectors of a folder, written once for an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _VECTORS or not _VECTORS[key].exists():
        where = f"{shared_dir(spark).rstrip('/')}/docweave-vector-index-{uuid.uuid4().hex}"
        delete_on_exit(spark, where)
        _VECTORS[key] = VectorIndex.build(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", where, Coding(cells=16, per_code=1))
    return _VECTORS[key]


@query(EDGES_SQL + """, c AS (SELECT src AS x, dst AS y FROM e WHERE status = 'accepted' AND weight > 0.3), u AS (SELECT x, y FROM c UNION SELECT y, x FROM c),
walk(node, comp) AS (SELECT x, x FROM u UNION SELECT u.y, walk.comp FROM walk JOIN u ON walk.node = u.x) SELECT node, min(comp) AS component FROM walk GROUP BY node""")
def edge_components(spark, sf_dir):
    """Components of the stronger accepted edges, over many hops."""
    return connected_components(_edges(spark, sf_dir).where("status = 'accepted' AND weight > 0.3"))


ORACLES["edge_components"] = ORACLES["edge_components"].replace("WITH v AS", "WITH RECURSIVE v AS", 1)

HOPS = EDGES_SQL + """, n AS (SELECT vec_id AS id, CASE label % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' END AS language, CASE WHEN vec_id % 10 < 7 THEN 'train' ELSE 'test' END AS split FROM embeddings),
he AS (SELECT e.edge_id, e.src, e.dst, e.directed, e.weight, a.split FROM e JOIN n a ON a.id = e.src JOIN n b ON b.id = e.dst WHERE e.status = 'accepted' AND a.language IS NOT DISTINCT FROM b.language AND a.split = b.split AND e.weight < 0.9)
"""


def _hop_edges(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    language = F.when(F.col("label") % 3 == 0, "en").when(F.col("label") % 3 == 1, "de")
    nodes = v.select(F.col("vec_id").alias("id"), language.alias("language"), F.when(F.col("vec_id") % 10 < 7, "train").otherwise("test").alias("split"), F.col("embedding").cast("array<double>").alias("vec"))
    edges = _edges(spark, sf_dir).where("status = 'accepted'").select("edge_id", "src", "dst", "rel", "directed")
    return training.hop_edges(edges, nodes, ["similar"], 0.9)


@query(HOPS + "SELECT edge_id, src, dst, split FROM he")
def hop_edges(spark, sf_dir):
    """Edges that a multi-hop path may follow."""
    return _hop_edges(spark, sf_dir).select("edge_id", "src", "dst", "split")


PATHS = """, adj AS (SELECT {split} AS split, edge_id, src, dst, sha256('path' || chr(31) || edge_id || chr(31)) AS h FROM he UNION ALL SELECT {split}, edge_id, dst, src, sha256('path' || chr(31) || edge_id || chr(31)) FROM he WHERE NOT directed),
st AS (SELECT DISTINCT split, src AS start, 2 + floor(('0x' || (sha256('path' || chr(31) || 'hops' || chr(31) || src::VARCHAR || chr(31)))[1:13])::BIGINT / 4503599627370496.0 * 2)::INT AS target FROM adj),
p2 AS (SELECT s.split, start, target, [start, a.dst, b.dst] AS nodes, [a.h, b.h] AS hs FROM st s JOIN adj a ON a.split = s.split AND a.src = start JOIN adj b ON b.split = s.split AND b.src = a.dst WHERE a.dst <> start AND b.dst NOT IN (start, a.dst)),
p3 AS (SELECT p.split, start, target, list_append(nodes, c.dst) AS nodes, list_append(hs, c.h) AS hs FROM p2 p JOIN adj c ON c.split = p.split AND c.src = nodes[3] WHERE target = 3 AND NOT list_contains(nodes, c.dst)),
best AS (SELECT split, start, nodes FROM (SELECT * FROM p2 WHERE target = 2 UNION ALL SELECT * FROM p3) QUALIFY row_number() OVER (PARTITION BY split, start ORDER BY hs, nodes) = 1)
"""


@query(HOPS + PATHS.format(split="'all'") + "SELECT start, array_to_string(nodes, '-') AS nodes FROM best")
def hop_paths(spark, sf_dir):
    """Of each node the first simple path of two or three hops."""
    found = training.hop_paths(_hop_edges(spark, sf_dir), 2, 3)
    return found.select("start", F.array_join(F.transform("nodes", lambda n: n.cast("string")), "-").alias("nodes"))


@query(HOPS + PATHS.format(split="split") + """, turns AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sha256('path' || chr(31) || start::VARCHAR || chr(31)), start) AS n FROM best), few AS (SELECT * FROM turns WHERE split = 'test' AND n <= 9)
SELECT split, start, array_to_string(nodes, '-') AS nodes FROM few UNION ALL SELECT split, start, array_to_string(nodes, '-') FROM turns WHERE split = 'train' AND n <= 30 - (SELECT count(*) FROM few)
""")
def split_hop_paths(spark, sf_dir):
    """Paths by split, thirty in all as the quota has it: each split its share, the largest the rest."""
    found = training.split_hop_paths(_hop_edges(spark, sf_dir), {"train": 0.7, "test": 0.3}, 30, 2, 3)
    return found.select("split", "start", F.array_join(F.transform("nodes", lambda n: n.cast("string")), "-").alias("nodes"))


@query("""
WITH RECURSIVE p AS (SELECT p_partkey AS b, lag(p_partkey) OVER (PARTITION BY p_type, p_size ORDER BY p_partkey) AS a FROM part), u AS (SELECT a AS x, b AS y FROM p WHERE a IS NOT NULL UNION SELECT b, a FROM p WHERE a IS NOT NULL),
r(node, comp) AS (SELECT x, x FROM u UNION SELECT u.y, r.comp FROM r JOIN u ON r.node = u.x) SELECT node AS id, min(comp) AS root FROM r GROUP BY node
""")
def union_find_without_conflicts(spark, sf_dir):
    """Evidence that nothing speaks against joins whole components."""
    w = Window.partitionBy("p_type", "p_size").orderBy("p_partkey")
    pairs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("b"), F.lag("p_partkey").over(w).alias("a")).where("a IS NOT NULL")
    return merging.guarded_union_find(pairs.select("a", "b", F.when(F.col("a") % 2 == 0, "identical").otherwise("same").alias("kind"), (F.col("b") % 10 / 10.0).alias("p")))


@query("""
WITH p AS (SELECT p_partkey AS b, lag(p_partkey) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS a, lag(p_partkey, 2) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS c, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)
SELECT a, b, 'judged_different' AS reason FROM p WHERE n = 3 AND c IS NOT NULL
""")
def refused_unions(spark, sf_dir):
    """The first three parts of a brand: the second is the first, the third is the second but not the first."""
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", F.row_number().over(w).alias("n"), F.lag("p_partkey").over(w).alias("a"), F.lag("p_partkey", 2).over(w).alias("c"))
    same = p.where("n IN (2, 3)").select("a", F.col("p_partkey").alias("b"), F.lit("same").alias("kind"), (1.0 - F.col("n") / 10).alias("p"))
    apart = p.where("n = 3").select(F.col("c").alias("a"), F.col("p_partkey").alias("b"), F.lit("different").alias("kind"), F.lit(0.9).alias("p"))
    return merging.refused_unions(same.unionByName(apart))


# ---- training data -----------------------------------------------------------------------

SOURCES_SQL = """
WITH ch AS (SELECT o_orderkey AS id, o_orderstatus AS t, o_orderpriority AS r FROM orders), ed AS (SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS id, l_returnflag AS rel FROM lineitem),
a AS (SELECT id, row_number() OVER (PARTITION BY t, r ORDER BY sha256('instruct' || chr(31) || id::VARCHAR || chr(31)), id) AS n, t, r FROM ch), b AS (SELECT id, rel, row_number() OVER (PARTITION BY rel ORDER BY sha256('reason' || chr(31) || id || chr(31)), id) AS n FROM ed)
(SELECT 'instruct' AS template, 'instruction' AS kind, id::VARCHAR AS source_key FROM a ORDER BY n, t, r LIMIT 50) UNION ALL (SELECT 'reason', 'graph_reasoning', id FROM b ORDER BY n, rel LIMIT 40)
UNION ALL SELECT 'facts', 'triples', id FROM ed UNION ALL SELECT 'facts', 'triples', 'c' || ps FROM (SELECT DISTINCT l_suppkey::VARCHAR AS ps FROM lineitem) UNION ALL (SELECT 'pairs', 'retrieval_pairs', id::VARCHAR FROM ch WHERE t = 'F' ORDER BY ch.id LIMIT 30)
"""


@query(SOURCES_SQL)
def training_sources(spark, sf_dir):
    """What each template is made of, within its quota."""
    o, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    tables = {
        "chunks": o.select(F.col("o_orderkey").alias("chunk_id"), F.col("o_orderstatus").alias("doc_type"), F.col("o_orderpriority").alias("role"), F.lit(99).alias("tokens")),
        "edges": line.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("edge_id"), F.col("l_returnflag").alias("rel")),
        "claims": line.select(F.concat(F.lit("c"), F.col("l_suppkey").cast("string")).alias("claim_id")).distinct(),
        "examples": o.select(F.col("o_orderkey").alias("example_id"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("review").alias("status"))}
    kinds = [("instruct", "instruction", 50), ("reason", "graph_reasoning", 40), ("facts", "triples", None), ("pairs", "retrieval_pairs", 30)]
    return training.sources(kinds, tables)


@query("""
WITH c AS (SELECT l_orderkey AS example, CASE WHEN bool_or(l_returnflag = 'R') THEN 'rejected' WHEN bool_and(l_returnflag = 'A') THEN 'accepted' ELSE 'review' END AS status FROM lineitem GROUP BY 1),
r AS (SELECT l_orderkey AS example, max_by(l_suppkey % 4 = 0, l_linenumber * 1000000 + l_suppkey) AS bad FROM lineitem WHERE l_linenumber > 1 GROUP BY 1)
SELECT example, CASE WHEN bad THEN 'rejected' ELSE status END AS status FROM c LEFT JOIN r USING (example)
""")
def example_status_with_rules(spark, sf_dir):
    """Statuses of examples, where the last check of the output rules overrules."""
    line = table(spark, sf_dir, "lineitem")
    checks = line.select(F.col("l_orderkey").alias("example"), F.when(F.col("l_returnflag") == "R", "reject").when(F.col("l_returnflag") == "A", "accept").otherwise("open").alias("outcome"))
    rules = line.where("l_linenumber > 1").select(F.col("l_orderkey").alias("example"), (F.col("l_linenumber") * 1000000 + F.col("l_suppkey")).alias("round"), F.when(F.col("l_suppkey") % 4 == 0, "reject").otherwise("accept").alias("outcome"))
    return training.example_status(checks, "example", rules=rules)


@query("""
WITH r AS (SELECT o_orderkey AS id, o_orderkey % 7 AS k FROM orders), n AS (SELECT id, k, CASE WHEN k >= 4 OR k = 0 THEN 0 WHEN k = 3 THEN 0 ELSE least(2, k) END AS rounds FROM r)
SELECT id, CASE WHEN k IN (1, 2) THEN 'v' || k ELSE 'v0' END AS version, CASE WHEN k = 3 THEN 1 ELSE 1 + rounds END::BIGINT AS checks, CASE WHEN k = 3 THEN 'reject' ELSE 'accept' END AS last FROM n
""")
def reauthored(spark, sf_dir):
    """Drafts written again until they pass, two times at most; some are never rewritten."""
    drafts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 7).alias("k"), F.lit(0).alias("version"))
    check = lambda d: d.select("id", F.when(F.col("k").isin(1, 2, 3) & (F.col("version") < F.col("k")), "reject").otherwise("accept").alias("outcome"))
    rewrite = lambda d: d.where("k <> 3").withColumn("version", F.col("version") + 1)
    held, checks = training.reauthor(drafts, check, rewrite, "id")
    last = checks.groupBy("id").agg(F.count("*").alias("checks"), F.max_by("outcome", "round").alias("last"))
    return held.join(last, "id").select("id", F.concat(F.lit("v"), F.col("version").cast("string")).alias("version"), "checks", "last")


# ---- questions ---------------------------------------------------------------------------

OFFLINE = "(CASE WHEN ('0x' || (sha256({q} || chr(31) || {s}))[1:8])::BIGINT % 10 <> 0 THEN 0.97 ELSE 0.02 END)"


@query("SELECT item_id::VARCHAR AS item_id, 'animals' AS parent, 'cat' AS choice FROM benchmark")
def hierarchical_choice(spark, sf_dir):
    """A choice in two steps by the offline provider, which takes the first real option."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("state"))
    return provider.hierarchical(items, "kind@1", "kind", {"none": ["none"], "animals": ["other", "cat", "dog"], "plants": ["oak"]})


@query("""
WITH RECURSIVE a AS (SELECT p_brand AS state, p_partkey::VARCHAR AS q, ceil(length(p_name || ' ') / 4.0)::BIGINT AS n, p_name, 'k' || p_partkey::VARCHAR AS k FROM part),
o AS (SELECT state, k, n, row_number() OVER (PARTITION BY state ORDER BY p_name, k) AS i, 60 - ceil(length(state) / 4.0)::BIGINT AS room FROM a),
r AS (SELECT state, k, i, n AS used, 1 AS held, 0 AS call, room FROM o WHERE i = 1
 UNION ALL SELECT o.state, o.k, o.i, CASE WHEN r.used + o.n > r.room OR r.held >= 5 THEN o.n ELSE r.used + o.n END, CASE WHEN r.used + o.n > r.room OR r.held >= 5 THEN 1 ELSE r.held + 1 END, CASE WHEN r.used + o.n > r.room OR r.held >= 5 THEN r.call + 1 ELSE r.call END, r.room
 FROM r JOIN o ON o.state = r.state AND o.i = r.i + 1)
SELECT state, k AS cache_key, call::BIGINT AS call FROM r
""")
def packed_questions(spark, sf_dir):
    """Questions of one state in as few calls as its window and the most questions of a call take."""
    asked = table(spark, sf_dir, "part").select(F.col("p_brand").alias("state"), F.col("p_name").alias("question"), F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("cache_key"), F.array(F.lit("")).alias("options"))
    return provider.packed(asked, 60, 5).select("state", "cache_key", "call")


@query("""
WITH p AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'noul' WHEN 1 THEN 'score' ELSE 'choice' END AS kind, event_id % 5 AS levels, value AS v, user_id % 7 AS u FROM events),
q AS (SELECT kind, CASE WHEN kind = 'noul' THEN v / 100 WHEN kind = 'score' AND levels > 1 THEN (v % 4) / (levels - 1) END AS o, CASE WHEN kind = 'noul' THEN (v + u) / 100 WHEN kind = 'score' AND levels > 1 THEN ((v + u) % 4) / (levels - 1) END AS n, u % 3 <> 0 AS other FROM p)
SELECT count(*) AS compared, count(*) FILTER (WHERE CASE WHEN kind = 'choice' THEN other ELSE (o >= 0.5) <> (n >= 0.5) END) AS flips, round(stddev_pop(n - o), 6) AS stdev, true AS breach FROM q
""")
def drift_of_answers(spark, sf_dir):
    """Drift over probabilities, scores and choices."""
    u = F.col("user_id") % 7
    kind = F.when(F.col("event_id") % 3 == 0, "noul").when(F.col("event_id") % 3 == 1, "score").otherwise("choice")
    value = lambda v: F.when(F.col("event_id") % 3 == 0, v / 100).otherwise(v % 4)
    pairs = table(spark, sf_dir, "events").select(
        kind.alias("kind"), value(F.col("value")).alias("old_p"), value(F.col("value") + u).alias("new_p"), F.lit("0").alias("old_choice"), (u % 3).cast("string").alias("new_choice"), (F.col("event_id") % 5).alias("levels"),
        F.lit("m").alias("old_model"), F.lit("m").alias("new_model"))
    return audit.drift_answers(pairs).select("compared", "flips", F.round("stdev", 6).alias("stdev"), "breach")


@query("""
WITH i AS (SELECT o_orderpriority AS stage, count(*) AS items FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), r AS (SELECT o_orderpriority AS stage, o_orderdate AS ended, o_orderkey AS k, o_custkey AS done, o_custkey * 2 + 1 AS calls, o_orderkey + 5 AS tokens FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY stage ORDER BY ended DESC, k DESC) = 1), c AS (SELECT stage, items, items * coalesce(calls / done, 2.0) AS calls, coalesce(tokens / l.calls, 900.0) AS per FROM i LEFT JOIN l USING (stage))
SELECT stage, items, round(calls, 6) AS calls, round(greatest(calls / 1200 * 60, calls * per / 250000) + items * 0.5 / 8, 6) AS seconds FROM c
""")
def planned_stages(spark, sf_dir):
    """How long stages will take, by their last finished run where there is one."""
    o = table(spark, sf_dir, "orders")
    items = o.where("o_orderstatus = 'O'").groupBy(F.col("o_orderpriority").alias("stage")).agg(F.count("*").alias("items"))
    ended = F.struct("o_orderdate", "o_orderkey")
    runs = o.where("o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'").select(
        F.col("o_orderpriority").alias("stage"), F.lit("done").alias("status"), ended.alias("ended_at"), F.col("o_custkey").alias("done"), (F.col("o_custkey") * 2 + 1).alias("calls"), (F.col("o_orderkey") + 5).alias("tokens"))
    return audit.estimate(items, runs, (2.0, 900.0, 0.5), 1200, 250_000, 8)


# ---- the session ---------------------------------------------------------------------------


def _session(spark, sf_dir):
    """A snapshot of documents as one chunk each, with edges between near vectors."""
    root = f"{shared_dir(spark).rstrip('/')}/docweave-session-{uuid.uuid4().hex}"
    d = table(spark, sf_dir, "documents")
    d.select("doc_id", F.col("source").alias("doc_type"), F.col("lang").alias("language"), (F.col("doc_id") % 11 == 0).alias("quarantined")).write.parquet(f"{root}/documents")
    hashed = F.pandas_udf(lambda ts: ts.map(lambda t: tx.hashed_vector(t or "", 16)), "array<double>")
    d.select(F.col("doc_id").cast("string").alias("chunk_id"), "doc_id", F.lit(0).alias("ord"), "text", F.lit("accepted").alias("status"), F.lit("x").alias("role"), tx.tokens(F.col("text")).alias("tokens"), hashed("text").alias("embedding")).write.parquet(f"{root}/chunks")
    e = _edges(spark, sf_dir)
    e.select("edge_id", F.col("src").cast("string").alias("src_id"), F.col("dst").cast("string").alias("dst_id"), "rel", "weight", "structural", "status", F.lit("chunk").alias("src_kind"), F.lit("chunk").alias("dst_kind")).write.parquet(f"{root}/edges")
    return GraphSession(spark, root, 16)


@query()
def session_search(spark, sf_dir):
    """The ten best chunks for a question: a report of that length."""
    return _session(spark, sf_dir).search("the house of the people", 10).select("id", "rank", F.round("rrf", 9).alias("rrf"))


@query()
def session_context(spark, sf_dir):
    """Cited passages for a question, within its budget of tokens."""
    found = _session(spark, sf_dir).context("the house of the people", Plan(seeds=5, hops=2, neighbours=3, tokens=4000))
    return found.select("passage", "id", F.md5("text").alias("digest"))


# ---- twins of sequential rules --------------------------------------------------------------

ORACLES["greedy_dedup"] = KNN_SQL.format(where="") + """, p AS (SELECT DISTINCT least(vec_id, neighbor_id) AS a, greatest(vec_id, neighbor_id) AS b FROM r WHERE rank <= 6 AND dist <= 0.65),
l AS (SELECT list_prepend([]::BIGINT[][], list([[a, b]] ORDER BY a, b)) AS ps FROM p),
g AS (SELECT list_reduce(ps, lambda acc, x: CASE WHEN list_contains(list_transform(acc, lambda q: q[2]), x[1][1]) OR list_contains(list_transform(acc, lambda q: q[2]), x[1][2]) THEN acc ELSE list_concat(acc, x) END) AS gone FROM l)
SELECT x[2] AS dropped, x[1] AS kept FROM (SELECT unnest(gone) AS x FROM g)
"""
ORACLES["passage_assembly"] = """
WITH rows AS (SELECT label AS q, vec_id AS id, vec_id % 7 AS doc_id, (vec_id * 13) % 90 + 10 AS tokens FROM embeddings), l AS (SELECT q, list_prepend([]::BIGINT[][], list([[id, tokens]] ORDER BY doc_id, id)) AS ps FROM rows GROUP BY q),
g AS (SELECT q, list_reduce(ps, lambda acc, x: CASE WHEN coalesce(list_sum(list_transform(acc, lambda y: y[2])), 0) + x[1][2] <= 600 THEN list_concat(acc, x) ELSE acc END) AS kept FROM l)
SELECT q, kept[i][1] AS id, 'p' || i::VARCHAR AS passage FROM (SELECT q, kept, unnest(range(1, len(kept) + 1)) AS i FROM g)
"""
ORACLES["soft_relevance"] = KNN_SQL.format(where="") + f"SELECT vec_id AS id, neighbor_id AS neighbor, {OFFLINE.format(q=chr(39) + 'relevant' + chr(39), s='vec_id::VARCHAR || chr(45) || neighbor_id::VARCHAR')}::DOUBLE AS label, 'accepted' AS status FROM r WHERE rank <= 10"
ORACLES["provider_gates"] = f"SELECT item_id::VARCHAR AS item_id, CASE WHEN {OFFLINE.format(q=chr(39) + 'related' + chr(39), s='text')} > 0.5 THEN 'accept' ELSE 'reject' END AS outcome FROM benchmark"

@query(f"""
WITH q(question, was) AS (VALUES ('related', true), ('relevant', true), ('of the same make', false))
SELECT item_id::VARCHAR AS item_id, question, was AS reused, {OFFLINE.format(q='question', s='text')}::DOUBLE AS p FROM benchmark, q
""")
def reused_answers(spark, sf_dir):
    """A new version of a question set: one question as it was, one moved, one reworded; only the last is asked."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("state"))
    store = answers.temporary(spark)
    store.ask(items, "links@1", [provider.Question("related"), provider.Question("of one make"), provider.Question("relevant")])
    return store.ask(items, "links@2", [provider.Question("relevant"), provider.Question("related"), provider.Question("of the same make")]).select("item_id", "question", "reused", "p")


@query("""
WITH i AS (SELECT conv_id, min(turn) AS first, list_sort(list(DISTINCT role)) AS roles FROM conversations GROUP BY conv_id), p AS (SELECT DISTINCT conv_id, turn::VARCHAR AS part, turn % 2 AS odd FROM conversations),
q AS (SELECT conv_id, NULL AS part, 'whole' AS logical, 'whole' AS question, [] AS options FROM i UNION ALL SELECT conv_id, NULL, 'speaker', 'Who asks?', roles FROM i
 UNION ALL SELECT conv_id, part, 'asks', 'Does turn ' || part || ' ask?', [] FROM p UNION ALL SELECT conv_id, part, 'tone', 'Tone of ' || part, [] FROM p WHERE odd = 0)
SELECT conv_id::VARCHAR AS item_id, part, logical, question, array_to_string(options, ',') AS options, 'k' || sha256('turns@3' || chr(31) || logical || chr(31) || coalesce(part, '') || chr(31))[1:12] AS key FROM q
""")
def fanned_questions(spark, sf_dir):
    """Questions on conversations and on each of their turns, some of them only on some turns, with opaque keys."""
    c = table(spark, sf_dir, "conversations").withColumn("item_id", F.col("conv_id").cast("string"))
    items = c.groupBy("item_id").agg(F.min("turn").cast("string").alias("state"), F.sort_array(F.collect_set("role")).alias("roles"))
    parts = c.select("item_id", F.col("turn").cast("string").alias("part"), F.when(F.col("turn") % 2 == 1, F.array(F.lit("asks"))).alias("only"))
    Q = provider.Question
    asked = provider.fanned(items, parts, "turns@3", [Q("whole"), Q("speaker", "choice", text="Who asks?", options_from="roles"), Q("asks", text="Does turn {part} ask?", fan=True), Q("tone", "score", levels=3, text="Tone of {part}", fan=True)])
    return asked.select("item_id", "part", "logical", "question", F.array_join("options", ",").alias("options"), "key")


@query("""
WITH w AS (SELECT l_partkey AS chunk, l_orderkey AS doc, (l_orderkey <> min(l_orderkey) OVER (PARTITION BY l_partkey))::INT AS r FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem)),
v AS (SELECT chunk, doc, r, 'status' AS field, o_orderstatus AS value FROM w JOIN orders ON o_orderkey = doc UNION ALL SELECT chunk, doc, r, 'priority', o_orderpriority FROM w JOIN orders ON o_orderkey = doc WHERE doc % 3 = 0),
s AS (SELECT chunk, field, value, min((r, doc)) AS place FROM v GROUP BY ALL), n AS (SELECT chunk, field, list(value ORDER BY place) AS after FROM s GROUP BY ALL), o AS (SELECT chunk, field, list(value) AS before FROM v WHERE r = 0 GROUP BY ALL)
SELECT field, coalesce(array_to_string(before, ','), '') AS before, coalesce(array_to_string(after, ','), '') AS after, count(*) AS chunks FROM o FULL JOIN n USING (chunk, field)
WHERE coalesce(list_sort(before), []) <> coalesce(list_sort(after), []) GROUP BY ALL
""")
def metadata_report(spark, sf_dir):
    """What it changes when chunks get the values of all documents that reuse them, counted by change."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("chunk_id"), F.col("l_orderkey").alias("doc_id")).distinct()
    own = l.groupBy("chunk_id").agg(F.min("doc_id").alias("doc_id"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderstatus", "o_orderpriority")
    documents = o.select("doc_id", F.lit("status").alias("field"), F.array("o_orderstatus").alias("values")).unionByName(o.where("doc_id % 3 = 0").select("doc_id", F.lit("priority").alias("field"), F.array("o_orderpriority").alias("values")))
    old = cu.chunk_values(own, own.where("false"), documents)
    return cu.metadata_report(cu.metadata_changes(old, cu.chunk_values(own, l, documents)))


# ---- stage steps without a query so far -----------------------------------------------------


@query("""
WITH c AS (SELECT conv_id AS doc_id, turn AS ord, [role, string_split(text, chr(10))[1]] AS p FROM conversations)
SELECT doc_id, ord, coalesce(array_to_string(lag(p) OVER (PARTITION BY doc_id ORDER BY ord), ' > '), '') AS prefix FROM c
""")
def context_prefixes(spark, sf_dir):
    """Chunks with the headings at the end of the chunk before."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ord"), F.array("role", F.get(F.split("text", "\n"), F.lit(0))).alias("last_heading_path"))
    return cu.context_prefix(c).select("doc_id", "ord", F.coalesce("context_prefix", F.lit("")).alias("prefix"))


@query("""
SELECT l_orderkey AS doc_id, l_linenumber AS id FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) o WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey % 3 = 0)
AND l_linenumber NOT IN (SELECT l_linenumber FROM lineitem WHERE l_suppkey % 3 = 0 AND l_orderkey % 5 = 0 AND l_linenumber < 4)
""")
def items_no_longer_made(spark, sf_dir):
    """Items of orders that were made anew, but not made again."""
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("id"), "l_suppkey").distinct()
    scope = line.where("l_suppkey % 3 = 0").select("doc_id", F.when((F.col("doc_id") % 5 == 0) & (F.col("id") < 4), F.col("id")).alias("id"))
    return cu.no_longer_made(line.select("doc_id", "id").distinct(), scope, "id", "doc_id")


@query("SELECT l_orderkey AS example_id, CASE WHEN bool_and(l_suppkey % 2 = 0) THEN 'accepted' ELSE 'rejected' END AS status FROM lineitem GROUP BY 1")
def needed_hops(spark, sf_dir):
    """Multi-hop examples of which every hop is needed."""
    checks = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("example_id"), F.when(F.col("l_suppkey") % 2 == 0, "reject").otherwise("accept").alias("outcome"))
    return cu.hop_status(checks)


@query("SELECT event_id::VARCHAR || '-review' AS review_id, 'reject' AS verdict, event_type <> 'click' AS overturned FROM events WHERE event_id = 7")
def resolved_review(spark, sf_dir):
    """One review found by the beginning of its id, and whether its verdict overturns the outcome."""
    q = table(spark, sf_dir, "events").select(F.concat(F.col("event_id").cast("string"), F.lit("-review")).alias("review_id"), F.when(F.col("event_type") == "click", "reject").otherwise("accept").alias("outcome"))
    return cu.resolve_review(q, "7-", "reject").select("review_id", "verdict", "overturned")


@query("SELECT list_sort(list(DISTINCT p_type)) AS kept FROM part WHERE p_type LIKE 'S%' AND p_type NOT LIKE '%TIN'")
def kept_proposals(spark, sf_dir):
    """Proposed names that are supported and overlap nothing."""
    names = table(spark, sf_dir, "part").where("p_type LIKE 'S%'").select(F.col("p_type").alias("name"))
    none = names.where("false")
    kept = cu.kept_proposals(names, names.where("name LIKE '%TIN'"), none.select(F.col("name").alias("a"), F.col("name").alias("b")), none)
    return kept.agg(F.sort_array(F.collect_set("name")).alias("kept"))


@query("""
WITH RECURSIVE n AS (SELECT DISTINCT p_name AS name FROM part), o AS (SELECT x.name AS a, y.name AS b FROM n x JOIN n y ON x.name < y.name AND split_part(x.name, ' ', 2) = split_part(y.name, ' ', 2) AND (length(x.name) + length(y.name)) % 3 <> 0),
p AS (SELECT name, row_number() OVER (ORDER BY name) AS i FROM n WHERE name NOT LIKE '%rod' AND name NOT IN (SELECT a FROM o WHERE b = 'small gizmo' UNION ALL SELECT b FROM o WHERE a = 'small gizmo')),
r(i, taken) AS (SELECT 0, []::VARCHAR[] UNION ALL SELECT r.i + 1, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.b = p.name AND list_contains(r.taken, o.a)) THEN r.taken ELSE list_append(r.taken, p.name) END FROM r JOIN p ON p.i = r.i + 1)
SELECT unnest(taken) AS name FROM r WHERE i = (SELECT max(i) FROM p)
""")
def greedy_proposals(spark, sf_dir):
    """Names taken in order unless they overlap one taken before or a known one."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    a, b = names.select(F.col("name").alias("a"), F.split_part("name", F.lit(" "), F.lit(2)).alias("w")), names.select(F.col("name").alias("b"), F.split_part("name", F.lit(" "), F.lit(2)).alias("w"))
    overlaps = a.join(b, "w").where("a < b AND (length(a) + length(b)) % 3 <> 0").select("a", "b")
    return cu.kept_proposals(names, names.where("name LIKE '%rod'"), overlaps, names.where("name = 'small gizmo'"))


QUEUE = """
WITH q AS (SELECT event_id::VARCHAR || '-' || event_type AS review_id, user_id::VARCHAR AS subject_id, CASE WHEN event_id % 40 = 3 THEN 'resolved' ELSE 'open' END AS status, CASE event_id % 3 WHEN 0 THEN 'accept' WHEN 1 THEN 'reject' END AS outcome FROM events),
v AS (SELECT event_id::VARCHAR || '-' AS prefix, CASE WHEN event_id % 4 < 2 THEN 'accept' ELSE 'reject' END AS verdict FROM events WHERE value > 60), r AS (
SELECT prefix, verdict, CASE WHEN status = 'open' THEN review_id END AS review_id, CASE WHEN status = 'open' THEN subject_id END AS subject_id, CASE WHEN status = 'open' THEN coalesce(outcome <> verdict, false) END AS overturned, CASE WHEN status = 'resolved' THEN 'already resolved' END AS problem
FROM v JOIN q ON split_part(q.review_id, '-', 1) || '-' = v.prefix)
"""


def _verdicts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    queue = e.select(
        F.concat_ws("-", F.col("event_id").cast("string"), "event_type").alias("review_id"), F.lit("user").alias("subject_kind"), F.col("user_id").cast("string").alias("subject_id"),
        F.when(F.col("event_id") % 40 == 3, "resolved").otherwise("open").alias("status"), F.when(F.col("event_id") % 3 == 0, "accept").when(F.col("event_id") % 3 == 1, "reject").alias("outcome"))
    verdicts = e.where("value > 60").select(F.concat(F.col("event_id").cast("string"), F.lit("-")).alias("prefix"), F.when(F.col("event_id") % 4 < 2, "accept").otherwise("reject").alias("verdict"))
    return cu.resolved_reviews(queue, verdicts)


@query(QUEUE + "SELECT prefix, verdict, review_id, subject_id, overturned, problem FROM r")
def resolved_reviews(spark, sf_dir):
    """Many verdicts at once, each on the one open review that its prefix names."""
    return _verdicts(spark, sf_dir).drop("subject_kind")


@query(QUEUE + """, l AS (SELECT subject_id, max_by(verdict, review_id) AS verdict FROM r WHERE problem IS NULL GROUP BY 1)
SELECT user_id, CASE verdict WHEN 'accept' THEN 'accepted' WHEN 'reject' THEN 'rejected' ELSE 'review' END AS status, coalesce(verdict = 'reject', true) AS quarantined FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN l ON l.subject_id = u.user_id::VARCHAR
""")
def rows_with_verdicts(spark, sf_dir):
    """The verdicts on the rows that they are about."""
    rows = table(spark, sf_dir, "events").select("user_id").distinct().select("user_id", F.lit("review").alias("status"), F.lit(True).alias("quarantined"))
    return cu.with_verdicts(rows, "user_id", "user", _verdicts(spark, sf_dir))


@query("""
WITH e AS (SELECT o_custkey AS src, (o_custkey * 7) % 1000 AS dst, CASE o_orderstatus WHEN 'F' THEN 'accepted' ELSE 'review' END AS status FROM orders),
h AS (SELECT src AS id FROM e WHERE status = 'accepted' UNION SELECT dst FROM e WHERE status = 'accepted'), l AS (SELECT src AS id FROM e WHERE status = 'review' UNION SELECT dst FROM e WHERE status = 'review')
SELECT c_custkey AS item_id, CASE WHEN c_custkey IN (SELECT id FROM l) AND c_custkey NOT IN (SELECT id FROM h) THEN 'pending' ELSE 'done' END AS status FROM customer
""")
def reopened_links(spark, sf_dir):
    """Link items whose last accepted edge an audit took."""
    e = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("src"), ((F.col("o_custkey") * 7) % 1000).alias("dst"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("review").alias("status"), F.lit(False).alias("structural"))
    items = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item_id"), F.lit("done").alias("status"))
    return cu.reopened_links(items, e)


@query("""
WITH w AS (SELECT p_partkey AS id, p_size::VARCHAR AS own FROM part)
SELECT id, CASE WHEN id % 2 = 0 THEN '9.1,9.1.' || own ELSE own END AS "values" FROM w
""")
def widened_values(spark, sf_dir):
    """Own values with the broader ones that the corpus knows."""
    own = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("9.1."), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.array_join(tx.widened(F.array(own), ["9.0", "9.1"]), ",").alias("values"))


#: The common subsequence of strings x and y, a row of the table for each letter.
LCS = """list_last(list_reduce(list_prepend(list_transform(range(length({y}) + 1), lambda i: 0), list_transform(range(1, length({x}) + 1), lambda i: [ascii({x}[i])])),
  lambda old, c: list_transform(range(1, length({y}) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda i: CASE WHEN i > 1 AND ascii({y}[i - 1]) = c[1] THEN old[i - 1] + 1 ELSE old[i] END)))))"""
RATIO = "200.0::DOUBLE * " + LCS + " / (length({x}) + length({y}))"

SETS = """
WITH p AS (SELECT p_partkey AS id, p_name AS a, p_type || ' ' || p_name AS b FROM part), n AS (SELECT DISTINCT p_name || ' of ' || p_type AS x, p_type || 's ' || split_part(p_name, ' ', 2) AS y FROM part),
w AS (SELECT x, y, list_sort(list_distinct(string_split(x, ' '))) AS xs, list_sort(list_distinct(string_split(y, ' '))) AS ys FROM n),
s AS (SELECT x, y, array_to_string(list_sort(list_intersect(xs, ys)), ' ') AS core, array_to_string(list_filter(xs, lambda v: NOT list_contains(ys, v)), ' ') AS ox, array_to_string(list_filter(ys, lambda v: NOT list_contains(xs, v)), ' ') AS oy FROM w),
t AS (SELECT *, trim(core || ' ' || ox) AS l, trim(core || ' ' || oy) AS r FROM s)
"""


@query(SETS + "SELECT x, y, round(CASE WHEN core <> '' AND (ox = '' OR oy = '') THEN 100.0 ELSE greatest(" + RATIO.format(x="l", y="r") + ", CASE WHEN core <> '' THEN greatest(" + RATIO.format(x="core", y="l") + ", " + RATIO.format(x="core", y="r") + ") ELSE 0 END) END, 6) AS ratio FROM t")
def unlike_name_ratios(spark, sf_dir):
    """Likeness by sets of words of names that share some words and differ in others."""
    ratio = F.pandas_udf(lambda a, b: a.combine(b, fuzzy.token_set_ratio), "double")
    p = table(spark, sf_dir, "part")
    names = p.select(F.concat_ws(" of ", "p_name", "p_type").alias("x"), F.concat(F.col("p_type"), F.lit("s "), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("y")).distinct()
    return names.select("x", "y", F.round(ratio("x", "y"), 6).alias("ratio"))


@query("WITH n AS (SELECT DISTINCT p_name || ' ' || p_type AS s FROM part), q AS (SELECT a.s AS a, b.s AS b FROM n a JOIN n b ON a.s < b.s), r AS (SELECT a, b, " + RATIO.format(x="a", y="b") + " AS ratio FROM q) SELECT a, b, round(ratio, 6) AS ratio FROM r WHERE ratio >= 85")
def alike_names(spark, sf_dir):
    """Pairs of names with a ratio of 85 or more, found by a join on pairs of letters."""
    names = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("s"))
    return fuzzy.alike(names, "s", 85).select("a", "b", F.round("ratio", 6).alias("ratio"))


@query(r"""
WITH f AS (SELECT item_id, text, length(text) AS n, 2 + item_id % 7 AS p FROM benchmark), s AS (SELECT item_id, text, p, substr(text, p::INT, 40) AS span FROM f WHERE n >= p + 60),
g AS (SELECT item_id, text, p, substr(span, 1, 17) || '~' || substr(span, 19) AS span FROM s WHERE span = trim(span) AND instr(text, span) = p AND NOT regexp_matches(span, '\s\s|\n'))
SELECT item_id, 'fuzzy' AS level, (p - 1)::INT AS char_start, (p + 39)::INT AS char_end FROM g
""")
def fuzzy_spans(spark, sf_dir):
    """Spans with one letter changed, grounded where they came from."""

    @F.pandas_udf("struct<level:string,a:int,b:int>")
    def grounded(spans: pd.Series, texts: pd.Series) -> pd.DataFrame:
        found = [tx.ground(s, t) for s, t in zip(spans, texts, strict=True)]
        return pd.DataFrame({"level": [f[0] for f in found], "a": [f[1][0][0] if f[1] else None for f in found], "b": [f[1][0][1] if f[1] else None for f in found]})

    b = table(spark, sf_dir, "benchmark").withColumn("at", (2 + F.col("item_id") % 7).cast("int"))
    s = b.where(F.char_length("text") >= F.col("at") + 60).withColumn("span", F.substring("text", F.col("at"), F.lit(40)))
    plain = (F.col("span") == F.trim("span")) & (F.instr("text", F.col("span")) == F.col("at")) & ~F.rlike("span", F.lit(r"\s\s|\n"))
    changed = F.concat(F.substring("span", 1, 17), F.lit("~"), F.substring("span", 19, 40))
    return s.where(plain).select("item_id", grounded(changed, "text").alias("g")).select("item_id", "g.level", F.col("g.a").alias("char_start"), F.col("g.b").alias("char_end"))


PUNKT = r"""
WITH x AS (SELECT unnest(regexp_extract_all(' ' || regexp_replace(lower(text), '([^\p{L}\p{N}_.])', ' \1 ', 'g') || ' ', '[\p{L}\p{N}_.]+')) AS w FROM documents),
w AS (SELECT regexp_replace(w, '[.]$', '') AS word, ends_with(w, '.')::INT AS stop FROM x WHERE regexp_full_match(w, '\p{L}+([.]\p{L}+)*[.]?')),
c AS (SELECT word, count(*)::DOUBLE AS n, sum(stop)::DOUBLE AS k FROM w GROUP BY word), p AS (SELECT greatest(least(sum(k) / sum(n), 1 - 1e-9), 1e-9) AS p FROM c), z AS (SELECT *, length(replace(word, '.', '')) AS m FROM c, p),
a AS (SELECT word, 2 * (k * ln(0.99) + (n - k) * ln(0.01) - k * ln(p) - (n - k) * ln(1 - p)) * exp(-m) * (length(word) - m + 1) * pow(m, -(n - k)) AS score FROM z WHERE k > 0 AND m <= 12)
"""


@query(PUNKT + "SELECT word, round(score, 6) AS score FROM a WHERE score >= 0.3")
def learned_abbreviations(spark, sf_dir):
    """Words of all documents that a stop belongs to, by counts."""
    return se.abbreviations(table(spark, sf_dir, "documents"), "text").select("word", F.round("score", 6).alias("score"))


@query()
def document_sentences(spark, sf_dir):
    """Sentences of all documents, none cut after the hundred surest abbreviations."""
    d = table(spark, sf_dir, "documents")
    short = [r["word"] for r in se.abbreviations(d, "text").orderBy(F.desc("score"), "word").limit(100).collect()]  # a list of bounded length
    found = d.select("doc_id", se.sentences(F.col("text"), short).alias("s"))
    return found.select("doc_id", F.size("s").alias("sentences"), F.md5(F.array_join("s", "\n")).alias("digest"))


@query("""
WITH c AS (SELECT user_id % 40 AS stage, count(*) FILTER (WHERE event_type = 'error') AS k, count(*) FILTER (WHERE event_type <> 'signup') AS n FROM events GROUP BY 1),
t AS (SELECT stage, k, n, (SELECT coalesce(sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.15) + (n - i) * ln(0.85))), 0) FROM range(k, n + 1) r(i)) AS tail FROM c)
SELECT stage, k AS others, n AS named, round(least(1, tail), 6)::DOUBLE AS tail, k > 0 AND pow(0.5, k) < 0.05 AND least(1, tail) < 0.05 AS due FROM t
""")
def relations_due(spark, sf_dir):
    """Groups whose picks name `other` more often than chance explains."""
    kind = F.when(F.col("event_type") == "error", "other").when(F.col("event_type") == "signup", "none").otherwise("named")
    picks = table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("stage"), kind.alias("pick"))
    found = cu.evolution_due(picks, "stage", 0.5, 0.15)
    return found.select("stage", "others", "named", F.round(cu.binomial_tail(F.col("others"), F.col("named"), 0.15), 6).alias("tail"), "due")


@query("""
WITH v AS (SELECT p_partkey AS id, p_name AS a, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS b FROM part) SELECT id, 100.0::DOUBLE AS ratio FROM v
""")
def name_ratios(spark, sf_dir):
    """Likeness of names by their sets of words: turned names are the same."""
    ratio = F.pandas_udf(lambda a, b: a.combine(b, tx.token_set_ratio), "double")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", F.array_join(F.reverse(F.split("p_name", " ")), " ").alias("turned"))
    return p.select("id", ratio("p_name", "turned").alias("ratio"))
