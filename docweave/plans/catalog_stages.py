"""More of the catalogue: the relational steps of the stages over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.operators import curation as cu
from docweave.plans import provider
from docweave.plans.catalog import TERMS, _knn, query, text_index
from docweave.storage import scratch, table


@query("""
WITH m AS (SELECT o_custkey AS id, o_orderkey AS seq, 'status' AS field, o_orderstatus AS v, false AS l FROM orders UNION ALL SELECT o_custkey, o_orderkey, 'priority', o_orderpriority, o_orderkey % 50 = 0 FROM orders),
f AS (SELECT id, field, v, min(seq) AS first_at, bool_or(l) AS l FROM m GROUP BY ALL)
SELECT id, field, string_agg(v, ',' ORDER BY first_at, v) AS "values", bool_or(l) OR count(*) > 1 AS is_list FROM f GROUP BY id, field
""")
def merged_metadata(spark, sf_dir):
    """Metadata of one key united in first-seen order."""
    o = table(spark, sf_dir, "orders")
    cell = lambda c, l: F.struct(F.array(c).alias("values"), l.alias("is_list"))
    meta = F.create_map(F.lit("status"), cell(F.col("o_orderstatus"), F.lit(False)), F.lit("priority"), cell(F.col("o_orderpriority"), F.col("o_orderkey") % 50 == 0))
    rows = o.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), meta.alias("meta"))
    return cu.merge_metadata(rows, "id", "meta", "seq").select("id", "field", F.array_join("values", ",").alias("values"), "is_list")


@query("""
WITH o AS (SELECT l_partkey AS chunk_id, l_orderkey AS doc_id, l_linenumber AS ord FROM lineitem), d AS (SELECT o_orderkey AS doc_id FROM orders WHERE o_orderstatus = 'F'),
c AS (SELECT chunk_id, min(doc_id) AS doc_id FROM o GROUP BY 1), n AS (SELECT chunk_id, min(doc_id) AS new_doc FROM o WHERE doc_id NOT IN (SELECT doc_id FROM d) GROUP BY 1)
SELECT chunk_id, doc_id, new_doc FROM c LEFT JOIN n USING (chunk_id) WHERE doc_id IN (SELECT doc_id FROM d)
""")
def reassigned_owners(spark, sf_dir):
    """Chunks of dead documents go to their first live occurrence."""
    occ = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("chunk_id"), F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("ord"))
    dead = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("doc_id"))
    return cu.reassign_owner(occ.groupBy("chunk_id").agg(F.min("doc_id").alias("doc_id")), occ, dead)


@query("""
WITH r AS (SELECT o_orderkey AS id, o_orderstatus AS s, o_orderpriority AS p, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS turn FROM orders)
SELECT id, s, p FROM r ORDER BY turn, s, p LIMIT 40
""")
def limited_in_turn(spark, sf_dir):
    """40 items, one from each queue in turn: an operator with a limit."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    return cu.limit_in_turn(o, ["s", "p"], 40, "id").select("id", "s", "p")


@query("""
WITH f AS (SELECT url AS path, (page_id % 2)::INT AS input, string_split(url, '/')[4] AS top, string_split(url, '/')[1] AS suffix, length(html) AS size FROM pages),
s AS (SELECT *, sha256(concat_ws(chr(31), top, suffix, ((size > 2000)::INT + (size > 6000)::INT)::VARCHAR)) AS s, sha256(path) AS h FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY input, s ORDER BY h, path) AS n FROM s QUALIFY n <= 3), p AS (SELECT *, row_number() OVER (PARTITION BY input ORDER BY n, s) AS place FROM r)
SELECT path FROM p ORDER BY place, input LIMIT 20
""")
def sampled_files(spark, sf_dir):
    """A stratified sample of files: a sampling operator."""
    parts = F.split("url", "/")
    f = table(spark, sf_dir, "pages").select(F.col("url").alias("path"), (F.col("page_id") % 2).cast("int").alias("input"), F.get(parts, F.lit(3)).alias("top"), F.get(parts, F.lit(0)).alias("suffix"), F.char_length("html").alias("size"))
    return cu.sample_files(f, 3, 20, [2000, 6000])


@query("""
WITH v AS (SELECT DISTINCT p_type AS v FROM part), r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS n, count(*) OVER () AS c FROM v)
SELECT v FROM r WHERE c <= 10 OR n IN (SELECT (i * c) // 10 FROM range(10) t(i), (SELECT count(*) AS c FROM v))
""")
def evenly_spread(spark, sf_dir):
    """Ten values spread evenly: a sampling operator."""
    return cu.evenly(table(spark, sf_dir, "part").select(F.col("p_type").alias("v")).distinct(), "v", 10)


@query("""
WITH m AS (SELECT doc_id, unnest(string_split('the,der,de,la', ',')) AS e FROM documents), x AS (SELECT doc_id, e, instr(lower(text), ' ' || e || ' ') AS p FROM m JOIN documents USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY doc_id, p) AS n FROM x WHERE p > 0)
SELECT e AS entity_id, n::INT AS turn, md5(text[(greatest(p - 10, 0) + 1):(p + length(e) + 10)]) AS snippet FROM r JOIN documents USING (doc_id) WHERE n <= 5
""")
def entity_snippets(spark, sf_dir):
    """Text around the first mentions of entities."""
    d = table(spark, sf_dir, "documents")
    m = d.select(F.col("doc_id").alias("chunk_id"), "text", F.explode(F.array(*[F.lit(w) for w in ("the", "der", "de", "la")])).alias("entity_id"))
    at = m.withColumn("char_start", F.expr("instr(lower(text), concat(' ', entity_id, ' '))")).where("char_start > 0")
    mentions = at.select("chunk_id", "entity_id", "char_start", (F.col("char_start") + F.length("entity_id")).alias("char_end"))
    return cu.snippets(mentions, d.select(F.col("doc_id").alias("chunk_id"), "text"), 10, 5).select("entity_id", "turn", F.md5("snippet").alias("snippet"))


@query("""
WITH c AS (SELECT conv_id * 1000 + turn AS c, conv_id AS d, turn AS ord, CASE WHEN role = 'user' THEN 'q' END AS s FROM conversations),
e AS (SELECT c::VARCHAR AS src, (lead(c) OVER (PARTITION BY d ORDER BY ord))::VARCHAR AS dst, 'NEXT' AS rel FROM c UNION ALL SELECT c::VARCHAR, d::VARCHAR, 'PART_OF' FROM c UNION ALL SELECT c::VARCHAR, d::VARCHAR || '#' || s, 'IN_SECTION' FROM c WHERE s IS NOT NULL)
SELECT src, dst, rel, sha256(src || chr(31) || dst || chr(31) || rel || chr(31)) AS edge_id FROM e WHERE dst IS NOT NULL
""")
def structural_edges(spark, sf_dir):
    """NEXT, PART_OF and IN_SECTION edges."""
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("chunk_id"), F.col("conv_id").alias("doc_id"), F.col("turn").alias("ord"), F.when(F.col("role") == "user", "q").alias("section"))
    return cu.structural_edges(c)


@query("SELECT event_id, event_type, ((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 16)::BIGINT AS batch FROM events")
def item_batches(spark, sf_dir):
    """Items in fixed batches, per profile."""
    return cu.batches(table(spark, sf_dir, "events"), 16, "event_id", by=["event_type"]).select("event_id", "event_type", "batch")


@query("""
WITH k AS (SELECT l_orderkey AS chunk_id, l_linenumber AS p, (l_shipdate::DATE::VARCHAR)[1:7] AS keyword FROM lineitem WHERE l_returnflag <> 'R'), f AS (SELECT chunk_id, keyword, min(p) AS p FROM k GROUP BY 1, 2)
SELECT chunk_id, string_agg(keyword, ',' ORDER BY p, keyword) AS keywords FROM f GROUP BY 1
""")
def kept_keywords(spark, sf_dir):
    """Accepted keywords, once each, in order."""
    k = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("chunk_id"), F.col("l_linenumber").alias("p"), F.date_format("l_shipdate", "yyyy-MM").alias("keyword"), F.when(F.col("l_returnflag") == "R", "reject").otherwise("accept").alias("outcome"))
    return cu.kept_keywords(k).select("chunk_id", F.array_join("keywords", ",").alias("keywords"))


@query("""
WITH i AS (SELECT event_id AS item_id, event_type AS type, CASE WHEN event_id % 6 = 0 THEN 'ungrounded' ELSE 'exact' END AS g, value, user_id FROM events)
SELECT item_id, CASE WHEN user_id % 5 = 0 THEN 'checked' ELSE type END AS type FROM i WHERE g <> 'ungrounded' AND value > 30
""")
def verified_items(spark, sf_dir):
    """Grounded and accepted items, their type checked again."""
    e = table(spark, sf_dir, "events")
    items = e.select(F.col("event_id").alias("item_id"), F.col("event_type").alias("type"), F.when(F.col("event_id") % 6 == 0, "ungrounded").otherwise("exact").alias("grounded"))
    gates = e.select(F.col("event_id").alias("item_id"), F.when(F.col("value") > 30, "accept").otherwise("reject").alias("outcome"), F.when(F.col("user_id") % 5 == 0, "checked").alias("checked_type"))
    return cu.verified_items(items, gates).select("item_id", "type")


@query("""
WITH h AS (SELECT l_orderkey AS item_id, l_quantity::BIGINT % 3 AS line, l_partkey AS start FROM lineitem), n AS (SELECT item_id, count(DISTINCT line) AS lines FROM h GROUP BY 1)
SELECT item_id, min(start) AS start FROM h JOIN n USING (item_id) WHERE lines = 1 OR line = item_id % 4 GROUP BY 1
""")
def chosen_hits(spark, sf_dir):
    """Ambiguous spans settled by line."""
    h = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item_id"), (F.col("l_quantity").cast("long") % 3).alias("line"), F.col("l_partkey").alias("start"))
    return cu.chosen_hit(h, h.select("item_id").distinct().select("item_id", (F.col("item_id") % 4).alias("line")))


@query("""
WITH m AS (SELECT DISTINCT l_orderkey AS d, l_suppkey AS a FROM lineitem), p AS (SELECT x.d, x.a, y.a AS b FROM m x JOIN m y ON x.d = y.d AND x.a < y.a WHERE x.a % 3 = y.a % 3),
r AS (SELECT a, b, row_number() OVER (PARTITION BY d ORDER BY a, b) AS n FROM p) SELECT DISTINCT a, b FROM r WHERE n <= 20
""")
def co_occurring_entities(spark, sf_dir):
    """Like-named entities of one document, twenty pairs a document: the operator's own cap."""
    m = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_suppkey").alias("entity_id"), (F.col("l_suppkey") % 3).alias("name"))
    return cu.co_occurring(m, 20)


DECIDED = """
WITH p AS (SELECT l_orderkey AS a, l_partkey AS b, CASE WHEN l_quantity > 15 THEN 'accept' ELSE 'reject' END AS o, CASE WHEN l_returnflag = 'N' THEN 'same_as' ELSE 'cites' END AS r,
  CASE l_linenumber % 3 WHEN 0 THEN 'symmetric' WHEN 1 THEN 'a_to_b' ELSE 'b_to_a' END AS d, l_linenumber % 4 AS s, l_discount > 0.05 AS c, l_tax > 0.01 AS v, l_linenumber FROM lineitem),
e AS (SELECT CASE WHEN d = 'b_to_a' THEN b ELSE a END AS src, CASE WHEN d = 'b_to_a' THEN a ELSE b END AS dst, r AS rel, d <> 'symmetric' AS directed,
  CASE WHEN o = 'accept' AND (r = 'same_as') = (d = 'symmetric') AND v THEN 'accepted' ELSE 'rejected' END AS status, s / 3.0::DOUBLE AS weight, c FROM p)
"""


@query(DECIDED + """SELECT src, dst, rel, directed, status, round(weight, 6) AS weight FROM e UNION ALL SELECT src, dst, 'contradicts', false, status, round(weight, 6) FROM e WHERE c AND status = 'accepted'""")
def resolved_edges(spark, sf_dir):
    """Edges from decided pairs."""
    turn = F.col("l_linenumber") % 3
    d = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"), F.when(F.col("l_quantity") > 15, "accept").otherwise("reject").alias("outcome"), F.when(F.col("l_returnflag") == "N", "same_as").otherwise("cites").alias("relation"),
        F.when(turn == 0, "symmetric").when(turn == 1, "a_to_b").otherwise("b_to_a").alias("direction"), (F.col("l_linenumber") % 4).alias("score"), F.lit(4).alias("levels"),
        (F.col("l_discount") > 0.05).alias("contradiction"), (F.col("l_tax") > 0.01).alias("verified"))
    return cu.resolved_edges(d, ["same_as"]).select("src", "dst", "rel", "directed", "status", F.round("weight", 6).alias("weight"))


@query("""
WITH f AS (SELECT p_size AS root, list_sort(list(DISTINCT string_split(p_name, ' ')[1])) AS forms FROM part GROUP BY 1),
n AS (SELECT root, forms, CASE WHEN root % 7 = 0 THEN 'old-' || root WHEN len(forms) = 1 THEN forms[1] WHEN root % 2 = 0 THEN forms[len(forms)] ELSE forms[1] END AS name FROM f)
SELECT root, name AS canonical_name, array_to_string(list_filter(forms, lambda x: x <> name), ',') AS aliases FROM n
""")
def canonical_names(spark, sf_dir):
    """Canonical names and aliases of clusters."""
    m = table(spark, sf_dir, "part").select(F.col("p_size").alias("root"), F.get(F.split("p_name", " "), F.lit(0)).alias("surface"))
    roots = m.select("root").distinct()
    old = roots.where("root % 7 = 0").select("root", F.concat(F.lit("old-"), F.col("root").cast("string")).alias("canonical_name"))
    last = m.groupBy("root").agg(F.max("surface").alias("choice")).where("root % 2 = 0")
    return cu.canonical_names(m, old, last).select("root", "canonical_name", F.array_join("aliases", ",").alias("aliases"))


@query("""
WITH a AS (SELECT DISTINCT event_id FROM events WHERE value < 20)
SELECT o_orderkey AS edge_id, CASE WHEN o_orderkey IN (SELECT event_id FROM a) AND o_orderstatus = 'F' THEN 'review' WHEN o_orderstatus = 'F' THEN 'accepted' ELSE 'rejected' END AS status FROM orders
""")
def demoted_edges(spark, sf_dir):
    """Edges that an audit sends to review."""
    e = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("edge_id"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("status"))
    a = table(spark, sf_dir, "events").select(F.col("event_id").alias("edge_id"), F.when(F.col("value") < 20, "reject").otherwise("accept").alias("outcome"))
    return cu.demoted(e, a)


@query("""
WITH c AS (SELECT l_suppkey AS id, count(*) FILTER (WHERE l_returnflag <> 'R') AS kept, count(*) FILTER (WHERE l_returnflag = 'R') AS failed FROM lineitem WHERE l_quantity > 10 GROUP BY 1)
SELECT id AS community_id, CASE WHEN kept > 0 AND failed / greatest(kept + failed, 1)::DOUBLE <= 0.25 THEN 'accepted' ELSE 'rejected' END AS status FROM c
UNION ALL SELECT s_suppkey + 100000, 'superseded' FROM supplier
""")
def community_states(spark, sf_dir):
    """Communities accepted, rejected or superseded."""
    flag = F.col("l_returnflag") == "R"
    now = table(spark, sf_dir, "lineitem").where("l_quantity > 10").groupBy(F.col("l_suppkey").alias("community_id")).agg(F.count_if(~flag).alias("kept"), F.count_if(flag).alias("failed"))
    stored = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 100000).alias("community_id"))
    return cu.community_states(now, stored, 0.25)


@query("SELECT o_orderkey AS edge_id FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 <> 0 AND o_custkey % 4 <> 0")
def evolution_window(spark, sf_dir):
    """Edges the ontology's evolution hasn't looked at."""
    e = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("edge_id"), F.lit("chunk").alias("src_kind"), (F.col("o_orderkey") % 3 == 0).alias("structural"), F.when(F.col("o_orderstatus") == "P", "superseded").otherwise("accepted").alias("status"), F.when(F.col("o_custkey") % 4 == 0, True).alias("evolution_seen"))
    return cu.unexamined(e).select("edge_id")


@query("""
WITH t AS (SELECT DISTINCT p_type AS name FROM part), r AS (SELECT name, row_number() OVER (ORDER BY name) AS pos FROM t)
SELECT x.name AS a, y.name AS b FROM r x JOIN r y ON x.pos < y.pos WHERE x.pos <= 2 OR y.pos <= 2
""")
def definition_pairs(spark, sf_dir):
    """Pairs of definitions to compare that touch the new ones."""
    from pyspark.sql import Window

    r = table(spark, sf_dir, "part").select(F.col("p_type").alias("name")).distinct().withColumn("pos", F.row_number().over(Window.orderBy("name"))).withColumn("kind", F.lit("relation"))
    return cu.definition_pairs(r, r.where("pos <= 2"))


@query("""
SELECT l_orderkey AS answer_id, count(*) FILTER (WHERE l_returnflag <> 'R' AND l_quantity > 5) AS kept, count(*) FILTER (WHERE NOT (l_returnflag <> 'R' AND l_quantity > 5)) AS failed,
       round(count(*) FILTER (WHERE NOT (l_returnflag <> 'R' AND l_quantity > 5)) / count(*)::DOUBLE, 6) AS fail_fraction FROM lineitem GROUP BY 1
""")
def citation_report(spark, sf_dir):
    """Sentences kept and failed by their citations."""
    verdicts = F.when(F.col("l_quantity") > 5, F.array(F.when(F.col("l_returnflag") != "R", "supports").otherwise("says_nothing")))
    return cu.citation_report(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("answer_id"), verdicts.alias("verdicts")))


@query("""
WITH e AS (SELECT l_orderkey AS example_id, list_sort(list(DISTINCT l_partkey)) AS hops FROM lineitem GROUP BY 1), x AS (SELECT example_id, hops, unnest(hops) AS removed FROM e)
SELECT example_id, removed, array_to_string(list_filter(hops, lambda h: h <> removed), ',') AS rest FROM x
""")
def multihop_checks(spark, sf_dir):
    """One check for each hop that is taken away."""
    e = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("example_id")).agg(F.sort_array(F.collect_set("l_partkey")).alias("hops"))
    return cu.hop_checks(e).select("example_id", "removed", F.array_join(F.transform("rest", lambda x: x.cast("string")), ",").alias("rest"))


@query("""
SELECT l_orderkey AS claim_id, l_returnflag AS claim_type, CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' END AS definition, l_linenumber::VARCHAR AS text, o_orderpriority AS passage
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def fact_rows(spark, sf_dir):
    """Claims with their passage and definition."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_orderkey").alias("chunk_id"), F.col("l_returnflag").alias("claim_type"), F.col("l_linenumber").cast("string").alias("text"))
    defs = spark.createDataFrame([("R", "returned"), ("A", "accepted")], "claim_type string, definition string")
    return cu.fact_rows(c, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chunk_id"), F.col("o_orderpriority").alias("text")), defs)


@query()
def soft_relevance(spark, sf_dir):
    """Soft labels for near rows from the offline provider's answers."""
    near = scratch(_knn(spark, sf_dir, 10), "near")  # read three times
    items = near.select(F.concat_ws("-", F.col("id").cast("string"), F.col("neighbor").cast("string")).alias("item_id"), "id", "neighbor").withColumn("state", F.col("item_id"))
    asked = provider.render(items, "rag_passage@2", [provider.Question("relevant")])
    good = provider.valid(asked, provider.answer(asked)).join(items.select("item_id", "id", "neighbor"), "item_id")
    return cu.soft_labels(near.select("id", "neighbor"), good.select("id", "neighbor", "p"))


@query()
def provider_gates(spark, sf_dir):
    """Questions rendered, packed, answered once each, checked and gated."""
    from docweave.operators.gating import All, Leaf, gate

    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("state"))
    asked = provider.render(items, "link@2", [provider.Question("related"), provider.Question("relation", "choice", ("none", "cites", "extends")), provider.Question("strength", "score", levels=4)])
    maps = provider.answer_maps(provider.valid(asked, provider.answer(asked)))
    return maps.select("item_id", gate(All((Leaf("related", "is_yes"), Leaf("relation", "not_in", ["none", "other"]), Leaf("strength", "level_in", [2, 3])))).alias("outcome"))


@query("""
WITH a AS (SELECT p_brand AS doc_id, 'type' AS field, list_sort(list(DISTINCT p_type)) AS v, 0 AS r FROM part WHERE p_size > 45 GROUP BY 1 UNION ALL SELECT DISTINCT p_brand, 'type', ['named'], 1 FROM part WHERE p_size % 2 = 0 UNION ALL SELECT DISTINCT p_brand, 'type', ['decided'], 2 FROM part)
SELECT doc_id, field, array_to_string(v, ',') AS "values" FROM a QUALIFY row_number() OVER (PARTITION BY doc_id, field ORDER BY r) = 1
""")
def derived_metadata(spark, sf_dir):
    """A document's own values, else those its text names, else those decided."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("doc_id"), F.lit("type").alias("field"), "p_type", "p_size")
    own = p.where("p_size > 45").groupBy("doc_id", "field").agg(F.sort_array(F.collect_set("p_type")).alias("values"))
    said = p.where("p_size % 2 = 0").select("doc_id", "field", F.array(F.lit("named")).alias("values")).distinct()
    return cu.derived_metadata(own, said, p.select("doc_id", "field", F.array(F.lit("decided")).alias("values")).distinct()).select("doc_id", "field", F.array_join("values", ",").alias("values"))


@query("""
WITH a AS (SELECT user_id AS d, list_sort(list(DISTINCT event_type)) AS v FROM events WHERE event_id % 4 < 2 GROUP BY 1), b AS (SELECT user_id AS d, list_sort(list(DISTINCT event_type)) AS v FROM events WHERE event_id % 4 >= 2 GROUP BY 1),
m AS (SELECT a.d, a.v AS before, CASE WHEN a.d % 9 = 0 THEN a.v ELSE list_sort(list_distinct(list_concat(a.v, coalesce(b.v, [])))) END AS after FROM a LEFT JOIN b USING (d))
SELECT d AS doc_id, array_to_string(after, ',') AS after, CASE WHEN d % 9 = 0 THEN 'text_changed' WHEN before = after THEN 'same' ELSE 'gained' END AS state FROM m
""")
def refreshed_metadata(spark, sf_dir):
    """Metadata made anew: derived values only gain."""
    e = table(spark, sf_dir, "events")
    lists = lambda c: e.where(c).groupBy(F.col("user_id").alias("doc_id")).agg(F.sort_array(F.collect_set("event_type")).alias("values"))
    changed = e.where("user_id % 9 = 0").select(F.col("user_id").alias("doc_id")).distinct()
    return cu.refreshed(lists("event_id % 4 < 2"), lists("event_id % 4 >= 2"), changed).select("doc_id", F.array_join("after", ",").alias("after"), "state")


@query(f"""
WITH t AS (SELECT doc_id AS id, {TERMS} AS ts FROM documents), p AS (SELECT id, len(ts) AS n, unnest(ts) AS term FROM t)
SELECT term, count(DISTINCT id) AS documents, count(*) AS uses FROM p GROUP BY term HAVING count(DISTINCT id) >= 20
""")
def term_statistics(spark, sf_dir):
    """Document frequency of terms in the inverted index."""
    p = text_index(spark, sf_dir).postings()
    return p.groupBy("term").agg(F.count("*").alias("documents"), F.sum("tf").alias("uses")).where("documents >= 20")
