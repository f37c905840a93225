"""From parsed units and verified items to chunks, entities, links and examples: the relational steps of each stage."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.fuzzy import alike
from docweave.ids import sha_id
from docweave.operators.merging import greedy_dedup
from docweave.operators.ordering import positions
from docweave.operators.relational import first_per_key, top_per_key
from docweave.storage import scratch

# ---- metadata and ownership ------------------------------------------------------------


def merge_metadata(rows: DataFrame, key: str, meta: str, *order: str) -> DataFrame:
    """(key, field, value list, is_list): values of each field in first-seen order over a key's rows.

    meta is map<string, struct<values array<string>, is_list boolean>>; a field
    that is a list anywhere stays one, a lone value otherwise doesn't.
    """
    each = rows.select(key, *order, F.explode(meta).alias("field", "v")).select(key, *order, "field", F.col("v.is_list").alias("is_list"), F.posexplode("v.values").alias("p", "value"))
    first = each.groupBy(key, "field", "value").agg(F.min(F.struct(*order, "p")).alias("at"), F.max("is_list").alias("is_list"))
    out = first.groupBy(key, "field").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("values"), F.max("is_list").alias("is_list"))
    return out.withColumn("is_list", F.col("is_list") | (F.size("values") > 1))


def reassign_owner(chunks: DataFrame, occurrences: DataFrame, dead_docs: DataFrame) -> DataFrame:
    """chunks (chunk_id, doc_id) of dead documents go to their first other live occurrence; new_doc is null where there is none."""
    dead = dead_docs.select(F.col("doc_id").alias("_d")).distinct()
    live = occurrences.join(dead, occurrences["doc_id"] == dead["_d"], "left_anti").groupBy("chunk_id").agg(F.min(F.struct("doc_id", "ord")).alias("o"))
    hit = chunks.join(dead, chunks["doc_id"] == dead["_d"], "left_semi")
    return hit.join(live, "chunk_id", "left").select("chunk_id", "doc_id", F.col("o.doc_id").alias("new_doc"))


def picked(row: DataFrame, fields: dict[str, str], untrusted: Sequence[str] = ()) -> DataFrame:
    """row with a column `state`: a JSON object of named fields, each from a dotted path of its columns.

    What is null, an empty text or an empty list is left out; a number is refused,
    since a state holds words; an untrusted field stands inside {"data": ...}, so
    that what it says can't be taken for instructions.
    """
    from pyspark.sql.types import ArrayType, NumericType

    parts = []
    for name, path in fields.items():
        kind = row.select(F.col(path)).schema[0].dataType
        if isinstance(kind.elementType if isinstance(kind, ArrayType) else kind, NumericType):
            raise ValueError(f"{path} is a number; a state holds no numbers")
        empty = F.size(path) == 0 if isinstance(kind, ArrayType) else F.col(path).cast("string") == ""
        value = F.when(~empty, F.col(path))
        parts.append((F.when(value.isNotNull(), F.struct(value.alias("data"))) if name in untrusted else value).alias(name))
    return row.withColumn("state", F.to_json(F.struct(*parts)))


# ---- sampling ---------------------------------------------------------------------------


def limit_in_turn(items: DataFrame, queues: Sequence[str], limit: int, *order: str) -> DataFrame:
    """limit items, one from each queue in turn, in their own order inside a queue."""
    w = Window.partitionBy(*queues).orderBy(*order)
    return items.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= limit).orderBy("turn", *queues).limit(limit)


def sample_files(files: DataFrame, per_stratum: int, most: int, size_buckets: Sequence[int]) -> DataFrame:
    """Paths from files (path, input, top, suffix, size): strata of input, folder, suffix and size; inputs take turns up to the most."""
    bucket = sum((F.when(F.col("size") > b, 1).otherwise(0) for b in size_buckets), F.lit(0))
    strata = files.withColumn("bucket", bucket)
    stratum = F.sha2(F.concat_ws("\x1f", "top", "suffix", F.col("bucket").cast("string")), 256)
    ranked = strata.withColumns({"s": stratum, "h": F.sha2("path", 256)})
    ranked = ranked.withColumn("n", F.row_number().over(Window.partitionBy("input", "s").orderBy("h", "path"))).where(F.col("n") <= per_stratum)
    ranked = ranked.withColumn("place", F.row_number().over(Window.partitionBy("input").orderBy("n", "s")))
    return ranked.orderBy("place", "input").limit(most).select("path").orderBy("path")


def evenly(values: DataFrame, column: str, n: int) -> DataFrame:
    """n values spread evenly over their sorted order: those at floor(i * count / n)."""
    count = values.count()
    if count <= n:
        return values
    wanted = [(i * count) // n + 1 for i in range(n)]
    return positions(values, "place_", [column]).where(F.col("place_").isin(wanted)).drop("place_")


def snippets(mentions: DataFrame, texts: DataFrame, width: int, n: int) -> DataFrame:
    """(entity_id, turn, snippet): the text around an entity's first n mentions (chunk_id, char_start, char_end; from 0)."""
    first = top_per_key(mentions, ["entity_id"], n, F.col("chunk_id"), F.col("char_start"))
    start = F.greatest(F.col("char_start") - width, F.lit(0))
    return first.join(texts, "chunk_id").select(
        "entity_id", F.col("rank").alias("turn"), F.substr("text", (start + 1).cast("int"), (F.col("char_end") + width - start).cast("int")).alias("snippet"))


# ---- structure --------------------------------------------------------------------------


def structural_edges(chunks: DataFrame) -> DataFrame:
    """NEXT, PART_OF and IN_SECTION edges of chunks (chunk_id, doc_id, ord, section)."""
    edge = lambda df, rel: df.select("src", "dst", F.lit(rel).alias("rel"), sha_id(F.col("src").cast("string"), F.col("dst").cast("string"), F.lit(rel)).alias("edge_id"))
    following = chunks.select(F.col("chunk_id").cast("string").alias("src"), F.lead("chunk_id").over(Window.partitionBy("doc_id").orderBy("ord")).cast("string").alias("dst")).where("dst IS NOT NULL")
    part = chunks.select(F.col("chunk_id").cast("string").alias("src"), F.col("doc_id").cast("string").alias("dst"))
    section = chunks.where("section IS NOT NULL").select(F.col("chunk_id").cast("string").alias("src"), F.concat_ws("#", F.col("doc_id").cast("string"), "section").alias("dst"))
    return edge(following, "NEXT").unionByName(edge(part, "PART_OF")).unionByName(edge(section, "IN_SECTION"))


def context_prefix(chunks: DataFrame) -> DataFrame:
    """Each chunk with the heading path at the end of the chunk before it."""
    return chunks.withColumn("context_prefix", F.array_join(F.lag("last_heading_path").over(Window.partitionBy("doc_id").orderBy("ord")), " > "))


# ---- enrichment --------------------------------------------------------------------------


def batches(items: DataFrame, size: int, *order: str, by: Sequence[str] = ()) -> DataFrame:
    """Items numbered in batches of a fixed size, over all items and not just those to be done."""
    numbered = positions(items, "place_", order, by)
    return numbered.withColumn("batch", F.floor((F.col("place_") - 1) / size).cast("long")).drop("place_")


def verified_items(items: DataFrame, gates: DataFrame) -> DataFrame:
    """Grounded items (item_id, kind, type) that their gate accepts; an accepted type check overwrites the type."""
    grounded = items.where("grounded <> 'ungrounded'")
    accepted = gates.where("outcome = 'accept'").select("item_id", "checked_type")
    return grounded.join(accepted, "item_id").withColumn("type", F.coalesce("checked_type", "type")).drop("checked_type")


def chosen_hit(hits: DataFrame, chosen: DataFrame) -> DataFrame:
    """(item_id, start): the first hit if all lie on one line, else the first on the line that was chosen; none otherwise."""
    lines = hits.groupBy("item_id").agg(F.countDistinct("line").alias("lines"))
    picked_ = hits.join(lines, "item_id").join(chosen.select("item_id", F.col("line").alias("said")), "item_id", "left")
    return picked_.where("lines = 1 OR line = said").groupBy("item_id").agg(F.min("start").alias("start"))


def kept_keywords(keywords: DataFrame) -> DataFrame:
    """(chunk_id, keywords): keywords (chunk_id, p, keyword, outcome) that were accepted, once each, in order."""
    first = keywords.where("outcome = 'accept'").groupBy("chunk_id", "keyword").agg(F.min("p").alias("p"))
    return first.groupBy("chunk_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "keyword"))), lambda x: x["keyword"]).alias("keywords"))


def no_longer_made(old: DataFrame, new: DataFrame, key: str, scope: str) -> DataFrame:
    """Old rows of the scopes that were made anew, but not made again."""
    return old.join(new.select(scope).distinct(), scope, "left_semi").join(new.select(key).distinct(), key, "left_anti")


# ---- entities and links --------------------------------------------------------------------


def co_occurring(mentions: DataFrame, cap: int, at_least: float | None = None) -> DataFrame:
    """(a, b): entities of one document whose names are alike, the first cap pairs a document in id order.

    Alike are equal names, with at_least also names of that indel ratio (found by
    a join of distinct names). Of entities of one name in one document the first
    2 * cap can stand in these pairs, so no document is joined with itself whole.
    """
    m = mentions.select("doc_id", F.col("entity_id").alias("a"), F.col("name").alias("name_a")).where("a IS NOT NULL AND name_a IS NOT NULL").distinct()
    few = top_per_key(m, ["doc_id", "name_a"], 2 * cap, F.col("a")).drop("rank")
    names = few.select("name_a", F.col("name_a").alias("name_b")).distinct()
    if at_least is not None:
        near = alike(mentions, "name", at_least).select(F.col("a").alias("name_a"), F.col("b").alias("name_b"))
        names = names.unionByName(near).unionByName(near.select(F.col("name_b").alias("name_a"), F.col("name_a").alias("name_b")))
    other = few.select("doc_id", F.col("a").alias("b"), F.col("name_a").alias("name_b"))
    pairs = few.join(names, "name_a").join(other, ["doc_id", "name_b"]).where("a < b").select("doc_id", "a", "b").distinct()
    return top_per_key(pairs, ["doc_id"], cap, F.col("a"), F.col("b")).select("a", "b").distinct()


def resolved_edges(decided: DataFrame, symmetric: Sequence[str]) -> DataFrame:
    """Edges from decided pairs (a, b, outcome, relation, direction, score, levels, contradiction, verified).

    b_to_a turns a pair round; a directed answer to a symmetric relation, or the
    other way round, rejects; so does a failed verification. A contradiction
    adds an edge of its own with the status and weight of the first.
    """
    backward = F.col("direction") == "b_to_a"
    fits = F.col("relation").isin(list(symmetric)) == (F.col("direction") == "symmetric")
    strength = F.when(F.coalesce(F.col("levels"), F.lit(0)) > 0, F.col("score") / F.greatest(F.col("levels") - 1, F.lit(1))).otherwise(F.col("score"))
    status = F.when((F.col("outcome") == "accept") & fits & F.coalesce("verified", F.lit(True)), "accepted").otherwise("rejected")
    edges = decided.select(
        F.when(backward, F.col("b")).otherwise(F.col("a")).alias("src"), F.when(backward, F.col("a")).otherwise(F.col("b")).alias("dst"),
        F.col("relation").alias("rel"), (F.col("direction") != "symmetric").alias("directed"), status.alias("status"), strength.cast("double").alias("weight"), "contradiction")
    extra = edges.where("contradiction AND status = 'accepted' AND rel <> 'contradicts'").withColumns({"rel": F.lit("contradicts"), "directed": F.lit(False)})
    both = edges.unionByName(extra).drop("contradiction")
    return both.withColumn("edge_id", sha_id(F.col("src").cast("string"), F.col("dst").cast("string"), F.col("rel")))


def canonical_names(members: DataFrame, existing: DataFrame, choices: DataFrame) -> DataFrame:
    """(root, canonical_name, aliases): an existing name stays, a lone form is the name, else the choice, else the first form."""
    forms = members.groupBy("root").agg(F.sort_array(F.collect_set("surface")).alias("forms"))
    named = forms.join(existing.select("root", F.col("canonical_name").alias("old")), "root", "left").join(choices.select("root", "choice"), "root", "left")
    name = F.coalesce("old", F.when(F.size("forms") == 1, F.get("forms", F.lit(0))), "choice", F.get("forms", F.lit(0)))
    return named.select("root", name.alias("canonical_name"), F.array_except("forms", F.array(name)).alias("aliases"))


def demoted(edges: DataFrame, audits: DataFrame) -> DataFrame:
    """Accepted edges that an audit rejected go to review."""
    bad = audits.where("outcome = 'reject'").select(F.col("edge_id").alias("_e")).distinct()
    return edges.join(bad, edges["edge_id"] == bad["_e"], "left").withColumn(
        "status", F.when(F.col("_e").isNotNull() & (F.col("status") == "accepted"), "review").otherwise(F.col("status"))).drop("_e")


def community_states(current: DataFrame, stored: DataFrame, max_failed: float = 0.2) -> DataFrame:
    """(community_id, status): accepted unless no sentence is kept or too many failed; what is stored but not current is superseded."""
    share = F.col("failed") / F.greatest(F.col("kept") + F.col("failed"), F.lit(1))
    now = current.select("community_id", F.when((F.col("kept") > 0) & (share <= max_failed), "accepted").otherwise("rejected").alias("status"))
    gone = stored.join(current.select("community_id"), "community_id", "left_anti").select("community_id", F.lit("superseded").alias("status"))
    return now.unionByName(gone)


# ---- evolution ------------------------------------------------------------------------------


def unexamined(edges: DataFrame) -> DataFrame:
    """The evolution window: chunk edges that are neither structural nor superseded nor looked at before."""
    return edges.where("src_kind = 'chunk' AND NOT structural AND status <> 'superseded' AND NOT coalesce(evolution_seen, false)")


def kept_proposals(proposed: DataFrame, unsupported: DataFrame, overlaps: DataFrame, known: DataFrame) -> DataFrame:
    """(name) taken greedily in order of name: supported, and overlapping neither a known type nor one taken before.

    proposed, unsupported and known: (name); overlaps: (a, b), either way round.
    """
    both = overlaps.select("a", "b").unionByName(overlaps.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    taken = both.join(known.select(F.col("name").alias("b")), "b", "left_semi").select(F.col("a").alias("name"))
    open_ = proposed.select("name").where("name IS NOT NULL").distinct().join(unsupported, "name", "left_anti").join(taken, "name", "left_anti")
    open_ = scratch(open_, "proposals")
    pairs = both.where("a < b").join(open_.select(F.col("name").alias("a")), "a", "left_semi").join(open_.select(F.col("name").alias("b")), "b", "left_semi")
    return open_.join(greedy_dedup(pairs).select(F.col("dropped").alias("name")), "name", "left_anti")


def definition_pairs(items: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(a, b): unordered pairs of relation definitions (name, pos, kind) to compare, those that touch `only` (name) if it is given.

    Definitions are numbered and each gives its partners' numbers, so pairs are
    made by an equi-join; with only, just those of its definitions are made. Of a
    null name or place there is no pair, nor of equal places.
    """
    r = items.where("kind = 'relation' AND name IS NOT NULL AND pos IS NOT NULL").select("name", "pos")
    n = positions(r, "n_", ["pos", "name"])
    count = n.agg(F.coalesce(F.max("n_"), F.lit(0))).first()[0]
    begin = n if only is None else n.join(only.select("name").distinct(), "name", "left_semi")
    # Every pair from its lower end; with only, from the end that is in it.
    to = F.sequence(F.col("n_") + 1 if only is None else F.lit(1).cast("long"), F.lit(count).cast("long"))
    each = begin.where(F.col("n_") < count if only is None else F.lit(True)).select(F.col("name").alias("x"), F.col("pos").alias("i"), F.col("n_").alias("own"), F.explode(to).alias("n_"))
    found = each.join(n.select("n_", F.col("name").alias("y"), F.col("pos").alias("j")), "n_").where("own <> n_ AND i <> j")
    return found.select(F.when(F.col("i") < F.col("j"), F.col("x")).otherwise(F.col("y")).alias("a"), F.when(F.col("i") < F.col("j"), F.col("y")).otherwise(F.col("x")).alias("b")).distinct()


def supported(items: DataFrame, answers: DataFrame, share: float | None = None) -> DataFrame:
    """(name, cited, yes, supported) of definitions (name, evidence array<string>) by answers (name, outcome) on what they cite.

    Supported is what any cited passage confirms, or with share, at least that
    share of them; a definition that cites nothing is unsupported without asking.
    """
    told = answers.groupBy("name").agg(F.count("*").alias("asked"), F.count_if(F.col("outcome") == "accept").alias("yes"))
    cited = F.coalesce(F.size(F.array_compact("evidence")), F.lit(0))
    rows = items.select("name", F.greatest(cited, F.lit(0)).alias("cited")).join(told, "name", "left").select("name", "cited", F.coalesce("asked", F.lit(0)).alias("asked"), F.coalesce("yes", F.lit(0)).alias("yes"))
    enough = F.col("yes") > 0 if share is None else F.col("yes") >= share * F.greatest("asked", F.lit(1))
    return rows.select("name", "cited", "yes", ((F.col("cited") > 0) & enough).alias("supported"))


# ---- answers, citations, training ------------------------------------------------------------


def citation_report(sentences: DataFrame, answer: str = "answer_id") -> DataFrame:
    """(answer_id, kept, failed, fail_fraction) over sentences (sentence_id, verdicts array<string>): one supporting passage keeps a sentence, none cited fails it."""
    ok = F.coalesce(F.array_contains("verdicts", "supports"), F.lit(False))
    return sentences.groupBy(answer).agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("failed"), F.round(F.count_if(~ok) / F.count("*"), 6).alias("fail_fraction"))


def hop_checks(examples: DataFrame) -> DataFrame:
    """(example_id, removed, rest): for each hop of a multi-hop example the passages that are left without it."""
    return examples.select("example_id", "hops", F.explode("hops").alias("removed")).select("example_id", "removed", F.array_except("hops", F.array("removed")).alias("rest"))


def hop_status(checks: DataFrame) -> DataFrame:
    """(example_id, status): every hop is needed if no check could be answered without it."""
    return checks.groupBy("example_id").agg(F.when(F.bool_and(F.col("outcome") == "reject"), "accepted").otherwise("rejected").alias("status"))


def fact_rows(claims: DataFrame, chunks: DataFrame, definitions: DataFrame) -> DataFrame:
    """Facts: each claim with its chunk's text and its type's definition."""
    return claims.join(chunks.select("chunk_id", F.col("text").alias("passage")), "chunk_id").join(definitions, "claim_type", "left").select("claim_id", "claim_type", "definition", "text", "passage")


def soft_labels(near: DataFrame, answers: DataFrame) -> DataFrame:
    """(id, neighbor, label, status): the answered probability of each candidate; an example with none is rejected."""
    rows = near.join(answers.select("id", "neighbor", F.col("p").alias("label")), ["id", "neighbor"], "left")
    some = F.max(F.col("label").isNotNull()).over(Window.partitionBy("id"))
    return rows.withColumn("status", F.when(some, "accepted").otherwise("rejected")).where("label IS NOT NULL OR status = 'rejected'").select("id", "neighbor", "label", "status")


def resolve_review(queue: DataFrame, prefix: str, verdict: str) -> DataFrame:
    """The one review item whose id begins so, with its verdict and whether that overturns what was decided; more than one is an error."""
    found = queue.where(F.col("review_id").startswith(prefix)).limit(2)
    n = F.count("*").over(Window.partitionBy())
    checked = F.when(n > 1, F.raise_error(F.lit(f"several reviews begin with {prefix}")).cast("string")).otherwise(F.lit(verdict))
    return found.withColumn("verdict", checked).withColumn("overturned", F.col("outcome").isNotNull() & (F.col("outcome") != F.col("verdict")))


def resolved_reviews(queue: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(prefix, verdict, review_id, subject_kind, subject_id, overturned, problem) of many verdicts (prefix, verdict) at once.

    queue: (review_id, subject_kind, subject_id, status, outcome). A verdict
    counts where one review begins with its prefix and is open; else review_id is
    null and problem says why. Only a decided outcome can be overturned.
    """
    lengths = [r["n"] for r in verdicts.select(F.char_length("prefix").alias("n")).where("n > 0").distinct().collect()]  # as many as ids have letters at most
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("review_id"))
    begins = queue.withColumn("prefix", F.explode(F.transform(fits, lambda n: F.substring(F.col("review_id"), F.lit(1), n)))).withColumn("n", F.lit(1))
    asked = begins.join(verdicts.select("prefix").distinct(), "prefix", "left_semi")
    found = asked.groupBy("prefix").agg(F.count("*").alias("n"), F.min(F.struct("review_id", "subject_kind", "subject_id", "status", "outcome")).alias("r"))
    each = verdicts.join(found, "prefix", "left")
    problem = F.when(F.col("n").isNull(), "no review").when(F.col("n") > 1, "several reviews").when(F.col("r.status") == "resolved", "already resolved").when(~F.col("verdict").isin("accept", "reject"), "no verdict")
    decided = F.col("r.outcome").isin("accept", "reject")
    of = lambda c: F.when(F.col("problem").isNull(), F.col(f"r.{c}")).alias(c)
    over = F.when(F.col("problem").isNull(), F.coalesce(decided & (F.col("r.outcome") != F.col("verdict")), F.lit(False)))
    return each.withColumn("problem", problem).select("prefix", "verdict", of("review_id"), of("subject_kind"), of("subject_id"), over.alias("overturned"), "problem")


def with_verdicts(rows: DataFrame, id_col: str, kind: str, resolved: DataFrame) -> DataFrame:
    """rows with the status that the verdicts on them give (accepted or rejected; the last by review id where there are several).

    A document that was accepted is released from quarantine and in scope, a
    rejected one the other way round, where the table has these columns.
    """
    last = first_per_key(resolved.where((F.col("subject_kind") == kind) & F.col("problem").isNull()), ["subject_id"], F.desc("review_id")).select(F.col("subject_id").alias("_s"), F.col("verdict").alias("_v"))
    joined = rows.join(last, rows[id_col].cast("string") == F.col("_s").cast("string"), "left")
    told, accepted = F.col("_v").isNotNull(), F.col("_v") == "accept"
    new = {"status": F.when(accepted, "accepted").otherwise("rejected"), "quarantined": ~accepted, "in_scope": accepted}
    return joined.select(*[(F.when(told, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)) for c in rows.columns])


def reopened_links(items: DataFrame, edges: DataFrame) -> DataFrame:
    """Link items (item_id, status) of chunks that no accepted edge holds any more go back to pending; edges: (src, dst, status, structural)."""
    held = edges.where("status = 'accepted' AND NOT structural").select(F.explode(F.array("src", "dst")).alias("item_id")).distinct().withColumn("_h", F.lit(True))
    lost = edges.where("status = 'review' AND NOT structural").select(F.explode(F.array("src", "dst")).alias("item_id")).distinct().withColumn("_l", F.lit(True))
    joined = items.join(held, "item_id", "left").join(lost, "item_id", "left")
    status = F.when((F.col("status") == "done") & F.col("_l").isNotNull() & F.col("_h").isNull(), "pending").otherwise(F.col("status"))
    return joined.withColumn("status", status).drop("_h", "_l")


def derived_metadata(docs: DataFrame, texts: DataFrame, decided: DataFrame) -> DataFrame:
    """(doc_id, field, values): a document's own values, else those its text names, else those that were decided."""
    ranked = docs.select("doc_id", "field", "values", F.lit(0).alias("r")).unionByName(texts.select("doc_id", "field", "values", F.lit(1).alias("r"))).unionByName(decided.select("doc_id", "field", "values", F.lit(2).alias("r")))
    return first_per_key(ranked.where(F.size("values") > 0), ["doc_id", "field"], F.col("r")).select("doc_id", "field", "values")


def refreshed(old: DataFrame, new: DataFrame, text_changed: DataFrame) -> DataFrame:
    """(doc_id, before, after, state) of metadata made anew: derived values only gain, a document whose text changed keeps its own."""
    changed = text_changed.select("doc_id", F.lit(True).alias("_c"))
    both = old.select("doc_id", F.col("values").alias("before")).join(new.select("doc_id", F.col("values").alias("made")), "doc_id", "left").join(changed, "doc_id", "left")
    after = F.when(F.col("_c"), F.col("before")).otherwise(F.array_sort(F.array_union("before", F.coalesce("made", F.array().cast("array<string>")))))
    out = both.withColumn("after", after)
    state = F.when(F.col("_c"), "text_changed").when(F.array_sort("before") == F.array_sort("after"), "same").otherwise("gained")
    return out.select("doc_id", "before", "after", state.alias("state"))


def chunk_values(chunks: DataFrame, occurrences: DataFrame, documents: DataFrame) -> DataFrame:
    """(chunk_id, field, values): of each chunk its document's values, then those of the documents that reuse it, each once.

    chunks: (chunk_id, doc_id); occurrences: (chunk_id, doc_id) of reuse; documents:
    (doc_id, field, values array<string>). The reusing documents follow in the
    order of their ids. A field without values isn't there.
    """
    ways = chunks.select("chunk_id", "doc_id", F.lit(0).alias("r")).unionByName(occurrences.select("chunk_id", "doc_id", F.lit(1).alias("r")))
    first = ways.groupBy("chunk_id", "doc_id").agg(F.min("r").alias("r"))
    each = first.join(documents, "doc_id").select("chunk_id", "field", "r", "doc_id", F.posexplode("values").alias("p", "value")).where("value IS NOT NULL")
    seen = each.groupBy("chunk_id", "field", "value").agg(F.min(F.struct("r", "doc_id", "p")).alias("at"))
    return seen.groupBy("chunk_id", "field").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("values"))


def metadata_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(chunk_id, field, before, after) of what new values (chunk_id, field, values) change; the same values in another order are no change, nothing is an empty array."""
    none = F.array().cast("array<string>")
    both = old.withColumnRenamed("values", "before").join(new.withColumnRenamed("values", "after"), ["chunk_id", "field"], "full_outer")
    told = both.select("chunk_id", "field", F.coalesce("before", none).alias("before"), F.coalesce("after", none).alias("after"))
    return told.where(F.array_sort("before") != F.array_sort("after"))


def metadata_report(changes: DataFrame) -> DataFrame:
    """(field, before, after, chunks): how many chunks each change is made on, values joined by commas."""
    text = lambda c: F.array_join(c, ",").alias(c)
    return changes.groupBy("field", text("before"), text("after")).agg(F.count("*").alias("chunks"))


def metadata_applied(old: DataFrame, changes: DataFrame) -> DataFrame:
    """old (chunk_id, field, values) with the changes made; a field that ends without values goes."""
    rest = old.join(changes.select("chunk_id", "field"), ["chunk_id", "field"], "left_anti").select("chunk_id", "field", "values")
    return rest.unionByName(changes.where(F.size("after") > 0).select("chunk_id", "field", F.col("after").alias("values")))


def structural_roles(units: DataFrame, key: str, share: float = 0.5) -> DataFrame:
    """(key, role) of chunks from their units (key, n, kind, tokens, ordered).

    heading where there is nothing else; procedure, reference or example where
    ordered lists, tables or code hold more than share of the tokens, headings
    aside (ties: what comes first); else null.
    """
    body = F.col("kind") != "heading"
    of = {"procedure": (F.col("kind") == "list") & F.col("ordered"), "reference": F.col("kind") == "table", "example": F.col("kind") == "code"}
    sums = [F.struct(F.sum(F.when(c, F.col("tokens"))).alias("held"), (-F.min(F.when(c, F.col("n")))).alias("turn"), F.lit(role).alias("role")).alias(role) for role, c in of.items()]
    found = units.groupBy(key).agg(F.sum(F.when(body, F.col("tokens"))).alias("all"), F.count_if(body).alias("bodies"), *sums)
    best = F.greatest(*of)
    role = F.when(F.col("bodies") == 0, "heading").when(best["held"] > share * F.greatest("all", F.lit(1)), best["role"])
    return found.select(key, role.alias("role"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X >= k) for n draws of chance p, its terms added up in logarithms."""
    start = F.struct((n * math.log1p(-p)).cast("double").alias("term"), F.when(k <= 0, F.exp(n * math.log1p(-p))).otherwise(F.lit(0.0)).alias("tail"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + math.log(p / (1 - p))
        return F.struct(term.alias("term"), (acc["tail"] + F.when(i >= k, F.exp(term)).otherwise(0.0)).alias("tail"))

    draws = F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.least(F.lit(1.0), F.aggregate(draws, start, step)["tail"])


def evolution_due(picks: DataFrame, by: str, support: float, baseline: float, alpha: float = 0.05, final: bool = False) -> DataFrame:
    """(by, others, named, due): whether the pick `other` comes so often that the relations on offer lack one.

    picks: (by, pick); none counts nothing. It is due where others alone have
    enough support, and (if the count isn't final) are more than the baseline explains.
    """
    counts = picks.groupBy(by).agg(F.count_if(F.col("pick") == "other").alias("others"), F.count_if(F.col("pick") != "none").alias("named"))
    enough = (F.col("others") > 0) & (F.pow(F.lit(support), F.col("others")) < alpha)
    due = enough if final else enough & (binomial_tail(F.col("others"), F.col("named"), baseline) < alpha)
    return counts.select(by, "others", "named", due.alias("due"))
