"""Training examples: splits without leaks, negatives, statuses, exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import vectors as vec
from docweave.ids import sha_id, unit_fraction
from docweave.operators.relational import round_robin, top_per_key
from docweave.storage import cut, scratch


def split_of(key: Column, shares: dict[str, float], salt: str = "split") -> Column:
    """The split of a key by its hash; shares add up to 1, the last takes the rest."""
    x = unit_fraction(sha_id(F.lit(salt), key.cast("string")))
    names, out, total = list(shares), F.lit(list(shares)[-1]), 1.0
    for name in reversed(names[:-1]):
        total = sum(shares[n] for n in names[: names.index(name) + 1])
        out = F.when(x < total, name).otherwise(out)
    return out


def example_splits(sources: DataFrame, example: str, split: str) -> DataFrame:
    """(example, split): the one split of all an example's sources, else cross_split."""
    found = sources.groupBy(example).agg(F.sort_array(F.collect_set(split)).alias("_s"))
    return found.select(example, F.when(F.size("_s") == 1, F.get("_s", F.lit(0))).when(F.size("_s") == 0, "unassigned").otherwise("cross_split").alias(split))


def example_status(checks: DataFrame, example: str, outcome: str = "outcome", rules: DataFrame | None = None) -> DataFrame:
    """rejected if any check rejects, accepted if all accept, else review.

    rules (example, round, outcome) are the checks of the output rules, of which
    the last counts: an example whose last one rejects is rejected whatever else,
    and earlier ones don't matter.
    """
    status = checks.groupBy(example).agg(
        F.when(F.bool_or(F.col(outcome) == "reject"), "rejected").when(F.bool_and(F.col(outcome) == "accept"), "accepted").otherwise("review").alias("status"))
    if rules is None:
        return status
    last = rules.groupBy(example).agg(F.max_by("outcome", "round").alias("last_"))
    return status.join(last, example, "left").select(example, F.when(F.col("last_") == "reject", "rejected").otherwise(F.col("status")).alias("status"))


def reauthor(records: DataFrame, check: Callable[[DataFrame], DataFrame], rewrite: Callable[[DataFrame], DataFrame], id_col: str, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """(records, checks): drafts checked against the output rules; what breaks one is written again, at most `rounds` times.

    check gives (id_col, outcome) of records, rewrite takes the failing ones and
    gives new versions of some of them. A record that is not written again keeps
    its last version and its last, failing check.
    """
    held, todo, checks = records, records, None
    for turn in range(rounds + 1):
        now = cut(check(todo).select(id_col, F.lit(turn).alias("round"), "outcome"))
        checks = now if checks is None else checks.unionByName(now)
        failing = todo.join(now.where("outcome = 'reject'"), id_col, "left_semi")
        if turn == rounds or not failing.head(1):
            break
        todo = cut(rewrite(failing).select(*records.columns))
        if not todo.head(1):
            break
        held = cut(held.join(todo, id_col, "left_anti").unionByName(todo))
    return held, checks


def sources(kinds: Sequence[tuple[str, str, int | None]], tables: dict[str, DataFrame], strata: Sequence[str] = ("doc_type", "role"), claims_per_chunk: int = 4, min_tokens: int = 40) -> DataFrame:
    """(template, kind, source_key): what each template (name, kind, quota) is made of.

    chunks (chunk_id, doc_type, role, tokens) serve qa_single and instruction: all
    by coverage without a quota, else in turn over the strata, by hash inside;
    paths (path_id) multi-hop questions; edges (edge_id, rel) graph reasoning, in
    turn over the relations; edges and claims (claim_id, chunk_id) triples; accepted
    examples (example_id) what is derived from them, the first ids up to the quota.
    """
    out = None
    for template, kind, quota in kinds:
        hashed = lambda c, template=template: sha_id(F.lit(template), F.col(c).cast("string"))
        take = lambda df, keys, c: round_robin(df.withColumn("h_", hashed(c)), keys, quota, F.col("h_"), F.col(c)) if quota is not None else df  # noqa: B023, E731
        if kind in ("qa_single", "instruction") and quota is None:
            rows = coverage(tables["claims"], tables["chunks"], claims_per_chunk, min_tokens, template).select(F.coalesce(F.col("claim_id").cast("string"), F.col("chunk_id").cast("string")).alias("source_key"))
        elif kind in ("qa_single", "instruction"):
            rows = take(tables["chunks"], list(strata), "chunk_id").select(F.col("chunk_id").cast("string").alias("source_key"))
        elif kind == "qa_multihop":
            rows = tables["paths"].orderBy("path_id").limit(quota).select(F.col("path_id").cast("string").alias("source_key"))
        elif kind == "graph_reasoning":
            rows = take(tables["edges"], ["rel"], "edge_id").select(F.col("edge_id").cast("string").alias("source_key"))
        elif kind == "triples":
            rows = tables["edges"].select(F.col("edge_id").cast("string").alias("source_key")).unionByName(tables["claims"].select(F.col("claim_id").cast("string").alias("source_key")))
        elif kind in ("retrieval_pairs", "rerank_soft_labels"):
            rows = tables["examples"].where("status = 'accepted'").orderBy("example_id").limit(quota).select(F.col("example_id").cast("string").alias("source_key"))
        else:
            raise ValueError(f"no sources for {kind}")
        made = rows.select(F.lit(template).alias("template"), F.lit(kind).alias("kind"), "source_key")
        out = made if out is None else out.unionByName(made)
    return out


def hop_edges(edges: DataFrame, nodes: DataFrame, relations: Sequence[str], max_similarity: float) -> DataFrame:
    """Edges (edge_id, src, dst, rel, directed) that a path may follow, with the split of their ends.

    Their relation carries a fact on, both ends (nodes: id, language, split, vec)
    have one language (two unknown ones are one), lie in one split, and aren't
    near copies: their cosine similarity is below the bound, or one has no vector.
    """
    side = lambda name: nodes.select(F.col("id").alias(name), F.struct("language", "split", "vec").alias(f"{name}_"))
    both = edges.where(F.col("rel").isin(list(relations))).join(side("src"), "src").join(side("dst"), "dst")
    a, b = F.col("src_"), F.col("dst_")
    near = 1 - vec.cosine_distance(a["vec"], b["vec"])
    fits = a["language"].eqNullSafe(b["language"]) & (a["split"] == b["split"]) & F.coalesce(near < max_similarity, F.lit(True))
    return both.where(fits).select(*edges.columns, a["split"].alias("split"))


def hop_paths(edges: DataFrame, min_hops: int, max_hops: int, limit: int | None = None, salt: str = "path", fan: int = 20_000) -> DataFrame:
    """(start, nodes, edge_ids): of each node one simple path over edges (edge_id, src, dst, directed), of a length drawn by hash.

    It is the path that a search in depth meets first, which tries edges in the
    order of their hashes; beginnings are followed in that order, `fan` of a node
    at first. A path that they lead to comes before all that later beginnings
    could; nodes without one, of whose beginnings some were left out, are
    searched again with eight times as many. With a limit, the starts of least
    hash that have a path count.
    """
    best = _first_paths(edges, min_hops, max_hops, salt, fan, None)
    h = sha_id(F.lit(salt), F.col("start").cast("string"))
    return best if limit is None else best.orderBy(h, "start").limit(limit)


def _first_paths(edges: DataFrame, min_hops: int, max_hops: int, salt: str, fan: int, only: DataFrame | None) -> DataFrame:
    """hop_paths of some starts (start), or of all."""
    h = lambda *c: sha_id(F.lit(salt), *c)
    one = edges.select("edge_id", "src", "dst", h(F.col("edge_id").cast("string")).alias("h"))
    back = edges.where("NOT directed").select("edge_id", F.col("dst").alias("src"), F.col("src").alias("dst"), h(F.col("edge_id").cast("string")).alias("h"))
    ways = one.unionByName(back)
    span = max_hops - min_hops + 1
    starts = ways.select(F.col("src").alias("start")).distinct() if only is None else only
    starts = starts.withColumn("target", min_hops + F.floor(unit_fraction(h(F.lit("hops"), F.col("start").cast("string"))) * span).cast("int"))
    paths = starts.select("start", "target", F.array("start").alias("nodes"), F.array().cast("array<string>").alias("hashes"), F.array().cast(f"array<{edges.schema['edge_id'].dataType.simpleString()}>").alias("edge_ids"))
    done, crowded = None, []
    for hop in range(1, max_hops + 1):
        step = paths.withColumn("src", F.element_at("nodes", -1)).join(ways, "src").where(~F.array_contains("nodes", F.col("dst")))
        grown = step.select("start", "target", F.array_append("nodes", F.col("dst")).alias("nodes"), F.array_append("hashes", F.col("h")).alias("hashes"), F.array_append("edge_ids", F.col("edge_id")).alias("edge_ids"))
        complete = grown.where(F.col("target") == hop)
        done = complete if done is None else done.unionByName(complete)
        if hop < max_hops:
            ranked = scratch(top_per_key(grown.where(F.col("target") > hop), ["start"], fan + 1, F.col("hashes"), F.col("nodes")), f"paths-{hop}")
            crowded.append(ranked.where(F.col("rank") > fan).select("start"))
            paths = ranked.where(F.col("rank") <= fan).drop("rank")
    best = done.groupBy("start").agg(F.min_by(F.struct("nodes", "edge_ids"), F.struct("hashes", "nodes")).alias("p")).select("start", "p.nodes", "p.edge_ids")
    if not crowded:
        return best
    best = scratch(best, "best-paths")
    again = crowded[0]
    for more in crowded[1:]:
        again = again.unionByName(more)
    again = scratch(again.distinct().join(best.select("start"), "start", "left_anti"), "crowded")
    return best if again.isEmpty() else best.unionByName(_first_paths(edges, min_hops, max_hops, salt, 8 * fan, again))


def split_hop_paths(edges: DataFrame, shares: dict[str, float], quota: int, min_hops: int, max_hops: int, salt: str = "path") -> DataFrame:
    """hop_paths of edges with a split: each split gets its share of the quota, and the largest what the others leave."""
    largest = max(shares, key=shares.get)
    out, left = None, quota
    for split in sorted(shares, key=lambda s: (s == largest, s)):
        found = hop_paths(edges.where(F.col("split") == split), min_hops, max_hops, left if split == largest else round(quota * shares[split]), salt)
        found = cut(found.select(F.lit(split).alias("split"), "*"))
        left -= found.count()
        out = found if out is None else out.unionByName(found)
    return out


def hard_negatives(near: DataFrame, texts: DataFrame, splits: DataFrame, n: int = 3) -> DataFrame:
    """(id, neighbor, turn): near rows (id, neighbor, dist) of the same split whose text, white space aside, isn't the query's nor repeated."""
    t = texts.select("id", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("t"))
    q = t.join(splits, "id").select("id", F.col("t").alias("own"), F.col("split").alias("own_split"))
    c = t.join(splits, "id").select(F.col("id").alias("neighbor"), "t", "split")
    fair = near.join(q, "id").join(c, "neighbor").where("own_split = split AND own <> t")
    first = top_per_key(fair, ["id", "t"], 1, F.col("dist"), F.col("neighbor")).drop("rank")
    return top_per_key(first, ["id"], n, F.col("dist"), F.col("neighbor")).select("id", "neighbor", F.col("rank").alias("turn"))


def judged_negatives(near: DataFrame, texts: DataFrame, splits: DataFrame, answers: DataFrame, n: int = 3) -> DataFrame:
    """(id, neighbor, turn, status): the first n hard negatives of each row that the judge rejected; a row without one is rejected, with a null neighbor.

    answers: (id, neighbor, outcome) for all candidates, judged before the cut, so
    that a candidate found relevant makes room for the next. What wasn't judged
    is no negative.
    """
    candidates = hard_negatives(near, texts, splits, 1 << 30).drop("turn")
    fair = candidates.join(answers.where("outcome = 'reject'").select("id", "neighbor").distinct(), ["id", "neighbor"], "left_semi")
    ranked = top_per_key(fair.join(near.select("id", "neighbor", "dist"), ["id", "neighbor"]), ["id"], n, F.col("dist"), F.col("neighbor"))
    kept = ranked.select("id", "neighbor", F.col("rank").alias("turn"), F.lit("accepted").alias("status"))
    none = near.select("id").distinct().join(kept.select("id"), "id", "left_anti")
    return kept.unionByName(none.select("id", F.lit(None).cast(near.schema["neighbor"].dataType).alias("neighbor"), F.lit(None).cast("int").alias("turn"), F.lit("rejected").alias("status")))


def coverage(claims: DataFrame, chunks: DataFrame, n: int, min_tokens: int, salt: str = "coverage") -> DataFrame:
    """(chunk_id, claim_id): at most n claims of each chunk by hash, or the chunk itself (a null claim) if it says enough and has none.

    Claims and chunks are ranked together, a chunk behind its claims, so that one
    deal of rows serves both: a join of chunks beside the ranking has so few bytes
    that adaptive execution leaves it to one task.
    """
    key = F.unhex(sha_id(F.lit(salt), F.col("claim_id").cast("string")))
    some = claims.select("chunk_id", "claim_id", key.alias("_h"), F.lit(0).alias("_own"), F.lit(1).cast("long").alias("_times"))
    own = chunks.where(F.col("tokens") >= min_tokens).groupBy("chunk_id").agg(F.count("*").alias("_times"))
    own = own.select("chunk_id", F.lit(None).cast(claims.schema["claim_id"].dataType).alias("claim_id"), F.lit(None).cast("binary").alias("_h"), F.lit(1).alias("_own"), "_times")
    # A chunk without an id has no claims, not even those without a chunk.
    rows = some.unionByName(own).withColumn("_apart", F.col("chunk_id").isNull() & (F.col("_own") == 1))
    w = Window.partitionBy("chunk_id", "_apart").orderBy("_own", "_h", "claim_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumn("_n", F.row_number().over(w)).withColumn("_first", F.first("_own").over(w)).where(F.col("_n") <= max(n, 1))
    kept = ranked.where(((F.col("_own") == 0) & (F.col("_n") <= n)) | ((F.col("_own") == 1) & (F.col("_first") == 1)))
    return kept.select("chunk_id", "claim_id", F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int"))).alias("_t")).drop("_t")


def inherited(ids: Column, more: Column) -> Column:
    """A sorted union of decision ids where the first lacks some of the second, else the first as it is."""
    return F.when(F.size(F.array_except(more, ids)) == 0, ids).otherwise(F.array_sort(F.array_union(ids, more)))
