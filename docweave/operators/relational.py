"""Joins, set operations, rankings and snapshots over any tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.ids import sha_id
from docweave.storage import discard, scratch


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """DISTINCT ON: the first row of each key; end the order with an id to make it total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_per_key(df: DataFrame, keys: Sequence[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each key, with their rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def round_robin(df: DataFrame, strata: Sequence[str], quota: int, *order: Column) -> DataFrame:
    """quota rows taken from the strata in turn, strata in sorted order, rows inside by order."""
    w = Window.partitionBy(*strata).orderBy(*order)
    ranked = df.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= quota)
    return ranked.orderBy("turn", *strata).limit(quota)


def _common_pairs(m: DataFrame, often: DataFrame | None, wide: int) -> DataFrame:
    """(a, b, shared): chunks, a < b, that share two entities or more, one of them at most of those in often.

    Both hold any two of their common entities, so they are found by pairs of
    entities, which are far fewer than pairs of chunks on an entity. Of the pairs
    that two chunks have in common, n(n - 1) / 2 are of n rare ones and n h of
    these with h frequent ones. A chunk of more than `wide` entities has too many
    pairs and is compared with all that it shares a rare one with.
    """
    m = m.select("a", "e", F.lit(False).alias("hot")) if often is None else m.join(often.withColumn("hot", F.lit(True)), "e", "left").select("a", "e", F.coalesce("hot", F.lit(False)).alias("hot"))
    broad = scratch(m.groupBy("a").agg(F.count("*").alias("n"), F.count_if("hot").alias("n_hot")).where((F.col("n") > wide) & (F.col("n_hot") < F.col("n"))).select("a"), "broad-chunks")
    some = not broad.isEmpty()
    few = m.join(broad, "a", "left_anti") if some else m
    # A frequent entity comes second, behind a rare one.
    first, second = few.where("NOT hot").select("a", "e"), few.select("a", F.col("e").alias("f"), "hot")
    both = first.join(second, "a").where("hot OR e < f").select("e", "f", "hot", "a")
    met = both.join(both.select("e", "f", F.col("a").alias("b")), ["e", "f"]).where("a < b")
    counts = met.groupBy("a", "b").agg(F.count_if(~F.col("hot")).alias("rare"), F.count_if("hot").alias("mixed"))
    rare = F.floor((1 + F.sqrt(1 + 8 * F.col("rare"))) / 2)
    found = counts.select("a", "b", (rare + F.floor(F.col("mixed") / rare)).cast("long").alias("shared"))
    if not some:
        return found
    cold = m.where("NOT hot").select("a", "e")
    of = cold.join(broad, "a", "left_semi").select(F.col("a").alias("x"), "e").join(cold.select(F.col("a").alias("y"), "e"), "e").where("x <> y")
    # Two broad chunks meet twice.
    ends = of.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("n"), F.count_distinct("x").alias("times"))
    counted = ends.select("a", "b", F.expr("n div times").alias("shared"))
    if often is not None:
        hot = m.where("hot").groupBy("a").agg(F.collect_set("e").alias("hot"))
        none = F.array().cast(f"array<{m.schema['e'].dataType.simpleString()}>")
        counted = counted.join(hot, "a", "left").join(hot.select(F.col("a").alias("b"), F.col("hot").alias("hot_b")), "b", "left")
        counted = counted.select("a", "b", (F.col("shared") + F.size(F.array_intersect(F.coalesce("hot", none), F.coalesce("hot_b", none)))).alias("shared"))
    return found.unionByName(counted.where("shared > 1"))


def shared_entity_pairs(mentions: DataFrame, chunk: str, entity: str, k: int, hot: int = 1000, wide: int = 16) -> DataFrame:
    """(a, b, shared, rank): for each chunk the k others that share most entities, ties by id.

    Of others that share one entity only the least ids can be among the best,
    and they are among its k + 1 least members; those that share more are found
    by pairs of entities. Entities of more than `hot` chunks are never joined
    with themselves. Chunks that share the same set of them are one class; of
    each class only its k + 1 least ids can matter to a chunk that shares nothing
    else with it, since they all share as many hot entities. So pairs through hot
    entities grow with the classes and not with the square of a hot entity's chunks.
    """
    m = mentions.select(F.col(chunk).alias("a"), F.col(entity).alias("e")).where("a IS NOT NULL AND e IS NOT NULL").distinct()
    m = scratch(m, "mentions")
    often = scratch(m.groupBy("e").count().where(F.col("count") > hot).select("e"), "hot-entities")
    any_hot = not often.isEmpty()
    cold = m.join(often, "e", "left_anti") if any_hot else m
    half = scratch(_common_pairs(m, often if any_hot else None, wide), "common-pairs")
    more = half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    least = top_per_key(cold, ["e"], k + 1, F.col("a")).select("e", F.col("a").alias("b"))
    best = more.unionByName(cold.join(least, "e").where("a <> b").select("a", "b", F.lit(1).cast("long").alias("shared")))
    if any_hot:
        marks = m.join(often, "e", "left_semi").groupBy("a").agg(F.sort_array(F.collect_set("e")).alias("hot"))
        members = top_per_key(marks, ["hot"], k + 1, F.col("a")).select(F.col("hot").alias("hot_b"), F.col("a").alias("b"))
        classes = marks.select("hot").distinct()
        meet = classes.select("hot", F.explode("hot").alias("e")).join(classes.select(F.col("hot").alias("hot_b"), F.explode("hot").alias("e")), "e").groupBy("hot", "hot_b").agg(F.count("*").alias("shared"))
        offered = top_per_key(meet.join(members, "hot_b"), ["hot"], k + 1, F.desc("shared"), F.col("b")).select("hot", "b", "shared")
        best = best.unionByName(marks.join(offered, "hot").where("a <> b").select("a", "b", "shared"))
    # Dealt by chunk once, for the counting and for the ranking.
    best = best.repartition("a").groupBy("a", "b").agg(F.max("shared").cast("long").alias("shared"))
    return top_per_key(best, ["a"], k, F.desc("shared"), F.col("b"))


def section_pairs(members: DataFrame, section: str, item: str, limit: int) -> DataFrame:
    """The first `limit` pairs (a < b) of items in one section, over all sections, in (a, b) order.

    Every item but a section's last begins a pair, so the pairs begin with one
    of the `limit` least such items; and from a section no more than its first
    2 * limit items can stand in them.
    """
    m = members.select(F.col(section).alias("s"), F.col(item).alias("a")).where("s IS NOT NULL AND a IS NOT NULL").distinct()
    first = top_per_key(m, ["s"], 2 * limit, F.col("a")).select("s", "a")
    last = m.groupBy("s").agg(F.max("a").alias("last"))
    begins = first.join(last, "s").where("a < last").select("a").distinct().orderBy("a").limit(limit)
    pairs = first.join(begins, "a", "left_semi").join(first.withColumnRenamed("a", "b"), "s").where("a < b")
    return pairs.select("a", "b").distinct().orderBy("a", "b").limit(limit)


def candidate_union(**sources: DataFrame) -> DataFrame:
    """(a, b, sources): unordered pairs from frames with columns a and b, and the names of all that gave them."""
    parts = [df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(name).alias("source")) for name, df in sorted(sources.items())]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.where("a <> b").groupBy("a", "b").agg(F.sort_array(F.collect_set("source")).alias("sources"))


def undecided(pairs: DataFrame, decided: DataFrame, new: DataFrame, node: str = "id") -> DataFrame:
    """Pairs (a, b) with a new member and no decision yet."""
    fresh = new.select(F.col(node).alias("n")).distinct()
    a = pairs.join(fresh, pairs["a"] == fresh["n"], "left_semi")
    b = pairs.join(fresh, pairs["b"] == fresh["n"], "left_semi")
    return a.unionByName(b).distinct().join(decided.select("a", "b").distinct(), ["a", "b"], "left_anti")


def neighbours(edges: DataFrame, frontier: DataFrame, k: int) -> DataFrame:
    """(from_id, edge_id, neighbour, weight, rank): each frontier node's k heaviest edges, whichever end it is.

    A union of two equi-joins stands for the disjunction; a self-loop counts once.
    """
    f = frontier.select(F.col("id").alias("from_id")).distinct()
    out = edges.join(f, edges["src"] == f["from_id"]).select("from_id", "edge_id", F.col("dst").alias("neighbour"), "weight")
    back = edges.where("src <> dst").join(f, edges["dst"] == f["from_id"]).select("from_id", "edge_id", F.col("src").alias("neighbour"), "weight")
    return top_per_key(out.unionByName(back), ["from_id"], k, F.desc_nulls_last("weight"), F.col("edge_id"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Column, update: Sequence[str] | None = None) -> DataFrame:
    """The table after new rows are put into old ones: the last row of a key wins.

    update names the columns that an existing row takes over: None all, an empty list none.
    """
    latest = first_per_key(new, keys, order.desc()).select(*old.columns)
    taken = [c for c in old.columns if c not in keys] if update is None else list(update)
    o, n = old.alias("o"), latest.withColumn("_new", F.lit(True)).alias("n")
    joined = o.withColumn("_old", F.lit(True)).alias("o").join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    pick = lambda c: F.when(F.col("_new").isNull() | (F.col("_old") & F.lit(c not in taken and c not in keys)), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
    return joined.select(*[pick(c) for c in old.columns])


def create_buckets(rows: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Writes a table in folders by hash of its keys, as upsert_buckets wants it."""
    _bucketed(rows, keys, buckets).repartition("bucket_").write.partitionBy("bucket_").parquet(path)


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn("bucket_", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert_buckets(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], order: Column, update: Sequence[str] | None = None, buckets: int = 64) -> int:
    """upsert into a table of create_buckets; only the folders that new keys fall in are read and rewritten. Gives how many.

    The new state of these folders is written beside the table first and then put
    in its place by one job that commits whole folders, so a run that dies before
    leaves the table as it was, and the same run again gives the same table.
    """
    old = spark.read.parquet(path)
    plain = [c for c in old.columns if c != "bucket_"]
    fresh = _bucketed(new, keys, buckets)
    touched = [r["bucket_"] for r in fresh.select("bucket_").distinct().collect()]  # buckets at most
    if not touched:
        return 0
    some = old.where(F.col("bucket_").isin(touched)).select(*plain)
    merged = scratch(_bucketed(upsert(some, new, keys, order, update), keys, buckets), "upsert")
    merged.repartition("bucket_").write.partitionBy("bucket_").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    discard(merged)
    return len(touched)


def supersede(chunks: DataFrame, dead: DataFrame, edges: DataFrame, mentions: DataFrame) -> dict[str, DataFrame]:
    """Marks what falls with dead chunks: edges on them, their mentions, and entities left without a live mention."""
    gone = dead.select(F.col("chunk_id").alias("_c")).distinct()
    mark = lambda df, col: df.join(gone, df[col] == gone["_c"], "left").withColumn(
        "status", F.when(F.col("_c").isNotNull(), "superseded").otherwise(F.col("status"))).drop("_c")
    live = mark(mentions, "chunk_id")
    ends = mark(mark(edges, "src"), "dst")
    touched = live.where("status = 'superseded'").select("entity_id").distinct()
    kept = live.where("status <> 'superseded'").select("entity_id").distinct()
    return {"chunks": mark(chunks, "chunk_id"), "edges": ends, "mentions": live, "entities": touched.join(kept, "entity_id", "left_anti")}


def new_rows(rows: DataFrame, runs: DataFrame, stage: str) -> DataFrame:
    """rows (run_id, status) that the stage hasn't seen: no finished run yet, an unknown creating run, or one that began since."""
    done = (F.col("stage") == stage) & (F.col("status") == "done") & (F.col("failed") == 0) & (F.col("done") == F.col("selected"))
    cut = runs.where(done).agg(F.max("started_at").alias("cut")).first()["cut"]
    accepted = rows.where("status = 'accepted'")
    if cut is None:
        return accepted
    began = runs.select("run_id", F.col("started_at").alias("_began"))
    return accepted.join(began, "run_id", "left").where(F.col("_began").isNull() | (F.col("_began") >= F.lit(cut))).drop("_began")


def runnable(items: DataFrame, ledger: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Items with their state against the ledger (item_id, input_hash, status, attempts), and whether to run them."""
    led = ledger.select("item_id", F.col("input_hash").alias("_h"), F.col("status").alias("_s"), "attempts")
    state = (
        F.when(F.col("_s").isNull(), "missing").when(~F.col("_h").eqNullSafe(F.col("input_hash")), "stale")
        .when((F.col("_s") == "failed") & (F.col("attempts") >= max_attempts), "failed_final").otherwise(F.col("_s"))
    )
    return items.join(led, "item_id", "left").withColumn("state", state).withColumn("runs", F.col("state").isin("missing", "stale", "pending", "failed")).drop("_h", "_s")


def changed_files(documents: DataFrame, incoming: DataFrame) -> DataFrame:
    """(doc_id, source_uri): live documents of files (source_uri, content_hash) whose contents are now others; they fall with all that came from them."""
    now = incoming.select("source_uri", F.col("content_hash").alias("hash_now")).distinct()
    live = documents.where("status <> 'superseded'").join(now, "source_uri")
    same = live.where("content_hash = hash_now").select("doc_id").distinct()
    return live.select("doc_id", "source_uri").distinct().join(same, "doc_id", "left_anti")


def claimed(ledger: DataFrame, now: Column, seconds: int, count: int, max_attempts: int = 3) -> DataFrame:
    """The first `count` items of a ledger (item_id, status, lease_until, attempts) that a worker may take, with their new lease.

    Those are pending ones and those whose lease is over, tried less often than allowed; in id order.
    """
    free = (F.col("status") == "pending") | ((F.col("status") == "running") & (F.col("lease_until") < now))
    taken = ledger.where(free & (F.col("attempts") < max_attempts)).orderBy("item_id").limit(count)
    return taken.select("item_id", F.lit("running").alias("status"), (now + F.make_dt_interval(secs=F.lit(seconds))).alias("lease_until"), (F.col("attempts") + 1).alias("attempts"))


def content_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks that aren't boilerplate; what was never judged isn't."""
    return chunks.where(~F.coalesce(F.col("boilerplate"), F.lit(False)))


def latest(rows: DataFrame, n: int, at: str = "created_at", id_col: str = "id") -> DataFrame:
    """The n newest rows, ties by id."""
    return rows.orderBy(F.desc(at), id_col).limit(n)


def least_pairs(members: DataFrame, keys: Sequence[str], item: str, cap: int, kind: str | None = None) -> DataFrame:
    """(keys, a, b): of each group the first cap pairs (a < b) of its items, in (a, b) order; with kind, of items of different kinds.

    No group is joined with itself. If an item begins no pair (all later ones
    are of its kind), no later one does either; so the first cap items are all
    that can begin one, and what they lead to is among the first 2 * cap items of a kind.
    """
    held = members.select(*keys, F.col(item).alias("a"), *([F.col(kind).alias("kind_")] if kind else [])).where("a IS NOT NULL").distinct()
    kinds = [*keys, "kind_"] if kind else list(keys)
    few = top_per_key(held, kinds, 2 * cap, F.col("a")).drop("rank")
    first = top_per_key(few, list(keys), cap, F.col("a")).drop("rank")
    other = few.select(*keys, F.col("a").alias("b"), *([F.col("kind_").alias("kind_b")] if kind else []))
    pairs = first.join(other, list(keys)).where("a < b")
    if kind:
        pairs = pairs.where("kind_ <> kind_b")
    return top_per_key(pairs, list(keys), cap, F.col("a"), F.col("b")).select(*keys, "a", "b")


def reusable(chunks: DataFrame, runs: DataFrame) -> DataFrame:
    """(text, chunk_id, uses): of each text the least chunk that a finished run made; chunks: (chunk_id, text, run_id), runs: (run_id, status).

    Texts are grouped by their digest and themselves, so a collision can't give one text the chunk of another.
    """
    done = runs.where("status = 'finished'").select("run_id").distinct()
    kept = chunks.where("text IS NOT NULL").join(done, "run_id", "left_semi")
    return kept.groupBy(F.md5("text").alias("h"), "text").agg(F.min("chunk_id").alias("chunk_id"), F.count("*").alias("uses")).drop("h")


def merged_attributes(members: DataFrame, cluster: str, member: str) -> DataFrame:
    """(cluster, key, value): attributes (cluster, member, key, value) of a cluster's members merged; the least member that has a key gives its value."""
    return members.groupBy(cluster, "key").agg(F.min_by("value", member).alias("value"))


def duplicate_edges(rows: DataFrame, id_col: str, text_col: str, relation: str = "DUPLICATE_OF") -> DataFrame:
    """(src, dst, edge_id): every copy of a text points at the least row that has it; null texts are no copies."""
    hashed = rows.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("src"), F.sha2(text_col, 256).alias("h"))
    first = hashed.groupBy("h").agg(F.min("src").alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = hashed.join(first, "h").where("src <> dst")
    return pairs.select("src", "dst", sha_id(F.col("src").cast("string"), F.col("dst").cast("string"), F.lit(relation)).alias("edge_id"))


def weighted(features: dict[str, tuple[float, Column]]) -> Column:
    """The sum of weighted features (name: weight, value); one that is missing counts nothing."""
    total = F.lit(0.0)
    for weight, value in features.values():
        total = total + weight * F.coalesce(value.cast("double"), F.lit(0.0))
    return total


def reranked(rows: DataFrame, features: dict[str, tuple[float, Column]], id_col: str, k: int, places: int = 6) -> DataFrame:
    """(id, score): the k rows of greatest weighted answers, ties by id."""
    return rows.select(id_col, F.round(weighted(features), places).alias("score")).orderBy(F.desc("score"), id_col).limit(k)
