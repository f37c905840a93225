"""Property-graph operators over edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators.relational import neighbours, top_per_key
from docweave.storage import cut, scratch


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree) over both ends."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def hubs(edges: DataFrame, share: float = 0.99, min_degree: int = 1) -> DataFrame:
    """(node, degree, cut): nodes above the interpolated percentile of degrees and not below min_degree."""
    return hubs_of(degrees(edges), share, min_degree)


def hubs_of(degrees: DataFrame, share: float = 0.99, min_degree: int = 1) -> DataFrame:
    """hubs by degrees (node, degree) that are known."""
    bound = degrees.agg(F.percentile("degree", F.lit(share)).alias("cut"))
    return degrees.join(F.broadcast(bound), F.col("degree") > F.col("cut")).where(F.col("degree") >= min_degree)


def asymmetric(edges: DataFrame) -> DataFrame:
    """Accepted undirected edges whose reverse twin of the same relation was rejected."""
    accepted = edges.where("status = 'accepted' AND NOT directed")
    rejected = edges.where("status = 'rejected'").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "rel").distinct()
    return accepted.join(rejected, ["src", "dst", "rel"], "left_semi")


def anomalies(edges: DataFrame, doc_types: DataFrame, related: Sequence[tuple[str, str]] = (), contradicts: str = "contradicts", share: float = 0.99, min_degree: int = 1) -> DataFrame:
    """(edge_id, reasons) of accepted edges: hub, contradiction, asymmetric, cross_doctype (a missing type is a type of its own)."""
    accepted = edges.where("status = 'accepted'")
    hub = hubs(accepted, share, min_degree).select(F.col("node"))
    at_hub = accepted.select("edge_id", F.explode(F.array("src", "dst")).alias("node")).join(hub, "node", "left_semi").select("edge_id", F.lit("hub").alias("reason"))
    contra = accepted.where(F.col("rel") == contradicts).select("edge_id", F.lit("contradiction").alias("reason"))
    twin = asymmetric(edges).select("edge_id", F.lit("asymmetric").alias("reason"))
    kind = doc_types.select(F.col("id"), F.coalesce("doc_type", F.lit("")).alias("kind"))
    a, b = kind.select(F.col("id").alias("src"), F.col("kind").alias("ka")), kind.select(F.col("id").alias("dst"), F.col("kind").alias("kb"))
    typed = accepted.join(a, "src", "left").join(b, "dst", "left").fillna("", ["ka", "kb"])
    known = F.lit(False)
    for x, y in related:
        known = known | ((F.least("ka", "kb") == min(x, y)) & (F.greatest("ka", "kb") == max(x, y)))
    cross = typed.where((F.col("ka") != F.col("kb")) & ~known).select("edge_id", F.lit("cross_doctype").alias("reason"))
    every = at_hub.unionByName(contra).unionByName(twin).unionByName(cross)
    return every.groupBy("edge_id").agg(F.sort_array(F.collect_set("reason")).alias("reasons"))


def orphans(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """Nodes on no accepted, non-structural edge."""
    ends = edges.where("status = 'accepted' AND NOT structural").select(F.explode(F.array("src", "dst")).alias(node))
    return nodes.join(ends.distinct(), node, "left_anti")


def expand(edges: DataFrame, seeds: DataFrame, hops: int, cap: int, judge=None) -> DataFrame:
    """(id, hop, parent, edge_id): expand_many for one question with seeds (id); judge filters the offered rows."""

    def outcome(offered: DataFrame) -> DataFrame:
        return judge(offered.drop("q", "hop")).withColumns({"q": F.lit(0), "hop": F.lit(None).cast("int"), "outcome": F.lit("accept")})

    return expand_many(edges, seeds.select(F.lit(0).alias("q"), "id"), hops, cap, outcome if judge is not None else None)[0].drop("q")


def expand_many(edges: DataFrame, seeds: DataFrame, hops: int, cap: int, judge=None) -> tuple[DataFrame, DataFrame]:
    """((q, id, hop, parent, edge_id), (q, hop, from_id, edge_id, neighbour, weight, rank, outcome)) of all questions at once.

    seeds: (q, id). Each frontier node of a question offers its `cap` heaviest
    edges, before what that question has visited is taken out; judge adds an
    outcome to the offered rows (or drops some). Of several accepted ways to a
    node the first by (parent, rank, edge) counts. A node's edges are found once,
    however many questions stand on it. It ends when no question has a frontier left.
    """
    kind, edge = edges.schema["src"].dataType, edges.schema["edge_id"].dataType
    start = seeds.select("q", F.col("id").cast(kind).alias("id")).where("id IS NOT NULL").distinct()
    seen = cut(start.select("q", "id", F.lit(0).alias("hop"), F.lit(None).cast(kind).alias("parent"), F.lit(None).cast(edge).alias("edge_id")))
    columns = ["q", "hop", "from_id", "edge_id", "neighbour", "weight", "rank", "outcome"]
    told = []
    for hop in range(1, hops + 1):
        frontier = seen.where(F.col("hop") == hop - 1).select("q", F.col("id").alias("from_id"))
        if frontier.isEmpty():
            break
        near = neighbours(edges, frontier.select(F.col("from_id").alias("id")), cap)
        offered = frontier.join(near, "from_id").join(seen.select("q", F.col("id").alias("neighbour")), ["q", "neighbour"], "left_anti").withColumn("hop", F.lit(hop))
        judged = (judge(offered) if judge is not None else offered.withColumn("outcome", F.lit("accept"))).withColumn("hop", F.lit(hop))
        judged = scratch(judged.select(*columns), f"offered-{hop}")
        told.append(judged)
        accepted = judged.where("outcome = 'accept'").withColumnRenamed("rank", "turn")
        first = top_per_key(accepted, ["q", "neighbour"], 1, F.col("from_id"), F.col("turn"), F.col("edge_id"))
        reached = first.select("q", F.col("neighbour").alias("id"), F.lit(hop).alias("hop"), F.col("from_id").alias("parent"), "edge_id")
        seen = cut(seen.unionByName(reached))
    decisions = told[0] if told else neighbours(edges, start.where("false"), cap).select(F.lit(None).cast(start.schema["q"].dataType).alias("q"), F.lit(0).alias("hop"), "from_id", "edge_id", "neighbour", "weight", "rank", F.lit("").alias("outcome"))
    for more in told[1:]:
        decisions = decisions.unionByName(more)
    return seen, decisions


def two_hop_paths(edges: DataFrame, salt: str = "path") -> DataFrame:
    """(a, b, c, key): for each start, its simple two-hop path of least hash sequence over accepted edges in both directions."""
    ways = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    ways = ways.withColumn("h", F.sha2(F.concat_ws("|", F.lit(salt), F.col("src").cast("string"), F.col("dst").cast("string")), 256))
    first = ways.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("h").alias("h1"))
    second = ways.select(F.col("src").alias("b"), F.col("dst").alias("c"), F.col("h").alias("h2"))
    paths = first.join(second, "b").where("a <> c")
    return paths.groupBy("a").agg(F.min_by(F.struct("b", "c"), F.struct("h1", "h2", "b", "c")).alias("p")).select("a", "p.b", "p.c")


def passages(rows: DataFrame, query: str, budget: int) -> DataFrame:
    """Cited passages of each query: in (doc_id, ord, id) order, an oversize passage is skipped and the next may still fit."""
    lists = rows.withColumn("_t", F.struct("doc_id", "ord", "id", "tokens")).groupBy(query).agg(F.sort_array(F.collect_list("_t")).alias("ts"))
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<struct<id:bigint,n:bigint>>").alias("out"))

    def step(acc, x):
        fits = acc["used"] + x["tokens"] <= budget
        item = F.array(F.struct(x["id"].cast("long").alias("id"), (F.size(acc["out"]) + 1).cast("long").alias("n")))
        return F.struct(F.when(fits, acc["used"] + x["tokens"]).otherwise(acc["used"]).cast("long").alias("used"), F.when(fits, F.concat(acc["out"], item)).otherwise(acc["out"]).alias("out"))

    folded = lists.select(query, F.explode(F.aggregate("ts", start, step)["out"]).alias("p"))
    return folded.select(query, F.col("p.id").alias("id"), F.concat(F.lit("p"), F.col("p.n").cast("string")).alias("passage"))
