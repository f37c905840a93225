"""Connected components over an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.storage import discard, scratch

#: Edges of one part file, and the parts that the edges of a round are written in at least.
FILE, FILES = 250_000, 8


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node on an edge; component is the smallest reachable node.

    Alternates large-star and small-star steps (Kiveris et al., 2014): each
    round is two aggregations over the edges, the edge count never grows, and
    the rounds grow with the logarithm of the component size. The star centre
    is found with a partial aggregate and joined back, so that a node of very
    high degree is split by adaptive execution instead of landing in one task.
    Edges with a null end are ignored; self-loops only name their node.
    Each round's edges are written and those of the round before deleted. They
    go to as many parts as there are edges for, not to one for each shuffle
    partition: every part file costs a task, and on a local disk processes that
    set its mode.
    """
    nodes = edges.select(F.explode(F.array(F.col(src), F.col(dst))).alias("node")).where("node IS NOT NULL").distinct()
    cur = (
        edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
        .select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .distinct()
    )
    cur = scratch(cur, "edges", "snappy")
    seen = None
    for _ in range(max_rounds):
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low2, "u")
        small = (
            hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low2.select("u", F.col("m").alias("v")))
            .distinct()
        )
        done = cur
        cur = scratch(small if seen is None else small.coalesce(max(FILES, seen[0] // FILE)), "edges", "snappy")
        discard(done)
        state = cur.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == (state["n"], state["h"]):
            break
        seen = (state["n"], state["h"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(roots.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
