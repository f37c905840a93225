"""GraphSession: search and context over a folder of snapshot tables, and incremental updates of it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.functions import vectors as vec
from docweave.functions.text import hashed_vector
from docweave.operators import graph, search
from docweave.operators.text_index import TextIndex
from docweave.sinks.export import publish
from docweave.storage import delete, modified


@dataclass(frozen=True)
class Filters:
    doc_types: tuple[str, ...] = ()
    roles: tuple[str, ...] = ()
    docs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Plan:
    """How far a question goes: seeds, hops, neighbours a node, relations (or * for all), tokens of context."""

    seeds: int = 8
    hops: int = 1
    neighbours: int = 8
    relations: tuple[str, ...] = ("*",)
    tokens: int = 3000


class GraphSession:
    """Tables documents, chunks, edges and communities under root; each is a Parquet folder that publish swaps in whole."""

    def __init__(self, spark: SparkSession, root: str, vector_size: int = 64):
        self.spark, self.root, self.size = spark, root.rstrip("/"), vector_size

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def live_chunks(self, filters: Filters = Filters()) -> DataFrame:
        """Accepted chunks of documents that aren't quarantined, as the filters have them."""
        d = self.table("documents").where(~F.coalesce(F.col("quarantined"), F.lit(False))).select("doc_id", "doc_type", "language")
        c = self.table("chunks").where("status = 'accepted'").join(d, "doc_id")
        for values, column in ((filters.doc_types, "doc_type"), (filters.roles, "role"), (filters.docs, "doc_id")):
            if values:
                c = c.where(F.col(column).isin(list(values)))
        return c

    def text_index(self) -> TextIndex:
        """The inverted index of the live chunks, beside the tables; written anew when documents or chunks were swapped."""
        version = "-".join(str(modified(self.spark, f"{self.root}/{name}")) for name in ("documents", "chunks"))
        found = TextIndex(self.spark, f"{self.root}/text_index/{version}")
        return found if found.exists() else TextIndex.build(self.live_chunks(), "chunk_id", "text", found.path)

    def nearest(self, query: str, k: int, filters: Filters = Filters()) -> DataFrame:
        """(id, dist, rank): the k nearest chunks to the query's vector, exactly."""
        q = F.array(*[F.lit(x) for x in hashed_vector(query, self.size)])
        near = self.live_chunks(filters).select(F.col("chunk_id").alias("id"), vec.cosine_distance(F.col("embedding"), q).alias("dist")).where("dist IS NOT NULL")
        best = near.orderBy("dist", "id").limit(k)
        return best.withColumn("rank", F.row_number().over(Window.orderBy("dist", "id")))

    def search(self, query: str, k: int = 10, filters: Filters = Filters(), fetch: int = 50, judge: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """(id, rrf, score, rank): vector and text candidates fused by rank, then by the judge's score if there is one.

        judge takes the fused candidates (id, rrf) and gives (id, score).
        """
        words = [w for group in search.websearch(query).any_of for phrase in group for w in phrase]
        among = self.live_chunks(filters).select(F.col("chunk_id").alias("id")) if filters != Filters() else None
        texts = self.text_index().top(words, fetch, among=among) if words else None
        lists = [self.nearest(query, fetch, filters), *([texts] if texts is not None else [])]
        fused = search.reciprocal_ranks(*lists)
        scored = fused.join(judge(fused), "id", "left") if judge else fused.withColumn("score", F.lit(0.0))
        order = [F.desc_nulls_last("score"), F.desc("rrf"), F.col("id")]
        return scored.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))

    def context(self, query: str, plan: Plan = Plan(), filters: Filters = Filters(), judge: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """(passage, id, text): cited passages from the seeds and what their edges lead to, within the plan's tokens."""
        seeds = self.search(query, plan.seeds, filters, judge=judge).select("id")
        live = self.live_chunks()
        ids = live.select(F.col("chunk_id").alias("neighbour"))
        edges = self.table("edges").where("status = 'accepted' AND NOT structural AND src_kind = 'chunk' AND dst_kind = 'chunk'").select("edge_id", F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "rel", "weight")
        if "*" not in plan.relations:
            edges = edges.where(F.col("rel").isin(list(plan.relations)))
        reached = graph.expand(edges, seeds, plan.hops, plan.neighbours, judge=lambda offered: offered.join(ids, "neighbour", "left_semi"))
        rows = live.join(reached.select(F.col("id").alias("chunk_id")), "chunk_id").select("chunk_id", "doc_id", "ord", "text", "tokens")
        numbered = rows.withColumn("id", F.row_number().over(Window.orderBy("doc_id", "ord", "chunk_id")).cast("long"))
        cited = graph.passages(numbered.select(F.lit(0).alias("q"), "doc_id", "ord", "id", "tokens"), "q", plan.tokens)
        return numbered.join(cited.select("id", "passage"), "id").select("passage", F.col("chunk_id").alias("id"), "text")

    def communities(self, ids: Sequence[str]) -> DataFrame:
        """Accepted communities that hold any of some chunks."""
        return self.table("communities").where(F.col("status") == "accepted").where(F.arrays_overlap("member_ids", F.array(*[F.lit(i) for i in ids])))

    def build(self, stages: Sequence[tuple[str, Callable[[GraphSession], set[str]]]], max_reopened: int = 2) -> list[str]:
        """Runs named stages in order and gives the names as they ran.

        A stage gives the names of earlier stages that have work again through it
        (an audit that sends a lone chunk back to be linked, say); from the first
        of these on all run again, at most max_reopened times.
        """
        names, ran = [n for n, _ in stages], []
        begin = 0
        for _ in range(1 + max_reopened):
            reopened: set[str] = set()
            for name, stage in stages[begin:]:
                reopened |= set(stage(self) or ())
                ran.append(name)
            if not reopened:
                break
            begin = min(names.index(n) for n in reopened)
        return ran

    def update(self, stages: Sequence[Callable[[GraphSession, dict[str, DataFrame]], dict[str, DataFrame]]]) -> None:
        """Runs stages in order; each gives new versions of tables, which are swapped in before the next begins. A failure stops the rest. Text indexes of older versions go at the end."""
        for stage in stages:
            made: dict[str, DataFrame] = {}
            made |= stage(self, made)
            publish(self.spark, made, self.root)
        delete(self.spark, f"{self.root}/text_index")
