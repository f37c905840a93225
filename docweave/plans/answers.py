"""An answer store that outlives versions of question sets: what was asked word for word on a state isn't asked again."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.ids import sha_id
from docweave.plans import provider
from docweave.storage import delete_on_exit, scratch, shared_dir, written

SHARDS = 64
STORED = provider.ANSWERS + ", reuse_key string, drift boolean, batch string, shard int"


def wording() -> Column:
    """A question as it is asked: its words, kind, options in their order, levels. The set's version isn't part of it."""
    return F.to_json(F.struct("question", "kind", "options", "levels"))


def keyed(items: DataFrame, question_set: str, questions: Sequence[provider.Question], model: str) -> DataFrame:
    """provider.render's rows with reuse_key (model, set name without version, state, wording) and its shard."""
    rows = provider.render(items, question_set, questions, model)
    key = sha_id(F.lit(model), F.lit(question_set.split("@")[0]), F.coalesce("state", F.lit("")), wording())
    return rows.withColumn("reuse_key", key).withColumn("shard", F.pmod(F.xxhash64("reuse_key"), F.lit(SHARDS)).cast("int"))


@dataclass
class AnswerStore:
    """Answers under path, in a folder for each shard of their key; rows are added and never changed.

    A batch is written whole or not at all. If two batches hold one key (they
    ran side by side), the least batch counts. Answers marked as drift, from
    repeated questions that watch the model, are never reused.
    """

    spark: SparkSession
    path: str

    def answers(self, shards: DataFrame | None = None) -> DataFrame:
        """One row for each key; of some shards only, which the scan is cut to."""
        if not written(self.spark, self.path):
            return self.spark.createDataFrame([], STORED)
        rows = self.spark.read.schema(STORED).parquet(self.path).where("NOT drift")
        if shards is not None:
            rows = rows.join(F.broadcast(shards.select("shard").distinct()), "shard", "left_semi")  # SHARDS rows at most
        names = [c for c in rows.columns if c != "reuse_key"]
        return rows.groupBy("reuse_key").agg(F.min(F.struct("batch", *[c for c in names if c != "batch"])).alias("r")).select("reuse_key", *[f"r.{c}" for c in names])

    def add(self, rows: DataFrame, drift: bool = False) -> None:
        """Appends answered rows (ANSWERS and reuse_key, shard)."""
        batch = uuid.uuid4().hex
        made = rows.select("*", F.lit(drift).alias("drift"), F.lit(batch).alias("batch")).select(*[c.split()[0] for c in STORED.split(", ")])
        made.repartition("shard").write.partitionBy("shard").mode("append").parquet(self.path)

    def ask(self, items: DataFrame, question_set: str, questions: Sequence[provider.Question], ask: Callable = provider.offline, model: str = "offline") -> DataFrame:
        """(item_id, question, reused, p, choice, score): valid answers to all questions on all items (item_id, state).

        Stored answers are found by a join on (shard, reuse_key): the shards asked
        for prune the folders, and on a store much greater than the batch Spark's
        runtime filter puts a Bloom filter of the keys before the shuffle. The
        rest is asked once for each key, then added.
        """
        asked = scratch(keyed(items, question_set, questions, model), "asked")
        known = self.answers(asked).join(asked.select("shard", "reuse_key").distinct(), ["shard", "reuse_key"], "left_semi")
        known = scratch(known.drop("batch", "drift"), "reused")
        # A key asked by several items of one state is one question.
        new = asked.join(known.select("reuse_key"), "reuse_key", "left_anti").dropDuplicates(["reuse_key"])
        made = provider.answer(new.withColumn("cache_key", F.col("reuse_key")), provider=ask)
        made = scratch(made.withColumn("reuse_key", F.col("cache_key")).withColumn("shard", F.pmod(F.xxhash64("reuse_key"), F.lit(SHARDS)).cast("int")), "answered")
        if not made.isEmpty():
            self.add(made)
        every = known.select(*made.columns, F.lit(True).alias("reused")).unionByName(made.withColumn("reused", F.lit(False)))
        told = asked.select("item_id", "reuse_key", F.col("options").alias("options")).join(every.drop("shard"), "reuse_key")
        fits = provider.fits()
        return told.where(F.coalesce(fits, F.lit(False))).select("item_id", "question", "reused", "p", "choice", "score")


def temporary(spark: SparkSession) -> AnswerStore:
    """A store in the shared folder, for tests and queries."""
    path = f"{shared_dir(spark).rstrip('/')}/docweave-answers-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return AnswerStore(spark, path)
