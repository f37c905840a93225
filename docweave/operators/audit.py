"""Reports, provenance audits and drift over decisions, work items and edges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outcome_rates(decisions: DataFrame, by: str, outcome: str = "outcome") -> DataFrame:
    """(by, n, accept_rate) with rates to four decimals."""
    return decisions.groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg((F.col(outcome) == "accept").cast("int")), 4).alias("accept_rate"))


def weighted_pass_rate(decisions: DataFrame, name: str) -> DataFrame:
    """(base, n, rate) by the name before @, and the overall rate weighted from the rounded ones."""
    rates = outcome_rates(decisions.withColumn("base", F.substring_index(name, "@", 1)), "base").withColumnRenamed("accept_rate", "rate")
    overall = rates.agg(F.lit("overall").alias("base"), F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("rate")) / F.sum("n"), 4).alias("rate"))
    return rates.unionByName(overall)


def overturn_rates(reviews: DataFrame, by: str, verdict: str, outcome: str) -> DataFrame:
    """(by, reviewed, overturned, rate): how often a verdict differs from what was decided."""
    return reviews.groupBy(by).agg(
        F.count("*").alias("reviewed"), F.count_if(F.col(verdict) != F.col(outcome)).alias("overturned"),
        F.round(F.count_if(F.col(verdict) != F.col(outcome)) / F.count("*"), 4).alias("rate"))


def provenance_violations(rows: DataFrame, id_col: str, ids_col: str, decisions: DataFrame, sets: Sequence[str], human: DataFrame | None = None) -> DataFrame:
    """Accepted rows without an accepting decision of an allowed question set; human holds (id_col) of rows that a person accepted."""
    good = decisions.where((F.col("outcome") == "accept") & F.substring_index("question_set", "@", 1).isin(list(sets))).select("decision_id").distinct()
    cited = rows.select(id_col, F.explode(ids_col).alias("decision_id")).join(good, "decision_id", "left_semi").select(id_col).distinct()
    bare = rows.where("status = 'accepted'").join(cited, id_col, "left_anti")
    return bare if human is None else bare.join(human.select(id_col).distinct(), id_col, "left_anti")


@dataclass(frozen=True)
class Rule:
    """A rule of the audit: accepted rows of a table that meet `when` (SQL) need an accepting decision of one of `sets`."""

    name: str
    table: str
    id_col: str
    sets: tuple[str, ...]
    when: str = "true"
    ids_col: str = "decision_ids"


def audited(tables: dict[str, DataFrame], rules: Sequence[Rule], decisions: DataFrame, human: DataFrame | None = None) -> DataFrame:
    """(rule, id) of what breaks the rules, ids as strings; human: (table, id) of rows that a person accepted."""
    every = None
    for r in rules:
        rows = tables[r.table].where(r.when)
        people = None if human is None else human.where(F.col("table") == r.table).select(F.col("id").cast(rows.schema[r.id_col].dataType).alias(r.id_col))
        bad = provenance_violations(rows, r.id_col, r.ids_col, decisions, r.sets, people).select(F.lit(r.name).alias("rule"), F.col(r.id_col).cast("string").alias("id"))
        every = bad if every is None else every.unionByName(bad)
    return every


def unmet_requirements(edges: DataFrame, decisions: DataFrame, groups: dict[str, list[list[str]]], human: DataFrame | None = None) -> DataFrame:
    """Accepted edges that lack an accepting decision in some group of sets their kind asks for; a kind without groups is unmet.

    human: (edge_id) of edges that a person accepted, which need nothing else.
    """
    good = decisions.where("outcome = 'accept'").select("decision_id", F.substring_index("question_set", "@", 1).alias("set"))
    accepted = edges.where("status = 'accepted'")
    passed = accepted.select("edge_id", F.explode_outer("decision_ids").alias("decision_id")).join(good, "decision_id", "left").groupBy("edge_id").agg(F.collect_set("set").alias("passed"))
    met: Column = F.lit(False)
    for kind, needs in groups.items():
        every = F.lit(bool(needs))
        for sets in needs:
            every = every & F.arrays_overlap("passed", F.array(*[F.lit(s) for s in sets]))
        met = F.when(F.col("src_kind") == kind, every).otherwise(met)
    if human is not None:
        accepted = accepted.join(human.select("edge_id").distinct(), "edge_id", "left_anti")
    return accepted.join(passed, "edge_id").where(~met).select("edge_id", "src_kind", F.sort_array("passed").alias("passed"))


def drift(pairs: DataFrame, boundary: float = 0.5, max_flips: float = 0.05, max_stdev: float = 0.1, min_compared: int = 20) -> DataFrame:
    """One row over (old, new) answers: compared, flips over the boundary, population deviation of differences, breach."""
    side = lambda c: F.col(c) >= boundary
    out = pairs.agg(F.count("*").alias("compared"), F.count_if(side("old") != side("new")).alias("flips"), F.coalesce(F.stddev_pop(F.col("new") - F.col("old")), F.lit(0.0)).alias("stdev"))
    breach = (F.col("compared") >= min_compared) & ((F.col("flips") / F.col("compared") > max_flips) | (F.col("stdev") > max_stdev))
    return out.withColumn("breach", breach)


def drift_answers(pairs: DataFrame, boundary: float = 0.5, max_flips: float = 0.05, max_stdev: float = 0.1, min_compared: int = 20) -> DataFrame:
    """drift over answers of every kind: rows (kind, old_p, new_p, old_choice, new_choice, levels, old_model, new_model).

    A yes-or-no answer is its probability, a score is rescaled to 0 to 1 by its
    levels (with fewer than two it is compared but has no difference), a choice
    only flips. Flips are counted over all kinds. Answers of another model than
    before are a breach whatever the numbers.
    """
    scale = F.when(F.col("kind") == "noul", F.lit(1.0)).when((F.col("kind") == "score") & (F.col("levels") > 1), F.col("levels") - 1)
    old, new = F.col("old_p") / scale, F.col("new_p") / scale
    flips = F.when(F.col("kind") == "choice", F.col("old_choice") != F.col("new_choice")).otherwise((old >= boundary) != (new >= boundary))
    out = pairs.agg(
        F.count("*").alias("compared"), F.count_if(flips).alias("flips"), F.coalesce(F.stddev_pop(new - old), F.lit(0.0)).alias("stdev"),
        F.coalesce(F.bool_or(F.col("old_model") != F.col("new_model")), F.lit(False)).alias("other_model"))
    wide = (F.col("compared") >= min_compared) & ((F.col("flips") / F.col("compared") > max_flips) | (F.col("stdev") > max_stdev))
    return out.withColumn("breach", wide | F.col("other_model"))


def estimate(items: DataFrame, runs: DataFrame, prior: tuple[float, float, float], calls_per_minute: float, tokens_per_second: float, concurrency: int) -> DataFrame:
    """(stage, items, calls, seconds) for stages with items to do (stage, items).

    Calls an item and tokens a call come from a stage's last finished run (stage,
    status, ended_at, done, calls, tokens), else from the prior; so do, always,
    the drafting seconds of an item. The slower of the two limits counts.
    """
    last = runs.where("status = 'done' AND done > 0 AND calls > 0").groupBy("stage").agg(F.max_by(F.struct("done", "calls", "tokens"), "ended_at").alias("r"))
    per_item, per_call = F.coalesce(F.col("r.calls") / F.col("r.done"), F.lit(prior[0])), F.coalesce(F.col("r.tokens") / F.col("r.calls"), F.lit(prior[1]))
    rows = items.join(last, "stage", "left").select("stage", "items", (F.col("items") * per_item).alias("calls"), per_call.alias("per_call"))
    seconds = F.greatest(F.col("calls") / calls_per_minute * 60, F.col("calls") * F.col("per_call") / tokens_per_second) + F.col("items") * prior[2] / concurrency
    return rows.select("stage", "items", F.round("calls", 6).alias("calls"), F.round(seconds, 6).alias("seconds"))


def multiset_changes(old: DataFrame, new: DataFrame, key: str, values: str) -> DataFrame:
    """(before, after, n): how often a list of values, order aside, turned into another."""
    a = old.select(key, F.array_join(F.sort_array(values), ",").alias("before"))
    b = new.select(key, F.array_join(F.sort_array(values), ",").alias("after"))
    return a.join(b, key).where(~F.col("before").eqNullSafe(F.col("after"))).groupBy("before", "after").agg(F.count("*").alias("n"))


def planned_seconds(calls: Column, tokens: Column, items: Column, calls_per_minute: float, tokens_per_minute: float, seconds_per_item: float, concurrency: int) -> Column:
    """The time that work takes: the slower of the limits on calls and tokens, and drafting over its concurrency."""
    return F.greatest(calls / float(calls_per_minute) * 60, tokens * 60 / float(tokens_per_minute)) + items * seconds_per_item / concurrency


def review_list(queue: DataFrame, kinds: Sequence[str], limit: int, kind: str = "kind", at: str = "created_at", id_col: str = "review_id") -> DataFrame:
    """The latest items of some kinds, as many as the list shows, ties by id."""
    return queue.where(F.col(kind).isin(list(kinds))).orderBy(F.desc(at), id_col).limit(limit)
