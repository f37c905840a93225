"""Gates: nested conditions over answers, compiled to one column.

A leaf is yes, no or skipped; skipped leaves take no part. A gate accepts if
its condition holds or nothing was asked; without a condition it accepts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    """One test of one answer. test: is_yes, is_no, eq, in, not_in or level_in; threshold overrides the gate's."""

    question: str
    test: str
    value: object = None
    if_asked: bool = False
    threshold: float | None = None


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


def backed_off(threshold: float, base: float, attempt: int) -> float:
    """The threshold after some failed attempts: what is missing to 1 shrinks by base each time."""
    if not (0 < threshold < 1 and 0 < base <= 1 and attempt >= 0):
        raise ValueError("threshold and base lie between 0 and 1, attempts from 0")
    return 1 - (1 - threshold) * base**attempt


def top_level(probabilities: Column, score: Column) -> Column:
    """The level of greatest probability, the first key in string order of ties; without probabilities the score rounded half to even."""
    entries = F.sort_array(F.transform(F.map_entries(probabilities), lambda e: F.struct((-e["value"]).alias("p"), e["key"].cast("string").alias("k"))))
    return F.when(F.size(probabilities) > 0, F.get(entries, F.lit(0))["k"].cast("int")).otherwise(F.bround(score).cast("int"))


def _leaf(leaf: Leaf, answers: str, threshold: float) -> Column:
    a = F.element_at(F.col(answers), leaf.question)
    t = F.lit(leaf.threshold if leaf.threshold is not None else threshold)
    values = leaf.value if isinstance(leaf.value, (list, tuple)) else [leaf.value]
    test = {
        "is_yes": lambda: a["p"] > t, "is_no": lambda: 1 - a["p"] > t,
        "eq": lambda: a["choice"] == F.lit(leaf.value), "in": lambda: a["choice"].isin(list(values)), "not_in": lambda: ~a["choice"].isin(list(values)),
        "level_in": lambda: top_level(a["probabilities"], a["score"]).isin(list(values)),
    }[leaf.test]()
    missing = F.lit(None).cast("boolean") if leaf.if_asked else F.raise_error(F.lit(f"no answer to {leaf.question}")).cast("boolean")
    return F.when(a.isNull(), missing).otherwise(F.coalesce(test, F.lit(False)))


def _column(node: object, answers: str, threshold: float) -> Column:
    if isinstance(node, Leaf):
        return _leaf(node, answers, threshold)
    if isinstance(node, Not):
        return ~_column(node.part, answers, threshold)
    parts = F.filter(F.array(*[_column(p, answers, threshold) for p in node.parts]), lambda x: x.isNotNull())
    both = F.forall(parts, lambda x: x) if isinstance(node, All) else F.exists(parts, lambda x: x)
    return F.when(F.size(parts) > 0, both)


def gate(condition: object | None, answers: str = "answers", threshold: float = 0.5, base: float = 0.5, attempt: int = 0) -> Column:
    """accept or reject; answers is a map from question to struct(p, choice, score, probabilities)."""
    if condition is None:
        return F.lit("accept")
    held = _column(condition, answers, backed_off(threshold, base, attempt))
    return F.when(F.coalesce(held, F.lit(True)), "accept").otherwise("reject")
