"""Likeness of strings: common subsequences by bits, the most alike part of a text, and a join of alike strings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; a column of the table at a time, as the bits of one number (Hyyro 2004)."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for c in b:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & every
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """200 * common subsequence / summed lengths; 100 for two empty strings."""
    return 200.0 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def _overlaps(needle: str, hay: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, size, characters in common) of the parts of hay as long as needle, and of the shorter ones at its two ends."""
    n, m = len(hay), len(needle)
    short = np.arange(1, m)
    begin = np.concatenate((np.arange(n - m + 1), np.zeros(m - 1, int), n - short))
    size = np.concatenate((np.full(n - m + 1, m), short, short))
    common = np.zeros(len(begin), int)
    letters = np.array(list(hay))
    for c in set(needle):
        seen = np.concatenate(([0], np.cumsum(letters == c)))
        common += np.minimum(seen[begin + size] - seen[begin], needle.count(c))
    return begin, size, common


def best_part(needle: str, hay: str) -> tuple[float, int, int]:
    """(ratio, begin, size): the part of hay most like needle, over all parts of its length and the shorter ones at both ends.

    Exact: parts go by an upper bound (characters in common, order aside), and
    all that could still be best are compared. Ties go to the first, then the
    longer part. A needle longer than hay is searched for hay; the part is then all of hay.
    """
    if not needle or not hay:
        return 0.0, 0, 0
    if len(needle) > len(hay):
        return best_part(hay, needle)[0], 0, len(hay)
    begin, size, common = _overlaps(needle, hay)
    bound = 200.0 * common / (len(needle) + size)
    best = (-1.0, 0, 0)
    for i in np.lexsort((-size, begin, -bound)).tolist():
        if bound[i] < best[0]:
            break
        b, n = int(begin[i]), int(size[i])
        found = (indel_ratio(needle, hay[b : b + n]), -b, n)
        best = max(best, found)
    return best[0], -best[1], best[2]


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio between the shared words and either side's words, order and repeats aside."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_a or not only_b):
        return 100.0
    left, right = (f"{both} {o}".strip() for o in (only_a, only_b))
    scores = [indel_ratio(left, right)]
    if both:
        scores += [indel_ratio(both, left), indel_ratio(both, right)]
    return max(scores)


def _verified(at_least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratios = np.array([indel_ratio(a, b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)])
            kept = pa.array(np.flatnonzero(ratios >= at_least))
            yield pa.RecordBatch.from_arrays([*(c.take(kept) for c in batch.columns), pa.array(ratios).take(kept)], ["a", "b", "ratio"])

    return run


def alike(strings: DataFrame, column: str, at_least: float) -> DataFrame:
    """(a, b, ratio), a < b: all pairs of distinct strings with an indel ratio of at_least (over 200/3) or more.

    A join on pairs of letters, not a comparison of all: two strings of lengths
    m and n at that ratio differ by at most e = (1 - ratio/100)(m + n) insertions
    and deletions, each of which breaks two pairs of letters of the string with the
    letter and one of the other, so they share (m + n + 2 - 3e)/2 pairs or more
    (ends count as letters). Only the rarest
    pairs of each string are joined on, as many as one must be shared; and only
    candidates with letters enough in common are compared.
    """
    if not 200 / 3 < at_least <= 100:
        raise ValueError("at_least must be over 200/3")
    loss = 1 - at_least / 100
    texts = strings.select(F.col(column).alias("s")).where("s IS NOT NULL AND s <> ''").distinct()
    n = F.char_length("s")
    framed = F.concat(F.lit("\x02"), F.col("s"), F.lit("\x03"))
    grams = texts.select("s", n.alias("n"), F.explode(F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.substring(framed, i, F.lit(2)))).alias("gram"))
    # Equal pairs in a string are told apart by their number.
    counted = grams.withColumn("k", F.row_number().over(Window.partitionBy("s", "gram").orderBy(F.lit(1))))
    spread = counted.groupBy("gram", "k").agg(F.count("*").alias("df"))
    ranked = counted.join(spread, ["gram", "k"]).withColumn("turn", F.row_number().over(Window.partitionBy("s").orderBy("df", "gram", "k")))
    # The shortest partner is n * ratio / (200 - ratio) long, and shares least.
    least = F.ceil(F.col("n") * at_least / (200 - at_least) - 1e-9)
    share = F.ceil((F.col("n") + least + 2) / 2 - 1.5 * loss * (F.col("n") + least) - 1e-9)
    keys = ranked.where(F.col("turn") <= F.col("n") + 1 - F.greatest(share, F.lit(1)) + 1).select("s", "n", "gram", "k")
    left, right = (keys.select("gram", "k", F.col("s").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    close = (F.abs(F.col("n_a") - F.col("n_b")) <= loss * (F.col("n_a") + F.col("n_b")) + 1e-9) & (F.col("a") < F.col("b"))
    pairs = left.join(right, ["gram", "k"]).where(close).select("a", "b").distinct()
    return pairs.mapInArrow(_verified(at_least), "a string, b string, ratio double")


def bound_is_met(a: str, b: str, at_least: float) -> bool:
    """Whether the count filter of `alike` lets a pair pass (for its test)."""
    grams = lambda s: [f"\x02{s}\x03"[i : i + 2] for i in range(len(s) + 1)]
    x, y = grams(a), grams(b)
    shared = sum(min(x.count(g), y.count(g)) for g in set(x))
    return shared >= math.ceil((len(a) + len(b) + 2) / 2 - 1.5 * (1 - at_least / 100) * (len(a) + len(b)) - 1e-9)
