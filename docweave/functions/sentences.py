"""Sentence boundaries with abbreviations learned from the corpus (after Kiss and Strunk 2006)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.storage import scratch

#: A word that may be an abbreviation, with stops inside and perhaps one at its end.
WORD = r"(?<![\p{L}\p{N}_.])(\p{L}+(?:\.\p{L}+)*\.?)(?![\p{L}\p{N}_.])"
CLOSERS = "\"')\\]}”’»"


@dataclass(frozen=True)
class Stops:
    """least: the weighted log-likelihood from which a word is an abbreviation; chance: how often such a word has its stop."""

    least: float = 0.3
    chance: float = 0.99
    longest: int = 12


def abbreviations(df: DataFrame, text_col: str, stops: Stops = Stops()) -> DataFrame:
    """(word, score) of the words that a stop belongs to, by counts over all texts.

    A word with a stop in `chance` of its uses is more likely than one with a
    stop as often as any word: the log of that ratio (Dunning 1993), weighted down
    by length and by uses without a stop, and up by stops inside. Words are small
    letters; single letters count, as initials do.
    """
    words = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD), F.lit(1))).alias("w"))
    each = words.select(F.regexp_replace("w", r"\.$", "").alias("word"), F.endswith(F.col("w"), F.lit(".")).cast("long").alias("stop"))
    counts = scratch(each.groupBy("word").agg(F.count("*").alias("n"), F.sum("stop").alias("k")), "word-counts")  # read twice
    total = counts.agg((F.sum("k") / F.sum("n")).alias("p"))
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    p = F.greatest(F.least(F.col("p"), F.lit(1 - 1e-9)), F.lit(1e-9))
    likely = lambda q: k * F.log(q) + (n - k) * F.log(1 - q)
    letters = F.char_length(F.replace("word", F.lit("."), F.lit("")))
    inside = F.char_length("word") - letters + 1
    score = 2 * (likely(F.lit(stops.chance)) - likely(p)) * F.exp(-letters) * inside * F.pow(letters.cast("double"), -(n - k))
    scored = counts.join(F.broadcast(total)).where((F.col("k") > 0) & (letters <= stops.longest))
    return scored.select("word", score.alias("score")).where(F.col("score") >= stops.least)


def sentences(text: Column, short: Iterable[str]) -> Column:
    """A text's sentences, trimmed: cut after stops, question and exclamation marks (and marks that close them) before white space.

    No cut after a word of `short`, an abbreviation that the list must bound. Null stays null, a blank text has none.
    """
    words = sorted(set(short), key=lambda w: (-len(w), w))
    guarded = text
    if words:
        # What follows an abbreviation is kept from the cut below by a mark, which then goes.
        any_of = "|".join(w.replace(".", r"\.") for w in words)
        guarded = F.regexp_replace(text, rf"(?iu)(?<![\p{{L}}\p{{N}}_.])({any_of})\.\s+", "$1.\x01 ")
    parts = F.split(F.regexp_replace(guarded, rf"([.!?…][{CLOSERS}]*)\s+", "$1\x00"), "\x00")
    trimmed = F.transform(parts, lambda s: F.regexp_replace(F.replace(s, F.lit("\x01"), F.lit("")), r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda s: s != "")
