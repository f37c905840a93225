"""Full-text search over an inverted index: match sets, BM25, rank fusion."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.storage import scratch

TERM = r"[\p{L}\p{N}_]+"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def postings(df: DataFrame, id_col: str, text_col: str, words: list[str] | None = None) -> DataFrame:
    """(id, term, tf, length): the inverted index, or its part for some words, which are picked before anything is exploded."""
    found = F.col("ts") if words is None else F.filter("ts", lambda t: t.isin(list(words)))
    each = df.select(F.col(id_col).alias("id"), terms(F.col(text_col)).alias("ts")).select("id", F.size("ts").alias("length"), F.explode(found).alias("term"))
    return each.groupBy("id", "length", "term").agg(F.count("*").alias("tf"))


@dataclass
class WebQuery:
    """Alternatives of phrases that must all hold, and terms that must not."""

    any_of: list[list[list[str]]] = field(default_factory=list)
    none_of: list[list[str]] = field(default_factory=list)


def websearch(query: str) -> WebQuery:
    """Words side by side all count, `or` parts alternatives, quotes make phrases, a minus excludes; `a b or c` is (a and b) or c."""
    out, current = WebQuery(), []
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', query):
        if word.lower() == "or" and not minus:
            if current:
                out.any_of.append(current)
            current = []
            continue
        words = re.findall(r"\w+", (phrase or word).lower())
        if words:
            (out.none_of if minus else current).append(words)
    if current:
        out.any_of.append(current)
    return out


def matches(ts: Column, query: WebQuery) -> Column:
    """Whether an array of terms satisfies a query."""

    # Terms hold no blanks, so a phrase is a part of the terms joined by blanks.
    joined = F.concat(F.lit(" "), F.array_join(ts, " "), F.lit(" "))

    def holds(words: list[str]) -> Column:
        return F.array_contains(ts, words[0]) if len(words) == 1 else joined.contains(f" {' '.join(words)} ")

    found = F.lit(False)
    for group in query.any_of:
        every = F.lit(True)
        for words in group:
            every = every & holds(words)
        found = found | every
    for words in query.none_of:
        found = found & ~holds(words)
    return found


def bm25(df: DataFrame, id_col: str, text_col: str, words: list[str], k: int, k1: float = 1.2, b: float = 0.75, places: int = 9) -> DataFrame:
    """(id, score, rank): the k best rows for a bag of words (Robertson's formula with the +1 inside the logarithm)."""
    sizes = df.select(F.size(terms(F.col(text_col))).alias("n")).agg(F.count("*").alias("docs"), F.avg("n").alias("mean"))
    hit = postings(df, id_col, text_col, words)
    spread = hit.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    scored = hit.join(F.broadcast(spread), "term").join(F.broadcast(sizes)).groupBy("id").agg(F.round(F.sum(idf * tf), places).alias("score"))
    best = scored.orderBy(F.desc("score"), "id").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "id")))


def reciprocal_ranks(*lists: DataFrame, k: int = 60) -> DataFrame:
    """(id, rrf): the sum of 1 / (k + rank) over ranked lists (id, rank)."""
    every = lists[0].select("id", "rank")
    for ranked in lists[1:]:
        every = every.unionByName(ranked.select("id", "rank"))
    return every.groupBy("id").agg(F.sum(1 / (F.lit(k) + F.col("rank"))).alias("rrf"))


def keyword_matches(asks: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(id, neighbour, score, rank): for each row (id, keyword) the rows that satisfy most keywords, ties by id.

    A keyword of several words asks for all of them; keywords are alternatives,
    so `a b` and `c` stand for (a and b) or c. index holds (id, term, tf). Rows
    that ask for the same keywords have the same ranking but for themselves, so
    only the k + 1 best of each set of keywords are found, and not the pairs of
    all who ask and all who are found.
    """
    asked = asks.where("id IS NOT NULL").select("id", "keyword", F.array_distinct(terms(F.col("keyword"))).alias("ts")).where(F.size("ts") > 0).distinct()
    classes = scratch(asked.groupBy("id").agg(F.sort_array(F.collect_set("keyword")).alias("asks")), "keyword-sets")
    words = asked.select("keyword", F.size("ts").alias("need"), F.explode("ts").alias("term")).distinct()
    held = index.select(F.col("id").alias("neighbour"), "term").where("neighbour IS NOT NULL").join(words.select("term").distinct(), "term", "left_semi").distinct()
    met = words.join(held, "term").groupBy("keyword", "need", "neighbour").agg(F.count("*").alias("have")).where("have = need")
    each = classes.select("asks").distinct().select("asks", F.explode("asks").alias("keyword"))
    scored = each.join(met, "keyword").groupBy("asks", "neighbour").agg(F.count("*").alias("score"))
    w = Window.partitionBy("asks").orderBy(F.desc("score"), "neighbour")
    best = scored.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
    # Without the row itself k of the k + 1 are left at least.
    listed = best.groupBy("asks").agg(F.sort_array(F.collect_list(F.struct("n", "neighbour", "score"))).alias("best"))
    others = F.slice(F.filter("best", lambda b: b["neighbour"] != F.col("id")), 1, k)
    found = classes.join(listed, "asks").select("id", F.posexplode(others).alias("at", "b"))
    return found.select("id", "b.neighbour", "b.score", (F.col("at") + 1).alias("rank"))
