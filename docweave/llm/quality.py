"""Distribution divergence: quality rules in DataFrame functions only.

A document's character-class and common-word histograms are held against the
histograms of each reference language (all documents that carry that language
tag, summed), by Jensen-Shannon distance. A document is kept if some language
lies near enough in both, or is the nearest in one and the text too short for
the other to mean anything.

Every language tag of which there are `reference_words` words or more makes a
reference. Its common words are a fixed list where there is one, else the most
frequent words of its own documents. A document with a tag of which there is too
little text for a reference is judged by the base rule alone, and so is every
document if there is no reference at all; one without a tag must be near some
reference.

Nulls and odd rows: a null or empty text has no words and fails the base rule;
a null language only keeps the row out of the references; repeated rows are
judged each alone; of words equally frequent the first by letters is common;
very long texts are counted whole; columns of the user may have any name; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.naming import fresh
from docweave.storage import scratch, table

# Common words of the reference languages.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "en": "the of and to in a is that it was for on are with as be at this have from or by not but what all were an they which".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce avec il sont aux mais ou".split(),
    "it": "di e il la che in un a per è una sono con non si da come anche le dei nel alla più i al della ha ma gli lo".split(),
    "nl": "de van het een en in is dat op te zijn met voor niet aan er om ook als bij maar door over uit naar heeft ze deze werd tot".split(),
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou".split(),
}
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Left out before the classes are counted: three quarters of common text.
SMALL = "[a-z]+"
#: Classes counted by pattern in what SMALL leaves; white space, beyond ASCII and the rest (small letters, in the main) follow.
CLASSES = [r"[A-Z]", r"[0-9]", r"[.,;:!?'\"()\-]", r"[#*$%&|<>@=+_/\\~^{}\[\]]"]
#: What score adds to a row.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept"]
LETTER = r"a-z\x{80}-\x{10FFFF}"


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict; distances are base-2 Jensen-Shannon distances, 0 to 1.

    A histogram over n words strays from its source by about 1/sqrt(n), so each
    limit is a floor plus an allowance over the square root of the word count.
    """

    min_words: int = 50
    class_floor: float = 0.14
    class_allowance: float = 1.0
    word_floor: float = 0.30
    word_allowance: float = 0.75
    #: The word histogram of a shorter text is too coarse to reject by.
    min_words_for_histogram: int = 120
    #: Words of a language that make a reference, and its most frequent words where no list is fixed.
    reference_words: int = 2000
    learned_words: int = 34


def _vocabulary(learned: Iterable[str] = ()) -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words} | set(learned))


def learned_words(inner: DataFrame, limits: Limits) -> list[str]:
    """The most frequent words of each language tag that has no fixed list.

    Words are counted by partial aggregates; a few for each language come to the driver.
    """
    unlisted = inner.where(F.col("_lang").isNotNull() & ~F.col("_lang").isin(sorted(COMMON_WORDS)))
    if not unlisted.head(1):
        return []
    words = unlisted.select("_lang", F.explode(F.split(F.lower("_text"), f"[^{LETTER}]+")).alias("word")).where("word <> ''")
    counts = words.groupBy("_lang", "word").agg(F.count("*").alias("n"))
    enough = counts.groupBy("_lang").agg(F.sum("n").alias("all")).where(F.col("all") >= limits.reference_words).select("_lang")
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("n"), "word"))
    # A word that is not among a thousandth of its language's words is none of the most frequent; so the ranking is over few rows.
    often = counts.join(counts.groupBy("_lang").agg((F.sum("n") / 1000).alias("least")), "_lang").where("n >= least").join(enough, "_lang")
    return sorted({r["word"] for r in often.withColumn("rank", rank).where(F.col("rank") <= limits.learned_words).select("word").collect()})


def _alternatives(words: list[str]) -> str:
    """A pattern of words as a tree of first letters, which fails after a letter or two."""
    if words == [""]:
        return ""
    heads = sorted({w[0] for w in words if w})
    parts = [h + _alternatives(sorted({w[1:] for w in words if w[:1] == h})) for h in heads]
    return f"(?:{'|'.join(parts)})" + ("?+" if "" in words else "")


def features(docs: DataFrame, keep: list[str], learned: Iterable[str] = ()) -> DataFrame:
    """The columns in keep, and everything the rules count, from one pass over text."""
    vocabulary = _vocabulary(learned)
    common = f"(?<![{LETTER}]){_alternatives(vocabulary)}(?![{LETTER}])"
    out = docs.select(*keep, F.col("_lang"), F.coalesce(F.col("_text"), F.lit("")).alias("_t"))
    out = out.select(
        *keep, "_lang", "_t",
        F.regexp_extract_all("_t", F.lit(f"({WORD})"), F.lit(1)).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_lines"),
        F.sort_array(F.regexp_extract_all(F.lower("_t"), F.lit(common), F.lit(0))).alias("_k"),
        F.regexp_replace("_t", SMALL, "").alias("_rare"),
        F.char_length("_t").cast("long").alias("_n"),
        (F.octet_length("_t") - F.char_length("_t")).cast("long").alias("_wide"),
    ).drop("_t")
    out = out.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count("_rare", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_counts": F.array(*[F.regexp_count("_rare", F.lit(p)).cast("long") for p in CLASSES]),
        # Windows of three words as 64-bit hashes.
        "_h": F.when(F.size("_w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))),
    }).drop("_w", "_lines", "_rare")
    # Only where a window comes twice are they sorted with their places: equal ones are neighbours then.
    out = out.withColumn("_tri", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )).drop("_h")
    out = out.withColumns({
        "_at": F.sort_array(F.transform(
            F.filter("_tri", lambda x, j: (x["h"] == F.get("_tri", j - 1)["h"]) | (x["h"] == F.get("_tri", j + 1)["h"])),
            lambda x: x["i"],
        )),
        "_starts": F.filter(
            F.when(F.size("_k") > 0, F.sequence(F.lit(0), F.size("_k") - 1)),
            lambda i: (i == 0) | (F.get("_k", i) != F.get("_k", i - 1)),
        ),
    })
    space = F.col("_n") - F.col("word_chars")
    small = F.col("_n") - space - F.col("_wide") - F.aggregate("_counts", F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select(
        *keep, "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        # Every place starts three covered words, fewer if the next place comes sooner.
        F.coalesce(F.aggregate(
            F.transform("_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, x: a + x,
        ), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.concat("_counts", F.array(space, F.col("_wide"), F.greatest(small, F.lit(0)))).alias("_classes"),
        F.coalesce(F.transform("_starts", lambda s, j: F.struct(
            F.find_in_set(F.get("_k", s), F.lit(",".join(vocabulary))).alias("k"),
            (F.coalesce(F.get("_starts", j + 1), F.size("_k")) - s).cast("long").alias("c"),
        )), F.array().cast("array<struct<k:int,c:bigint>>")).alias("_common"),
    )


def references(feats: DataFrame, learned: Iterable[str] = (), limits: Limits = Limits()) -> dict[str, tuple[list[float], list[float]]]:
    """Language -> (class shares, common-word shares with all other words last).

    Sums over all rows; what comes to the driver is bounded by the languages
    times the histogram width.
    """
    tagged = feats.where(F.col("_lang").isNotNull() & (F.col("n_words") > 0))
    width = len(CLASSES) + 3
    sums = tagged.groupBy("_lang").agg(
        F.sum("n_words").alias("words"), *[F.sum(F.col("_classes")[i]).alias(f"c{i}") for i in range(width)]
    ).collect()
    runs = tagged.select("_lang", F.explode("_common").alias("r")).groupBy("_lang", F.col("r.k").alias("k")).agg(F.sum("r.c").alias("c")).collect()
    size = len(_vocabulary(learned))
    found = {}
    for row in sorted(sums, key=lambda r: r["_lang"]):
        if row["words"] < limits.reference_words:
            continue
        classes = [float(row[f"c{i}"]) for i in range(width)]
        words = [0.0] * (size + 1)
        for r in runs:
            if r["_lang"] == row["_lang"]:
                words[r["k"] - 1] = r["c"] / row["words"]
        words[size] = max(0.0, 1.0 - sum(words))
        found[row["_lang"]] = ([c / sum(classes) for c in classes], words)
    return found


def _entropy_terms(p: Column, q: Column) -> Column:
    """The share of one bin in twice the divergence, in bits."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    return part(p) + part(q)


def _class_distance(ref: list[float]) -> Column:
    total = F.greatest(F.aggregate("_classes", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    terms = [_entropy_terms(F.col("_classes")[i] / total, F.lit(q)) for i, q in enumerate(ref)]
    return F.sqrt(F.greatest(sum(terms, F.lit(0.0)) / 2, F.lit(0.0)))


def _word_distance(ref: list[float]) -> Column:
    """Bins that the document lacks add their reference share, so only its own runs are visited."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    shares = F.array(*[F.lit(q) for q in ref])

    def bin_(p: Column, q: Column) -> Column:
        return _entropy_terms(p, q) - q

    seen = F.aggregate("_common", F.lit(0.0), lambda a, r: a + bin_(r["c"] / n, F.get(shares, r["k"] - 1)))
    others = 1 - F.aggregate("_common", F.lit(0).cast("long"), lambda a, r: a + r["c"]) / n
    return F.sqrt(F.greatest((seen + bin_(others, F.lit(ref[-1])) + 1) / 2, F.lit(0.0)))


def score(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits(), whole: bool = False) -> DataFrame:
    """docs with the counts, distances and verdict of every row; without its text and language unless `whole`."""
    keep = [c for c in docs.columns if whole or c not in (text_col, lang_col)]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)],
                        F.col(f"`{text_col}`").cast("string").alias("_text"), F.col(f"`{lang_col}`").alias("_lang"))
    learned = learned_words(inner, limits)
    # Snappy, since a zstd writer takes native memory beside the heap, and this stage fills the heap.
    feats = scratch(features(inner, [f"_keep{i}" for i in range(len(keep))], learned), "quality", "snappy")
    refs = references(feats, learned, limits)
    out = feats.withColumn("base_failed", (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    if refs:
        pairs = F.array(*[F.struct(_class_distance(c).alias("c"), _word_distance(w).alias("w"), F.lit(lang).alias("lang")) for lang, (c, w) in refs.items()])
        out = out.withColumn("_d", pairs)
        root = F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
        near = F.exists("_d", lambda d: (d["c"] <= limits.class_floor + limits.class_allowance / root) & (
            (F.col("n_words") < limits.min_words_for_histogram) | (d["w"] <= limits.word_floor + limits.word_allowance / root)))
        out = out.withColumns({
            "class_distance": F.round(F.array_min(F.transform("_d", lambda d: d["c"])), 6),
            "word_distance": F.round(F.array_min(F.transform("_d", lambda d: d["w"])), 6),
            "kept": ~F.col("base_failed") & (near | (F.col("_lang").isNotNull() & ~F.col("_lang").isin(sorted(refs)))),
        })
    else:
        out = out.withColumns({"class_distance": F.lit(None).cast("double"), "word_distance": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    return out.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], *[F.col(c) for c in COUNTS])


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The rows of docs that are kept, in their own columns; the verdict goes with the row, so nothing is joined."""
    names = fresh(COUNTS, *[f"column_{i}" for i in range(len(docs.columns))])
    inner = docs.toDF(*names)
    at = lambda c: names[docs.columns.index(c)]
    return score(inner, at(text_col), at(lang_col), limits, whole=True).where("kept").select(*names).toDF(*docs.columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return score(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"
    )
