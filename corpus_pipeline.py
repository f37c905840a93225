"""The corpus pipeline: quality rules, near-dedup, suffix-array dedup, decontamination, packing.

Every stage works on all that the one before it kept, and takes an empty table
to an empty one. Columns beyond those of documents pass through all stages but
the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import decontaminate, packing, quality, simhash, suffix_dedup
from docweave.storage import scratch, table

#: Passages of more than 50 words. The 400-byte rule beside it holds for text without white space between its words.
PASSAGES = suffix_dedup.Repeats(window=51, gram=16, keep="first", words=True)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null or empty text goes, a null language is no fault, repeated rows are judged each alone."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near duplicates. Null and empty texts are one group; of repeated rows one stays; a null id is the least."""
    return simhash.keep_one(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of more than 50 words, and the 400-byte strings, that start earlier in the corpus too; n_chars follows the text.

    Earlier is by id, nulls first, then offset. A null or empty text stays as it
    is; a text of which nothing is left goes; of repeated rows each stays as the first does.
    """
    return suffix_dedup.remove_repeats(docs, by_words=PASSAGES).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows are judged alike; without items all stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence and place of every piece of every document. A null or empty text is a piece of its end id; repeated rows are packed each on their own."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeats_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]
#: SQL can't express the fingerprints' XXH64 or the tokenizer; stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
