"""Sources: files to be discovered, parsed into units, and read as JSON lines."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docweave.sources.listing import contents, listed
from docweave.sources.parsers import HtmlRules, ParseError, parse_bytes
from docweave.storage import scratch

UNITS = "array<struct<ord:int,kind:string,text:string,heading_path:array<string>>>"
PARSED = f"path string, mime string, title string, meta map<string,string>, units {UNITS}, error string"


def _parsed(rules: HtmlRules):
    unit = pa.struct([("ord", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("heading_path", pa.list_(pa.string()))])
    kinds = [pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(unit), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data, beside in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                row = {"path": path, "mime": None, "title": None, "meta": None, "units": None, "error": None}
                try:
                    p = parse_bytes(path, data or b"", {k: v.decode("utf-8", "replace") for k, v in beside or ()}, rules)
                    row |= {"mime": p.mime, "title": p.title, "meta": [(str(k), str(v)) for k, v in p.meta.items()],
                            "units": [{"ord": i, "kind": u.kind, "text": u.text, "heading_path": u.heading_path} for i, u in enumerate(p.units)]}
                except (ParseError, ValueError, RecursionError, yaml.YAMLError) as e:
                    row["error"] = str(e)[:500]
                yield pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in zip(row, kinds, strict=True)], list(row))

    return run


def _siblings(contents: DataFrame) -> DataFrame:
    """(path, beside): the files that a JSON or YAML file's references name, by the names it uses."""
    specs = contents.where(F.lower("path").rlike(r"\.(?:json|ya?ml)$"))
    refs = F.regexp_extract_all(F.col("content").cast("string"), F.lit(r"\$ref['\"]?\s*:\s*['\"]?([^'\"#\s,}]+)"), F.lit(1))
    named = specs.select("path", F.explode(F.array_distinct(refs)).alias("name"))
    named = named.withColumn("name", F.regexp_replace("name", r"^\./", "")).withColumn("target", F.concat(F.regexp_extract("path", r"^(.*/|)[^/]*$", 1), "name"))
    held = named.join(specs.select(F.col("path").alias("target"), "content"), "target")
    return held.groupBy("path").agg(F.map_from_entries(F.collect_set(F.struct("name", "content"))).alias("beside"))


def parse_contents(contents: DataFrame, rules: HtmlRules = HtmlRules()) -> DataFrame:
    """contents (path, content binary) parsed; a file that can't be read has an error instead of units."""
    rows = contents.select("path", "content").join(_siblings(contents), "path", "left").select("path", "content", "beside")
    return rows.mapInArrow(_parsed(rules), PARSED)


def read_files(spark: SparkSession, paths: list[str], rules: HtmlRules = HtmlRules()) -> DataFrame:
    """Listed files with origin (input, top), parsed. Listing and reading are the tasks' work, not the driver's."""
    found = scratch(listed(spark, paths), "files")
    return parse_contents(contents(found), rules).join(found, "path")


def units(parsed: DataFrame) -> DataFrame:
    """One row for each unit, with its offsets in the text that joins units by an empty line."""
    each = parsed.where("error IS NULL").select("path", F.explode("units").alias("u")).select("path", "u.*")
    from pyspark.sql import Window

    before = Window.partitionBy("path").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("text") + 2).over(before), F.lit(0))
    return each.withColumn("char_start", start).withColumn("char_end", F.col("char_start") + F.char_length("text"))


def read_records(spark: SparkSession, path: str, schema: StructType, key: str = "id") -> DataFrame:
    """JSON lines that fit the schema, one for each key, the last in the order of file name and line; a bad line is a row of nulls and goes."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    full = StructType([*schema.fields]).add("_bad", "string")
    rows = lines.select("file", "block", "line", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = rows.where(F.col("r._bad").isNull() & F.col(f"r.{key}").isNotNull())
    # Inside one block of a file the generated ids follow its lines.
    last = good.groupBy(F.col(f"r.{key}").alias("k")).agg(F.max_by("r", F.struct("file", "block", "line")).alias("r"))
    return last.select("r.*").drop("_bad")
