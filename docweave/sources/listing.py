"""Files of folders and patterns, listed by tasks: each round lists the folders that the last one found."""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.storage import scratch, ship

FOUND = "path string, input int, top string, inner string, segments array<string>, folder boolean"
KINDS = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_()]


def _place(path: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path on it, what goes before a path to name it again)."""
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:"), ""
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: len(path) - len(inner)] if path.endswith(inner) else path.split("://")[0] + "://"


def _after(name: str, segments: list[str]) -> list[list[str]]:
    """What of a pattern is left after a name: of `**` both that it ends here and that it goes on."""
    first, rest = segments[0], segments[1:]
    if first == "**":
        return [segments, *(_after(name, rest) if rest else [[]])]
    return [rest] if fnmatch.fnmatchcase(name, first) else []


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of folders. Of a pattern (segments left) only what matches; of a walked folder (no segments) all but files named with a dot first."""
    for batch in batches:
        for row in batch.to_pylist():
            system, at, before = _place(row["path"])
            out: list[tuple] = []
            for e in system.get_file_info(fs.FileSelector(at, allow_not_found=True)):
                folder, path = e.type == fs.FileType.Directory, before + e.path
                if row["segments"]:
                    for left in _after(e.base_name, row["segments"]):
                        if left and not folder:
                            continue
                        out.append((path, row["input"], "", "", left, folder))
                elif folder or not e.base_name.startswith("."):
                    inner = f"{row['inner']}/{e.base_name}" if row["inner"] else e.base_name
                    out.append((path, row["input"], inner.split("/")[0] if "/" in inner else "", inner, [], folder))
            for i in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 10_000], strict=True), KINDS, strict=True)], ["path", "input", "top", "inner", "segments", "folder"])


def _start(path: str, number: int) -> tuple:
    """An input as the folder where its pattern begins and the segments left, or as itself."""
    parts = path.split("/")
    first = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[")), None)
    if first is None:
        return path.rstrip("/") or "/", number, "", "", [], None
    return "/".join(parts[:first]) or ("/" if path.startswith("/") else "."), number, "", "", parts[first:], True


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, input, top): every file of the inputs, the first input that reaches it, and its top folder inside that.

    An input is a file, a folder (walked whole) or a pattern (`*`, `?`, `[...]` in a
    name, `**` for any folders between), on this machine or by a URI that Arrow can
    open; executors must see it. In a walked folder files whose own name begins
    with a dot are left out; hidden folders and names that begin with `_` are not.
    What isn't there gives nothing. Links are followed on local disks.
    """
    ship(spark)
    begin = []
    for n, raw in enumerate(paths):
        row = list(_start(raw, n))
        if row[5] is None:
            system, at, _ = _place(row[0])
            kind = system.get_file_info(at).type
            if kind == fs.FileType.NotFound:
                continue
            row[5] = kind == fs.FileType.Directory
        begin.append(tuple(row))
    level = spark.createDataFrame(begin, FOUND)
    files, turn = [level.where("NOT folder")], 0
    level = level.where("folder")
    while not level.isEmpty():
        # Folders go to as many tasks as there are cores for; a folder is one listing.
        spread = level.repartition(spark.sparkContext.defaultParallelism, "path")
        found = scratch(spread.mapInArrow(_listed, FOUND), f"listing-{turn}")
        files.append(found.where("NOT folder"))
        level, turn = found.where("folder"), turn + 1
    every = files[0]
    for more in files[1:]:
        every = every.unionByName(more)
    real = F.pandas_udf(lambda ps: ps.map(lambda p: p if "://" in p else os.path.realpath(p.removeprefix("file:"))), "string")
    best = every.select(real("path").alias("path"), F.struct("input", F.char_length("top").alias("n"), "top").alias("o")).groupBy("path").agg(F.min("o").alias("o"))
    return best.select("path", "o.input", "o.top")


def contents(files: DataFrame) -> DataFrame:
    """(path, content) of listed files, read by tasks, a file at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, at, _ = _place(path)
                with system.open_input_file(at) as f:
                    data = f.read()
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([data], pa.binary())], ["path", "content"])

    return files.select("path").mapInArrow(run, "path string, content binary")
