"""Versions of files as a stateful stream: what changed since the last look, committed by batch number."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docweave.storage import ship, written

VERSIONS = "source_uri string, version int, content_hash string, modified timestamp, content binary"


def _changes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The versions of one file that differ from the one before, oldest first; state holds the last digest, its time and its number."""
    rows = pd.concat(list(batches)).sort_values(["modified", "content_hash"])
    held, at, number = state.get if state.exists else (None, None, 0)
    out = []
    for r in rows.itertuples(index=False):
        if r.content_hash == held or (at is not None and r.modified < at):
            continue  # the same bytes, or an older state that comes late
        held, at, number = r.content_hash, r.modified, number + 1
        out.append((key[0], number, r.content_hash, r.modified, r.content))
    if out:
        state.update((held, at, number))
    yield pd.DataFrame(out, columns=["source_uri", "version", "content_hash", "modified", "content"])


def changes(files: DataFrame) -> DataFrame:
    """New versions of files, from a stream of (source_uri, modified, content): a row for each change, numbered by file.

    State is one small row for each file, kept by Spark's state store by key, so
    it outlives a restart; a file that comes again with the same bytes is no change.
    """
    rows = files.withColumn("content_hash", F.sha2("content", 256))
    return rows.groupBy("source_uri").applyInPandasWithState(_changes, VERSIONS, "held string, at timestamp, number int", "append", GroupStateTimeout.NoTimeout)


def commit(versions: DataFrame, batch: int, path: str) -> None:
    """Writes a batch's versions as its own folder; a batch that runs again after a failure replaces what it wrote."""
    versions.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def live(spark: SparkSession, path: str) -> DataFrame:
    """The last version of every file, over all committed batches."""
    rows = spark.read.schema(VERSIONS + ", batch int").parquet(path)
    last = Window.partitionBy("source_uri").orderBy(F.desc("version"))
    return rows.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n")


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """(source_uri, version) of the versions that a later one took the place of: what falls with them is relational.supersede's."""
    rows = spark.read.schema(VERSIONS + ", batch int").parquet(path).select("source_uri", "version")
    return rows.join(live(spark, path).select("source_uri", F.col("version").alias("now")), "source_uri").where("version < now").select("source_uri", "version")


class FolderSource(DataSource):
    """Files under a folder as a stream that sees a file again when it was replaced (Spark's file source looks at names only).

    An offset is a modification time; a batch has the files modified after the
    last offset and up to the next. The folder is listed for each batch; files
    are read by tasks, `files` of them a partition.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_versions"

    def schema(self) -> str:
        return "source_uri string, modified timestamp, content binary"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _FolderReader(self.options["path"], int(self.options.get("files", "64")))


@dataclass
class _Files(InputPartition):
    paths: list[tuple[str, int]]


class _FolderReader(DataSourceStreamReader):
    def __init__(self, folder: str, files: int):
        self.folder, self.files = folder, files

    def _listed(self) -> list[tuple[str, int]]:
        system, at = (fs.FileSystem.from_uri(self.folder)) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        found = system.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True))
        return sorted((f.path, f.mtime_ns) for f in found if f.type == fs.FileType.File and not f.base_name.startswith("."))

    def initialOffset(self) -> dict:
        return {"at": -1}

    def latestOffset(self, *_) -> dict:
        return {"at": max((at for _, at in self._listed()), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        some = [(p, at) for p, at in self._listed() if start["at"] < at <= end["at"]]
        return [_Files(some[i : i + self.files]) for i in range(0, len(some), self.files)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for path, at in partition.paths:
            system = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder else fs.LocalFileSystem()
            with system.open_input_file(path) as f:
                data = f.read()
            yield path, dt.datetime.fromtimestamp(at / 1e9), data

    def commit(self, end: dict) -> None:
        pass


def follow(spark: SparkSession, folder: str, checkpoint: str, path: str, once: bool = True) -> StreamingQuery:
    """Starts a query that follows the files under folder and commits their versions under path."""
    ship(spark)
    spark.dataSource.register(FolderSource)
    files = spark.readStream.format("folder_versions").option("path", folder).load()
    out = changes(files).writeStream.outputMode("append").foreachBatch(lambda df, n: commit(df, n, path)).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def began(spark: SparkSession, path: str, batch: int) -> bool:
    """Whether a batch was committed."""
    return written(spark, f"{path}/batch={batch}")
