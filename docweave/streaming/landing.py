"""New files as a stream: each micro-batch is parsed and handed on, files already seen by content are not parsed again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docweave.sources.files import parse_contents


def watch(spark: SparkSession, folder: str, checkpoint: str, update: Callable[[DataFrame, int], None], delay: str = "1 day", once: bool = True) -> StreamingQuery:
    """Starts a query that parses files as they land in folder and calls update(parsed, batch number).

    Copies of a file's bytes that arrive within the delay are dropped by the
    stream's own state, which the watermark bounds.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").load(folder)
    fresh = files.withColumn("sum", F.sha2("content", 256)).withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["sum"])
    out = fresh.writeStream.foreachBatch(lambda df, n: update(parse_contents(df), n)).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
