"""Table access, lineage cuts and scratch tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a context, so that they need no copy of it on their path."""
    context = spark.sparkContext
    if getattr(context, "_docweave_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="docweave-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(f"{folder}/docweave.zip", "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(f"{folder}/docweave.zip")
    context._docweave_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; any path that Spark's readers open will do."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor sees.

    Where it is unset and everything runs on this machine (tests), a temporary
    folder takes its place and is remembered for the session; on a cluster,
    whose executors would not see that folder, it is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="docweave-")
        atexit.register(shutil.rmtree, where, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint."""
    spark = df.sparkSession
    ship(spark)
    where = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Has a folder deleted when the driver ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def scratch(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """df written as Parquet in the shared folder and read back.

    Columnar and compressed, so smaller than a checkpoint of the same rows; a
    lost executor costs only the tasks that it was running. The table goes when
    the driver's process ends.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark).rstrip('/')}/docweave-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    delete_on_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a scratch table that nothing reads any more, before the driver ends."""
    delete(df.sparkSession, df._scratch)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def modified(spark: SparkSession, path: str) -> int:
    """When a folder was last written, in milliseconds."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).getModificationTime()


def written(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a table that was written to its end."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
