"""Writes training examples, serving files and whole snapshots."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.storage import written


def export_examples(examples: DataFrame, path: str, form: str = "json") -> None:
    """One folder for each (template, split) as JSON lines or Parquet; cross_split stays out, no split is `unassigned`."""
    kept = examples.withColumn("split", F.coalesce("split", F.lit("unassigned"))).where("split <> 'cross_split'")
    kept.repartition("template", "split").sortWithinPartitions("template", "split", "example_id").write.partitionBy("template", "split").mode("overwrite").format(form).save(path)


def rounded(vector: Column, places: int = 6) -> Column:
    return F.transform(vector, lambda x: F.round(x.cast("double"), places))


def export_vectors(rows: DataFrame, path: str, id_col: str, vec_col: str, per_file: int = 1000) -> None:
    """JSON lines of rounded vectors, some rows a file."""
    rows.select(F.col(id_col).cast("string").alias("id"), rounded(F.col(vec_col)).alias("values")).write.option("maxRecordsPerFile", per_file).mode("overwrite").json(path)


def fingerprint(df: DataFrame, id_col: str, digits: int = 3) -> DataFrame:
    """(n, digest): a digest of all ids in order, from digests of hash-dealt pieces, so that no task gathers every id."""
    piece = F.substring(F.md5(F.col(id_col).cast("string")), 1, digits)
    part = df.groupBy(piece.alias("piece")).agg(F.count("*").alias("n"), F.md5(F.array_join(F.sort_array(F.collect_list(F.col(id_col).cast("string"))), ",")).alias("d"))
    whole = F.transform(F.sort_array(F.collect_list(F.struct("piece", "d"))), lambda x: x["d"])
    return part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.md5(F.array_join(whole, ",")).alias("digest"))


def state_digest(df: DataFrame, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """(n, digest) of a table's contents whatever its row order; columns that change from run to run are left out."""
    columns = sorted(c for c in df.columns if c not in leave_out)
    rows = df.select(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias("h"))
    return fingerprint(rows, "h")


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> None:
    """Writes `<name>_next` beside each table, then swaps them in and keeps the old as `<name>_prev`.

    A `<name>_next` that is there already, from a run that died, is taken only
    if its contents are those of the table now to be written; else it is written anew.
    """
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, df in tables.items():
        there = f"{root}/{name}_next"
        if fs.exists(path(f"{there}/_SUCCESS")):
            old = spark.read.parquet(there)
            if sorted(old.columns) == sorted(df.columns) and state_digest(old).first() == state_digest(df).first():
                continue
        df.write.mode("overwrite").parquet(there)
    for name in tables:
        if fs.exists(path(f"{root}/{name}")):
            fs.delete(path(f"{root}/{name}_prev"), True)
            fs.rename(path(f"{root}/{name}"), path(f"{root}/{name}_prev"))
        fs.rename(path(f"{root}/{name}_next"), path(f"{root}/{name}"))


def with_referencing(changed: set[str], references: Iterable[tuple[str, str]]) -> set[str]:
    """Some tables with all that refer to them, directly or not; references: (child, parent) names, a schema's and so few."""
    children: dict[str, set[str]] = {}
    for child, parent in references:
        children.setdefault(parent, set()).add(child)
    out, todo = set(changed), list(changed)
    while todo:
        new = children.get(todo.pop(), set()) - out
        out |= new
        todo += new
    return out


def publish_changed(spark: SparkSession, tables: dict[str, DataFrame], root: str, references: Iterable[tuple[str, str]] = (), accepted: Iterable[str] = ("edges",)) -> list[str]:
    """Publishes the tables whose contents differ from what is served, and the tables that refer to these; gives their names.

    Of the tables named in accepted only accepted rows are served. All are
    written beside the served ones before any is swapped in, so readers never see
    a parent of one state with a child of another for longer than the renames take; a run that died goes on where it was.
    """
    only = {n: df.where("status = 'accepted'") if n in set(accepted) else df for n, df in tables.items()}
    changed = set()
    for name, df in only.items():
        if not written(spark, f"{root}/{name}"):
            changed.add(name)
            continue
        served = spark.read.parquet(f"{root}/{name}")
        if sorted(served.columns) != sorted(df.columns) or state_digest(served).first() != state_digest(df).first():
            changed.add(name)
    names = [n for n in only if n in with_referencing(changed, references)]
    publish(spark, {n: only[n] for n in names}, root)
    return names


def export_dataset(examples: DataFrame, path: str) -> None:
    """Examples as a dataset folder: data/<template>/<split>/*.parquet, payloads as JSON strings, and the fields and splits in dataset_info.json."""
    kept = examples.withColumn("split", F.coalesce("split", F.lit("unassigned"))).where("split <> 'cross_split'")
    kept.repartition("template", "split").sortWithinPartitions("template", "split", "example_id").write.partitionBy("template", "split").mode("overwrite").parquet(f"{path}/data")
    spark = examples.sparkSession
    sizes = kept.groupBy("template", "split").agg(F.count("*").alias("num_examples"))
    fields = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in examples.schema], "name string, dtype string")
    info = sizes.agg(F.sort_array(F.collect_list(F.struct("template", "split", "num_examples"))).alias("splits"))  # one row a template and split
    info.join(fields.agg(F.collect_list(F.struct("name", "dtype")).alias("features"))).coalesce(1).write.mode("overwrite").json(f"{path}/dataset_info.json")


def _pieces(cap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of a task in pieces of at most cap bytes, line ends included; a longer line is a piece of its own."""
        from pyspark import TaskContext

        task, number, used = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            piece = []
            for size in pc.binary_length(batch.column("value").cast(pa.binary())).to_pylist():
                if used and used + size + 1 > cap:
                    number, used = number + 1, 0
                used += size + 1
                piece.append(f"{task:06d}-{number:06d}")
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(piece, pa.string())], ["value", "piece"])

    return run


def export_statements(rows: DataFrame, path: str, table_name: str, per_file: int = 1000, max_bytes: int | None = None) -> None:
    """INSERT statements, some rows a file (or with max_bytes, files of at most so many bytes in folders by piece), with strings quoted and nulls named; numbers and booleans stay bare."""
    def literal(c: str, kind: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        plain = kind in ("int", "bigint", "smallint", "tinyint", "double", "float", "boolean") or kind.startswith("decimal")
        return F.coalesce(text if plain else F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))

    values = F.concat_ws(", ", *[literal(c, k) for c, k in rows.dtypes])
    said = rows.select(F.concat(F.lit(f"INSERT INTO {table_name} ({', '.join(rows.columns)}) VALUES ("), values, F.lit(");")).alias("value"))
    if max_bytes is None:
        said.write.option("maxRecordsPerFile", per_file).mode("overwrite").text(path)
    else:
        # Pieces of a task come one after the other, so one file is open at a time.
        said.mapInArrow(_pieces(max_bytes), "value string, piece string").write.partitionBy("piece").mode("overwrite").text(path)
