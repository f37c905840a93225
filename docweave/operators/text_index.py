"""A stored inverted index: postings in blocks with their greatest impact and positions, and top-k search that skips blocks.

Rows are put in an order in which neighbours are alike (commonest term, then
length) and cut into segments of `segment` rows. A block holds what one term
has in one segment: row ids, counts, lengths and positions, and the greatest
impact of any of them, which is BM25's factor without the idf. Blocks lie in
folders by hash of the term, sorted by term and segment.

A search reads the blocks' heads (term, segment, count, impact) first. A
segment's bound is the sum of idf times impact over the terms asked: no row in
it can score more. Segments are scored in rounds by falling bound, each round
four times the last; the k-th score so far is a threshold, and segments whose
bound doesn't reach it are never read. That gives the same rows as scoring
everything (block-max pruning). Segments of a round go to the scan as ranges.

Nulls and odd rows: a null text has no terms and counts as a row of length 0;
null ids are kept; repeated ids are rows of their own; ties go by id; a term's
block is bounded by its segment, whatever the term's frequency; an empty table
gives an empty index, and a search without words an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.operators.search import WebQuery, terms
from docweave.storage import discard, scratch, ship, written

#: Ranges of segments in one pushed filter; more are left to a join.
RANGES = 200
#: Segments scored in one round, beyond which all that can still matter are.
TURN = 1 << 16
#: Rows whose postings a task holds at once.
ROWS = 2048
#: Words whose postings a task holds at once, where a segment doesn't have more, and words of all rows of a task.
PLACES, TASK = 1 << 18, 1_000_000


@dataclass(frozen=True)
class Layout:
    """segment: rows of a segment; buckets: folders of terms; k1 and b: BM25's; first: segments of the first round at least."""

    segment: int = 32
    buckets: int = 8
    k1: float = 1.2
    b: float = 0.75
    first: int = 2


@dataclass
class Report:
    """What a search read of what its terms have: blocks and postings."""

    blocks: int = 0
    blocks_read: int = 0
    postings: int = 0
    postings_read: int = 0

    def add(self, segments: DataFrame) -> None:
        r = segments.agg(F.sum("held").alias("held"), F.sum("n").alias("n")).first()
        self.blocks_read += r["held"] or 0
        self.postings_read += r["n"] or 0

    def of(self, segments: DataFrame) -> None:
        r = segments.agg(F.sum("held").alias("held"), F.sum("n").alias("n")).first()
        self.blocks, self.postings = r["held"] or 0, r["n"] or 0


@dataclass
class TextIndex:
    spark: SparkSession
    path: str
    layout: Layout = field(default_factory=Layout)

    # ---- building ----

    @staticmethod
    def build(df: DataFrame, id_col: str, text_col: str, path: str, layout: Layout = Layout()) -> TextIndex:
        """Writes the index of a table under path, which must not exist.

        Rows are shuffled once, to their order, as their distinct words and numbers for
        these; the task that gets them makes and writes the blocks of its segments.
        So there is a file for each task and folder, sorted by term.
        """
        spark = df.sparkSession
        ship(spark)
        rows = df.select(F.col(id_col).alias("id"), F.coalesce(terms(F.col(text_col)), F.array().cast("array<string>")).alias("ts"))
        kind = rows.schema["id"].dataType.simpleString()
        posted = scratch(rows.mapInArrow(_numbered, f"id {kind}, length int, common string, words string, numbers binary"), "index-rows")
        stats = posted.agg(F.count("*").alias("docs"), F.avg("length").alias("mean"), F.max(F.when(F.lit(False), F.col("id"))).alias("id"))
        stats.write.parquet(f"{path}/stats")
        held = spark.read.parquet(f"{path}/stats").first()
        # Ranges are even in rows; by hash inside a term they are in lengths too. Segments follow the lengths inside a range.
        # As many tasks as there are words for, so that what a task sorts doesn't grow with the table.
        parts = max(spark.sparkContext.defaultParallelism, -(-int(held["docs"] * (held["mean"] or 0)) // TASK))
        ordered = posted.repartitionByRange(parts, "common", F.xxhash64("id")).sortWithinPartitions("common", "length", "id")
        row = f"struct<place:long,id:{kind},tf:int,length:int,impact:double>"
        blocks = ordered.mapInArrow(_blocks(layout, held["mean"] or 1.0), f"term string, segment long, n int, impact double, rows array<{row}>, positions array<array<int>>")
        blocks = blocks.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(layout.buckets)).cast("int"))
        dealt = blocks.sortWithinPartitions("bucket", "term", "segment")
        dealt.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/blocks")
        discard(posted)
        return TextIndex(spark, path, layout)

    def exists(self) -> bool:
        return written(self.spark, f"{self.path}/blocks")

    def stats(self):
        return self.spark.read.parquet(f"{self.path}/stats").first()

    # ---- reading ----

    def _table(self) -> DataFrame:
        kind = self.spark.read.parquet(f"{self.path}/stats").schema["id"].dataType.simpleString()
        row = f"struct<place:long,id:{kind},tf:int,length:int,impact:double>"
        return self.spark.read.schema(f"term string, segment long, n int, impact double, rows array<{row}>, positions array<array<int>>, bucket int").parquet(f"{self.path}/blocks")

    def _blocks(self, words: list[str]) -> DataFrame:
        """The blocks of some terms; only their folders are listed."""
        table = self._table()
        bucket = [F.pmod(F.xxhash64(F.lit(w)), F.lit(self.layout.buckets)).cast("int") for w in words]
        return table.where(F.col("bucket").isin(*bucket) & F.col("term").isin(words))

    def postings(self, words: list[str] | None = None) -> DataFrame:
        """(id, term, tf, length) of some terms, or of all."""
        blocks = self._table() if words is None else self._blocks(words)
        return blocks.select("term", F.explode("rows").alias("r")).select("r.id", "term", "r.tf", "r.length")

    def _some(self, blocks: DataFrame, segments: DataFrame) -> DataFrame:
        """Blocks of some segments: as pushed ranges where they are few, else by a join."""
        few = segments.select("segment").distinct().limit(50 * RANGES + 1).collect()  # a bounded number of whole numbers
        if len(few) <= 50 * RANGES:
            ranges: list[list[int]] = []
            for s in sorted(r["segment"] for r in few):
                if ranges and s == ranges[-1][1] + 1:
                    ranges[-1][1] = s
                else:
                    ranges.append([s, s])
            if not ranges:
                return blocks.where(F.lit(False))
            if len(ranges) <= RANGES:
                inside = F.lit(False)
                for a, b in ranges:
                    inside = inside | F.col("segment").between(a, b)
                return blocks.where(inside)
        return blocks.join(segments.select("segment").distinct(), "segment", "left_semi")

    def top(self, words: list[str], k: int, places: int = 9, among: DataFrame | None = None, report: Report | None = None) -> DataFrame:
        """(id, score, rank): the k best rows by BM25, ties by id; among holds the ids (id) that count, all if it isn't given.

        Counts of documents and lengths are those of the whole index, whatever among holds.
        """
        words = sorted(set(words))
        blocks = self._blocks(words) if words else self._table().where(F.lit(False))
        stats = self.stats()
        heads = scratch(blocks.select("term", "segment", "n", "impact"), "index-heads")
        spread = {r["term"]: r["df"] for r in heads.groupBy("term").agg(F.sum("n").alias("df")).collect()}  # a row for each word asked
        if not spread:
            return blocks.where(F.lit(False)).select(F.col("rows")[0]["id"].alias("id"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
        idf = {w: F.log(1 + (F.lit(stats["docs"]) - F.lit(n) + 0.5) / (F.lit(n) + 0.5)) for w, n in spread.items()}
        weight = F.coalesce(*[F.when(F.col("term") == w, x) for w, x in idf.items()])
        bounds = heads.groupBy("segment").agg(F.sum(weight * F.col("impact")).alias("bound"), F.count("*").alias("held"), F.sum("n").alias("n"))

        bounds = scratch(bounds, "index-bounds")

        def scored(segments: DataFrame) -> list[tuple]:
            each = self._some(blocks, segments).select("term", F.explode("rows").alias("r")).select("term", "r.place", "r.id", "r.impact")
            if among is not None:
                each = each.join(among.select("id").distinct(), "id", "left_semi")
            sums = each.groupBy("place", "id").agg(F.round(F.sum(weight * F.col("impact")), places).alias("score"))
            return [tuple(r) for r in sums.orderBy(F.desc("score"), "id", "place").select("id", "place", "score").limit(k).collect()]

        # Rounds over segments of falling bound; k rows at most are on the driver.
        best: list[tuple] = []
        least, below, take = 0.0, float("inf"), max(self.layout.first, -(-2 * k // self.layout.segment))
        while True:
            left = bounds.where((F.col("bound") < below) & (F.col("bound") + 10.0**-places >= F.lit(least)))
            last = left.orderBy(F.desc("bound")).limit(take).agg(F.min("bound").alias("b"), F.count("*").alias("n")).first() if take <= TURN else None
            if last is not None and not last["n"]:
                break
            now = left if last is None else left.where(F.col("bound") >= F.lit(last["b"]))
            if report is not None:
                report.add(now)
            best = sorted(best + scored(now), key=lambda r: (-r[2], r[0] is not None, r[0], r[1]))[:k]
            least = best[-1][2] if len(best) == k else 0.0
            if last is None or last["n"] < take:
                break
            below, take = last["b"], 4 * take
        if report is not None:
            report.of(bounds)
        kind = self._table().schema["rows"].dataType.elementType["id"].dataType.simpleString()
        return self.spark.createDataFrame([(i, score, n) for n, (i, _, score) in enumerate(best, 1)], f"id {kind}, score double, rank int")

    def match(self, query: WebQuery) -> DataFrame:
        """(id) of the rows that satisfy a query; phrases by positions, in segments that hold all words of an alternative."""
        words = sorted({w for group in [*query.any_of, query.none_of] for phrase in group for w in phrase})
        if not query.any_of or not words:
            return self._table().where(F.lit(False)).select(F.col("rows")[0]["id"].alias("id"))
        blocks = self._blocks(words)
        held = blocks.groupBy("segment").agg(F.collect_set("term").alias("held"))
        may = F.lit(False)
        for group in query.any_of:
            every = F.lit(True)
            for w in {w for phrase in group for w in phrase}:
                every = every & F.array_contains("held", w)
            may = may | every
        rows = self._some(blocks, held.where(may)).select("term", F.explode(F.arrays_zip("rows", "positions")).alias("r"))
        each = rows.groupBy("r.rows.place", "r.rows.id").agg(*[F.max(F.when(F.col("term") == w, F.col("r.positions"))).alias(f"w{i}") for i, w in enumerate(words)])
        at = {w: F.col(f"w{i}") for i, w in enumerate(words)}
        none: Column = F.lit(False)
        for phrase in query.none_of:
            none = none | _holds(at, phrase)
        found = F.lit(False)
        for group in query.any_of:
            every = F.lit(True)
            for phrase in group:
                every = every & _holds(at, phrase)
            found = found | every
        return each.where(found & ~none).select("id")


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal keys together and keeps their order, where groups begin in it)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1)) if len(keys) else np.empty(0, np.int64)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row as its distinct terms in order of first use, joined by blanks, and a number among these for each place; and its commonest term (ties: the first used)."""
    for whole in batches:
        for at in range(0, len(whole), ROWS):
            batch = whole.slice(at, ROWS)
            ts = batch.column(1)
            size = np.diff(ts.offsets.to_numpy())
            row = np.repeat(np.arange(len(batch)), size)
            coded = ts.flatten().dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order, begin = _grouped(row * max(1, len(coded.dictionary)) + code)
            count, of, first = np.diff(np.append(begin, len(order))), row[order[begin]], order[begin]
            turn = np.lexsort((first, of))  # a row's terms by first use
            held = np.bincount(of, minlength=len(batch))
            ends = np.concatenate(([0], np.cumsum(held)))
            number = np.empty(len(turn), np.uint32)
            number[turn] = np.arange(len(turn)) - np.repeat(ends[:-1], held)
            of_token = np.empty(len(order), np.uint32)
            of_token[order] = np.repeat(number, count)
            best = np.full(len(batch), -1)
            ranked = np.lexsort((first, -count, of))[::-1]
            best[of[ranked]] = ranked
            names = coded.dictionary.take(pa.array(code[first[turn]]))
            common = coded.dictionary.take(pa.array(np.where(best >= 0, code[first][np.maximum(best, 0)], 0), mask=best < 0)) if len(begin) else pa.nulls(len(batch), pa.string())
            narrow = of_token.astype(np.uint16) if held.max(initial=0) < 1 << 16 else of_token
            raw = pa.array(np.concatenate(([0], np.cumsum(size))) * narrow.itemsize, pa.int32())
            numbers = pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, raw.buffers()[1], pa.py_buffer(narrow)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int32()), common, pc.binary_join(_lists(ends, names), " "), numbers], ["id", "length", "common", "words", "numbers"])


def _pieces(length: np.ndarray, segment: int) -> Iterator[tuple[int, int]]:
    """Runs of whole segments (but for the last) with ROWS rows and PLACES words at most, or of one segment."""
    ends, at = np.cumsum(length, dtype=np.int64), 0
    while at < len(length):
        few = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PLACES, "right")) - at
        to = min(at + max(segment, min(few, ROWS) // segment * segment), len(length))
        yield at, to
        at = to


def _blocks(layout: Layout, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of segments of rows as they come; a segment never spans two batches."""
        from pyspark import TaskContext

        place = segment = TaskContext.get().partitionId() << 33
        for whole in batches:
            for at, to in _pieces(whole.column("length").to_numpy(), layout.segment):
                batch = whole.slice(at, to - at)
                length = batch.column("length").to_numpy()
                split = pc.split_pattern(batch.column("words"), " ")
                coded = split.flatten().dictionary_encode()
                local = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                first_word = split.offsets.to_numpy()[:-1] - split.offsets.to_numpy()[0]
                if length.sum():
                    row = np.repeat(np.arange(len(batch)), length)
                    numbers = np.concatenate([np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32) for raw, n in zip(batch.column("numbers").to_pylist(), length.tolist(), strict=True)])
                    code = local[first_word[row] + numbers]
                    spot = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
                    # Tokens by segment and term, and in these by row and place.
                    order, begin = _grouped((row // layout.segment) * len(coded.dictionary) + code)
                    new = np.zeros(len(order), bool)
                    new[begin] = True
                    new[1:] |= row[order[1:]] != row[order[:-1]]
                    post = np.flatnonzero(new)  # a posting is a row's tokens of one term
                    tf, of = np.diff(np.append(post, len(order))), row[order[post]]
                    impact = tf * (layout.k1 + 1) / (tf + layout.k1 * (1 - layout.b + layout.b * length[of] / mean))
                    ends = np.append(np.searchsorted(post, begin), len(post))
                    rows = pa.StructArray.from_arrays(
                        [pa.array(place + of), batch.column("id").take(pa.array(of)), pa.array(tf, pa.int32()), pa.array(length[of], pa.int32()), pa.array(impact)], ["place", "id", "tf", "length", "impact"])
                    positions = _lists(np.append(post, len(order)), pa.array(spot[order], pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [coded.dictionary.take(pa.array(code[order[begin]])), pa.array(segment + row[order[begin]] // layout.segment), pa.array(np.diff(ends), pa.int32()), pa.array(np.maximum.reduceat(impact, ends[:-1])),
                         _lists(ends, rows), _lists(ends, positions)],
                        ["term", "segment", "n", "impact", "rows", "positions"])
                place += len(batch)
                segment += -(-len(batch) // layout.segment)

    return run


def _holds(at: dict[str, Column], phrase: list[str]) -> Column:
    """Whether the words of a phrase stand one after the other; false where one is missing."""
    if len(phrase) == 1:
        return at[phrase[0]].isNotNull()

    def follow(p: Column) -> Column:
        every = F.lit(True)
        for i, w in enumerate(phrase[1:], 1):
            every = every & F.array_contains(at[w], p + i)
        return every

    return F.coalesce(F.exists(at[phrase[0]], follow), F.lit(False))
