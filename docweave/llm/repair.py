"""Re-Pair grammar compression: token-id shards with rules and random access.

Documents are put in ascending id order by a range partitioning; each task
tokenizes its range and closes a shard every `shard_ids` ids. In a shard, the
most frequent pairs of neighbouring symbols are replaced by new symbols until no
pair comes `least` times, which is twice: nothing else ends it. Pairs never span
documents. Classical Re-Pair (Larsson and Moffat 1999) replaces one pair at a
time; here all pairs that come at least `floor` times go in one round, the more
frequent first where places overlap, and the floor falls eightfold whenever no
pair reaches it. So pairs still go in the order of their frequency, to within a
factor of eight, and there are few rounds.

One shard is one binary value in this layout (little-endian, unsigned 32-bit
unless said): magic b"RPR1"; number of terminals (first symbol that is a rule);
counts of rules, documents and symbols; rules as (left, right); each rule's
expansion length; each document's symbol count; each document's id count; the
symbols. Shards are rows of a Parquet table (part, seq, doc ids, blob), which
Spark's writer commits task by task, so a lost executor leaves no half shard.

A document's symbols are found by summing symbol counts, and a token range
inside it by summing expansion lengths, without decoding what lies before.

Nulls and odd rows: a null text is empty and has the end id only; null ids come
first; repeated ids stay next to each other, ordered by a hash of the text and
then the text, and very many of them are split between tasks; an empty table
gives no shard and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.tokens import encoder
from docweave.storage import scratch, table

MAGIC = b"RPR1"
#: By how much the floor falls from one round to the next.
FALL = 8
#: Bytes of text that are tokenized together: the more, the fewer words are looked up again.
BLOCK = 8 << 20


@dataclass(frozen=True)
class Grammar:
    """shard_ids: ids of a shard; least: times a pair must come to be replaced."""

    shard_ids: int = 1 << 20
    least: int = 2
    vocabulary: str | None = None
    end_id: int = 1


def _countable(symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a pair begins at each place but the last: not at a document's end, and in a run of one symbol at every other place only."""
    free = ~last[:-1]
    twin = (symbols[:-1] == symbols[1:]) & free
    at = np.flatnonzero(twin)
    if len(at):
        step = np.arange(len(at))
        begins = np.concatenate(([True], at[1:] != at[:-1] + 1))
        free[at[(step - np.maximum.accumulate(np.where(begins, step, 0))) % 2 == 1]] = False
    return free


def _frequent(symbols: np.ndarray, free: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places, pair number at each, pairs by number, the greatest count) of pairs that come at least floor times.

    A hashed count leaves out most others unsorted; where it shows that none
    reaches the floor, the greatest hashed count stands for the greatest count.
    """
    none = np.empty(0, np.int64)
    left, right = symbols[:-1], symbols[1:]
    if floor > 4:
        bits = min(20, max(8, int(len(symbols)).bit_length() + 1))
        bucket = left * np.uint32(0x9E3779B1)
        bucket ^= right * np.uint32(0x85EBCA77)
        bucket >>= np.uint32(32 - bits)
        counts = np.bincount(bucket, minlength=1 << bits)  # places that begin no pair are counted too, which leaves out less
        many = counts >= floor
        if not many.any():
            return none, none, none, int(counts.max())
        at = np.flatnonzero(many[bucket] & free)
    else:
        at = np.flatnonzero(free)
    if not len(at):
        return none, none, none, floor
    pairs = left[at].astype(np.uint64) << np.uint64(32) | right[at]
    order = np.argsort(pairs)
    ordered = pairs[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(first, len(ordered)))
    often = np.flatnonzero(counts >= floor)
    rank = often[np.lexsort((ordered[first[often]], -counts[often]))]  # most frequent first, ties by pair
    number = np.full(len(first), -1, np.int64)
    number[rank] = np.arange(len(rank))
    of = np.empty(len(at), np.int64)
    of[order] = np.repeat(number, counts)
    held = of >= 0
    return at[held], of[held], ordered[first[rank]], int(counts.max())


def compress(ids: np.ndarray, sizes: np.ndarray, params: Grammar = Grammar()) -> bytes:
    """One shard from the ids of its documents, joined, and their counts."""
    symbols = ids.astype(np.uint32)
    terminals = int(symbols.max()) + 1 if len(symbols) else 0
    ends = np.cumsum(sizes)
    last = np.zeros(len(symbols), bool)
    last[ends[sizes > 0] - 1] = True
    rules: list[np.ndarray] = []
    total, floor = 0, max(params.least, len(symbols) >> 8)
    open_: np.ndarray | None = None
    while len(symbols) > 1:
        free = _countable(symbols, last)
        if open_ is not None:  # at the last floor only a pair that came twice before, or holds a new symbol, can come twice now
            free &= open_[:-1] | (symbols[:-1] == symbols[1:])
        at, of, pairs, most = _frequent(symbols, free, floor)
        if not len(pairs):
            if floor == params.least:
                break
            floor = max(params.least, min(floor - 1, most) // FALL)
            continue
        # Of overlapping places the more frequent pair wins. One pair's places don't overlap, so the most frequent keeps all of its.
        best = np.full(len(symbols) + 1, len(pairs), np.int64)
        best[at + 1] = of
        take = at[(of < best[at]) & (best[at + 2] >= of)]
        number = best[take + 1]
        # Rules that lost all their places, or all but one, are left out.
        used = np.flatnonzero(np.bincount(number, minlength=len(pairs)) > 1)
        new = np.full(len(pairs), -1, np.int64)
        new[used] = np.arange(len(used))
        kept = new[number] >= 0
        take, number = take[kept], new[number[kept]]
        symbols[take] = (terminals + total + number).astype(np.uint32)
        last[take] |= last[take + 1]
        stay = np.ones(len(symbols), bool)
        stay[take + 1] = False
        if floor == params.least:
            open_ = np.zeros(len(symbols), bool)
            open_[at] = open_[take] = True
            open_[np.maximum(take - 1, 0)] = True
            open_ = open_[stay]
        elif len(take) < len(symbols) >> 5:
            floor = max(params.least, floor // FALL)
        symbols, last = symbols[stay], last[stay]
        rules.append(np.stack([(pairs[used] >> np.uint64(32)).astype(np.uint32), pairs[used].astype(np.uint32)], axis=1))
        total += len(used)
    grammar = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    closed = np.flatnonzero(last) + 1
    per_doc = np.zeros(len(sizes), np.uint32)
    per_doc[sizes > 0] = np.diff(np.concatenate(([0], closed)))
    head = np.array([terminals, total, len(sizes), len(symbols)], "<u4")
    parts = [head, grammar, _expansions(grammar, terminals), per_doc, sizes.astype(np.uint32), symbols]
    return MAGIC + b"".join(p.astype("<u4").tobytes() for p in parts)


def _expansions(grammar: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each rule stands for; a rule only names terminals and rules of earlier rounds."""
    lengths = np.zeros(len(grammar), np.uint32)
    open_ = np.ones(len(grammar), bool)
    while open_.any():
        at = np.flatnonzero(open_)
        sides = grammar[at].astype(np.int64) - terminals
        size = np.where(sides < 0, 1, lengths[np.maximum(sides, 0)])
        ready = (size > 0).all(axis=1)
        lengths[at[ready]] = size[ready].sum(axis=1)
        open_[at[ready]] = False
    return lengths


class Shard:
    """A shard's arrays, read in place."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a Re-Pair shard")
        self.terminals, rules, docs, symbols = np.frombuffer(blob, "<u4", 4, 4).tolist()
        at = 20
        out = []
        for n in (2 * rules, rules, docs, docs, symbols):
            out.append(np.frombuffer(blob, "<u4", n, at))
            at += 4 * n
        self.rules, self.lengths, self.per_doc, self.sizes, self.symbols = out[0].reshape(-1, 2), *out[1:]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids for symbols, one level of rules at a time."""
        while True:
            rule = symbols >= self.terminals
            if not rule.any():
                return symbols
            times = rule.astype(np.int64) + 1
            place = np.cumsum(times) - times
            out = np.repeat(symbols, times)
            pair = self.rules[symbols[rule] - self.terminals]
            out[place[rule]], out[place[rule] + 1] = pair[:, 0], pair[:, 1]
            symbols = out

    def expansions(self) -> tuple[np.ndarray, np.ndarray] | None:
        """(the ids of all terminals and rules in a row, where each begins); none if that is much longer than the text.

        Rules are written out from short to long, and a rule's sides are shorter than it.
        """
        lengths = np.concatenate((np.ones(self.terminals, np.int64), self.lengths.astype(np.int64)))
        total = int(lengths.sum())
        if total > 4 * (int(self.sizes.sum(dtype=np.int64)) + self.terminals):
            return None
        begins = np.cumsum(lengths) - lengths
        store = np.empty(total, np.uint32)
        store[: self.terminals] = np.arange(self.terminals, dtype=np.uint32)
        order = np.argsort(self.lengths, kind="stable")
        sizes = self.lengths[order]
        edges = np.flatnonzero(np.concatenate(([True], sizes[1:] != sizes[:-1], [True]))) if len(sizes) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            of = order[a:b]
            left, right = self.rules[of, 0], self.rules[of, 1]
            at, first = begins[self.terminals + of], lengths[left]
            length = int(sizes[a])
            for k in range(length) if length <= 16 else ():
                inside = k < first
                source = np.where(inside, begins[left] + k, begins[right] + k - first)
                store[at + k] = store[source]
            if length > 16:
                for i in range(b - a):
                    f = int(first[i])
                    store[at[i] : at[i] + f] = store[begins[left[i]] : begins[left[i]] + f]
                    store[at[i] + f : at[i] + length] = store[begins[right[i]] : begins[right[i]] + length - f]
        return store, begins

    def ids(self) -> np.ndarray:
        """All ids of the shard."""
        written = self.expansions()
        if written is None:
            return self.expand(self.symbols)
        store, begins = written
        sizes = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.terminals
        sizes[rule] = self.lengths[self.symbols[rule] - self.terminals]
        past = np.cumsum(sizes)
        return store[np.repeat(begins[self.symbols] - (past - sizes), sizes) + np.arange(int(past[-1]) if len(past) else 0)]

    def read(self, doc: int, start: int = 0, count: int | None = None) -> np.ndarray:
        """Ids of one document from start on, decoding only the symbols that cover them."""
        begin = int(self.per_doc[:doc].sum())
        own = self.symbols[begin : begin + int(self.per_doc[doc])]
        stop = int(self.sizes[doc]) if count is None else min(int(self.sizes[doc]), start + count)
        sizes = np.ones(len(own), np.int64)
        rule = own >= self.terminals
        sizes[rule] = self.lengths[own[rule] - self.terminals]
        past = np.cumsum(sizes)
        a, b = int(np.searchsorted(past, start, "right")), int(np.searchsorted(past, stop, "left")) + 1
        skipped = int(past[a - 1]) if a else 0
        return self.expand(own[a:b])[start - skipped : stop - skipped] if stop > start else own[:0]


def _write(params: Grammar, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(params.vocabulary, params.end_id)
        part, seq, within = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names: list = []
        size = 0

        def close() -> pa.RecordBatch:
            blob = compress(np.concatenate(held), np.concatenate(counts), params)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([within], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([names], pa.list_(id_type)), pa.array([blob], pa.binary())], ["part", "seq", "within", "n_ids", "ids", "blob"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for row, ids, sizes in enc.blocks(batch.column(1), BLOCK):
                ends = np.cumsum(sizes)
                at = 0
                while at < len(sizes):
                    before = int(ends[at - 1]) if at else 0
                    past = min(len(sizes), int(np.searchsorted(ends, before + params.shard_ids - size, "left")) + 1)
                    held.append(ids[before : int(ends[past - 1])])
                    counts.append(sizes[at:past])
                    names += keys[row + at : row + past]
                    size += int(ends[past - 1]) - before
                    at = past
                    if size >= params.shard_ids:
                        yield close()
                        held, counts, names, seq, within, size = [], [], [], seq + 1, within + size, 0
        if held:
            yield close()

    return run


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Grammar = Grammar()) -> DataFrame:
    """Writes the shards of docs and gives their table, read back: part, seq, within (ids of the part before it), n_ids, ids (of documents), blob."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    ordered = rows.withColumn("turn", F.xxhash64("text")).repartitionByRange("id", "turn").sortWithinPartitions("id", "turn", "text").select("id", "text")
    return scratch(ordered.mapInArrow(_write(params, to_arrow_type(rows.schema["id"].dataType)), f"part int, seq int, within long, n_ids long, ids array<{kind}>, blob binary"), "repair")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(len(batch)):
            shard = Shard(batch.column("blob")[r].as_py())
            flat = shard.ids().astype("<u4").tobytes()
            ends = np.cumsum(shard.sizes.astype(np.int64))
            begins = ends - shard.sizes
            crcs = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            ids = batch.column("ids")[r].values
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(begins + batch.column("base")[r].as_py()), pa.array(shard.sizes.astype(np.int64)), pa.array(crcs, pa.int64()),
                 pa.array(np.full(len(crcs), len(shard.symbols), np.int64))],
                ["id", "start", "n_tokens", "ids_crc32", "shard_symbols"])


def read_shards(shards: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, shard_symbols) of every document in a table of shards."""
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row for each part of the range partitioning: few, and so broadcast.
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = shards.join(F.broadcast(before), "part").select((F.col("before") + F.col("within")).alias("base"), "ids", "blob")
    return placed.mapInArrow(_decode, f"id {kind}, start long, n_tokens long, ids_crc32 long, shard_symbols long")


def op7_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document's ids lie in the shards, read back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_shards(write_shards(docs)).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard_symbols")
