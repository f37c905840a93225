"""Grouping genetic algorithm: packing of documents into sequences.

A document's ids (with the end id) are cut into pieces of `capacity` tokens
only if there are more; full pieces are sequences of their own. All other
pieces are dealt by hash into blocks of about `block` pieces.

A block is packed by several islands, each with its own seed and population.
A chromosome is a list of sequences (groups of pieces). The population begins
with best-fit decreasing and packings of it whose sequences were emptied in
part, always in full number. Crossover injects the well-filled sequences of one
parent into the other, removes the sequences that hold a piece a second time,
and gives the displaced pieces back: first one or two of them take the place of
a piece in a sequence that gets fuller by it (Falkenauer 1996, after Martello
and Toth), then all that is loose goes best-fit, longest first; mutation empties
the least-filled sequences in the same way. After each epoch every island sends
its elite to the next one (a join in the cluster, not the driver), and at the
end the best island of a block gives its packing. Fewer sequences are better,
then those whose squared fillings sum to more: so what room is left gathers in
few sequences. An island stops early only where nothing can be better: the
lower bound ceil(tokens / capacity) is met and one sequence holds all the room.

The sequences of a block that still have room, usually one, are opened again:
they are dealt in whole to fewer blocks and packed anew, level by level, until
one block is left. A level begins with the sequences as they were too, so it
never needs more of them.

Nulls and odd rows: a null or empty text is one piece with the end id; repeated
rows are packed each on their own; null ids are kept; ties on a length go by
serial number; a very long text is cut and its pieces are packed like any; an
empty table gives an empty result.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.tokens import encoder
from docweave.storage import scratch, table

PIECE = "doc_id {kind}, serial long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Packing:
    """capacity: tokens of a sequence; block: pieces packed together; the rest steers the genetic algorithm."""

    capacity: int = 4096
    block: int = 4096
    islands: int = 3
    epochs: int = 2
    population: int = 6
    offspring: int = 12
    well_filled: float = 0.995
    seed: int = 11
    vocabulary: str | None = None
    end_id: int = 1
    #: Bytes of text tokenized together.
    block_bytes: int = 5 << 20


# ---- pieces ----------------------------------------------------------------------


def _pieces(params: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(params.vocabulary, params.end_id)
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, ids, sizes in enc.blocks(batch.column(1), params.block_bytes):
                flat = memoryview(ids.astype("<u4")).cast("B")
                rows, serials, pieces, starts, lengths, crcs = [], [], [], [], [], []
                begin = 0
                for i, size in enumerate(sizes.tolist()):
                    for n, a in enumerate(range(0, size, params.capacity)):
                        length = min(params.capacity, size - a)
                        rows.append(row + i)
                        serials.append(serial)
                        pieces.append(n)
                        starts.append(a)
                        lengths.append(length)
                        crcs.append(zlib.crc32(flat[4 * (begin + a) : 4 * (begin + a + length)]))
                        serial += 1
                    begin += size
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(serials, pa.int64()), pa.array(pieces, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs))],
                    ["doc_id", "serial", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Packing = Packing()) -> DataFrame:
    """Every document's pieces with a serial number, written once so that the numbers stay."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return scratch(rows.mapInArrow(_pieces(params), PIECE.format(kind=kind)), "pieces")


# ---- the genetic algorithm on one block -------------------------------------------


#: Loose pieces up to which pairs of them are tried in place of one.
PAIRS = 150


class Bins:
    """Sequences of a block, with their free room kept in order for best-fit."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.groups: dict[int, list[int]] = {}
        self.room: dict[int, int] = {}
        self.order: list[tuple[int, int]] = []
        self.next = 0

    def add(self, group: list[int]) -> None:
        free = self.capacity - sum(self.sizes[i] for i in group)
        self.groups[self.next], self.room[self.next] = group, free
        insort(self.order, (free, self.next))
        self.next += 1

    def drop(self, b: int) -> list[int]:
        del self.order[bisect_left(self.order, (self.room.pop(b), b))]
        return self.groups.pop(b)

    def best_fit(self, items: list[int]) -> None:
        """Puts items, longest first, each where the least room is left."""
        sizes, order = self.sizes, self.order
        for i in sorted(items, key=lambda i: (-sizes[i], i)):
            at = bisect_left(order, (sizes[i], -1))
            if at == len(order):
                self.add([i])
                continue
            free, b = order.pop(at)
            self.groups[b].append(i)
            self.room[b] = free - sizes[i]
            insort(order, (free - sizes[i], b))

    def value(self) -> tuple[int, float]:
        """Smaller is better: the number of sequences, then minus the squares of their filling (Falkenauer)."""
        fill = sum(((self.capacity - r) / self.capacity) ** 2 for r in self.room.values())
        return len(self.groups), -round(fill, 9)

    def exchange(self, loose: list[int]) -> list[int]:
        """One or two loose pieces take the place of a piece where the sequence gets fuller by it; what is loose then.

        Sequences with least room come first, so that they fill up. Pairs are
        tried where few pieces are loose; many find their place best-fit.
        """
        sizes, pairs = self.sizes, len(loose) <= PAIRS
        free = sorted((sizes[i], i) for i in loose)
        for room, b in list(self.order):
            if room == 0 or not free:
                continue
            group = self.groups[b]
            best: tuple[int, int, list[int]] | None = None  # gain, position in the group, positions in free
            for at, i in enumerate(group):
                size = sizes[i]
                k = bisect_left(free, (size + room + 1, -1)) - 1
                if k >= 0 and free[k][0] > size and (best is None or free[k][0] - size > best[0]):
                    best = (free[k][0] - size, at, [k])
                x, y = 0, bisect_left(free, (size + room, -1)) - 1
                while pairs and x < y:
                    both = free[x][0] + free[y][0] - size
                    if both > room:
                        y -= 1
                        continue
                    if both > 0 and (best is None or both > best[0]):
                        best = (both, at, [x, y])
                    x += 1
                if best is not None and best[0] == room:
                    break
            if best is None:
                continue
            gain, at, ks = best
            out = group[at]
            new = [free[k][1] for k in ks]
            for k in sorted(ks, reverse=True):
                del free[k]
            group[at : at + 1] = new
            insort(free, (sizes[out], out))
            del self.order[bisect_left(self.order, (room, b))]
            self.room[b] = room - gain
            insort(self.order, (room - gain, b))
        return [i for _, i in free]

    def listed(self) -> list[list[int]]:
        return [sorted(g) for g in self.groups.values()]


def packed(groups: list[list[int]], sizes: list[int], capacity: int, rooms: list[int] | None = None) -> Bins:
    """Bins of copies of some groups, whose rooms may be known."""
    out = Bins(sizes, capacity)
    out.groups = {b: list(g) for b, g in enumerate(groups)}
    out.room = dict(enumerate(rooms if rooms is not None else [capacity - sum(map(sizes.__getitem__, g)) for g in groups]))
    out.order = sorted((r, b) for b, r in out.room.items())
    out.next = len(groups)
    return out


def crossover(a: Bins, b: Bins, rng: random.Random, well_filled: float) -> Bins:
    """A child of a with whole well-filled groups of b."""
    full = [k for k, r in b.room.items() if r <= (1 - well_filled) * b.capacity]
    rng.shuffle(full)
    full = full[: max(1, len(full) // 2)]
    injected = [b.groups[k] for k in full]
    held = {i for g in injected for i in g}
    kept, rooms, loose = [], [], []
    for k, g in a.groups.items():
        if held.isdisjoint(g):
            kept.append(g)
            rooms.append(a.room[k])
        else:
            loose += [i for i in g if i not in held]
    child = packed([*kept, *injected], a.sizes, a.capacity, [*rooms, *(b.room[k] for k in full)])
    child.best_fit(child.exchange(loose))
    return child


def mutate(bins: Bins, rng: random.Random, share: float = 0.03) -> None:
    """Empties the least-filled sequences and a few others, and puts their pieces back."""
    count = max(2, int(share * len(bins.groups)))
    worst = [b for _, b in bins.order[-count:]]
    others = rng.sample(sorted(bins.groups), min(len(bins.groups), count))
    loose: list[int] = []
    for b in dict.fromkeys([*worst, *others]):
        loose += bins.drop(b)
    bins.best_fit(bins.exchange(loose))


def best_possible(sizes: list[int], capacity: int) -> tuple[int, float]:
    """The value of a packing with as few sequences as the tokens need, all full but one."""
    bound = -(-sum(sizes) // capacity)
    rest = sum(sizes) - (bound - 1) * capacity
    return bound, -round(bound - 1 + (rest / capacity) ** 2, 9)


def evolve(sizes: list[int], population: list[list[list[int]]], seed: int, params: Packing) -> list[list[list[int]]]:
    """One epoch of one island: its population, best first; best-fit decreasing is always tried."""
    rng = random.Random(seed)
    people = [packed(p, sizes, params.capacity) for p in population]
    if len(people) < params.population:
        first = Bins(sizes, params.capacity)
        first.best_fit(list(range(len(sizes))))
        people.append(first)
    while len(people) < params.population:
        other = packed(list(people[0].groups.values()), sizes, params.capacity, list(people[0].room.values()))
        mutate(other, rng, rng.uniform(0.05, 0.3))
        people.append(other)
    people.sort(key=Bins.value)
    goal = best_possible(sizes, params.capacity)
    for _ in range(params.offspring):
        if people[0].value() <= goal:
            break
        a, b = rng.sample(people, 2)
        child = crossover(a, b, rng, params.well_filled)
        if rng.random() < 0.5:
            mutate(child, rng)
        people = sorted([*people, child], key=Bins.value)[: max(2, params.population)]
    return [p.listed() for p in people]


GROUPS = "array<array<array<int>>>"


def _epoch(params: Packing, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row is one island of one block: its own population and the elite that came in."""
        kind = pa.list_(pa.list_(pa.list_(pa.int32())))
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                r = row.to_pylist()[0]
                start = (r["people"] or []) + (r["elite"] or [])
                out = evolve(r["sizes"], start, hash((params.seed, r["block"], r["island"], epoch)), params)
                count, fill = packed(out[0], r["sizes"], params.capacity).value()
                yield pa.RecordBatch.from_arrays(
                    [row.column("block"), row.column("island"), row.column("sizes"), pa.array([out], kind), pa.array([count], pa.int32()), pa.array([fill], pa.float64())],
                    ["block", "island", "sizes", "people", "bins", "fill"])

    return run


def _placed(ordered: DataFrame, begin: DataFrame | None, params: Packing, level: int, blocks: int) -> DataFrame:
    """(block, bin, turn, place, room): where each piece of each block goes, and the room of its sequence; begin holds (block, people) to start from."""
    lists = ordered.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", F.col("length").cast("int").alias("n")))), lambda x: x["n"]).alias("sizes"))
    if begin is None:
        lists = lists.withColumn("people", F.lit(None).cast(GROUPS))
    else:
        lists = lists.join(begin, "block")
    state = lists.select("block", F.explode(F.sequence(F.lit(0), F.lit(params.islands - 1))).alias("island"), "sizes", "people", F.lit(None).cast(GROUPS).alias("elite"))
    shape = f"block long, island int, sizes array<int>, people {GROUPS}, bins int, fill double"
    for epoch in range(params.epochs):
        # An island is little data and much work, so there is a task for each, up to some thousands.
        state = state.repartition(min(4096, blocks * params.islands), "block", "island").mapInArrow(_epoch(params, epoch), shape)
        state = scratch(state, f"islands-{level}-{epoch}")
        if epoch + 1 < params.epochs:
            elite = state.select("block", ((F.col("island") + 1) % params.islands).alias("island"), F.slice("people", 1, 1).alias("elite"))
            state = state.join(elite, ["block", "island"]).select("block", "island", "sizes", "people", "elite")
    best = state.groupBy("block").agg(F.min_by(F.struct(F.get("people", F.lit(0)).alias("groups"), "sizes"), F.struct("bins", "fill", "island")).alias("best"))
    bins = best.select("block", "best.sizes", F.posexplode("best.groups").alias("bin", "group"))
    room = F.lit(params.capacity) - F.aggregate("group", F.lit(0), lambda a, i: a + F.get("sizes", i))
    return bins.select("block", "bin", room.alias("room"), F.posexplode("group").alias("turn", "place"))


def pack(parts: DataFrame, params: Packing = Packing()) -> DataFrame:
    """parts with sequence_id and offset; parts as from pieces()."""
    whole = parts.where(F.col("length") >= params.capacity).select(
        "*", F.col("serial").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = parts.where(F.col("length") < params.capacity)
    blocks = max(1, -(-rest.count() // params.block))
    dealt, begin = rest.withColumn("block", F.pmod(F.xxhash64("serial"), F.lit(blocks)).cast("long")), None
    inside = Window.partitionBy("block", "bin").orderBy("turn")
    closed = []
    for level in range(32):
        ordered = scratch(dealt.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy("serial")) - 1), f"dealt-{level}")
        if level:  # the sequences as they came are a packing to begin with
            groups = ordered.groupBy("block", "group").agg(F.sort_array(F.collect_list("place")).alias("places"))
            begin = groups.groupBy("block").agg(F.array(F.collect_list("places")).alias("people"))
        joined = ordered.join(_placed(ordered, begin, params, level, blocks), ["block", "place"])
        out = joined.select(
            *parts.columns, "block", "room", (F.lit(level) * F.lit(1 << 56) + F.col("block") * F.lit(1 << 20) + F.col("bin")).alias("sequence_id"),
            (F.sum("length").over(inside) - F.col("length")).alias("offset"))
        out = scratch(out, f"packed-{level}")
        if blocks == 1:
            closed.append(out)
            break
        open_ = F.col("room") > params.capacity * (1 - params.well_filled)
        closed.append(out.where(~open_))
        left = out.where(open_)
        fewer = min(blocks // 2, max(1, -(-left.count() // params.block)))
        # Whole blocks go together, so that a sequence's pieces stay together.
        dealt = left.select(*parts.columns, F.pmod(F.xxhash64("block"), F.lit(fewer)).cast("long").alias("block"), F.col("sequence_id").alias("group"))
        blocks = fewer
    for part in closed:
        whole = whole.unionByName(part.select(*parts.columns, "sequence_id", "offset"))
    return whole


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and place of every piece of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Packing = Packing()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack(pieces(docs, id_col, text_col, params), params).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
