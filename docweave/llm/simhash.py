"""Multi-index hashing: SimHash near-duplicates by Hamming balls in pieces of the fingerprint.

Fingerprints come from 3-word shingles (repeats count) of the text with A-Z in
lower case. Two documents link if their fingerprints differ in at most three
of 64 bits. Of the two 32-bit halves of a linked pair one differs in at most
one bit, so every distinct fingerprint is stored under both halves, and looks
up each half and the ball of one bit around it; complete distances decide.
A half that differs in one bit has a 0 there on exactly one side, so only
flips from 0 to 1 are looked up. A distance of seven has four pieces of 16 bits
in the place of the halves; the near copies of the pipeline use that (similar.py).

Copies collapse to one row per fingerprint before any lookup. A bucket of a
piece that very many fingerprints share is dealt anew by the remaining bits, in
one part more than the distance where the pieces agree (that many errors leave
one part untouched; one part fewer where one bit was flipped), so no bucket has to
fit a task whole because of its piece alone. In a bucket only links that join
two so far unconnected parts leave the task: components keep every link's
effect while the rows stay fewer than the lookups.

Nulls and odd rows: a null or empty text has fingerprint zero and links like
any other; repeated rows have one fingerprint and so one component; null ids
never become a component's name unless all ids of it are null; of several least
ids, equal, any is the name; very long texts are hashed whole, their bits counted in pieces; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators.components import connected_components
from docweave.storage import scratch, table

if TYPE_CHECKING:
    from docweave.llm.similar import Similar

SEED = 42


@dataclass(frozen=True)
class SimHash:
    """words: shingle length; distance: most differing bits of a link, 3 for an index of two halves, 7 for one of four pieces."""

    words: int = 3
    distance: int = 3
    #: Fingerprints under one piece beyond which its bucket is dealt anew; exact either way.
    bucket: int = 2048

    @property
    def pieces(self) -> int:
        """Pieces of a fingerprint, of which one differs in at most one bit where the distance holds."""
        count = (self.distance + 1) // 2
        if self.distance % 2 == 0 or count < 2 or 64 % count:
            raise ValueError("the index is built for distances of 3, 7 and 15")
        return count


def fingerprint(text: bytes, words: int) -> int:
    """The 64-bit SimHash of a text in UTF-8; bytes.split knows the same six ASCII spaces."""
    import xxhash

    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the 64-bit hashes; zero if there are none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.fromiter((fingerprint((t.as_py() or "").encode(), words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SimHash = SimHash()) -> DataFrame:
    """(id, fp) for every row; fp holds the 64 bits as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(params.words), f"id {kind}, fp long")


def _entries(prints: DataFrame, count: int) -> DataFrame:
    """(piece, key, probe, fp): every fingerprint under its pieces, and its lookups one flip away."""
    width = 64 // count
    flips = F.expr(f"filter(sequence(0, {width - 1}), b -> (part >> b) & 1 = 0)")
    parts = F.array(*[F.expr(f"shiftrightunsigned(fp, {width * i}) & {(1 << width) - 1}") for i in range(count)])
    pieces = prints.select("fp", F.posexplode(parts).alias("piece", "part"))
    return pieces.select(
        "piece", "fp", F.explode(F.concat(
            F.array(F.struct(F.col("part").alias("key"), F.lit(False).alias("probe"))),
            F.transform(flips, lambda b: F.struct(F.expr("part").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)).alias("key"), F.lit(True).alias("probe"))),
        )).alias("e"),
    ).select("piece", "e.key", "e.probe", "fp")


def _remaining(count: int):
    """The bits of a fingerprint without its piece, moved together."""
    width, out = 64 // count, F.lit(None).cast("long")
    for i in range(count):
        low = f"(fp & {(1 << width * i) - 1})"
        both = low if i == count - 1 else f"{low} | shiftleft(shiftrightunsigned(fp, {width * (i + 1)}), {width * i})"
        out = F.when(F.col("piece") == i, F.expr(both)).otherwise(out)
    return out


def _parts(other, bits: int, count: int):
    """Remaining bits in parts, each with its place, as one long apiece."""
    width = [bits // count + (1 if i < bits % count else 0) for i in range(count)]
    at = [sum(width[:i]) for i in range(count)]
    return [F.shiftright(other, a).bitwiseAND(F.lit((1 << w) - 1)) + F.lit((count * 16 + i) << 32) for i, (a, w) in enumerate(zip(at, width, strict=True))]


def _deal_hot(entries: DataFrame, hot: DataFrame, params: SimHash) -> DataFrame:
    """sub: 0 in common buckets; in hot ones each row once for each part of its remaining bits."""
    marked = entries.join(hot.withColumn("hot", F.lit(True)), ["piece", "key"], "left")
    other, bits = _remaining(params.pieces), 64 - 64 // params.pieces
    exact, flipped = _parts(other, bits, params.distance + 1), _parts(other, bits, params.distance)
    subs = F.when(F.col("hot").isNull(), F.array(F.lit(0).cast("long"))).when(F.col("probe"), F.array(*flipped)).otherwise(F.array(*exact, *flipped))
    return marked.select("piece", "key", F.explode(subs).alias("sub"), "probe", "fp")


def _bucket_links(fps: np.ndarray, probe: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of one bucket that join parts not yet joined; every pair with a stored side is compared."""
    bits = fps.view(np.uint64)  # a signed number's bits would be counted without its sign
    stored = bits[~probe]
    everyone = np.concatenate((stored, bits[probe]))
    if len(stored) == 0 or len(everyone) < 2:
        return []
    part = np.arange(len(everyone))
    found = []
    step = max(1, (1 << 20) // len(everyone))
    for a in range(0, len(stored), step):
        near = np.bitwise_count(stored[a : a + step, None] ^ everyone[None, :]) <= distance
        near &= np.arange(len(everyone))[None, :] > np.arange(a, min(a + step, len(stored)))[:, None]
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            at = np.flatnonzero(near[i])
            joined, first = np.unique(part[at], return_index=True)
            apart = joined != part[a + i]
            if apart.any():
                found += [(stored[a + i], x) for x in everyone[at[first[apart]]]]
                part[np.isin(part, joined)] = part[a + i]
    return found


def _links(distance: int):
    def emit(found: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; a bucket may go on in the next batch."""
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)))
            piece, key, sub, probe, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            new = np.flatnonzero((piece[1:] != piece[:-1]) | (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])) + 1
            cuts = [0, *new.tolist()]
            found = _many(fp, probe, cuts, distance)
            last = cuts[-1]
            held = [(piece[last:], key[last:], sub[last:], probe[last:], fp[last:])]
            if found:
                yield emit(found)
        if held and len(held[0][0]):
            yield emit(_bucket_links(held[0][4], held[0][3].astype(bool), distance))

    return run


def _many(fp: np.ndarray, probe: np.ndarray, cuts: list[int], distance: int) -> list[tuple[int, int]]:
    """Links of the buckets between cuts; buckets of one row, or of lookups only, are passed over."""
    found: list[tuple[int, int]] = []
    if len(cuts) < 2:
        return found
    at = np.array(cuts)
    stored = np.add.reduceat((~probe.astype(bool)).astype(np.int64), at)[:-1]
    for k in np.flatnonzero((np.diff(at) > 1) & (stored > 0)).tolist():
        found += _bucket_links(fp[cuts[k] : cuts[k + 1]], probe[cuts[k] : cuts[k + 1]].astype(bool), distance)
    return found


def links(prints: DataFrame, params: SimHash = SimHash()) -> DataFrame:
    """(src, dst): links between distinct fingerprints, enough of them to span every component."""
    entries = _entries(prints, params.pieces)
    hot = entries.where("NOT probe").groupBy("piece", "key").count().where(F.col("count") > params.bucket).select("piece", "key")
    dealt = _deal_hot(entries, hot, params).repartition("piece", "key", "sub").sortWithinPartitions("piece", "key", "sub")
    return dealt.mapInArrow(_links(params.distance), "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SimHash = SimHash()) -> DataFrame:
    """(id_col, fingerprint in 16 hex digits, component_id) for every row of docs."""
    prints = scratch(fingerprints(docs, id_col, text_col, params), "simhash")
    distinct = scratch(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    parts = connected_components(scratch(links(distinct.select("fp"), params), "simhash-links"))
    named = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("part"))
    lowest = named.groupBy("part").agg(F.min("first").alias("component_id"))
    by_print = named.join(lowest, "part").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Similar | None = None) -> DataFrame:
    """One row of each group of near copies by five-word similarity, found by these links first: see similar.keep_one."""
    from docweave.llm import similar

    return similar.keep_one(docs, id_col, text_col, params or similar.Similar())


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
