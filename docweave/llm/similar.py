"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words are parted by the six ASCII spaces, with A-Z in lower case; a text of
fewer words is one shingle. Equal sets collapse first.

The search is that of simhash.py: SimHash fingerprints of the sets, and its
multi-index for a distance of `bits` of 64. Sets of one fingerprint are compared
with the first of them, and fingerprints by the index's links; each such pair is
decided by its true similarity, so a link is never wrong. Fingerprints alone
can't reach the bound: a pair of similarity 0.8 differs in 9.7 bits on average,
and an index for the 19 bits that would take in all but one pair in a thousand
has pieces of so few bits that it compares nearly everything with everything.

So what the index leaves apart is searched once more, for pairs whose
fingerprints lie farther off, by min-hashes in bands: two sets share a band with
a chance of J^rows, and at J = 0.8 all bands miss a pair with a chance of
(1 - 0.8^4)^20 = 3e-5. Buckets whose sets the index has joined already are
passed over, and so are pairs of joined sets; the others are decided by their
true similarity.

Buckets with the same members are looked at once. A bucket of up to `pairs`
sets gives all its pairs. In a larger one each member is compared with a few
centers: the member that is in most large buckets (that which the others are
copies of, as a rule), and some that differ from bucket to bucket. So pairs grow
with the members and not with their square. No pair inside a component needs a
further look; where a large bucket still spans several components, members
outside its largest one are compared with all members of their bucket in other
components, block by block inside tasks, which give back nothing but the links
that join components. Where that would be much work, they are first compared
with new centers from the largest component, up to `rounds` times, so that fewer
are left. So no pair that shares a bucket is passed over that could join anything.

Equal sets are found by 128-bit digests and then numbered, once, in a table that
is written: everything after goes by these numbers.

Nulls and odd rows: null and empty texts are equal; repeated rows are copies of
each other, of which one stays; of rows with one id the one of least 128-bit
hash of id and text stays; very long texts are hashed in pieces; columns of the
user may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm import simhash
from docweave.llm.naming import fresh
from docweave.llm.suffix_dedup import _mix, names, row_blocks, row_key, text_words
from docweave.operators.components import connected_components
from docweave.storage import discard
from docweave.storage import scratch as written


@dataclass(frozen=True)
class Similar:
    """words: shingle length; share: least similarity of a link; bits: distance of the fingerprints' index; bands of so many rows find what it leaves."""

    words: int = 5
    share: float = 0.8
    bits: int = 7
    bands: int = 20
    rows: int = 4
    #: Sets of one bucket up to which all pairs are compared, and the members compared with all others beyond.
    pairs: int = 32
    centers: int = 3
    rounds: int = 2
    #: Comparisons for each set of the table that the rest may take before it goes on to be made smaller by rounds.
    work: int = 200
    #: Sets of a large bucket that lie together in one task, twice, when its rest is compared.
    block: int = 256


def scratch(df: DataFrame, label: str, rows: int | None = None, of: int = 100_000) -> DataFrame:
    """A scratch table with a light codec: hashes don't compress, and a zstd writer takes native memory.

    Where its rows, or those that it takes to make it, are known to be at most
    `rows`, there are tasks and part files for `of` rows each and no more.
    """
    return written(df if rows is None else df.coalesce(max(12, rows // of)), label, "snappy")


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, the set of its shingles as sorted 64-bit names) of every text."""
    for row, _, data, offsets in row_blocks(column, 1 << 19):
        small = data + np.uint8(32) * ((data - np.uint8(65)) < 26)
        hashes, ends = text_words(small, offsets)
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True), row):
            own = hashes[a:b]
            yield i, np.unique(names(own, min(words, b - a))) if b > a else own


def band_keys(found: np.ndarray, params: Similar) -> np.ndarray:
    """A key for each band from the least values of a set under many hashes."""
    low = least_values(found, params).astype(np.uint64).reshape(params.bands, params.rows)
    key = np.arange(params.bands, dtype=np.uint64)
    for i in range(params.rows):
        key = _mix(key, low[:, i])
    return key


def least_values(found: np.ndarray, params: Similar) -> np.ndarray:
    """The least value of a set under each of the hashes."""
    low = np.full(params.bands * params.rows, np.iinfo(np.uint32).max, np.uint32)
    narrow = (found >> np.uint64(32)).astype(np.uint32)  # names are mixed, so that half of one will do to pick the least
    turn, factor = _hashes(params.bands * params.rows)
    for at in range(0, len(found), 1024):
        low = np.minimum(low, ((narrow[None, at : at + 1024] ^ turn) * factor).min(axis=1))
    return low


@lru_cache(maxsize=4)
def _hashes(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    turn, factor = (rng.integers(0, 1 << 32, (count, 1), np.uint32) for _ in range(2))
    return turn, factor | np.uint32(1)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            yield b.slice(at, 1000)


def _prints(params: Similar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in _small(batches):
            sids, prints, keys = [], [], []
            for _, found in shingle_sets(batch.column(1), params.words):
                sids.append(xxhash.xxh3_128_digest(found.tobytes()))
                prints.append(simhash.majority(found))
                keys.append(band_keys(found, params).view(np.int64) if len(found) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sids, pa.binary()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], ["row", "digest", "fp", "keys"])

    return run


def _sets(params: Similar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            found = [x.tobytes() for _, x in shingle_sets(batch.column(1), params.words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["sid", "shingles"])

    return run


def alike(a: np.ndarray, b: np.ndarray, share: float) -> bool:
    """Whether two sets, as sorted arrays, have the similarity."""
    if min(len(a), len(b)) < share * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= share * (len(a) + len(b) - both) - 1e-9


def _verified(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [alike(*(np.frombuffer(x.as_buffer(), "<u8") for x in pair), share) for pair in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2]], ["src", "dst"]).filter(pa.array(good, pa.bool_()))

    return run


def _centers(members: DataFrame, count: int, salt: int) -> DataFrame:
    """(key, other, other_part): for each key some of its members by hash, one row each."""
    some = [F.min_by(F.struct(F.col("sid").alias("other"), F.col("part").alias("other_part")), F.struct(F.xxhash64("sid", "key", F.lit(salt + i)), "sid")) for i in range(count)]
    return members.groupBy("key").agg(F.array(*some).alias("o")).select("key", F.explode(F.array_distinct("o")).alias("o")).select("key", "o.*")


def _ordered(pairs: DataFrame) -> DataFrame:
    """The pairs once each, without those of sets that are joined already, where that is known."""
    apart = "part <> other_part" if "other_part" in pairs.columns else "sid <> other"
    return pairs.where(apart).select(F.least("sid", "other").alias("src"), F.greatest("sid", "other").alias("dst")).distinct()


def printed_pairs(distinct: DataFrame, params: Similar) -> DataFrame:
    """(src, dst): sets with the first of their fingerprint, and the firsts of fingerprints that the multi-index links."""
    index, n = simhash.SimHash(params.words, params.bits), distinct.count()
    prints = scratch(distinct.groupBy("fp").agg(F.min("sid").alias("other")), "similar-prints", n)
    found = scratch(simhash.links(prints.select("fp"), index), "similar-index", n * (32 + index.pieces)).distinct()
    ends = found.join(prints.select(F.col("fp").alias("src"), F.col("other").alias("sid")), "src").join(prints.select(F.col("fp").alias("dst"), "other"), "dst")
    return _ordered(distinct.join(prints, "fp").select("sid", "other").unionByName(ends.select("sid", "other")))


def candidates(entries: DataFrame, large: DataFrame, params: Similar, rows: int | None = None) -> DataFrame:
    """(src, dst): pairs of sets of different parts that share a small bucket, or a large one (its members are given) with one of them a center of it."""
    buckets = entries.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("sid")).alias("x"), F.min("sid").alias("low"), F.min("part").alias("a"), F.max("part").alias("b"))
    # Of buckets with the same members one is enough.
    few = buckets.where((F.col("n") <= params.pairs) & (F.col("a") < F.col("b"))).groupBy("n", "x", "low").agg(F.min("key").alias("key")).select("key")
    small = scratch(entries.join(few, "key"), "similar-members", rows)
    pairs = small.join(small.select("key", F.col("sid").alias("other"), F.col("part").alias("other_part")), "key").where("sid < other").select("sid", "other", "part", "other_part")
    degree = large.groupBy("sid").agg(F.count("*").alias("degree"))
    first = large.join(degree, "sid").groupBy("key").agg(F.max_by(F.struct(F.col("sid").alias("other"), F.col("part").alias("other_part")), F.struct("degree", "sid")).alias("o")).select("key", "o.*")
    centers = first.unionByName(_centers(large, params.centers - 1, 0)) if params.centers > 1 else first
    return _ordered(pairs.unionByName(large.join(centers.distinct(), "key").select("sid", "other", "part", "other_part")))


def _in_parts(sets: DataFrame, parts: DataFrame, *others: str) -> DataFrame:
    """(others, sid, part): the component of each set, itself where it has none."""
    return sets.join(parts, sets["sid"] == parts["node"], "left").select(*others, "sid", F.coalesce("component", "sid").alias("part"))


def _split(large: DataFrame, parts: DataFrame, rows: int) -> DataFrame:
    """(key, sid, part, main): members of large buckets that span several components; main is the bucket's largest."""
    members = scratch(_in_parts(large.select("key", "sid"), parts, "key"), "similar-large", rows)
    sizes = members.groupBy("key", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("key", "main")
    return scratch(members.join(main, "key"), "similar-split", rows)


def _compared(params: Similar):
    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        """Links between the rest and the members of one pair of blocks that join components not yet joined."""
        rest, members = ([r for r in rows if r[0] == side] for side in (True, False))
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        sets = [np.frombuffer(r[3], "<u8") for r in members]
        low = np.array([least_values(x, params) for x in sets])
        out = []
        for _, sid, part, raw in rest:
            own = np.frombuffer(raw, "<u8")
            # Five deviations below what is to be expected at the least similarity.
            likely = params.bands * params.rows * params.share - 5 * np.sqrt(params.bands * params.rows * params.share * (1 - params.share))
            for i in np.flatnonzero((low == least_values(own, params)).sum(axis=1) >= likely).tolist() if len(members) else ():
                a, b = find(part), find(members[i][2])
                if a != b and alike(own, sets[i], params.share):
                    root[max(a, b)] = min(a, b)
                    out.append((sid, members[i][1]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key and pair of blocks."""
        last, held = None, []
        for batch in batches:
            found = []
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            for k, row in zip(keys, zip(*(batch.column(i) for i in range(3, 7)), strict=True), strict=True):
                if k != last:
                    found += links(held)
                    last, held = k, []
                held.append((row[0].as_py(), row[1].as_py(), row[2].as_py(), row[3].as_py()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["src", "dst"])
        if found := links(held):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["src", "dst"])

    return run


def leftovers(split: DataFrame, sizes: DataFrame, distinct: DataFrame, rows: DataFrame, params: Similar) -> DataFrame:
    """(src, dst): links of one large bucket between components, one end outside the bucket's largest."""
    blocks = sizes.select("key", F.ceil(F.col("all") / params.block).cast("int").alias("nj"), F.ceil(F.col("rest") / params.block).cast("int").alias("ni"))
    sets = _sets_of(split.select("sid").distinct(), distinct, rows, params)
    dealt = split.join(blocks, "key").join(sets, "sid")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda n: F.pmod(F.xxhash64("sid"), F.col(n)).cast("int")
    rest = dealt.where("part <> main").select("key", place("ni").alias("i"), F.explode(every("nj")).alias("j"), F.lit(True).alias("rest"), "sid", "part", "shingles")
    members = dealt.select("key", F.explode(every("ni")).alias("i"), place("nj").alias("j"), F.lit(False).alias("rest"), "sid", "part", "shingles")
    together = rest.unionByName(members).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    links = scratch(together.mapInArrow(_compared(params), "src long, dst long"), "similar-rest")
    discard(sets)
    return links


def _sets_of(sids: DataFrame, distinct: DataFrame, rows: DataFrame, params: Similar) -> DataFrame:
    """(sid, shingles) from the texts themselves."""
    texts = rows.select(F.col("row.row").alias("row"), "text").join(distinct.join(sids, "sid").select("sid", F.col("first.row").alias("row")), "row")
    return scratch(texts.dropDuplicates(["sid"]).select("sid", "text").mapInArrow(_sets(params), "sid long, shingles binary"), "similar-sets")


def _links(pairs: DataFrame, distinct: DataFrame, rows: DataFrame, params: Similar) -> DataFrame:
    """The pairs whose true similarity is high enough."""
    sets = _sets_of(pairs.select(F.explode(F.array("src", "dst")).alias("sid")).distinct(), distinct, rows, params)
    held = pairs.join(sets.select(F.col("sid").alias("src"), F.col("shingles").alias("a")), "src").join(sets.select(F.col("sid").alias("dst"), F.col("shingles").alias("b")), "dst")
    links = scratch(held.select("src", "dst", "a", "b").mapInArrow(_verified(params.share), "src long, dst long"), "similar-links", pairs.count(), 2000)
    discard(sets)
    return links


def chosen_rows(docs: DataFrame, row_col: str, id_col: str, text_col: str, params: Similar = Similar()) -> DataFrame:
    """(row_col): of each group of near copies the row of least id, then least row."""
    rows = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), F.col(f"`{row_col}`").alias("row")).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    prints = rows.mapInArrow(_prints(params), f"row {kind}, digest binary, fp long, keys array<long>")
    distinct = prints.groupBy("digest").agg(F.min("row").alias("first"), F.any_value("fp").alias("fp"), F.any_value("keys").alias("keys"))
    distinct = scratch(distinct.select(F.monotonically_increasing_id().alias("sid"), "first", "fp", "keys"), "similar")
    sets = distinct.count()
    every = sets * params.bands
    links = _links(scratch(printed_pairs(distinct, params), "similar-printed", sets), distinct, rows, params)
    parts = connected_components(links)
    entries = _in_parts(distinct.select("sid", "keys"), parts, "keys").select("sid", "part", F.explode("keys").alias("key"))
    crowded = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("part").alias("a"), F.max("part").alias("b")).where((F.col("n") > params.pairs) & (F.col("a") < F.col("b"))).select("key")
    large = scratch(entries.join(crowded, "key"), "similar-crowded", every)
    links = links.unionByName(_links(scratch(candidates(entries, large, params, every), "similar-pairs", every), distinct, rows, params))
    parts = scratch(connected_components(links), "similar-parts")
    for turn in range(params.rounds + 1):
        split = _split(large, parts, every)
        sizes = split.groupBy("key").agg(F.count("*").alias("all"), F.count_if(F.col("part") != F.col("main")).alias("rest"))
        work = sizes.agg(F.sum(F.col("all") * F.col("rest"))).first()[0]
        if not work:
            break
        last = turn == params.rounds or work <= params.work * sets
        if last:
            more = leftovers(split, sizes, distinct, rows, params)
        else:
            centers = _centers(split.where("part = main"), params.centers, 1000 * (turn + 1))
            pairs = scratch(_ordered(split.where("part <> main").join(centers, "key").select("sid", "other", "part", "other_part")), "similar-pairs", every)
            more = _links(pairs, distinct, rows, params)
        if more.head(1):
            links = links.unionByName(more)
            parts = scratch(connected_components(links), "similar-parts")
        if last:
            break
    named = distinct.join(parts, distinct["sid"] == parts["node"], "left").select("first", F.coalesce("component", "sid").alias("part"))
    return named.groupBy("part").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row_col))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Similar = Similar()) -> DataFrame:
    """One row of each group of near copies, that of least id (then least hash of id and text), in the columns of docs."""
    (row,) = fresh(docs.columns, "row")
    keyed = docs.withColumn(row, row_key(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")))
    chosen = chosen_rows(keyed, row, id_col, text_col, params).distinct()
    return keyed.join(chosen, row, "left_semi").dropDuplicates([row]).drop(row)
