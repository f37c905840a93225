"""Suffix-array dedup: removes repeated byte strings by longest-previous-factor arrays.

A text is UTF-8 bytes. A byte goes if a window of `window` bytes that covers it
also starts elsewhere (keep="none"), or starts at an earlier place
(keep="first"; places are ordered by id, then offset). Windows never cross
documents and are judged on the input. With words=True all lengths count words
(what the six ASCII spaces part) instead of bytes: a text is the row of its
words' 64-bit hashes, and everything below holds for these as for bytes.

How it is split over a cluster:

1. Equal texts are found by digest; copies beyond the first need no index (by
   bytes; a rule in words indexes them like any other text).
2. Every window names an anchor: its least `gram`-byte hash, leftmost of ties.
   Equal windows have equal anchors at equal offsets, so consecutive windows of
   one anchor form a run, and only runs whose anchor hash comes twice go on. No
   two windows of one run are equal: their anchors would lie at different places.
3. A run carries the joined 64-bit names of its first and last window, which
   cover it. Where all runs of an anchor hash have one name (128 bits with the
   anchor's), they are equal and each is a repeat whole; no bytes are moved.
4. Of the others, equal runs once, the bytes are fetched and brought together by
   anchor hash. In each group the suffixes at the window starts are sorted into
   suffix order by their bytes, cut at `window` (ranks of 8, 24, 72 ... bytes by
   repeated tripling, after Karp, Miller and Rosenberg 1972); neighbours' common
   prefixes come from the same ranks; previous and next smaller places in suffix
   order (by pointer jumping) give each suffix's longest previous factor. A
   window goes if that reaches `window`.
5. Runs of an anchor hash with very many different contexts are dealt anew by
   the name of each window (128 bits with the anchor's), and the first place of
   each name is a partial aggregate, so no anchor has to fit one task.
6. Spans go back to their documents, where their union is cut out.

Nulls and odd rows: a null text is empty; rows are told apart by a 128-bit hash
of id and text, so repeated rows are copies of each other, each with its
own result row; a null id sorts first; ties on an id go by that hash; a very long
text is searched in pieces; columns of the user may have any name; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docweave.llm.naming import fresh
from docweave.storage import scratch, table

PLACE_BITS = 22
#: Bytes looked at together in the search for anchors, and in the ranking of groups.
BLOCK = 1 << 19
RANKED = 1 << 18
#: Tasks over which the rows of one crowded key are spread, and the runs of an anchor from which on its rows carry a salt.
SPREAD = 32
CROWD = 4096


@dataclass(frozen=True)
class Repeats:
    """window: bytes of a repeat that counts; gram: bytes of an anchor; keep: "none" or "first"; words: both in words."""

    window: int = 400
    gram: int = 64
    keep: str = "none"
    #: Different runs of one anchor hash beyond which its windows are dealt singly; exact either way.
    group: int = 1024
    words: bool = False

    @property
    def unit(self) -> int:
        """Bytes of data in one place."""
        return 8 if self.words else 1

    def places(self, data) -> np.ndarray:
        """Data as an array with one value a place."""
        return np.frombuffer(data, "<u8" if self.words else np.uint8)


# ---- names and orders over bytes -------------------------------------------------


def _mix(left: np.ndarray, right: np.ndarray | None) -> np.ndarray:
    """Names of joined strings from the names of their halves."""
    out = left * np.uint64(0x9E3779B97F4A7C15)
    if right is not None:
        out += right
    shifted = out >> np.uint64(29)
    out ^= shifted
    out *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(out, np.uint64(32), out=shifted)
    out ^= shifted
    return out


def name_levels(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(width, name of the string of that width at every place) for doubled widths up to length."""
    if data.dtype == np.uint64:
        level, width = _mix(data, None), 1
    else:
        level, width = _mix(np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data), 0, (1,)), None), 8
    levels = [(width, level)]
    while 2 * width <= length:
        level = _mix(level[: max(0, len(level) - width)], level[width:])
        width *= 2
        levels.append((width, level))
    return levels


def _named(levels: list[tuple[int, np.ndarray]], length: int, at: np.ndarray | None = None) -> np.ndarray:
    """Names of the strings of one length at some places, or at all: the levels that make up the length, wide ones first."""
    out, done = None, 0
    count = len(levels[0][1]) + levels[0][0] - length
    for width, level in reversed(levels):
        if length & width:
            part = level[done : done + max(0, count)] if at is None else level[at + done]
            out = part if out is None else _mix(out, part)
            done += width
    return out


def names(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit name of the `length` bytes (a multiple of 8) or 64-bit words (any number) at every place."""
    return _named(name_levels(data, length), length) if len(data) >= length else np.empty(0, np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, from minima kept forward and backward in blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def _ranked(keys: np.ndarray) -> np.ndarray:
    """The rank of every key among the distinct keys."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), np.uint32)
    out[order] = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1])), dtype=np.uint32) if len(keys) else 0
    return out


def rank_levels(data: np.ndarray, window: int) -> list[tuple[int, np.ndarray]]:
    """(width, rank of the string of that width at every place), narrow ones first, the last at least a third of the window."""
    if data.dtype != np.uint64 and window >= 8:
        width, keys = 8, np.ndarray((max(0, len(data) - 7),), ">u8", np.ascontiguousarray(data), 0, (1,)).astype(np.uint64)
    else:
        width, keys = 1, data.astype(np.uint64)
    levels = [(width, _ranked(keys))]
    fold = 3 if len(data) < 1 << 21 else 2  # three ranks of 21 bits, or two of 32, make a key
    while fold * width <= window:
        below = levels[-1][1]
        width *= fold
        levels.append((width, _ranked(_joined(below, [width // fold * i for i in range(fold)], len(data) - width + 1, fold))))
    return levels


def _joined(rank: np.ndarray, offsets: list[int], count: int, fold: int) -> np.ndarray:
    """Ranks at some offsets side by side in one key, for the first `count` places."""
    key = np.zeros(max(0, count), np.uint64)
    for o in offsets:
        key = key << np.uint64(21 if fold == 3 else 32) | rank[o : o + len(key)]
    return key


def suffix_array(data: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): suffixes at `starts` in suffix order, cut at `window`; and the common prefix of each with the one before it in that order."""
    if len(starts) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    levels = rank_levels(data, window)
    width, rank = levels[-1]
    offsets = sorted({*range(0, window - width, width), window - width})
    fold = 3 if len(data) < 1 << 21 else 2
    key = _joined(rank, offsets, len(data) - window + 1, fold)[starts]
    order = np.argsort(key)
    ordered = key[order]
    common = np.full(len(order), window, np.int64)
    common[0] = 0
    differ = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    a, b = starts[order[differ - 1]], starts[order[differ]]
    length = np.zeros(len(differ), np.int64)
    for width, rank in reversed(levels):
        for _ in range(fold):  # what a wider string denies is less than that
            at = np.flatnonzero(length + width <= window)
            same = at[rank[a[at] + length[at]] == rank[b[at] + length[at]]]
            if not len(same):
                break
            length[same] += width
    if levels[0][0] > 1:
        for _ in range(levels[0][0] - 1):
            at = np.flatnonzero(length < window)
            same = at[data[a[at] + length[at]] == data[b[at] + length[at]]]
            # A stopped one stays stopped: its byte differs in every round.
            if not len(same):
                break
            length[same] += 1
    common[differ] = length
    return order, common


def smaller_before(place: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each in suffix order the nearest one before it with a smaller place (-1: none), and their common prefix."""
    found = np.arange(len(place)) - 1
    reach = common.copy()
    open_ = np.arange(1, len(place))
    while len(open_):
        p = found[open_]
        open_ = open_[(p >= 0) & (place[p] > place[open_])]
        p = found[open_]
        # All between an entry and its place so far are greater; so are those it jumps over.
        found[open_], reach[open_] = found[p], np.minimum(reach[open_], reach[p])
    reach[found < 0] = 0
    return found, reach


def longest_previous_factors(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each in suffix order the longest prefix that also starts at a smaller place."""
    _, before = smaller_before(place, common)
    turned = np.concatenate(([0], common[:0:-1])) if len(common) else common
    _, after = smaller_before(place[::-1], turned)
    return np.maximum(before, after[::-1])


def repeated(data: np.ndarray, starts: np.ndarray, window: int, keep: str) -> np.ndarray:
    """Whether the factor of each window start also starts before it (or, for keep="none", anywhere else)."""
    order, common = suffix_array(data, starts, window)
    longest = longest_previous_factors(order, common)
    if keep != "first":  # what starts at a greater place is what comes before from behind
        longest = np.maximum(longest, longest_previous_factors(len(order) - order, common))
    out = np.zeros(len(order), bool)
    out[order] = longest >= window
    return out


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, gram: int):
    """Runs of windows with one anchor: arrays of hash, name, document, first and last window."""
    nothing = (*(np.empty(0, np.uint64) for _ in range(2)), *(np.empty(0, np.int64) for _ in range(3)))
    if len(data) < window:
        return nothing
    levels = name_levels(data, window)
    hashes = _named([x for x in levels if x[0] <= gram], gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keyed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(keyed, window - gram + 1) & low).astype(np.int64)
    step = np.zeros(len(data) + 1, np.int32)
    enough = ends - starts >= window
    np.add.at(step, starts[enough], 1)
    np.add.at(step, ends[enough] - window + 1, -1)
    inside = np.cumsum(step)[: len(at)] > 0
    change = np.ones(len(at), bool)
    change[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(at)) - 1
    held = inside[first]
    first, last = first[held], last[held]
    doc = np.searchsorted(starts, first, "right") - 1
    whole = _mix(_named(levels, window, first), _named(levels, window, last) ^ (last - first).astype(np.uint64))
    return hashes[at[first]], whole, doc, first, last


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(17)
#: A random number for each byte, and the factor of one place to the next in a word's hash.
BYTES = _RNG.integers(0, 1 << 64, 256, np.uint64)
FACTOR = np.uint64(0x2127599BF4325C37)
LONG_WORD = 64


@lru_cache(maxsize=4)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The factor and its inverse (modulo 2^64) to the powers 0 to count - 1."""
    inverse = np.uint64(pow(int(FACTOR), -1, 1 << 64))
    return tuple(np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(count - 1, x)))) for x in (FACTOR, inverse))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of some texts in a row, words up to each offset); words end at the six ASCII spaces and at a text's end.

    A word's bytes, replaced by random numbers, are the coefficients of a
    polynomial modulo 2^64, taken from running sums; words of more than
    LONG_WORD bytes, which could be made to collide there, go to XXH3.
    """
    import xxhash

    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    open_ = np.concatenate(([True], IS_SPACE[data], [True]))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(~open_[1:-1] & (open_[:-2] | edge[:-1]))
    ends = np.flatnonzero(~open_[1:-1] & (open_[2:] | edge[1:])) + 1
    size = 1 << max(10, int(len(data)).bit_length())
    powers, inverse = _powers(size)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTES[data] * powers[: len(data)])))
    out = _mix((sums[ends] - sums[begins]) * inverse[begins], (ends - begins).astype(np.uint64))
    for i in np.flatnonzero(ends - begins > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[begins[i] : ends[i]].tobytes())
    return out, np.searchsorted(begins, offsets, "left")


def flattened(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, their offsets); null is empty."""
    flat = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], np.uint8) if flat.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last, their bytes, offsets) in blocks of about size bytes; a longer text is a block of its own."""
    data, offsets = flattened(column)
    row = 0
    while row < len(column):
        past = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, past, data[offsets[row] : offsets[past]], offsets[row : past + 1] - offsets[row]
        row = past


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes in pieces of bounded size, for a block that may be one very long text."""
    if len(data) <= 4 * BLOCK:
        return word_hashes(data, offsets)
    parts, row_ends, begin, done = [], np.zeros(len(offsets), np.int64), 0, 0
    while begin < len(data):
        stop = min(len(data), begin + BLOCK)
        while stop < len(data):  # on to the next space
            gap = np.flatnonzero(IS_SPACE[data[stop : stop + BLOCK]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(len(data), stop + BLOCK)
        inside = np.clip(offsets - begin, 0, stop - begin)
        found, ends = word_hashes(data[begin:stop], inside)
        row_ends += ends
        parts.append(found)
        begin, done = stop, done + len(found)
    return np.concatenate(parts), row_ends


def _blocks(column: pa.Array, params: Repeats) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last, their places, offsets in them) in blocks."""
    for row, past, data, offsets in row_blocks(column, BLOCK):
        if params.words:
            data, offsets = text_words(data, offsets)
        yield row, past, data, offsets


def _place_data(text: pa.Scalar, params: Repeats) -> memoryview:
    """One text as the bytes of its places: the text itself, or the hashes of its words."""
    if not params.words:
        return memoryview(text.as_buffer())
    data = np.frombuffer(text.as_buffer(), np.uint8)
    return memoryview(text_words(data, np.array([0, len(data)]))[0].view(np.uint8))


def _find_anchors(params: Repeats):
    over, block = params.window - 1, BLOCK // params.unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, past, data, offsets in _blocks(batch.column(2), params):
                pieces = [(0, data, offsets)]
                if past == row + 1 and len(data) > 2 * block:
                    pieces = [(at, d := data[at : at + block + over], np.array([0, len(d)])) for at in range(0, max(1, len(data) - over), block)]
                for shift, piece, places in pieces:
                    hashes, name, doc, first, last = anchors(piece, places[:-1], places[1:], params.window, params.gram)
                    base, of = places[doc] - shift, pa.array(row + doc)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(hashes.view(np.int64)), pa.array(name.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of),
                        pa.array((first - base).astype(np.int64)), pa.array((last - first + 1).astype(np.int32)),
                    ], ["h", "w", "id", "rid", "lo", "n"])

    return run


def _cut_runs(params: Repeats, id_type: pa.DataType):
    """Bytes of each wanted run of each document."""
    window, unit = params.window, params.unit
    place = pa.struct([("id", id_type), ("rid", pa.binary()), ("lo", pa.int64())])
    shape = pa.schema([("h", pa.int64()), ("w", pa.int64()), ("place", place), ("hot", pa.bool_()), ("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            size = 0
            for data, runs in zip(batch.column("data"), batch.column("runs"), strict=True):
                view = _place_data(data, params)
                for r in runs.as_py():
                    lo = r["place"]["lo"]
                    r["part"] = bytes(view[unit * lo : unit * (lo + r.pop("n") - 1 + window)])
                    out.append(r)
                    size += len(r["part"])
                    if size > 8 * BLOCK:
                        yield pa.RecordBatch.from_pylist(out, shape)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, shape)

    return run


def _ranges(flags: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each stretch of flags between bounds, its runs of true flags as (first, past the last)."""
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        part = flags[a:b]
        if part.all():
            out.append([(0, b - a)])
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], part.view(np.int8), [0]))))
        out.append(list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))
    return out


def _rank_groups(params: Repeats):
    """Rows come sorted by anchor hash and place; whole groups are ranked together in blocks."""
    window, keep = params.window, params.keep

    def rank(keys: list[tuple], parts: list[bytes]) -> pa.RecordBatch:
        lengths = np.array([len(p) // params.unit for p in parts])
        sizes = lengths - window + 1
        data = params.places(b"".join(parts))
        begin = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        windows = np.repeat(begin - bounds[:-1], sizes) + np.arange(bounds[-1])
        flags = repeated(data, windows, window, keep)
        spans = _ranges(flags, bounds)
        held = [i for i, s in enumerate(spans) if s]
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        return pa.RecordBatch.from_arrays([
            pa.array([keys[i][0] for i in held], pa.int64()), pa.array([keys[i][1] for i in held], pa.int64()),
            pa.array([[{"s": a, "e": b} for a, b in spans[i]] for i in held], kind),
        ], ["h", "w", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple] = []
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            for h, w, part in zip(batch.column("h").to_pylist(), batch.column("w").to_pylist(), batch.column("part"), strict=True):
                if keys and keys[-1] == (h, w):
                    continue  # a repeated row
                if size > RANKED and keys[-1][0] != h:
                    yield rank(keys, parts)
                    keys, parts, size = [], [], 0
                keys.append((h, w))
                parts.append(part.as_py())
                size += len(parts[-1])
        if keys:
            yield rank(keys, parts)

    return run


def _single_windows(params: Repeats):
    """One row per run with the names of all its windows, each 8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [names(params.places(p.as_buffer()), params.window).view(np.int64) for p in batch.column("part")]
            bounds = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            values = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("w"), batch.column("place"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))],
                ["h", "w", "place", "names"])

    return run


def merged_spans(spans: list[dict]) -> list[list[int]]:
    """The union of spans as maximal runs."""
    merged: list[list[int]] = []
    for s, e in sorted((s["s"], s["e"]) for s in spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return merged


def _cut_out():
    """The rest of every document, and what went."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, digests, spans_out = [], [], [], [], []
            for data, spans in zip(batch.column("data"), batch.column("spans").to_pylist(), strict=True):
                view = memoryview(data.as_buffer())
                merged = merged_spans(spans or [])
                digest, at = hashlib.sha256(), 0
                for s, e in [*merged, [len(view), len(view)]]:
                    digest.update(view[at:s])
                    at = e
                sizes.append(len(view))
                removed.append(sum(e - s for s, e in merged))
                counts.append(len(merged))
                digests.append(digest.hexdigest())
                spans_out.append([{"s": s, "e": e} for s, e in merged])
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("rid"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(spans_out, kind)],
                ["id", "rid", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def row_key(id_: Column, text: Column) -> Column:
    """128 bits that tell a row's id and text: two chained 64-bit hashes, one from either end."""
    return F.concat(*[F.unhex(F.lpad(F.hex(h), 16, "0")) for h in (F.xxhash64(id_, text), F.xxhash64(text, id_))])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(f"`{id_col}`").alias("id"), row_key(F.col(f"`{id_col}`"), text).alias("rid"), text.alias("data"))


def _grouped(rows: DataFrame, keys: list[str], order: Column, own: list[str]) -> DataFrame:
    """rows whose keys come more than once, with the first of their key by an order.

    A key is dealt over SPREAD tasks by what is a row's own, and only the salts
    that a key has are joined back, so no key has to fit one task.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*own), F.lit(SPREAD)).cast("int"))
    parts = salted.groupBy(*keys, "salt").agg(F.count("*").alias("times"), F.min(order).alias("first"))
    whole = parts.groupBy(*keys).agg(F.sum("times").alias("times"), F.min("first").alias("first"), F.collect_set("salt").alias("salts")).where("times > 1")
    return salted.join(whole.select(*keys, "first", F.explode("salts").alias("salt")), [*keys, "salt"])


def _copies(rows: DataFrame, params: Repeats) -> tuple[DataFrame, DataFrame]:
    """Spans of whole texts that go as copies, and the rows beyond the first of each text."""
    sums = rows.select("id", "rid", F.length("data").alias("size"), F.unhex(F.md5("data")).alias("sum"))
    found = _grouped(sums, ["sum"], F.struct("id", "rid"), ["rid"])
    copies = scratch(found.select(
        "rid", "size", ((F.col("first.id").eqNullSafe(F.col("id"))) & (F.col("first.rid") == F.col("rid"))).alias("is_first")), "copies")
    later = copies.where("NOT is_first").select("rid").distinct()
    gone = copies.where(F.lit(params.keep == "none") | ~F.col("is_first")).select(
        "rid", F.lit(0).cast("long").alias("s"), F.col("size").cast("long").alias("e")).distinct()
    if params.keep == "first":  # repeated rows share a rid: the one result holds for each, so the first stays whole
        gone = gone.join(copies.where("is_first").select("rid").distinct(), "rid", "left_anti")
    return gone, later


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Repeats = Repeats()) -> DataFrame:
    """(rid, spans): the spans of bytes (or words) to remove from each document that has any; they may overlap."""
    least = 2 * params.window - 1 if params.words else params.window
    rows = _keyed(docs, id_col, text_col).where(F.length("data") >= least)
    id_type = rows.schema["id"].dataType
    kind = id_type.simpleString()

    # 1. Copies: all but the first row of each text stay out of the index. (Not by words, where a copy may be shorter than the window.)
    gone, later = None, None
    if not params.words:
        gone, later = _copies(rows, params)

    # 2. Anchors, and the runs whose anchor hash comes more than once.
    runs = rows.mapInArrow(_find_anchors(params), f"h long, w long, id {kind}, rid binary, lo long, n int")
    runs = scratch(runs if later is None else runs.join(later, "rid", "left_anti"), "anchors")
    # Written, so that both sides of the join are dealt for it and a crowded hash can be split between tasks.
    twice = runs.groupBy("h").agg(F.count("*").alias("runs"), F.min("w").alias("a"), F.max("w").alias("z")).where("runs > 1")
    twice = scratch(twice.select("h", (F.col("a") == F.col("z")).alias("equal"), (F.col("runs") > CROWD).alias("many")), "anchors-twice")
    # A run of an anchor with many is dealt with a salt from here on, and what is joined to those is repeated for every salt.
    salt = F.when(F.col("many"), F.pmod(F.xxhash64("rid", "lo"), F.lit(SPREAD)).cast("int")).otherwise(0)
    salts = F.when(F.col("many"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    hits = scratch(runs.join(twice, "h").withColumn("salt", salt), "hits")
    place = F.struct("id", "rid", "lo")
    whole = [F.col("lo").alias("s"), (F.col("lo") + F.col("n") - 1 + params.window).alias("e")]

    # 3. Anchors with one run only, over and over.
    equal = hits.where("equal")
    if params.keep == "first":
        firsts = equal.groupBy("h").agg(F.min(place).alias("first"), F.first("many").alias("many"))
        firsts = scratch(firsts.select("h", "first", F.explode(salts).alias("salt")), "first-runs")
        equal = equal.join(firsts, ["h", "salt"]).where(~F.col("first").eqNullSafe(place))
    spans = equal.select("rid", *whole)

    # 4. The bytes of different runs of one anchor, equal runs once; anchors with very many go their own way.
    mixed = hits.where("NOT equal")
    distinct = scratch(mixed.groupBy("h", "w").agg(F.min(place).alias("place"), F.count("*").alias("times"), F.first("n").alias("n"), F.first("many").alias("many")), "distinct-runs")
    crowded = distinct.groupBy("h").agg(F.count("*").alias("different")).where(F.col("different") > params.group)
    crowded = crowded.select("h", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"), F.lit(True).alias("hot"))
    marked = distinct.drop("many").withColumn("salt", F.pmod(F.col("w"), F.lit(SPREAD)).cast("int")).join(crowded, ["h", "salt"], "left")
    wanted = marked.select(F.col("place.rid").alias("rid"), F.struct("h", "w", "place", F.coalesce("hot", F.lit(False)).alias("hot"), "n").alias("run"))
    wanted = wanted.groupBy("rid").agg(F.collect_set("run").alias("runs"))
    cut = rows.join(wanted, "rid").select("data", "runs").mapInArrow(
        _cut_runs(params, to_arrow_type(id_type)), f"h long, w long, place struct<id:{kind},rid:binary,lo:long>, hot boolean, part binary")
    cut = scratch(cut, "runs")
    ranked = cut.where("NOT hot").repartition("h").sortWithinPartitions("h", "place").select(
        "h", "w", "part").mapInArrow(_rank_groups(params), "h long, w long, spans array<struct<s:int,e:int>>")

    # 5. Crowded anchors: first place and count of every window name.
    single = cut.where("hot").select("h", "w", "place", "part").dropDuplicates(["h", "w"]).mapInArrow(
        _single_windows(params), f"h long, w long, place struct<id:{kind},rid:binary,lo:long>, names array<long>")
    single = single.select("h", "w", "place", F.posexplode("names").alias("k", "name"))
    start = F.struct(F.col("place.id"), F.col("place.rid"), (F.col("place.lo") + F.col("k")).alias("lo"), "w", "k")
    hit = _grouped(single, ["h", "name"], start, ["w", "k"])
    if params.keep == "first":
        hit = hit.where((F.col("first.w") != F.col("w")) | (F.col("first.k") != F.col("k")))
    crowd = hit.groupBy("h", "w").agg(F.collect_set(F.struct(F.col("k").alias("s"), (F.col("k") + 1).alias("e"))).alias("spans"))

    # 6. Spans of runs become spans of documents. A run that comes twice is a repeat whole, except for its first place.
    found = distinct.select("h", "w", "times", "many", F.col("place").alias("first")).join(ranked.unionByName(crowd), ["h", "w"], "left")
    found = found.where("times > 1 OR spans IS NOT NULL").select("h", "w", "times", "first", "spans", F.explode(salts).alias("salt"))
    again = F.col("times") > 1
    if params.keep == "first":
        again = again & ~F.col("first").eqNullSafe(place)
    own = F.transform("spans", lambda s: F.struct((F.col("lo") + s["s"]).alias("s"), (F.col("lo") + s["e"] - 1 + params.window).alias("e")))
    placed = mixed.join(scratch(found, "found-runs"), ["h", "w", "salt"]).select("rid", F.explode(F.when(again, F.array(F.struct(*whole))).otherwise(own)).alias("x"))
    spans = spans.unionByName(placed.select("rid", "x.s", "x.e"))
    return (spans if gone is None else gone.unionByName(spans)).groupBy("rid").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Repeats = Repeats()) -> DataFrame:
    """(id, rid, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row of docs."""
    rows = _keyed(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    spans = scratch(repeated_spans(docs, id_col, text_col, params), "spans")
    return rows.join(spans, "rid", "left").mapInArrow(
        _cut_out(),
        f"id {id_type}, rid binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<s:long,e:long>>")


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_bytes(data: bytes, spans: list[dict]) -> list[dict]:
    """Spans of words as spans of bytes, from the first word's begin to the last word's end."""
    places = [m.span() for m in WORD.finditer(data)]
    return [{"s": places[s][0], "e": places[e - 1][1]} for s, e in merged_spans(spans)]


def _cut_texts(at: int):
    """The rest of every text as text: a span gives back what it holds of a character cut by its ends.

    The last two columns are spans of bytes and spans of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stays = [], []
            for text, spans, of_words in zip(batch.column(at), *(batch.column(batch.num_columns - k).to_pylist() for k in (2, 1)), strict=True):
                stays.append(True)
                if of_words:
                    spans = (spans or []) + word_bytes(text.as_py().encode(), of_words)
                if not spans:
                    texts.append(text.as_py())
                    continue
                data, out, done = text.as_py().encode(), [], 0
                for s, e in merged_spans(spans):
                    while s < e and data[s] & 0xC0 == 0x80:
                        s += 1
                    while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
                        e -= 1
                    out.append(data[done:s])
                    done = e
                texts.append(b"".join([*out, data[done:]]).decode())
                stays[-1] = bool(texts[-1].strip())
            columns = [*batch.columns[:-2]]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-2]).filter(pa.array(stays, pa.bool_()))

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Repeats = Repeats(keep="first"), by_words: Repeats | None = None
) -> DataFrame:
    """docs in their own columns with repeated strings cut out of the text; a text of which nothing is left goes.

    by_words is a second rule, in words; what either rule finds is cut.
    """
    rid, of_bytes, of_words = fresh(docs.columns, "rid", "spans", "word_spans")
    spans = scratch(repeated_spans(docs, id_col, text_col, params), "spans").select(F.col("rid").alias(rid), F.col("spans").alias(of_bytes))
    if by_words is None:
        spans = spans.withColumn(of_words, F.lit(None).cast(spans.schema[of_bytes].dataType))
    else:
        words = scratch(repeated_spans(docs, id_col, text_col, by_words), "word-spans").select(F.col("rid").alias(rid), F.col("spans").alias(of_words))
        spans = spans.join(words, rid, "full")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    joined = docs.withColumn(rid, row_key(F.col(f"`{id_col}`"), text)).join(spans, rid, "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], of_bytes, of_words)
    return joined.mapInArrow(_cut_texts(docs.columns.index(text_col)), docs.schema)


#: Passages of more than 50 words, whatever their length in bytes.
PASSAGES = Repeats(window=51, gram=16, words=True)


def covered_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Repeats = PASSAGES) -> DataFrame:
    """(rid, n_passage_words): words of each document with any that lie in a repeated passage."""
    spans = scratch(repeated_spans(docs, id_col, text_col, params), "word-spans")
    # Spans in order, each counted from where all before it end.
    ordered = F.sort_array("spans")
    walk = F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"), (a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], a["end"]))).alias("n")))
    return spans.select("rid", walk["n"].alias("n_passage_words"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to 400-byte strings that start more than once; beside it, its words in passages of 51 words that do."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = scratch(covered_words(docs), "passage-words")
    return dedup(docs).join(words, "rid", "left").select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", F.coalesce("n_passage_words", F.lit(0)).cast("long").alias("n_passage_words"))
