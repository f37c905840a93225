"""Order-preserving packing: windows over the stream of documents, cut by dynamic programming.

The documents of a task are one stream of ids, in the order of their rows. Cuts
lie at ends of documents and of sentences (and lines); where neither comes for
`stretch` ids, a cut is allowed at each `stretch` ids, at a price. A window of
length n costs its padding (capacity - n, or nothing if n is a power of two),
`window` for itself, and the truncation penalty of its last cut: nothing at a
document's end, `sentence` at a sentence's, `inside` elsewhere. The windows of
least total cost are chosen:

    f(j) = min over i of f(i) + padding(j - i) + window + penalty(j)

Without powers of two that is the least f(i) + i of the last `capacity` ids,
which a monotone queue holds at its head: its entries ascend in value and in
place, a new one drops those behind it that are no less, and those out of reach
leave at the front. Powers of two are at most 12 more places for each j. So
the work is linear in the number of cuts. Ties go to the longer window.

Programming goes over blocks of `block_bytes` of text, at ends of documents, in
which order and the rule stay the same; a block's last window is like any other. Nothing is
shuffled: tokenizing and cutting are one pass over the table.

Nulls and odd rows: a null or empty text is the end id alone; repeated rows are
packed each on their own; null ids are kept; a very long text is many sentences;
an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.tokens import WORD_END, encoder
from docweave.storage import ship, table

#: Marks that end a sentence, marks that may follow them, and words after which a full stop ends none (fixed values).
ENDS = ".!?…。！？"
CLOSERS = "\"')]}”’»"
SHORT = "mr mrs ms dr prof st vs etc eg ie no nr bzw ca usw sr sra mme mlle"


@dataclass(frozen=True)
class Windows:
    """Costs are in ids of padding."""

    capacity: int = 2048
    sentence: int = 24
    inside: int = 96
    window: int = 32
    stretch: int = 128
    vocabulary: str | None = None
    end_id: int = 1
    #: Bytes of text cut together.
    block_bytes: int = 5 << 20


# ---- cuts -------------------------------------------------------------------------


class Sentences:
    """Which ids end sentences, by the vocabulary's strings."""

    def __init__(self, whole):
        vocab = whole.get_vocab()
        self.ends, self.closes, self.digit, self.short = (np.zeros(max(vocab.values()) + 1, bool) for _ in range(4))
        for token, i in vocab.items():
            if not token.endswith(WORD_END):
                continue
            word = token[: -len(WORD_END)]
            marks = bool(word) and all(c in ENDS or c in CLOSERS for c in word)
            self.ends[i] = marks and any(c in ENDS for c in word)
            self.closes[i] = marks and not self.ends[i]
            self.digit[i] = word.isdigit()
            self.short[i] = word in SHORT.split() or (len(word) == 1 and word.isalpha())

    def after(self, ids: np.ndarray) -> np.ndarray:
        """Ascending places after ids that end a sentence, marks that close it included; a stop between figures or after a short form is none."""
        if not len(ids):
            return np.empty(0, np.int64)
        end = self.ends[ids]
        before, behind = np.append(False, self.digit[ids[:-1]]), np.append(self.digit[ids[1:]], False)
        end &= ~(before & behind) & ~np.append(False, self.short[ids[:-1]])
        at = np.flatnonzero(end)
        past = at + 1
        for _ in range(3):  # ." or .) and the like
            more = past < len(ids)
            more[more] = self.closes[ids[past[more]]] | self.ends[ids[past[more]]]
            past = past + more
        return np.unique(past)


def cut_points(size: int, docs: np.ndarray, sentences: np.ndarray, params: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(places, penalties): where a stream of ids may be cut, ascending, from 0 to size; docs are documents' ends."""
    told = np.unique(np.concatenate((np.zeros(1, np.int64), docs, sentences[(sentences > 0) & (sentences < size)])))
    gaps = np.diff(told)
    extra = (gaps - 1) // params.stretch
    base = np.repeat(told[:-1], extra)
    nth = np.arange(len(base)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    places = np.concatenate((told, base + nth * params.stretch))
    price = np.concatenate((np.full(len(told), params.sentence), np.full(len(base), params.inside)))
    price[: len(told)][np.isin(told, docs, assume_unique=True)] = 0
    order = np.argsort(places, kind="stable")
    return places[order], price[order]


def windows(places: np.ndarray, price: np.ndarray, params: Windows) -> list[int]:
    """The chosen cuts, as numbers of places, the first and last included; no gap between places is beyond the capacity."""
    count, capacity = len(places), params.capacity
    number = np.full(int(places[-1]) + 1, -1, np.int32)
    number[places] = np.arange(count)
    powers = [1 << k for k in range(capacity.bit_length()) if 1 << k <= capacity]
    powers.reverse()  # longer windows first
    pairs = []
    for p in powers:
        j = np.flatnonzero(places >= p)
        i = number[places[j] - p]
        held = i >= 0
        pairs.append(np.stack((j[held], i[held])))
    js, is_ = np.concatenate(pairs, axis=1)
    order = np.argsort(js, kind="stable")
    js, is_ = js[order], is_[order].tolist()
    begin = np.searchsorted(js, np.arange(count + 1)).tolist()

    at, cost = places.tolist(), price.tolist()
    f, source = [0] * count, [0] * count
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (f + place, place, number)
    for j in range(1, count):
        p = at[j]
        while queue[0][1] < p - capacity:
            queue.popleft()
        least, _, i = queue[0]
        best, n = least + capacity - p, i
        for m in range(begin[j], begin[j + 1]):
            i = is_[m]
            if f[i] < best or (f[i] == best and i < n):
                best, n = f[i], i
        best += params.window + cost[j]
        f[j], source[j] = best, n
        value = best + p
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, p, j))
    out = [count - 1]
    while out[-1]:
        out.append(source[out[-1]])
    return out[::-1]


# ---- pieces -----------------------------------------------------------------------


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all lines in a row, how many each text has); a text has one at least."""
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    return split.flatten(), np.maximum(1, np.diff(split.offsets.to_numpy()))


def encoded(enc, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids in a row, sizes of texts, places after lines); white space is dropped by the vocabulary, so lines' ids are the text's."""
    lines, count = _lines(texts)
    ids, sizes = enc.encode_block(lines)
    ends = np.cumsum(sizes)
    last = np.cumsum(count) - 1
    extra = np.ones(len(sizes), bool)
    extra[last] = False
    kept = np.ones(len(ids), bool)
    kept[ends[extra] - 1] = False  # the end id of a line that isn't a text's last
    past = ends - np.cumsum(extra)
    return ids[kept], np.diff(np.concatenate(([0], past[last]))), past[extra]


def _cut(params: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(params.vocabulary, params.end_id)
        found, serial = Sentences(enc.whole), TaskContext.get().partitionId() << 40
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            row = 0
            while row < len(batch):
                before = int(ends[row - 1]) if row else 0
                past = max(row + 1, int(np.searchsorted(ends, before + params.block_bytes, "right")))
                ids, sizes, lines = encoded(enc, batch.column(1).slice(row, past - row))
                docs = np.cumsum(sizes)
                places, price = cut_points(len(ids), docs, np.concatenate((lines, found.after(ids))), params)
                bounds = places[windows(places, price, params)]
                starts = np.union1d(docs[:-1], bounds[:-1])
                if not len(starts) or starts[0]:
                    starts = np.append(0, starts)
                lens = np.diff(np.append(starts, len(ids)))
                doc = np.searchsorted(docs, starts, "right")
                window = np.searchsorted(bounds, starts, "right") - 1
                flat = memoryview(ids.astype("<u4")).cast("B")
                crcs = [zlib.crc32(flat[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), lens.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, past - row).take(pa.array(doc)), pa.array(starts - (docs - sizes)[doc]), pa.array(lens), pa.array(crcs, pa.int64()), pa.array(sizes[doc]),
                     pa.array(window + serial), pa.array(starts - bounds[window])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
                serial += len(bounds) - 1
                row = past

    return run


def pack_in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Windows = Windows()) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    if params.stretch > params.capacity:
        raise ValueError("stretch is beyond the capacity")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_cut(params), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op12_order_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window and place of every piece of every document."""
    return pack_in_order(table(spark, sf_dir, "documents").select("doc_id", "text"))
