"""Pigeonhole edit matching: finds benchmark items in documents within an edit budget.

Both sides are put in lower case with white space runs as one blank. An item of
n characters may differ by k = floor(rate * n) edits. It is split into k + 1
pieces, or k + 2 to make them even: some piece is then untouched, and of the
pairs of neighbouring pieces one holds at most one edit. Exact piece hits come
from one automaton over all items; a hit goes on only if its pair lies there
with at most one edit; the whole item is then verified in the text around the
hit. Both checks use Myers' bit-parallel distance (1999) with the text's ends
free.

Items are a stated query set: they are read in blocks of bounded size, each
block is broadcast, and all documents are scanned once per block.

Items of fewer than `min_chars` characters leave no room for edits: they are
found where they stand as whole words, exactly. Such a match says little, so it
is reported, but a document isn't removed for it.

Nulls and odd rows: a null or empty text or item matches nothing;
repeated items and repeated documents each get their own rows; of places with
equal distance the first counts; null ids are kept; very long texts are searched
whole; columns of the user may have any name; an empty table on either side
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.storage import table


@dataclass(frozen=True)
class Budget:
    """rate: edits per character of an item; block_chars: the most benchmark text broadcast at once."""

    rate: float = 0.08
    min_chars: int = 24
    block_chars: int = 4_000_000


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def masks(pattern: str) -> dict[str, int]:
    """For each character, its places in the pattern as bits."""
    found: dict[str, int] = {}
    for i, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << i
    return found


def myers(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to any part of text, and where the first such part ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        flat = eq | down
        eq |= (((eq & up) + up) ^ up) & full
        plus = down | (full & ~(eq | up))
        minus = up & eq
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | (full & ~(flat | plus))
        down = plus & flat
        if score < best:
            best, at = score, j
    return best, at


class Matcher:
    """All items of a block, ready to be searched in one pass over a text."""

    def __init__(self, items: list[tuple[object, str]], budget: Budget, short: bool = True):
        import ahocorasick

        self.items = []
        self.short: dict[str, list] = {}
        where: dict[str, list[tuple[int, int, int, int]]] = {}
        for item_id, raw in items:
            text = normalise(raw)
            if not text or (len(text) < budget.min_chars and not short):
                continue
            if len(text) < budget.min_chars:
                self.short[text] = [*self.short.get(text, ()), item_id]
                continue
            k = int(len(text) * budget.rate)
            count = max(2, k + 1 + (k + 1) % 2)
            cuts = [len(text) * i // count for i in range(count + 1)]
            n = len(self.items)
            self.items.append((item_id, text, k, masks(text), masks(text[::-1])))
            for i in range(count):
                pair = i - i % 2
                where.setdefault(text[cuts[i] : cuts[i + 1]], []).append((n, cuts[i], cuts[pair], cuts[pair + 2]))
        self.where = where
        self.pairs: dict[tuple[int, int], dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in {**where, **self.short}:
            self.automaton.add_word(piece, piece)
        if where or self.short:
            self.automaton.make_automaton()

    def _pair_fits(self, text: str, n: int, start: int, a: int, b: int) -> bool:
        pattern = self.items[n][1][a:b]
        allowed = min(1, self.items[n][2])
        from_ = max(0, start - 1)
        if text.startswith(pattern, max(0, start)):
            return True
        if not allowed:
            return False
        peq = self.pairs.get((n, a))
        if peq is None:
            peq = self.pairs[n, a] = masks(pattern)
        return myers(peq, len(pattern), text[from_ : start + len(pattern) + 1])[0] <= allowed

    def find(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, distance, start, end) for each item within its budget: its best place, the first of ties."""
        if not (self.where or self.short) or not text:
            return []
        places: dict[int, list[int]] = {}
        found = []
        seen: set[str] = set()
        for last, piece in self.automaton.iter(text):
            begin = last + 1 - len(piece)
            if piece in self.short and piece not in seen and not (text[begin - 1 : begin].isalnum() or text[last + 1 : last + 2].isalnum()):
                seen.add(piece)
                found += [(item_id, 0, begin, last + 1) for item_id in self.short[piece]]
            for n, offset, a, b in self.where.get(piece, ()):
                at = begin - offset
                known = places.setdefault(n, [])
                if known and at in known[-8:]:
                    continue
                if self._pair_fits(text, n, at + a, a, b):
                    known.append(at)
        for n, starts in places.items():
            item_id, pattern, k, ahead, back = self.items[n]
            best: tuple[int, int, int] | None = None
            spans: list[list[int]] = []
            for s in sorted(starts):
                lo, hi = max(0, s - k), min(len(text), s + len(pattern) + k)
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = max(hi, spans[-1][1])
                else:
                    spans.append([lo, hi])
            for lo, hi in spans:
                at = text.find(pattern, lo, hi)
                if at >= 0:
                    hit = (0, at, at + len(pattern))
                else:
                    d, end = myers(ahead, len(pattern), text[lo:hi])
                    if d > k:
                        continue
                    stop = lo + end
                    _, length = myers(back, len(pattern), text[max(lo, stop - len(pattern) - k) : stop][::-1])
                    hit = (d, stop - length, stop)
                if best is None or hit < best:
                    best = hit
            if best is not None:
                found.append((item_id, *best))
        return found


def _search(items, budget: Budget):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, budget)
        for batch in batches:
            rows, out = [], []
            for i, text in enumerate(batch.column(1)):
                for hit in matcher.find(normalise(text.as_py())):
                    rows.append(i)
                    out.append(hit)
            if rows:
                item, distance, start, end = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(item), *(pa.array(x, pa.int64()) for x in (distance, start, end))],
                    ["id", "item", "distance", "start", "end"])

    return run


def _blocks(items: DataFrame, budget: Budget) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of bounded text; an item is the unit, so one longer item makes a block of its own."""
    block: list[tuple[object, str]] = []
    size = 0
    for row in items.toLocalIterator():
        if size > 0 and size + len(row["text"]) > budget.block_chars:
            yield block
            block, size = [], 0
        block.append((row["item"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", budget: Budget = Budget()) -> DataFrame:
    """(id, item, distance, start, end) for each document and each item in it; places count characters of the normalised text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")).where("text IS NOT NULL")
    id_type, item_type = (x.schema[c].dataType.simpleString() for x, c in ((rows, "id"), (items, "item")))
    schema = f"id {id_type}, item {item_type}, distance long, start long, end long"
    spark = docs.sparkSession
    out = None
    for block in _blocks(items, budget):
        found = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), budget), schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _clean_only(items, budget: Budget, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, budget, short=False)
        for batch in batches:
            clean = [not matcher.find(normalise(t.as_py())) for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", budget: Budget = Budget()) -> DataFrame:
    """The rows of docs that hold no item of min_chars or more, in their own columns; nothing is shuffled."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")).where("text IS NOT NULL")
    out = docs
    for block in _blocks(items, budget):
        out = out.mapInArrow(_clean_only(docs.sparkSession.sparkContext.broadcast(block), budget, docs.columns.index(text_col)), docs.schema)
    return out


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item in each document that holds it, with its distance and place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "distance", "start", "end")
