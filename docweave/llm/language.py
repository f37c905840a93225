"""Cross-parsing entropy: language by how few phrases of a language's text make up a document.

For each language a suffix automaton is built over a bounded sample of its
labelled text: all labelled texts are cut into passages of `passage` characters,
and those of least hash are taken, equal ones once, so that any part of any text
may be learned and copies of one text don't crowd out others. A document is parsed greedily into the longest phrases that
occur in that sample (a character that never occurs there is a phrase of its
own). With n sampled characters a phrase costs about log2(n) bits to point at,
so phrases * log2(n) is the normalised count; the language with the least wins.

The automata are laid out as one table (state, character class) -> state with a
mark where a new phrase begins, so a task parses thousands of texts side by
side, one character of each at a time, for all languages at once. Longer texts
are parsed in pieces, which adds a phrase a piece for every language alike.

Nulls and odd rows: `und` with score 0 for a null text or one without a letter,
and for every row if nothing could be learned; rows with a null language teach
nothing; repeated rows each get the same answer; of languages with equal counts
the first by name wins; very long texts are parsed whole, piece by piece; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.storage import table

UND = "und"


@dataclass(frozen=True)
class Parsing:
    """Bounds of what is learned, and how texts are laid side by side.

    sample_chars of each language are learned (fewer if all languages' tables
    would take more than table_bytes), in passages of `passage` characters;
    piece: characters parsed in a row before a new piece begins.
    """

    sample_chars: int = 24_000
    passage: int = 1500
    table_bytes: int = 1 << 28
    piece: int = 512
    block_bytes: int = 1 << 21


def clean(text: str) -> str:
    """Small letters, each run of anything else as one blank."""
    out = "".join(c if c.isalpha() else " " for c in text.lower())
    return " ".join(out.split())


class SuffixAutomaton:
    """All substrings of one string; next[s] maps a character class to the state after it."""

    def __init__(self, codes: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        last = 0
        for c in codes:
            last = self._extend(last, c)

    def _extend(self, last: int, c: int) -> int:
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            if self.length[p] + 1 == self.length[q]:
                self.link[new] = q
            else:
                copy = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p >= 0 and self.next[p].get(c) == q:
                    self.next[p][c] = copy
                    p = self.link[p]
                self.link[q] = self.link[new] = copy
        return new


@dataclass
class Model:
    """table: all automata, width columns a state, a negative entry (-state - 1) where a new phrase begins."""

    languages: list[str]
    classes: np.ndarray
    width: int
    table: np.ndarray
    roots: np.ndarray
    bits: np.ndarray


#: Bytes of letters, and of blanks; every other byte of clean text is part of a letter beyond ASCII.
def byte_classes(samples: list[bytes]) -> tuple[np.ndarray, int]:
    """A class per byte: those seen in any sample have their own, all others share class 0."""
    seen = sorted(set().union(*samples)) if samples else []
    classes = np.zeros(256, np.uint8)
    for i, b in enumerate(seen, 1):
        classes[b] = min(i, 255)
    return classes, min(len(seen), 255) + 1


def fit(samples: dict[str, str]) -> Model:
    """samples: language -> cleaned text."""
    languages = sorted(k for k, v in samples.items() if v)
    raw = [samples[k].encode() for k in languages]
    classes, width = byte_classes(raw)
    tables, roots, base = [], [], 0
    for text in raw:
        sam = SuffixAutomaton(classes[np.frombuffer(text, np.uint8)].tolist())
        count = len(sam.next)
        first = np.full(width, -1, np.int64)  # a class unseen here: a phrase of one character, back at the root
        for c, s in sam.next[0].items():
            first[c] = -s - 1
        cells = np.tile(first, (count, 1))
        cells[cells < 0] -= base
        rows = np.fromiter((s for s, n in enumerate(sam.next) for _ in n), np.int64)
        cols = np.fromiter((c for n in sam.next for c in n), np.int64)
        to = np.fromiter((t for n in sam.next for t in n.values()), np.int64)
        cells[rows, cols] = to + base
        cells[0] = first - base
        tables.append(cells.astype(np.int32))
        roots.append(base)
        base += count
    bits = np.array([math.log2(max(2, len(t))) for t in raw])
    joined = np.concatenate(tables) if tables else np.empty((0, width), np.int32)
    # Entries hold the row's offset in the flat table, so a step is one addition and one lookup.
    flat = np.where(joined < 0, -((-joined.astype(np.int64) - 1) * width) - 1, joined.astype(np.int64) * width)
    return Model(languages, classes, width, flat.astype(np.int32).ravel(), np.array(roots, np.int32) * width, bits)


def phrases(model: Model, pieces: list[np.ndarray], steps: int) -> np.ndarray:
    """(piece, language) phrase counts; pieces are byte classes, at most steps long each."""
    order = np.argsort([-len(p) for p in pieces], kind="stable")
    sizes = np.array([len(pieces[i]) for i in order])
    codes = np.zeros((steps, len(pieces)), np.int32)
    for col, i in enumerate(order.tolist()):
        codes[: sizes[col], col] = pieces[i]
    langs = len(model.languages)
    state = np.repeat(model.roots[:, None], len(pieces), axis=1)
    count = np.zeros((langs, len(pieces)), np.int32)
    live = np.searchsorted(-sizes, -np.arange(1, steps + 1), "right")
    for t in range(steps):
        n = int(live[t])
        if n == 0:
            break
        cell = model.table.take(state[:, :n] + codes[t, :n])
        new = cell < 0
        count[:, :n] += new
        np.bitwise_xor(cell, -new.astype(np.int32), out=cell)  # ~x = -x - 1 where a phrase began
        state[:, :n] = cell
    out = np.empty((len(pieces), langs), np.int64)
    out[order] = count.T
    return out


def _flatten(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], np.uint8) if flat.buffers()[2] is not None and flat.buffers()[2].size else np.empty(0, np.uint8)
    return data, offsets


def classify(model: Model, texts: pa.Array, params: Parsing) -> tuple[list[str], list[float]]:
    """Language and score of each text; the score is the share by which the winner needs fewer bits than the next."""
    if not model.languages:
        return [UND] * len(texts), [0.0] * len(texts)
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    cleaned = pc.replace_substring_regex(lowered, r"[^\p{L}]+", " ")
    lettered = pc.match_substring_regex(cleaned, r"\p{L}").to_numpy(zero_copy_only=False)
    data, offsets = _flatten(pc.utf8_trim_whitespace(cleaned))
    codes = model.classes[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    total = np.zeros((len(texts), len(model.languages)), np.int64)
    row = 0
    while row < len(texts):
        past = max(row + 1, int(np.searchsorted(offsets, offsets[row] + params.block_bytes, "right")) - 1)
        # A text longer than a block makes one block; its pieces still go side by side, block by block.
        pieces, owner = [], []
        for i in range(row, past):
            for a in range(int(offsets[i]), int(offsets[i + 1]), params.piece):
                pieces.append(codes[a : min(a + params.piece, int(offsets[i + 1]))])
                owner.append(i)
        most = max(1, params.block_bytes // params.piece) * 2
        for a in range(0, len(pieces), most):
            np.add.at(total, np.array(owner[a : a + most]), phrases(model, pieces[a : a + most], params.piece))
        row = past
    cost = total * model.bits
    best = cost.argmin(axis=1)
    rank = np.sort(cost, axis=1)
    second = rank[:, 1] if rank.shape[1] > 1 else rank[:, 0] * 2
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(second > 0, 1 - rank[:, 0] / second, 0.0)
    langs = [model.languages[b] if ok else UND for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
    return langs, np.where(lettered, score, 0.0).tolist()


def _predict(model, params: Parsing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = max(1, len(batch) * 8 * params.block_bytes // max(1, batch.nbytes))
            for at in range(0, len(batch), size):
                part = batch.slice(at, size)
                langs, scores = classify(model.value, part.column(part.num_columns - 1), params)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*part.schema.names[:-1], "lang_pred", "score"])

    return run


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", params: Parsing = Parsing()) -> Model:
    """A model from about sample_chars of each language, in the passages of least hash.

    A bound on the hash that should leave about four times what is needed comes
    from an estimate of the different passages; where it leaves too little it is
    widened. Passages below it are made distinct by a partial aggregate, so
    neither the shuffle nor what comes to the driver follows the input.
    """
    rows = labelled.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    cut = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(f"(?s).{{1,{params.passage}}}"), F.lit(0))
    rows = rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.explode(cut).alias("t")).select("lang", "t", F.xxhash64("t").alias("h"))
    wanted = -(-params.sample_chars // params.passage)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    share = {lang: 4.0 * wanted / max(1, n) for lang, n in counts.items()}
    unit = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    # The widest table: two states a byte, and a column of four bytes for each byte class.
    chars = max(params.passage, min(params.sample_chars, params.table_bytes // (8 * 256 * max(1, len(counts)))))
    samples: dict[str, str] = {}
    while share:
        keep = F.lit(False)
        for lang, part in share.items():
            keep = keep | ((F.col("lang") == lang) & (unit <= part))
        found = rows.where(keep).groupBy("lang", "h").agg(F.min("t").alias("t"))
        found = found.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("h", "t"))).alias("rows")).collect()
        for r in found:
            parts, size = [], 0
            for x in r["rows"]:
                if size < chars and (t := clean(x["t"])):
                    parts.append(t)
                    size += len(t) + 1
            samples[r["lang"]] = " ".join(parts)
        share = {lang: 8 * part for lang, part in share.items() if part < 1 and len(samples.get(lang, "")) < chars}
    return fit(samples)


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", params: Parsing = Parsing()) -> DataFrame:
    """The columns in keep, with lang_pred and score."""
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("_text"))
    kinds = ", ".join(f"_k{i} {inner.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = inner.mapInArrow(_predict(shared, params), f"{kinds}, lang_pred string, score double")
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows whose crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = learn(docs.where(~held))
    return identify(docs.withColumn("held_out", held), model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"))
