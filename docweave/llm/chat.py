"""Quotation linking: conversations in reply order, without quotes.

A message's lines that begin with quote marks ("> ", nested as ">>" or "> >")
form passages: neighbouring lines of one level. Each passage is normalised
(marks off, small letters, white space as one blank) and hashed, whole and line
by line; so is every message's own text. Passages are joined to the earliest
message of the conversation that has the same hash and comes before; the whole
passage counts first, then its lines that say enough, then the short ones. A
message replies to the original of its shallowest linked passage, the latest of
several. A passage that links to nothing isn't lost: it stands in `unlinked`.

Only the first turn of each (conversation, hash) is kept, by a partial
aggregate, so one very long conversation or one very common line never has to
fit a task, and a lookup meets one row at most. Threads are found by pointer
doubling over the links: a message's thread is the turn its chain of replies
begins at. `position` numbers the messages of a conversation in reply order
(thread, then turn), by a range sort that splits long conversations.

Nulls and odd rows: a null text is empty; messages without a conversation or
turn are never linked, and null conversations are numbered as one; repeated rows
stay, each with the same link; ties on a turn are linked to by their common
turn and numbered in any order; a very long text is parsed whole, line by line;
columns beside the four named ones may have any name and are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators.ordering import positions
from docweave.storage import scratch, table

MARKED = re.compile(r"\s*((?:>[ \t]?)+)(.*)", re.S)
#: The last word of a line that introduces a quote, in the languages of the corpus.
INTRODUCTION = re.compile(r"(?:\bwrote|\bsaid|\bschrieb(?:en)?|a écrit|\bescribió)\s*:\s*$", re.I)


@dataclass(frozen=True)
class Linking:
    """min_chars: normalised characters from which on a single line says enough to be looked up before shorter ones."""

    min_chars: int = 12
    template: str = "<|{role}|>\n{text}"


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def parse(text: str | None) -> tuple[str, list[tuple[int, list[str]]]]:
    """(the message's own text, its passages as (level, lines)), in order."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    level = 0
    for line in (text or "").split("\n"):
        m = MARKED.fullmatch(line)
        now = m[1].count(">") if m else 0
        if m:
            if level == 0 and own and INTRODUCTION.search(own[-1]):
                own.pop()
            if now != level:
                passages.append((now, []))
            passages[-1][1].append(m[2])
        elif not (level and not line.strip() and own and not own[-1].strip()):
            own.append(line)
        level = now
    if passages:
        return "\n".join(own).strip("\n"), passages
    return text or "", passages


def _hash(text: str) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def hashes(text: str, params: Linking) -> list[int]:
    """The hash of the whole text, then of its lines, those that say enough first; none for an empty text."""
    whole = normalise(text)
    if not whole:
        return []
    lines = [n for x in text.split("\n") if (n := normalise(x))]
    return list(dict.fromkeys(_hash(x) for x in [whole, *sorted(lines, key=lambda n: len(n) < params.min_chars)]))


def _parse(params: Linking):
    passage = pa.struct([("level", pa.int32()), ("text", pa.string()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owns, found, units = [], [], []
            for text in batch.column(batch.num_columns - 1):
                own, passages = parse(text.as_py())
                owns.append(own)
                units.append(hashes(own, params))
                found.append([{"level": level, "text": "\n".join(lines), "hashes": hashes("\n".join(lines), params)} for level, lines in passages])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(owns, pa.string()), pa.array(found, pa.list_(passage)), pa.array(units, pa.list_(pa.int64()))],
                [*batch.schema.names[:-1], "own", "passages", "units"])

    return run


def quote_links(parsed: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, linked): one row for each message with a linked passage; linked holds the places of its linked passages."""
    known = parsed.where("conv IS NOT NULL AND turn IS NOT NULL")
    firsts = known.select("conv", "turn", F.explode("units").alias("h")).groupBy("conv", "h").agg(F.min("turn").alias("origin"))
    asked = known.where(F.size("passages") > 0).select("conv", "turn", F.posexplode("passages").alias("p", "passage")).select(
        "conv", "turn", "p", "passage.level", F.posexplode("passage.hashes").alias("rank", "h")).distinct()
    hits = asked.join(firsts, ["conv", "h"]).where("origin < turn")
    each = hits.groupBy("conv", "turn", "p", "level").agg(F.min_by("origin", "rank").alias("origin"))
    return each.groupBy("conv", "turn").agg(
        F.max_by("origin", F.struct(-F.col("level"), "origin")).alias("reply_to"), F.collect_set("p").alias("linked"))


def threads(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(conv, turn, thread): where each linked message's chain of replies begins, by pointer doubling."""
    cur = scratch(links.select("conv", "turn", F.col("reply_to").alias("thread")), "threads")
    for _ in range(rounds):
        up = cur.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("above"))
        moved = scratch(cur.join(up, ["conv", "thread"], "left").select(
            "conv", "turn", F.coalesce("above", "thread").alias("thread"), F.col("above").isNotNull().alias("moved")), "threads")
        cur = moved.select("conv", "turn", "thread")
        if not moved.where("moved").head(1):
            return cur
    raise RuntimeError("reply chains did not end")


def conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", params: Linking = Linking()) -> DataFrame:
    """Every message without its quotes, with what it replies to, its thread, and its text as a chat turn."""
    rows = messages.select(*[F.col(f"`{c}`").alias(n) for c, n in ((conv_col, "conv"), (turn_col, "turn"), (role_col, "role"))], F.col(f"`{text_col}`").cast("string").alias("text"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("conv", "turn", "role"))
    parsed = scratch(rows.mapInArrow(_parse(params), f"{kinds}, own string, passages array<struct<level:int,text:string,hashes:array<long>>>, units array<long>"), "parsed")
    links = scratch(quote_links(parsed), "quote-links")
    placed = links.join(threads(links), ["conv", "turn"])
    role = F.coalesce(F.col("role"), F.lit("user"))
    before, _, rest = params.template.partition("{role}")
    between, _, after = rest.partition("{text}")
    linked = F.coalesce("linked", F.array().cast("array<int>"))
    unlinked = F.filter("passages", lambda x, i: ~F.array_contains(linked, i))
    joined = parsed.join(placed, ["conv", "turn"], "left").select(
        "conv", "turn", "role", "own", F.size("passages").cast("long").alias("n_passages"), F.size(linked).cast("long").alias("n_linked"), "reply_to",
        F.coalesce("thread", "turn").alias("thread"), F.transform(unlinked, lambda x: x["text"]).alias("unlinked"),
        F.concat(F.lit(before), role, F.lit(between), F.col("own"), F.lit(after)).alias("chat"))
    return positions(joined, "position", ["thread", "turn"], ["conv"]).select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("own").alias(text_col),
        "n_passages", "n_linked", "reply_to", "thread", "position", "unlinked", "chat")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, message by message."""
    return conversations(table(spark, sf_dir, "conversations"))

