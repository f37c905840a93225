"""The decision provider as a relation: questions in, answers out, each asked once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.ids import sha_id, short_key

ANSWERS = "cache_key string, question string, kind string, p double, choice string, score double, levels int"


@dataclass(frozen=True)
class Question:
    """kind: noul (yes or no), choice (of options) or score (of levels).

    For fanned: text is the wording (the name if empty; {part} stands for the
    part), fan asks it for each part, options_from names a column of the items
    that holds the options.
    """

    name: str
    kind: str = "noul"
    options: tuple[str, ...] = ()
    levels: int = 0
    text: str = ""
    fan: bool = False
    options_from: str | None = None


def render(items: DataFrame, question_set: str, questions: Sequence[Question], model: str = "offline") -> DataFrame:
    """One row for each item (item_id, state) and question, with the key its answer is cached under."""
    asked = F.array(*[F.struct(F.lit(q.name).alias("question"), F.lit(q.kind).alias("kind"), F.array(*[F.lit(o) for o in q.options]).cast("array<string>").alias("options"), F.lit(q.levels).alias("levels")) for q in questions])
    rows = items.select("item_id", "state", F.explode(asked).alias("q")).select("item_id", "state", "q.*")
    return rows.withColumn("cache_key", sha_id(F.lit(model), F.lit(question_set), "state", "question", F.to_json("options")))


def fanned(items: DataFrame, parts: DataFrame, question_set: str, questions: Sequence[Question], model: str = "offline") -> DataFrame:
    """One row for each item and question, and for each part of an item where the question fans out; in render's columns, with logical, part and key.

    items: (item_id, state, and columns of options); parts: (item_id, part, only),
    where only lists the questions that are asked of a part, null all of them.
    key is opaque: it tells neither the question nor the part to whoever answers.
    A question with no options to choose from isn't asked.
    """
    every = None
    for q in questions:
        rows = items.withColumn("part", F.lit(None).cast("string"))
        if q.fan:
            some = parts.where(F.col("only").isNull() | F.array_contains("only", q.name)).select("item_id", F.col("part").cast("string").alias("part")).where("part IS NOT NULL").distinct()
            rows = items.join(some, "item_id")
        options = F.col(q.options_from) if q.options_from else F.array(*[F.lit(o) for o in q.options])
        wording = F.replace(F.lit(q.text or q.name), F.lit("{part}"), F.coalesce("part", F.lit("")))
        asked = rows.select(
            "item_id", "state", wording.alias("question"), F.lit(q.kind).alias("kind"), options.cast("array<string>").alias("options"), F.lit(q.levels).alias("levels"), F.lit(q.name).alias("logical"), "part",
            short_key(sha_id(F.lit(question_set), F.lit(q.name), F.coalesce("part", F.lit("")))).alias("key"))
        if q.kind == "choice":
            asked = asked.where(F.size("options") > 0)
        every = asked if every is None else every.unionByName(asked)
    return every.withColumn("cache_key", sha_id(F.lit(model), F.lit(question_set), "state", "question", F.to_json("options")))


def packed(asked: DataFrame, window: int, most: int = 1 << 30, longest: int = 1 << 30, by: str = "state") -> DataFrame:
    """Questions of one state numbered into as few calls as its window of estimated tokens takes, in the order of question and key.

    A call holds the state once and at most `most` questions. A state or a
    question that is too long alone is an error.
    """
    size = lambda c: F.ceil(F.char_length(c) / 4).cast("long")
    room = F.lit(window) - size(F.col(by))
    n = size(F.concat_ws(" ", F.col("question"), F.array_join("options", " ")))
    each = asked.select(F.col(by).alias("state"), "question", "cache_key", n.alias("n"), room.alias("room")).distinct()
    too_long = (F.col("n") > F.col("room")) | (F.col("n") > longest) | (F.col("room") <= 0)
    checked = each.withColumn("n", F.when(too_long, F.raise_error(F.lit("a state or question is over the window")).cast("long")).otherwise(F.col("n")))
    ordered = checked.repartition("state").sortWithinPartitions("state", "question", "cache_key", "n")
    kinds = {f.name: f.dataType.simpleString() for f in checked.schema}
    calls = ordered.mapInArrow(_numbered(most), f"state {kinds['state']}, cache_key {kinds['cache_key']}, call long")
    return asked.join(calls.withColumnRenamed("state", by), [by, "cache_key"])


def _numbered(most: int):
    """Calls of rows (state, cache_key, n, room) that come by in order; of a state only its last call so far is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began, state, used, held, call = False, None, 0, 0, 0
        for batch in batches:
            out = []
            for s, n, room in zip(*(batch.column(c).to_pylist() for c in ("state", "n", "room")), strict=True):
                if not began or s != state:
                    began, state, used, held, call = True, s, 0, 0, 0
                if held and ((room is not None and used + n > room) or held >= most):
                    used, held, call = 0, 0, call + 1
                used, held = used + n, held + 1
                out.append(call)
            yield pa.RecordBatch.from_arrays([batch.column("state"), batch.column("cache_key"), pa.array(out, pa.int64())], ["state", "cache_key", "call"])

    return run


def hierarchical(items: DataFrame, question_set: str, name: str, tree: dict[str, Sequence[str]], provider: Callable | None = None, model: str = "offline") -> DataFrame:
    """(item_id, parent, choice): a choice among too many options in two steps, first among the parents, then among the children of the chosen one.

    A parent with one child needs no second question. tree is configuration, and small.
    """
    ask = provider or offline
    first = render(items, question_set, [Question(name, "choice", tuple(tree))], model)
    parents = valid(first, answer(first, provider=ask)).select("item_id", F.col("choice").alias("parent"))
    children = parents.sparkSession.createDataFrame([(p, list(c)) for p, c in tree.items()], "parent string, children array<string>")
    chosen = items.join(parents, "item_id").join(F.broadcast(children), "parent")
    lone = chosen.where(F.size("children") == 1).select("item_id", "parent", F.get("children", F.lit(0)).alias("choice"))
    more = chosen.where(F.size("children") > 1)
    asked = more.select("item_id", "state", F.concat_ws("/", F.lit(name), "parent").alias("question"), F.lit("choice").alias("kind"), F.col("children").alias("options"), F.lit(0).alias("levels"), "parent")
    asked = asked.withColumn("cache_key", sha_id(F.lit(model), F.lit(question_set), "state", "question", F.to_json("options")))
    said = valid(asked, answer(asked, provider=ask)).select("item_id", "choice")
    return lone.unionByName(more.select("item_id", "parent").join(said, "item_id"))


def offline(question: str, kind: str, options: Sequence[str], levels: int, state: str) -> tuple[float | None, str | None, float | None]:
    """An answer that depends on the question and state alone: by hash, yes in nine of ten, the first real option, the top level."""
    h = int(hashlib.sha256(f"{question}\x1f{state}".encode()).hexdigest()[:8], 16)
    if kind == "noul":
        return (0.97 if h % 10 else 0.02), None, None
    if kind == "choice":
        real = [o for o in options if o not in ("none", "neither", "other")]
        return None, (real or list(options) or [None])[0], None
    return None, None, float(max(levels - 1, 0))


def _ask(provider: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = [provider(r["question"], r["kind"], r["options"], r["levels"], r["state"]) for r in rows]
            yield pa.RecordBatch.from_pydict({
                "cache_key": [r["cache_key"] for r in rows], "question": [r["question"] for r in rows], "kind": [r["kind"] for r in rows],
                "p": pa.array([o[0] for o in out], pa.float64()), "choice": pa.array([o[1] for o in out], pa.string()), "score": pa.array([o[2] for o in out], pa.float64()),
                "levels": pa.array([r["levels"] for r in rows], pa.int32())})

    return run


def answer(asked: DataFrame, known: DataFrame | None = None, provider: Callable = offline) -> DataFrame:
    """Answers to all that is asked: those known by key, and the provider's for the rest, each key asked once."""
    once = asked.select("cache_key", "question", "kind", "options", "levels", "state").dropDuplicates(["cache_key"])
    if known is not None:
        once = once.join(known.select("cache_key"), "cache_key", "left_anti")
    made = once.mapInArrow(_ask(provider), ANSWERS)
    return made if known is None else known.join(asked.select("cache_key").distinct(), "cache_key", "left_semi").unionByName(made)


def valid(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers that fit what was asked: a probability between 0 and 1, an option that was offered, a level there is."""
    both = asked.select("item_id", "cache_key", "options").join(answers, "cache_key")
    return both.where(F.coalesce(fits(), F.lit(False)))


def fits() -> Column:
    """The condition of valid, over an answer's columns and options."""
    return F.when(F.col("kind") == "noul", F.col("p").between(0, 1)).when(F.col("kind") == "choice", F.array_contains("options", F.col("choice"))).otherwise(F.col("score").between(0, F.col("levels") - 1))


def answer_maps(checked: DataFrame) -> DataFrame:
    """(item_id, answers): one map for each item, as gates read it."""
    value = F.struct("p", "choice", "score", F.lit(None).cast("map<string,double>").alias("probabilities"))
    return checked.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("question", value.alias("v")))).alias("answers"))
