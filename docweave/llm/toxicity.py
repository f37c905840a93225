"""Weighted finite-state pattern grammar: toxicity of clauses, not of isolated words.

A lexical transducer reads the words of a clause and writes marks: INSULT and
WEAK (stems learned from labelled rows), THREAT, TARGET, NEGATION and REPORT
(reported speech; fixed word lists), quote marks, or a dot. Four transducers over
marks are composed with each other (fst.compose):

- NEGATION rewrites an insult or a threat within three marks after a negation;
- REPORT rewrites an insult inside quotes after a word of reported speech, and a
  threat anywhere after one;
- TARGET parts insults and threats with a target in their clause, before or after
  them, from those without: it guesses at the word and only paths whose guess
  comes true can end;
- SCORE gives every pattern that is written its weight.

The best path of a clause's marks through the composed transducer names the
patterns of the clause. A text's score is the logistic of the pattern weights,
summed over log(1 + matches); the weights are fitted on the labelled sample. So
an insult that is negated, reported or aimed at somebody weighs differently
from a bare one. A bare insult has a weight of its own, which the labels decide.

Only clauses with an insult or a threat can emit anything, so a text is first
scanned once for those; clauses around hits are then transduced in full.

Learning takes a bounded sample of labelled rows (sample_rows of least id hash;
equal texts count once); everything is scored. Stems and patterns of the sample
are counted in the cluster, so no text comes to the driver. Labels, language,
source and id are never inputs of a score.

Nulls and odd rows: a null or empty text gets the score of a text without
matches; labels that are null or without a document teach nothing; repeated
rows get equal scores; of equally good stems the shorter one stands, and of
equally good paths the one whose arcs were added first; very long texts are
scanned whole; columns of the user may have any name; with no labelled rows the
seed weights stand; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.fst import Fst, compose
from docweave.storage import scratch, table

# Words of the transducers that are not learned.
THREATS = "kill hurt stab shoot strangle murder destroy töten umbringen schlagen tuer frapper matar golpear".split()
TARGETS = (
    "you your yours he him his she her they them their this these those people everyone "
    "du dich dir dein ihr euch sie er diese dieser tu toi te vous votre il elle ils elles ces cette "
    "tú ti usted ustedes él ella ellos ellas este esta estos"
).split()
NEGATIONS = "not no never neither nor cannot nicht kein keine nie niemals pas jamais aucun sin nunca jamás tampoco".split()
REPORTS = "said says say told called calls wrote quoted claimed alleged sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split()

PATTERNS = ("insult", "insult_target", "insult_negated", "insult_reported", "threat_target", "threat_negated", "threat_reported", "insult_weak")
#: Weights before any label is seen: bias first.
SEED_WEIGHTS = (-3.0, 4.0, 4.5, 1.0, 1.5, 3.0, 0.0, 0.0, 2.0)
#: Weak insults count by their rate in a thousand words (six characters each) of a text taken as this long at least.
LEAST_WORDS = 400
WORD = re.compile(r"[^\W\d_]+|[\"“”«»„.!?;\n]")
CLAUSE_END = re.compile(r"[.!?;\n]")
CLAUSE_ENDS = frozenset(".!?;\n")
DOTS = re.compile(r"\.{4,}")
QUOTES = frozenset("\"“”«»„")


@dataclass(frozen=True)
class Learning:
    """Bounds of the sample, and what makes a stem an insult."""

    sample_rows: int = 4000
    stem_lengths: tuple[int, ...] = (4, 5, 6, 7, 8)
    #: Texts that must hold a stem, or fewer if it comes again and again in them.
    support: int = 7
    least_support: int = 3
    mean_times: float = 1.8
    precision: float = 0.96
    weak_precision: float = 0.88


#: What the composed transducers write for each pattern.
WRITTEN = dict(zip("BAikVhmJ", PATTERNS, strict=True))
MARKS = ".TNRQIJH"
#: Marks after a negation that it reaches.
REACH = 3


def negation() -> Fst:
    out = Fst(0, final=dict.fromkeys(range(REACH + 1), 0.0))
    for left in range(REACH + 1):
        for m in MARKS:
            after = REACH if m == "N" else max(0, left - 1)
            out.arc(left, m, {"I": "i", "H": "h"}.get(m, m) if left else m, after)
    return out


def report() -> Fst:
    out = Fst("plain", final=dict.fromkeys(("plain", "said", "quoted", "open"), 0.0))
    for state in ("plain", "said", "quoted", "open"):  # open: inside quotes, nobody said to speak
        for m in MARKS + "ih":
            after, write = state, m
            if m == "R":
                after = "quoted" if state in ("quoted", "open") else "said"
            elif m == "Q":
                after = {"plain": "open", "open": "plain", "said": "quoted", "quoted": "said"}[state]
            elif m in "Ii" and state == "quoted":
                write = "k"
            elif m in "Hh" and state in ("said", "quoted"):
                write = "m"
            out.arc(state, m, write, after)
    return out


def target() -> Fst:
    """States: none yet; seen; ahead (promised, so that only a target leads to an end); never (denied, so that no target may come)."""
    out = Fst("none", final={"none": 0.0, "seen": 0.0, "never": 0.0})
    for m in MARKS + "ihkm":
        aimed, bare = {"I": ("A", "B"), "H": ("V", ".")}.get(m, (m, m))
        for state in ("none", "seen", "ahead", "never"):
            if m == "T":
                if state != "never":
                    out.arc(state, m, m, "seen")
            elif aimed == bare:
                out.arc(state, m, m, state)
            elif state == "none":
                out.arc(state, m, aimed, "ahead")
                out.arc(state, m, bare, "never")
            else:
                out.arc(state, m, bare if state == "never" else aimed, state)
    return out


def scores(weights: dict[str, float]) -> Fst:
    out = Fst(0, final={0: 0.0})
    for m in MARKS + "ihkmABV":
        out.arc(0, m, m if m in WRITTEN else ".", 0, weights.get(WRITTEN.get(m, ""), 0.0))
    return out


def clause_transducer(weights: dict[str, float] | None = None) -> Fst:
    """NEGATION, REPORT, TARGET and SCORE in one."""
    return reduce(compose, (negation(), report(), target(), scores(weights or {})))


@dataclass
class Grammar:
    """Insult stems and the weight of each pattern; everything else is fixed.

    A weak stem also begins harmless words now and then, so that only its rate
    in a text tells; it emits insult_weak whatever stands around it.
    """

    stems: list[str]
    weak: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.array(SEED_WEIGHTS))

    def __post_init__(self):
        self.marks: dict[str, str] = {}
        for mark, words in (("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("H", THREATS)):
            for w in words:
                self.marks.setdefault(w, mark)
        self.lengths = sorted({len(s) for s in [*self.stems, *self.weak]})
        self.by_stem = {s: "J" for s in self.weak} | {s: "I" for s in self.stems}
        heads = [re.escape(s) for s in self.by_stem] + [rf"{re.escape(w)}\b" for w in THREATS]
        self.transducer = clause_transducer(dict(zip(PATTERNS, self.weights[1:].tolist(), strict=True)))
        self.known: dict[str, tuple[int, ...]] = {}
        self.trigger = re.compile(rf"(?<![^\W\d_])(?:{tree(sorted(set(heads)))})") if heads else None

    def lexical(self, word: str) -> str:
        """The lexical transducers: a word's mark, or a dot."""
        if word in CLAUSE_ENDS:
            return "E"
        if word in QUOTES:
            return "Q"
        for n in self.lengths:
            if found := self.by_stem.get(word[:n]):
                return found
        return self.marks.get(word, ".")

    def clause(self, marks: str) -> tuple[int, ...]:
        """How often the best path of a clause's marks writes each pattern."""
        # What a mark does never reaches over more than REACH dots, so longer runs of dots are alike.
        short = DOTS.sub("." * (REACH + 1), marks)
        if short not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            _, written = self.transducer.best(short)
            self.known[short] = tuple(map(written.count, WRITTEN))
        return self.known[short]

    def patterns(self, text: str | None) -> list[int]:
        """How often each pattern is matched in the whole text."""
        counts = [0] * len(PATTERNS)
        if not text or self.trigger is None:
            return counts
        low = text.lower()
        done = 0
        for hit in self.trigger.finditer(low):
            if hit.start() < done:
                continue
            begin = max(low.rfind(c, done, hit.start()) for c in CLAUSE_ENDS) + 1 or done
            end = CLAUSE_END.search(low, hit.end())
            done = end.start() if end else len(low)
            found = self.clause("".join(map(self.lexical, WORD.findall(low, begin, done))))
            counts = [a + b for a, b in zip(counts, found, strict=True)]
        return counts

    def features(self, counts: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """What the weights apply to; counts by text and pattern."""
        x = counts.astype(float)
        x[:, 7] *= 1000 / np.maximum(chars / 6, LEAST_WORDS)
        return np.hstack([np.ones((len(x), 1)), np.log1p(x)])

    def score(self, counts: np.ndarray, chars: np.ndarray) -> np.ndarray:
        z = self.features(counts, chars) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def tree(patterns: list[str]) -> str:
    """Alternatives grouped by their first character, so most words fail at once."""
    heads: dict[str, list[str]] = {}
    for p in patterns:
        heads.setdefault(p[:1], []).append(p)
    return "|".join(f"{h}(?:{'|'.join(x[1:] for x in sorted(xs, key=len))})" if h != "\\" else "|".join(xs) for h, xs in sorted(heads.items()))


def stem_counts(text: str, params: Learning) -> Counter:
    """How often each stem (word beginning) comes in a text."""
    stems: Counter = Counter()
    for w, c in Counter(w for w in WORD.findall(text.lower()) if len(w) >= params.stem_lengths[0]).items():
        for n in params.stem_lengths:
            if n <= len(w):
                stems[w[:n]] += c
    return stems


def choose_stems(counts: dict[str, tuple[int, int, int, int, int]], params: Learning = Learning()) -> tuple[list[str], list[str]]:
    """Stems that mark toxic texts, strong and weak.

    counts: of each stem the toxic and the harmless texts that hold it, those
    that hold it twice, and its times in toxic texts (six a text at most).
    Strong: hardly any harmless text holds it. Weak: hardly any harmless text
    holds it twice.
    """

    def shortest(good: dict[str, int]) -> dict[str, int]:
        """Of a stem and its longer forms, the one that is as long as it can be without losing texts."""
        kept: dict[str, int] = {}
        for s in sorted(good, key=lambda s: (len(s), s)):
            short = next((s[:n] for n in params.stem_lengths if n < len(s) and s[:n] in kept), None)
            if short is None:
                kept[s] = good[s]
            elif good[s] == kept[short]:
                del kept[short]
                kept[s] = good[s]
        return kept

    strong, weak = {}, {}
    for s, (pos, neg, pos2, neg2, times) in counts.items():
        if pos >= params.least_support and pos >= params.precision * (pos + neg) and (pos >= params.support or times >= params.mean_times * pos):
            strong[s] = pos
        elif pos2 >= params.least_support + 1 and pos2 >= params.weak_precision * (pos2 + neg2) and times >= 2 * pos:
            weak[s] = pos2
    weak = shortest(weak)
    longer = lambda s: any(s[:n] in weak for n in params.stem_lengths if n < len(s))
    strong = shortest({s: c for s, c in strong.items() if not longer(s)})
    order = lambda d: sorted(d, key=lambda s: (-d[s], s))
    return order(strong), order(weak)


def fitted(grammar: Grammar, counts: np.ndarray, chars: np.ndarray, labels: np.ndarray) -> Grammar:
    """The grammar with weights fitted to the patterns and labels of some texts."""
    if len(labels) < 20 or labels.min() == labels.max():
        return grammar
    x = grammar.features(counts, chars)
    prior = np.array(SEED_WEIGHTS)
    w = prior.copy()
    pull = np.full(len(w), 0.5)
    for _ in range(30):  # Newton steps towards the labels, held by the seed weights
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - labels) + pull * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Grammar(grammar.stems, grammar.weak, w)


def _stems(params: Learning):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("t"), batch.column("y").to_pylist(), strict=True):
                found = stem_counts(text.as_py(), params)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array(np.full(len(found), label, np.int32)), pa.array(list(found.values()), pa.int64())], ["stem", "y", "c"])

    return run


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", params: Learning = Learning()) -> Grammar:
    """A grammar from at most sample_rows labelled documents, those of least id hash.

    What comes to the driver is bounded by the sample: stems that enough of its
    toxic texts hold, and eight numbers for each of its texts.
    """
    named = labels.where(F.col(f"`{label_col}`").isin(0, 1) & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").cast("int").alias("y"))
    bound = named.distinct().select("i", "y", F.xxhash64("i").alias("h")).orderBy("h", "i", "y").limit(params.sample_rows).select("i", "y")
    texts = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t")).where("t <> ''")
    # The bound of the broadcast side is sample_rows. Equal texts count once, so repeated rows don't add up.
    sample = scratch(texts.join(F.broadcast(bound), "i").groupBy(F.md5("t").alias("m"), "y").agg(F.first("t").alias("t")), "toxicity-sample")
    each = sample.select("t", "y").mapInArrow(_stems(params), "stem string, y int, c long")
    sums = each.groupBy("stem").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"), F.count_if((F.col("y") == 1) & (F.col("c") > 1)).alias("pos2"),
        F.count_if((F.col("y") == 0) & (F.col("c") > 1)).alias("neg2"), F.sum(F.col("y") * F.least("c", F.lit(6))).alias("times"))
    counts = {r["stem"]: tuple(r)[1:] for r in sums.where(F.col("pos") >= params.least_support).collect()}
    grammar = Grammar(*choose_stems(counts, params))
    rows = score(sample.select("t", "y", F.char_length("t").alias("n")), grammar, ["y", "n"], "t").collect()
    rows.sort(key=tuple)  # sums of floating point follow one order
    return fitted(grammar, np.array([[r[p] for p in PATTERNS] for r in rows]).reshape(-1, len(PATTERNS)), np.array([r["n"] for r in rows]), np.array([float(r["y"]) for r in rows]))


def _score(grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Grammar(*grammar.value)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(batch.num_columns - 1)]
            counts = np.array([model.patterns(t) for t in texts], np.int64).reshape(-1, len(PATTERNS))
            chars = np.array([len(t) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(model.score(counts, chars)), *(pa.array(counts[:, i]) for i in range(len(PATTERNS)))],
                [*batch.schema.names[:-1], "score", *PATTERNS])

    return run


def score(docs: DataFrame, grammar: Grammar, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in keep, the score, and the count of every pattern."""
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").cast("string").alias("_text"))
    kinds = ", ".join(f"_k{i} {inner.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    shared = docs.sparkSession.sparkContext.broadcast((grammar.stems, grammar.weak, grammar.weights))
    out = inner.mapInArrow(_score(shared), f"{kinds}, score double, {', '.join(f'{p} long' for p in PATTERNS)}")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "score", *PATTERNS)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    crc = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    grammar = learn(docs, labels.where(~crc))
    return score(docs.withColumn("held_out", crc), grammar, ["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")).select("doc_id", "held_out", "score", "predicted", *PATTERNS)
