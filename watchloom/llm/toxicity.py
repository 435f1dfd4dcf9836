"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, report, quote, other); a
clause is a string of symbols. Four small transducers rewrite it one after the other
and are composed into one machine: reported speech marks what stands behind a report
verb or in quotes, negation marks what stands shortly behind a negator, the insult
and threat transducers turn marked symbols into events, and the target transducer
adds an event where an insult and a person meet in the clause. Each event has a
learned weight; a document's score is the logistic of the sum over its clauses.

The insult lexicon (whole words and word beginnings, so that inflected forms are
found) and the event weights are learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchloom.llm.common import rows_of

THRESHOLD = 0.3
HELD_OUT = (4, 2)  # crc32(doc_id as text) mod 4 = 2 is never learned from
#: About so many labelled documents are learned from, drawn by a hash of their id; all labelled ones if fewer.
LABELLED_SAMPLE = 20_000
#: A lexicon entry must occur in at least so many toxic documents of the sample, be so pure if both classes were
#: equally frequent, and pass a likelihood-ratio test at a level of one false entry among all that are tested.
MIN_TOXIC, MIN_PRECISION = 4, 0.93
PREFIXES = (4, 5, 6, 7, 8)

TARGETS = "you your yours yourself u ur they them he she him her du dich dir ihr euch sie tu te toi vous tú ti usted ustedes vosotros"
NEGATORS = "not no never neither nor none without isn't aren't wasn't weren't don't doesn't didn't won't nicht kein keine nie pas ne jamais nunca jamás"
REPORTERS = "said says say saying wrote writes claimed claims called calls quoted quotes reported reports sagte sagt schrieb dit disait écrit dijo dice escribió"
THREATS = "kill murder hurt destroy shoot stab strangle beat burn töten umbringen tuer frapper matar golpear"
SYMBOLS = {"target": TARGETS, "negator": NEGATORS, "report": REPORTERS, "threat": THREATS}
EVENTS = ("insult", "negated", "reported", "targeted", "threat")
#: Used for an event that no labelled document shows, and all of them where nothing is labelled.
PRIOR = (2.0, 0.5, 0.5, 2.0, 3.0)
PRIOR_BIAS = -3.0

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[\"“”«»]")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_ENDS = ".!?;\n"
_END = re.compile(f"[{_ENDS}]")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``step(state, symbol)`` gives (state, symbol out, event or None); ``final`` an event at the end."""

    start: str
    arcs: dict = field(default_factory=dict)  # (state, symbol) -> (state, symbol, events); symbol None: any other, unchanged
    final: dict = field(default_factory=dict)  # state -> events

    def step(self, state: str, symbol: str) -> tuple[str, str, tuple[str, ...]]:
        found = self.arcs.get((state, symbol))
        if found is None:
            to, out, events = self.arcs.get((state, None), (state, None, ()))
            return to, out or symbol, events
        return found

    def compose(self, after: Transducer, alphabet: tuple[str, ...]) -> Transducer:
        """The machine that feeds this one's output to ``after``."""
        start = (self.start, after.start)
        arcs, final, todo = {}, {}, [start]
        seen = {start}
        while todo:
            a, b = state = todo.pop()
            if events := (*self.final.get(a, ()), *after.final.get(b, ())):
                final[state] = events
            for symbol in alphabet:
                a2, mid, first = self.step(a, symbol)
                b2, out, second = after.step(b, mid)
                arcs[state, symbol] = ((a2, b2), out, first + second)
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    todo.append((a2, b2))
        return Transducer(start, arcs, final)


ALPHABET = ("other", "insult", "threat", "target", "negator", "report", "quote")


def grammar() -> Transducer:
    reported = Transducer("said", {
        ("said", "report"): ("told", "other", ()), ("said", "quote"): ("quoted", "other", ()),
        ("told", "insult"): ("told", "insult/reported", ()), ("told", "threat"): ("told", "other", ()),
        ("quoted", "insult"): ("quoted", "insult/reported", ()), ("quoted", "threat"): ("quoted", "other", ()),
        ("quoted", "quote"): ("said", "other", ()), ("told", "quote"): ("quoted", "other", ())})
    negation = Transducer("0", {
        **{(s, "negator"): ("3", "other", ()) for s in "0123"},
        **{(s, "insult"): ("0", "insult/negated", ()) for s in "123"},
        **{(s, "threat"): ("0", "other", ()) for s in "123"},
        ("3", None): ("2", None, ()), ("2", None): ("1", None, ()), ("1", None): ("0", None, ())})
    insult = Transducer("i", {
        ("i", "insult"): ("i", "hit", ("insult",)), ("i", "insult/negated"): ("i", "other", ("negated",)),
        ("i", "insult/reported"): ("i", "other", ("reported",))})
    threat = Transducer("none", {
        ("none", "threat"): ("meant", "other", ()), ("none", "target"): ("aimed", "target", ()),
        ("meant", "target"): ("none", "target", ("threat",)), ("aimed", "threat"): ("none", "other", ("threat",))})
    target = Transducer("none", {
        ("none", "target"): ("target", "other", ()), ("none", "hit"): ("hit", "other", ()),
        ("target", "hit"): ("both", "other", ()), ("hit", "target"): ("both", "other", ())}, {"both": ("targeted",)})
    machine = reported
    for following in (negation, insult, threat, target):
        machine = machine.compose(following, ALPHABET)
    return machine


@dataclass
class Model:
    lexicon: dict[str, float]  # a word ends with "$", else a word's beginning; to its weight
    weights: tuple[float, ...] = PRIOR
    bias: float = PRIOR_BIAS


class Reader:
    """Runs a model over texts."""

    def __init__(self, model: Model) -> None:
        self._model, self._memo = model, {}
        self._fixed = {w: kind for kind, words in SYMBOLS.items() for w in words.split()}
        self._fixed |= {q: "quote" for q in "\"“”«»"}
        # Finds where an insult or a threat may stand; what it is, the word itself says.
        self._finder = ahocorasick.Automaton()
        for word in (*THREATS.split(), *(entry.removesuffix("$") for entry in model.lexicon)):
            self._finder.add_word(word, word)
        self._finder.make_automaton()
        machine = grammar()
        numbers = {s: k for k, s in enumerate(dict.fromkeys([machine.start, *(s for s, _ in machine.arcs)]))}
        self._arcs = {(numbers[s], x): (numbers[to], [EVENTS.index(e) for e in events]) for (s, x), (to, _, events) in machine.arcs.items()}
        self._final = {numbers[s]: [EVENTS.index(e) for e in events] for s, events in machine.final.items()}

    def symbol(self, word: str) -> tuple[str, float]:
        known = self._memo.get(word)
        if known is None:
            if len(self._memo) > 500_000:
                self._memo.clear()
            lexicon = self._model.lexicon
            weight = lexicon.get(word + "$") or next((lexicon[p] for n in reversed(PREFIXES) if (p := word[:n]) in lexicon), None)
            known = self._memo[word] = ("insult", weight) if weight else (self._fixed.get(word, "other"), 1.0)
        return known

    def features(self, text: str) -> list[float]:
        """How often each event occurs over all clauses, insults by the weight of their word.

        Every event needs an insult or a threat, and a clause's end resets the machine, so
        only clauses where one may stand are read.
        """
        low = text.lower()
        out = [0.0] * len(EVENTS)
        end = 0
        for last, word in self._finder.iter(low):
            at = last - len(word) + 1
            if at < end or (at and low[at - 1].isalnum()):
                continue
            start = max(end, *(low.rfind(c, end, at) + 1 for c in _ENDS))
            found = _END.search(low, at)
            end = found.start() if found else len(low)
            self._read(low[start:end], out)
        return out

    def _read(self, clause: str, out: list[float]) -> None:
        state, weight = 0, 1.0
        for token in _TOKEN.findall(clause):
            symbol, by = self.symbol(token)
            state, events = self._arcs[state, symbol]
            if symbol == "insult":
                weight = by
            for k in events:
                out[k] += by if k < 3 else 1.0
        for k in self._final.get(state, ()):
            out[k] += weight

    def score(self, text: str) -> float:
        z = self._model.bias + sum(w * math.log1p(x) for w, x in zip(self._model.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _sketch(text: str) -> int:
    """The least hash of any five-word shingle: near copies mostly share it, other texts don't."""
    words = text.encode().lower().split()
    return min(xxhash.xxh64_intdigest(b" ".join(words[k: k + 5])) for k in range(max(1, len(words) - 4))) - (1 << 63)


def _is_held_out(doc_id: str = "doc_id"):
    modulus, rest = HELD_OUT
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == rest, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = LABELLED_SAMPLE) -> Model:
    """Lexicon and weights from a bounded sample of labelled rows outside the held-out part.

    Copies count once: rows whose least shingle hash is the same are one example.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~_is_held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30)) < int((1 << 30) * sample / total))
    # The drawn rows number about `sample` (twelve bytes each), so this broadcast has a bound.
    drawn = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, toxic in rows_of(batches, "text", "toxic"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_sketch(t) for t in texts], pa.int64()), pa.array(texts), pa.array(toxic, pa.int32())], ["sketch", "text", "toxic"])

    once = drawn.mapInArrow(sketched, "sketch long, text string, toxic int").groupBy("sketch").agg(
        F.min(F.struct(F.col("text"), "toxic")).alias("row")).select("row.text", "row.toxic").persist()
    try:
        return _fit(once)
    finally:
        once.unpersist()


def _pure(by_entry: DataFrame, n1: int, n0: int, tested: int) -> dict[str, float]:
    """Log-odds of the entries (entry, c1, c0) that mark toxic documents."""
    both = F.col("c1") + F.col("c0")
    part = lambda c, n: F.when(c > 0, c * F.log(c * (n0 + n1) / (both * n))).otherwise(0.0)
    ratio = 2 * (part(F.col("c1"), n1) + part(F.col("c0"), n0))
    pure = by_entry.filter((ratio >= 2 * math.log(max(2, tested))) & (
        F.col("c1") / n1 >= MIN_PRECISION / (1 - MIN_PRECISION) * F.col("c0") / n0))
    return {r["entry"]: math.log((r["c1"] + 0.5) / (n1 + 1)) - math.log((r["c0"] + 0.5) / (n0 + 1)) for r in pure.collect()}


def _fit(once: DataFrame) -> Model:
    sizes = {r["toxic"]: r["n"] for r in once.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model({})

    def documents_with(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
        """(entry, n): in how many documents an entry occurs, counted in the task first; only ``wanted`` ones if given."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()

            def flush() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["entry", "n"])
                counts.clear()
                return out

            for (texts,) in rows_of(batches, "text"):
                for text in texts:
                    words = set(_WORD.findall(text.lower()))
                    found = {w + "$" for w in words}
                    for n in PREFIXES:
                        found.update([w[:n] for w in words if len(w) >= n])
                    counts.update(found if wanted is None else found & wanted)
                    if len(counts) > 300_000:
                        yield flush()
            yield flush()

        return rows.select("text").mapInArrow(run, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))

    # Only what occurs in enough toxic documents can be pure, so only that is counted in the others. All of it comes
    # from the toxic part of a bounded sample; every entry seen there counts as tested.
    toxic = documents_with(once.filter("toxic = 1"), None).persist()
    try:
        tested = toxic.count()
        by_entry = toxic.filter(F.col("n") >= MIN_TOXIC).withColumnRenamed("n", "c1")
        candidates = frozenset(r["entry"] for r in by_entry.select("entry").collect())
        clean = documents_with(once.filter("toxic = 0"), candidates).withColumnRenamed("n", "c0")
        by_entry = by_entry.join(clean, "entry", "left").select("entry", "c1", F.coalesce("c0", F.lit(0)).alias("c0"))
        odds = _pure(by_entry, n1, n0, tested)
    finally:
        toxic.unpersist()
    # A beginning stands for its words: what a shorter pure beginning covers is left out.
    lexicon = {}
    for entry, value in odds.items():
        bare = entry.removesuffix("$")
        if not any(len(bare) >= n and bare[:n] in odds and bare[:n] != entry for n in PREFIXES):
            lexicon[entry] = min(2.0, max(0.5, value / 4))
    model = Model(lexicon)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for texts, toxic in rows_of(batches, "text", "toxic"):
            yield pa.RecordBatch.from_arrays([pa.array([reader.features(t) for t in texts], pa.list_(pa.float64())), pa.array(toxic, pa.int32())], ["x", "y"])

    # Equal feature rows are counted on the executors; at most one row per sampled document comes here.
    rows = once.mapInArrow(featured, "x array<double>, y int").groupBy("x", "y").count().collect()
    x = np.log1p(np.array([r["x"] for r in rows], dtype=float))
    y, n = np.array([r["y"] for r in rows], dtype=float), np.array([r["count"] for r in rows], dtype=float)
    w = _logistic(x, y, n)
    seen = (x * n[:, None]).sum(axis=0) > 0
    return Model(lexicon, tuple(float(a) if s else p for a, s, p in zip(w[1:], seen, PRIOR)), float(w[0]))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Newton's method with a ridge towards the prior weights."""
    a = np.hstack([np.ones((len(x), 1)), x])
    prior = np.array([PRIOR_BIAS, *PRIOR])
    w = prior.copy()
    keep = np.array([0.01] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + np.diag(keep), a.T @ (n * (p - y)) + keep * (w - prior))
        w -= np.clip(step, -2, 2)
    return w


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and ``toxic_score``, ``toxic_flag``, over whole texts.

    A null or empty text scores like one without any event. Every row gives a row,
    repeated or not; an empty table gives none. Columns of these two names are replaced.
    """
    kept = docs.drop("toxic_score", "toxic_flag")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = [reader.score(t or "") for t in part.column("text").to_pylist()]
                scores = pa.array(values, pa.float64())
                flags = pa.array([int(v >= threshold) for v in values], pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, scores, flags], [*part.schema.names, "toxic_score", "toxic_flag"])

    schema = T.StructType([*kept.schema.fields, T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_flag", T.IntegerType())])
    return kept.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, sample: int = LABELLED_SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; see ``learn`` and ``score``."""
    scored = score(docs.select("doc_id", "text"), learn(docs, labels, sample))
    return scored.select("doc_id", _is_held_out().alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_flag").alias("predicted"))
