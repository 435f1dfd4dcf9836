"""Personal data by weak supervision, in DataFrame functions only.

Every kind has a pattern whose matches are candidates. Labelers (format, check digits
and ranges, gazetteers, words before, boundaries) vote yes, no or abstain on each.
Expectation-maximisation estimates from the agreement of the votes how reliable each
labeler is, and its posteriors train a logistic span classifier per kind. Base
matches (``BASE``) always stay; the classifier decides which further candidates join.

Both fits need only how often each pattern of votes occurs, at most
``kinds * 3 ** labelers`` counts. Nothing is shuffled but those.

Positions come from the split and the matches of the same pattern: gap lengths and
match lengths add up to code points. Patterns are possessive, so they take time in
proportion to the text, and none repeats a group (Java would recurse).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import materialise

BASE = ("email", "ip", "card", "phone")
#: Kinds of the further spans behind the base kinds, in the order of the span list.
KINDS = (*BASE, "iban", "name", "secret", "ssn")
CONTEXT = 24

_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: On text in which every doubled separator is taken out of the way, see ``_single``.
_CARD = r"[0-9][0-9 -]*[0-9]"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_DOUBLED = r"[ -](?=[ -])|(?<=[ -])[ -]"

#: kind -> (cheap test whether the text can hold a match, pattern) of the further candidates.
EXTRA = {
    "card": (r"[0-9]{13}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})(?![0-9])"),
    "phone": (r"[0-9]{3}[ .-][0-9]{4}", r"(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{3}\) ?|(?<![0-9])[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "iban": (r"[A-Z]{2}[0-9]{2}", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "name": (r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b", r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? \p{Lu}\p{L}++(?: \p{Lu}\p{L}++){0,2}"),
    "secret": (r"AKIA|(?i:token|key|secret|password)", r"\bAKIA[0-9A-Z]{16}\b|(?i:\b(?:api_?key|token|secret|password)) ?[=:] ?[\"']?[A-Za-z0-9+/_-]{12,}+"),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
#: Labelers in the order of a candidate's votes.
LABELERS = ("format", "check", "gazetteer", "context", "boundary", "base")
_WORDS = {
    "email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|pay|karte|carte|tarjeta",
    "phone": "tel|phone|call|fax|mobile", "iban": "iban|bank|account|konto", "name": "name|sign|by|from|dear", "secret": "key|token|secret|password|aws",
    "ssn": "ssn|social|security",
}
_NOT_WORDS = r"version|build|isbn|order|ref|id|no\.|page|chapter"
_GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$", "ip": r"^(?!0\.|127\.|255\.)", "card": r"^[3-6]", "phone": r"^\+?(1|33|34|44|49)?[ .(-]",
    "iban": r"^(DE|FR|ES|GB|IT|NL|BE|CH|AT|PL|PT)", "name": r"\b(Smith|Jones|Miller|Meyer|Schmidt|Müller|Martin|Bernard|Garcia|García|Lopez|López)\b",
    "secret": r"^AKIA|[0-9]", "ssn": r"^(?!000|666|9)",
}
_FORMAT = {
    "email": rf"^[A-Za-z0-9]{_LOCAL}*@[A-Za-z0-9.-]+\.[A-Za-z]{{2,24}}$", "ip": r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$", "card": r"^[0-9]{13,19}$|^[0-9]{4}([ -][0-9]{3,7}){2,4}$",
    "phone": r"^(\+[0-9]{1,3} )?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$", "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11,30}$", "name": r"\p{Lu}\p{Ll}+$",
    "secret": r"[A-Za-z0-9]{16}", "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
}
_SPAN = "array<struct<kind:string,start:int,end:int,hit:string,before:string,after:string>>"


def _located(text: Column, pattern: str, kind: str, hits_from: Column | None = None) -> Column:
    """Every match of ``pattern`` in ``text`` with its place and what stands around it."""
    source = text if hits_from is None else hits_from
    gaps, hits = F.split(source, pattern, -1), F.regexp_extract_all(source, F.lit(pattern), F.lit(0))
    n = F.size(hits)
    sides = F.zip_with(F.slice(gaps, 1, n), F.slice(gaps, 2, n), lambda a, b: F.struct(
        F.length(a).alias("gap"), F.right(a, F.lit(CONTEXT)).alias("before"), F.left(b, F.lit(CONTEXT)).alias("after")))
    zipped = F.zip_with(sides, hits, lambda s, h: F.struct(
        (s["gap"] + F.length(h)).alias("move"), s["before"].alias("before"), s["after"].alias("after"), h.alias("hit")))

    def spans(found: Column) -> Column:
        return F.zip_with(found, _sums(F.transform(found, lambda x: x["move"])), lambda x, end: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(x["hit"])).alias("start"), end.alias("end"), x["hit"].alias("hit"),
            x["before"].alias("before"), x["after"].alias("after")))

    return _let(zipped, spans)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _sums(numbers: Column) -> Column:
    """Running sums of an array of int: of the parts of about the root of its length, then inside each part.

    So an array is appended to, which copies it, only while it is short.
    """
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, v: a + v)

    def within(part: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, first, lambda acc, v: F.struct((acc["at"] + v).alias("at"), F.array_append(acc["out"], acc["at"] + v).alias("out")), lambda acc: acc["out"])

    def cut(x: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(x))).cast("int"))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(x)), width), lambda at: F.slice(x, at, width))

    def joined(cuts: Column) -> Column:
        return _let(F.transform(cuts, total), lambda totals: F.flatten(F.transform(cuts, lambda part, k: within(part, total(F.slice(totals, F.lit(1), k))))))

    return _let(numbers, lambda x: _let(cut(x), joined))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """13 to 19 digits with a valid check digit."""
    digits = F.reverse(_digits(hit))
    places = F.transform(F.split(digits, ""), lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    total = F.aggregate(places, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return F.length(digits).between(13, 19) & (total % 10 == 0)


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return hit.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return _luhn(hit)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _where(possible: Column, found: Column) -> Column:
    return F.when(possible, found).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """The base matches of each kind; those that fail their check are dropped."""
    single = F.regexp_replace(text, _DOUBLED, "_")  # one character for one: positions stay
    found = {
        "email": _where(F.contains(text, F.lit("@")), _located(text, _EMAIL, "email")),
        "ip": _where(text.rlike(r"[0-9]\.[0-9]"), _located(text, _IP, "ip")),
        "card": _where(text.rlike(r"[0-9](?:[ -]?[0-9]){12}"), _located(text, _CARD, "card", single)),
        "phone": _where(text.rlike(r"\+[0-9]"), _located(text, _PHONE, "phone")),
    }
    return {kind: _checked(kind, spans) for kind, spans in found.items()}


def _checked(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda x: _valid(kind, x["hit"]))


def _votes(kind: str, x: Column, base: bool) -> Column:
    """+1, -1 or 0 of every labeler."""
    before = F.lower(x["before"])
    edge = x["before"].rlike(r"[\p{L}0-9]$") | x["after"].rlike(r"^[\p{L}0-9]")
    votes = [
        F.when(x["hit"].rlike(_FORMAT[kind]), 1).otherwise(-1),
        F.when(_valid(kind, x["hit"]), 1).otherwise(-1) if kind in BASE else F.lit(0),
        F.when(x["hit"].rlike(_GAZETTEER[kind]), 1).otherwise(0),
        F.when(before.rlike(rf"\b(?:{_WORDS[kind]})"), 1).when(before.rlike(rf"\b(?:{_NOT_WORDS})\W*$"), -1).otherwise(0),
        F.when(edge, -1).otherwise(0),
        F.lit(1 if base else 0),
    ]
    return F.array(*[v.cast("tinyint") for v in votes])


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``cands``: every candidate span (kind, start, end, base, votes) of the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def judged(spans: Column, kind: str, base: bool) -> Column:
        return F.transform(spans, lambda x: F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lit(base).alias("base"), _votes(kind, x, base).alias("votes")))

    found = [judged(spans, kind, True) for kind, spans in base_spans(text).items()]
    for kind, (test, pattern) in EXTRA.items():
        found.append(judged(_checked(kind, _where(text.rlike(test), _located(text, pattern, kind))), kind, False))
    return docs.drop("cands").withColumn("cands", F.concat(*found))


@dataclass
class Model:
    """Per kind: reliabilities (how often a labeler is right when it votes), bias and weights of the classifier."""

    reliability: dict[str, tuple[float, ...]]
    weights: dict[str, tuple[float, ...]]


def fit(judged: DataFrame, rounds: int = 50) -> Model:
    """EM over the counts of vote patterns, then a logistic classifier on its posteriors."""
    patterns = judged.select(F.explode("cands").alias("c")).groupBy("c.kind", "c.votes").agg(F.count("*").alias("n")).collect()
    reliability, weights = {}, {}
    for kind in KINDS:
        mine = [(list(r["votes"]), r["n"]) for r in patterns if r["kind"] == kind]
        votes = np.array([v for v, _ in mine], dtype=float).reshape(-1, len(LABELERS))
        n = np.array([c for _, c in mine], dtype=float)
        reliability[kind], posterior = _em(votes, n, rounds)
        weights[kind] = _logistic(votes, n, posterior, reliability[kind])
    return Model(reliability, weights)


def _em(votes: np.ndarray, n: np.ndarray, rounds: int) -> tuple[tuple[float, ...], np.ndarray]:
    """Binary truth, one reliability per labeler with a Beta(8, 2) prior, a prior of one half for the truth."""
    right, prior = np.full(votes.shape[1], 0.8), 0.5
    posterior = np.zeros(len(votes))
    for _ in range(rounds):
        logit = votes @ np.log(right / (1 - right)) + math.log(prior / (1 - prior))
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        agree = ((votes > 0) * posterior[:, None] + (votes < 0) * (1 - posterior)[:, None]) * n[:, None]
        right = np.clip((agree.sum(axis=0) + 8) / (((votes != 0) * n[:, None]).sum(axis=0) + 10), 0.55, 0.99)
        prior = float(np.clip(((posterior * n).sum() + 1) / (n.sum() + 2), 0.05, 0.95))
    return tuple(map(float, right)), posterior


#: How many candidates the starting weights (those of the labelers' reliabilities) count for in the classifier.
RIDGE = 1.0


def _logistic(votes: np.ndarray, n: np.ndarray, target: np.ndarray, right: tuple[float, ...], steps: int = 30) -> tuple[float, ...]:
    start = np.array([0.0, *(math.log(r / (1 - r)) for r in right)])
    if not len(votes):
        return tuple(start)
    a = np.hstack([np.ones((len(votes), 1)), votes])
    w, share = start.copy(), n.astype(float)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (share * p * (1 - p))[:, None]).T @ a + RIDGE * np.eye(len(w))
        w -= np.clip(np.linalg.solve(h, a.T @ (share * (p - target)) + RIDGE * (w - start)), -1, 1)
    return tuple(map(float, w))


def chosen(model: Model, cands: Column) -> Column:
    """Base spans, and the further ones that the classifier takes and that lie in no base span of their kind."""
    base = F.filter(cands, lambda c: c["base"])

    def taken(c: Column) -> Column:
        z = F.lit(0.0)
        for kind, w in model.weights.items():
            own = F.lit(w[0])
            for k, weight in enumerate(w[1:]):
                own = own + F.element_at(c["votes"], k + 1) * F.lit(weight)
            z = F.when(c["kind"] == kind, own).otherwise(z)
        return z > 0

    further = F.filter(cands, lambda c: ~c["base"] & taken(c) & ~F.exists(
        base, lambda b: (b["kind"] == c["kind"]) & (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return F.concat(base, further)


def _ordered(spans: Column) -> Column:
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(spans, lambda c: F.struct(F.array_position(order, c["kind"]).alias("k"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda c: F.concat_ws(":", c["kind"], c["start"], c["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts and digest of the base spans, and all spans.

    Null and empty texts have no span (the digest is that of the empty string). Rows
    without an id and repeated rows each give a row. Only ``doc_id`` and ``text`` are
    read, so further columns may have any name. An empty table gives no row.
    """
    judged = materialise(candidates(docs.select("doc_id", "text")).select("doc_id", "cands"), "pii-candidates")
    model = fit(judged)
    base = F.filter("cands", lambda c: c["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return judged.select(
        "doc_id", *counts, F.sha2(_ordered(base).cast("binary"), 256).alias("base_sha256"), _ordered(chosen(model, F.col("cands"))).alias("spans"))


def mask(judged: DataFrame, model: Model) -> DataFrame:
    """``judged`` (see ``candidates``) with every chosen span of the text replaced by its kind in brackets.

    Overlapping spans become one mask. A null text stays null.
    """
    spans = F.array_sort(F.transform(chosen(model, F.col("cands")), lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("back"), c["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.array_append(F.array_append(acc["out"], piece), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], -s["back"]).alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, empty, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return judged.withColumn("text", F.when(F.size("cands") > 0, done).otherwise(F.col("text"))).drop("cands")
