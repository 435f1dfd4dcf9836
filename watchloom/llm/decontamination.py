"""Benchmark decontamination by canonical templates.

Tokens become templates: numbers, units and names turn into typed placeholders, the
rest is lower-cased without punctuation. Windows of the template sequence are hashed
and looked up among the windows of the benchmark items. Matched windows on one
alignment of a document and an item must fill their slots consistently: a value of
the item's slots always stands for the same value of the document's, and the other
way round. So a question with other numbers or names is found, while two texts that
merely have numbers in the same places are not.

Documents and items are looked at in three ways, each judged by itself: token by token
as templates; as they stand but for case, which also finds copies made mostly of names
and numbers or in other letters; and with every run of names, or of numbers and units,
as one placeholder, so that a value may have another number of tokens. Alignments near
each other add up, so inserted and deleted words do not hide an item.

The benchmark goes to the tasks in slices of bounded size, each a pass over the
documents; a benchmark of any size is handled, an ordinary one is one slice.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import rows_of

WINDOW = 6
#: Placeholder tokens carry little: a window needs so many other tokens.
LITERALS = 3
#: A document leaks an item if consistent windows cover this share of it, or so many of its tokens in a row.
SHARE, RUN = 0.6, 13
#: Bytes of benchmark text that one pass holds.
SLICE_BYTES = 2_000_000
#: Texts are looked through together up to so many characters (one text at least).
TOGETHER = 1 << 17
UNITS = ("mm cm m km in ft yd mi inch inches foot feet mile miles meter meters metre metres mg g kg lb lbs oz gram grams pound pounds ml l liter "
         "liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kph km/h % "
         "percent dollar dollars cent cents euro euros $ € £ usd eur gb mb kb w kw kwh v hz degree degrees °c °f")

_UNITS = frozenset(UNITS.split())
_NUMBER = re.compile(r"[+-]?[\d.,/]*\d(?:[\d.,/:]*\d)?")
_TRIM = "\"'“”‘’«»()[]{}<>,;:.!?…*#&|$%~_=-–—"
_SIGNS = frozenset("+-.,/")  # a number begins with one of these or a digit
_ENDS = frozenset(".!?:")
_QUOTES = "\"'”’»)]*#&$%"
_CLOSING = _ENDS | frozenset(_QUOTES)
_PLAIN, _NUM, _UNIT, _UPPER, _END = 0, 1, 2, 4, 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LINE = "\x00"
_BREAK = "<text> <text>"  # between texts; no token has a space


class _Ids(dict):
    """Number of a raw token; a new one is classified once."""

    def __init__(self, canon: Canon) -> None:
        super().__init__()
        self._canon = canon

    def __missing__(self, raw: str) -> int:
        self[raw] = number = self._canon.add(raw)
        return number


class Canon:
    """Template classes of raw tokens. A capital makes a name only where no sentence starts."""

    def __init__(self, most: int = 400_000) -> None:
        self._most = most
        self.name, self.number, self.unit = (xxhash.xxh64_intdigest(x) for x in ("<name>", "<number>", "<unit>"))
        self._line, self._break = xxhash.xxh64_intdigest(value(_LINE)), xxhash.xxh64_intdigest(_BREAK)
        self._clear()

    def _clear(self) -> None:
        self._hashes, self._plain = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)
        self._flags, self._size = np.zeros(1 << 12, np.uint8), 0
        self._ids = _Ids(self)
        self._ids[_LINE]  # number 0
        self._ids[_BREAK]  # number 1

    def add(self, raw: str) -> int:
        at = self._size
        if at == len(self._hashes):
            self._hashes, self._plain, self._flags = (np.concatenate([x, np.zeros_like(x)]) for x in (self._hashes, self._plain, self._flags))
        self._hashes[at], self._plain[at], self._flags[at] = self._classify(raw)
        self._size += 1
        return at

    def _classify(self, raw: str) -> tuple[int, int, int]:
        """Hash as a template, hash as it stands, flags. Most tokens are plain words: these are hashed once and meet no pattern."""
        if raw == _LINE:
            return 0, self._line, _END
        if raw == _BREAK:
            return self._break, self._break, _END
        bare = raw.strip(_TRIM)
        low = bare.lower()
        own = xxhash.xxh64_intdigest(low)
        end = _END if raw[-1] in _CLOSING and raw.rstrip(_QUOTES)[-1:] in _ENDS else _PLAIN
        if low in _UNITS or (len(raw) > len(bare) and raw.lower() in _UNITS):
            return self.unit, own, _UNIT | end
        head = bare[:1]
        if head.isdecimal() or head in _SIGNS:
            if _NUMBER.fullmatch(bare):
                return self.number, own, _NUM | end
            if (found := _NUMBER.match(bare)) and bare[found.end():].lower() in _UNITS:  # 5km
                return self.number ^ self.unit, own, _NUM | end
        return own, own, (_UPPER if head.isupper() else _PLAIN) | end

    def views(self, text: str) -> list[View]:
        """The text as templates, as it stands but for case, and with runs of slots as one."""
        self._tidy()
        raw, ids = self._read(text)
        return self._views(ids, raw)

    def together(self, texts: list[str]) -> tuple[list[View], np.ndarray]:
        """The views of many texts as one with breaks between them, and the number of the text that each token is of."""
        self._tidy()
        apart = np.ones(1, dtype=np.int64)  # _BREAK
        ids = np.concatenate([x for text in texts for x in (self._read(text)[1], apart)])
        ends = ids[ids > 0] == 1
        return self._views(ids, []), np.cumsum(ends) - ends

    def _tidy(self) -> None:
        if self._size > self._most:
            self._clear()

    def _read(self, text: str) -> tuple[list[str], np.ndarray]:
        raw = text.replace("\n", f" {_LINE} ").split()
        return raw, np.fromiter(map(self._ids.__getitem__, raw), dtype=np.int64, count=len(raw))

    def _views(self, ids: np.ndarray, raw: list[str]) -> list[View]:
        h, plain, flags = self._hashes[ids], self._plain[ids], self._flags[ids]
        starts = np.ones(len(ids), dtype=bool)
        starts[1:] = (flags[:-1] & _END) > 0
        name = ((flags & _UPPER) > 0) & ~starts
        h[name] = self.name
        kind = name + 2 * ((flags & (_NUM | _UNIT)) > 0) * ~name
        words = np.flatnonzero(ids)
        h, plain, kind = h[words], plain[words], kind[words]
        slot, each = kind > 0, np.arange(len(words) + 1)
        raw_at = lambda k: raw[words[k]]
        first = np.ones(len(words), dtype=bool)
        first[1:] = ~slot[1:] | (kind[1:] != kind[:-1])
        at = np.append(np.flatnonzero(first), len(words))
        joined = h[first]
        numeric = (kind[first] == 2) & ((joined != self.unit) | (np.diff(at) > 1))
        joined[numeric] = self.number
        return [View(h, slot, each, raw_at), View(plain, slot, each, raw_at), View(joined, slot[first], at, raw_at)]


@dataclass
class View:
    """Hashes of a text's parts, which of them are slots, and the token each begins at (and the end)."""

    h: np.ndarray
    slot: np.ndarray
    at: np.ndarray
    raw: Callable[[int], str]

    def held(self, k: int) -> str:
        return "".join(value(self.raw(t)) for t in range(self.at[k], self.at[k + 1]))


def value(raw: str) -> str:
    """What a slot holds, for comparing."""
    return raw.strip(_TRIM).lower()


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` templates."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    mixed = h ^ (h >> np.uint64(31))
    out = mixed[: len(h) - n + 1].copy()
    for k in range(1, n):
        out *= _MIX
        out += mixed[k: k + len(out)]
    return out ^ (out >> np.uint64(33))


@dataclass
class Index:
    """Windows of one view of some items: window length -> window hash -> (item, position)."""

    items: dict[int, View]
    at: dict[int, dict[int, list[tuple[int, int]]]]
    keys: dict[int, np.ndarray]
    maybe: dict[int, np.ndarray]  # window length -> a flag for the upper 20 bits of each window hash


def index(items: list[tuple[int, str]], n: int = WINDOW, literals: int = LITERALS) -> list[Index]:
    """An index for each view. Items shorter than a window are one window of their own length."""
    canon = Canon()
    seen = [(item, views) for item, text in items if len((views := canon.views(text))[0].h)]
    out = []
    for which in range(3):
        kept: dict[int, View] = {}
        at: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item, views in seen:
            view = kept[item] = views[which]
            h, size = view.h, min(n, len(view.h))
            variants = [(h, len(h))]
            if which != 1:
                # The first token counts as a sentence start here, but may be a name to the document: both are indexed.
                other = h.copy()
                other[0] = canon.name
                variants.append((other, size))
            for variant, upto in variants:
                for p, key in enumerate(windows(variant[:upto], size).tolist()):
                    rich = which == 1 or (~view.slot[p: p + size]).sum() >= min(literals, size)
                    if rich and (item, p) not in at[size][key]:
                        at[size][key].append((item, p))
        keys = {s: np.array(sorted(d), dtype=np.uint64) for s, d in at.items()}
        maybe = {}
        for s, k in keys.items():
            maybe[s] = np.zeros(1 << 20, dtype=bool)
            maybe[s][(k >> np.uint64(44)).astype(np.int64)] = True
        out.append(Index(kept, {s: dict(d) for s, d in at.items()}, keys, maybe))
    return out


class Cover:
    """The tokens of an item that windows of a document cover in order, with one value for each slot value."""

    def __init__(self, item: View, doc: View) -> None:
        self.item, self.doc = item, doc
        self.there: dict[str, str] = {}
        self.back: dict[str, str] = {}
        self.place = np.full(len(item.h), -1)  # part of the document that a part of the item lies at

    def add(self, p: int, q: int, size: int) -> None:
        mine, new = self.place[q: q + size], np.arange(p, p + size)
        before, after = self.place[:q], self.place[q + size:]
        if ((mine >= 0) & (mine != new)).any() or (before >= p).any() or ((after >= 0) & (after < p + size)).any():
            return
        item, doc = self.item, self.doc
        pairs = [(item.held(q + k), doc.held(p + k)) for k in range(size) if item.slot[q + k] or doc.slot[p + k]]
        there, back = dict(self.there), dict(self.back)
        if all(there.setdefault(a, b) == b and back.setdefault(b, a) == a for a, b in pairs):
            self.there, self.back = there, back
            self.place[q: q + size] = new

    def sizes(self) -> tuple[int, int]:
        """Tokens covered, and how many in a row."""
        covered = np.repeat(self.place >= 0, np.diff(self.item.at))
        padded = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
        return int(covered.sum()), int((padded[1::2] - padded[::2]).max()) if len(padded) else 0


def matches(doc: View, own: Index) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each window length: (length, places of ``doc`` where a window of an item begins, hashes of these)."""
    for size, keys in own.keys.items():
        found = windows(doc.h, size)
        if len(found) and len(keys):
            maybe = np.flatnonzero(own.maybe[size][(found >> np.uint64(44)).astype(np.int64)])
            found = found[maybe]
            same = keys[np.minimum(np.searchsorted(keys, found), len(keys) - 1)] == found
            yield size, maybe[same], found[same]


def touched(texts: list[str], known: list[Index], canon: Canon) -> np.ndarray:
    """Whether each text has a window of some item; no other one leaks anything."""
    out = np.zeros(len(texts), dtype=bool)
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (size < TOGETHER or end == start):
            size += len(texts[end])
            end += 1
        views, of = canon.together(texts[start:end])
        for view, own in zip(views, known):
            for _, places, _ in matches(view, own):
                out[start + of[view.at[places]]] = True
        start = end
    return out


def leaks(text: str, known: list[Index], canon: Canon, share: float = SHARE, run: int = RUN) -> list[tuple[int, int, int]]:
    """(item, tokens covered, tokens of the item) of every item that ``text`` leaks."""
    best: dict[int, tuple[int, int]] = {}
    for doc, own in zip(canon.views(text), known):
        lines: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        for size, places, found in matches(doc, own):
            for p, key in zip(places.tolist(), found.tolist()):
                for item, q in own.at[size][key]:
                    lines.setdefault(item, {}).setdefault(p - q, []).append((p, q, size))
        for item, by in lines.items():
            view = own.items[item]
            tokens = int(view.at[-1])
            # Alignments of the item within half its length are near each other; each is taken first once.
            reach, order, low = max(WINDOW, len(view.h) // 2), sorted(by), 0
            for k, d in enumerate(order):
                cover = Cover(view, doc)
                for match in sorted(by[d]):
                    cover.add(*match)
                total, longest = cover.sizes()
                while order[low] < d - reach:
                    low += 1
                if total < share * tokens and longest < run:
                    high = k
                    while high + 1 < len(order) and order[high + 1] <= d + reach:
                        high += 1
                    for near in sorted(order[low: high + 1], key=lambda e: (abs(e - d), e)):
                        if near != d:
                            for match in sorted(by[near]):
                                cover.add(*match)
                    total, longest = cover.sizes()
                if total >= share * tokens or longest >= run:
                    best[item] = max(best.get(item, (0, 0)), (total, tokens))
    return [(item, *best[item]) for item in sorted(best)]


def slices(benchmark: DataFrame, limit: int = SLICE_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in lists of at most ``limit`` bytes (one item at least)."""
    rows = benchmark.select("item_id", "text").filter("item_id is not null and length(text) > 0")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * size // limit))
    part = F.pmod(F.xxhash64("item_id"), F.lit(n))
    for k in range(n):
        held: list[tuple[int, str]] = []
        used = 0
        for row in rows.filter(part == k).orderBy("item_id", "text").toLocalIterator():
            held.append((row["item_id"], row["text"]))
            used += len(row["text"])
            if used > limit:
                yield held
                held, used = [], 0
        if held:
            yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` and ``leaked``: array of (item_id, covered, tokens), empty where nothing leaks.

    Whole texts are read; null and empty ones leak nothing. Repeated rows each give a
    row. Items without id or words are ignored, items with equal text or id count each.
    A column ``leaked`` of ``docs`` is replaced. An empty table gives no row, an empty
    benchmark no leak.
    """
    spark = docs.sparkSession
    kind = "array<struct<item_id:long,covered:int,tokens:int>>"
    out = docs.drop("leaked").withColumn("leaked", F.array().cast(kind))
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("covered", pa.int32()), ("tokens", pa.int32())]))
    for items in slices(benchmark):
        sent = spark.sparkContext.broadcast(items)  # at most SLICE_BYTES of text

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            canon, known = Canon(), index(sent.value, n)
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    texts = [text or "" for text in part.column("text").to_pylist()]
                    found = [
                        before + [{"item_id": i, "covered": c, "tokens": t} for i, c, t in (leaks(text, known, canon) if some else ())]
                        for text, before, some in zip(texts, part.column("leaked").to_pylist(), touched(texts, known, canon))]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, arrow)], part.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: (doc_id, contaminated, n_items, item_ids, covered), the last two sorted by item."""
    found = contaminated(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", (F.size("leaked") > 0).alias("contaminated"), F.size("leaked").cast("long").alias("n_items"),
        F.transform("leaked", lambda x: x["item_id"]).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("leaked", lambda x: x["covered"] / x["tokens"])), F.lit(0.0)).alias("covered"))
