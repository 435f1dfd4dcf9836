"""Licence scan as an exact set-similarity join of text blocks with licence notices.

Every notice (template) is a set of words. Text blocks are windows of words: for templates
of up to S words (S a power of two) the blocks are 2S words long and start every S words,
so a notice that stands in one piece lies whole in some block. A block holds a template
when it has at least ``THRESHOLD`` per cent of its words.

The join prunes without losing a pair. Words are ordered from rare to frequent by their
count in all texts. With o words needed of a template T, a block B of fewer than o words is
out (length filter); of the others B's first |B| - o + 1 words and T's first |T| - o + 1
must share one (prefix filter, an equality join on the word); and from the first shared
word on, both must have words enough left to reach o (position filter). What remains is
compared in full. Words of no template never count towards an overlap, so blocks are kept
as the template words they hold, and only if those pass the length filter.

Of one family (the GPL versions, say) the template met best names the block; families do
not compete. Defined cases: a null text is empty and has no words; null and repeated
doc_ids are rows like any other; long texts are read whole, in a pass that keeps two bytes
a word; ties of a family go to more shared words, then to the greater label; other columns
of the input are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import document_bytes, materialise, rows_of

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: Per cent of a template's words that a block must hold.
THRESHOLD = 80
#: Longer texts are tokenised word by word instead of as one list.
_LONG = 1 << 22
#: The templates are sent to every task: their words are bounded.
MOST_WORDS = 20_000

# Phrases and labels of the contract.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# (label, family, notice): public licence notices in the wording their licences ask for.
NOTICES = (
    ("gpl-2.0", "gpl", "Licensed under the GNU General Public License version 2"),
    ("gpl-3.0", "gpl", "Licensed under the GNU General Public License version 3"),
    ("lgpl-2.1", "gpl", "Licensed under the GNU Lesser General Public License version 2.1"),
    ("lgpl-3.0", "gpl", "Licensed under the GNU Lesser General Public License version 3"),
    ("agpl-3.0", "gpl", "Licensed under the GNU Affero General Public License version 3"),
    ("gpl-notice", "gpl-notice",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-warranty", "gpl-notice",
     "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("apache-2.0", "apache", "Licensed under the Apache License, Version 2.0"),
    ("apache-notice", "apache-notice",
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
     "and limitations under the License."),
    ("mit-notice", "mit",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
     "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("isc", "mit",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
     "above copyright notice and this permission notice appear in all copies."),
    ("bsd", "bsd",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-4.0", "cc", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "cc", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "cc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "cc", "Licensed under CC BY-ND 4.0"),
    ("cc-by-4.0", "creative-commons", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "creative-commons", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "creative-commons", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "creative-commons", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
)


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class Templates:
    """Notices and phrases as numbered words; number 0 stands for every other word."""

    def __init__(self, notices=NOTICES, phrases=PHRASES, threshold: int = THRESHOLD):
        self.threshold = threshold
        split = [words_of(text.encode()) for _, _, text in notices]
        if sum(map(len, split)) > MOST_WORDS or not all(split):
            raise ValueError(f"templates need words, and no more than {MOST_WORDS} in all")
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases.items()]
        listed = dict.fromkeys(w for ws in [*split, *(p for p, _ in self.phrases)] for w in ws)
        self.numbers = {w: i + 1 for i, w in enumerate(listed)}
        #: (label, family, span, distinct word numbers, words needed)
        self.rows = []
        for (label, family, _), ws in zip(notices, split):
            numbers = sorted({self.numbers[w] for w in ws})
            self.rows.append((label, family, 1 << (len(ws) - 1).bit_length(), numbers, -(-threshold * len(numbers) // 100)))

    def spans(self) -> dict[int, tuple[np.ndarray, int]]:
        """Per span: which word numbers its templates hold, and the fewest words one of them needs."""
        out = {}
        for span in sorted({r[2] for r in self.rows}):
            mine = [r for r in self.rows if r[2] == span]
            held = np.zeros(len(self.numbers) + 1, dtype=bool)
            held[[n for r in mine for n in r[3]]] = True
            out[span] = held, min(r[4] for r in mine)
        return out


def _numbers(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    if len(text) > _LONG:
        return np.fromiter((known.get(m[0], 0) for m in WORD.finditer(text.lower())), dtype=np.int16)
    found = WORD.findall(text.lower())
    return np.fromiter(map(known.get, found, repeat(0)), dtype=np.int16, count=len(found))


def _places(words: np.ndarray, ends: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Starts of the phrase in words of several documents; none crosses the end of its document."""
    n = len(phrase)
    at = np.flatnonzero(words[: len(words) - n + 1] == phrase[0]) if len(words) >= n else np.zeros(0, dtype=np.int64)
    for k in range(1, n):
        at = at[words[at + k] == phrase[k]]
    return at[np.searchsorted(ends, at, "right") == np.searchsorted(ends, at + n - 1, "right")]


def _blocks(words: np.ndarray, doc: np.ndarray, at: np.ndarray, counts: np.ndarray, span: int, held: np.ndarray, least: int):
    """(document, block, sorted distinct template words) of each block that passes the length filter.

    ``words`` are template words, ``doc`` their document, ``at`` their place in it. Each
    document has a spare empty cell behind its last one, so that no block reaches into the next.
    """
    mine = held[words]
    words, doc, at = words[mine], doc[mine], at[mine]
    first = np.concatenate([[0], np.cumsum(-(-counts // span) + 1)])
    cell = first[doc] + at // span
    size = np.bincount(cell, minlength=first[-1] + 1)
    ample = size[:-1] + size[1:] >= least
    pairs = []
    for start, usable in ((cell, np.ones(len(cell), dtype=bool)), (cell - 1, at >= span)):
        usable = usable & ample[np.maximum(start, 0)]
        pairs.append(start[usable] * len(held) + words[usable])
    keys = np.unique(np.concatenate(pairs))
    block, word = keys // len(held), keys % len(held)
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(block)]):
        if b - a >= least:
            of = int(np.searchsorted(first, block[a], "right")) - 1
            yield of, int(block[a] - first[of]), word[a:b].tolist()


def scan(docs: DataFrame, templates: Templates) -> DataFrame:
    """One row a document (row, doc_id, base columns, blocks) and one row a task with the counts of all template words."""
    known, spans = templates.numbers, templates.spans()
    phrases = [([known[w] for w in ws], label) for ws, label in templates.phrases]
    schema = (
        "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "blocks array<struct<span:int,block:long,words:array<int>>>, counts array<long>")
    block_type = pa.list_(pa.struct([("span", pa.int32()), ("block", pa.int64()), ("words", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known) + 1, dtype=np.int64)
        for rows, ids, texts in rows_of(batches, "row", "doc_id", "text"):
            each = [_numbers(t, known) for t in texts]
            counts = np.array([len(w) for w in each], dtype=np.int64)
            ends = np.cumsum(counts)
            words = np.concatenate(each)
            total += np.bincount(words, minlength=len(total))
            spots = [[] for _ in texts]
            labels = [set() for _ in texts]
            for phrase, label in phrases:
                for at in _places(words, ends, phrase).tolist():
                    of = int(np.searchsorted(ends, at, "right"))
                    spots[of].append(at - int(ends[of] - counts[of]))
                    labels[of].add(label)
            here = np.flatnonzero(words)
            doc = np.searchsorted(ends, here, "right")
            place = here - (ends - counts)[doc]
            blocks = [[] for _ in texts]
            for span, (held, least) in spans.items():
                for of, block, found in _blocks(words[here], doc, place, counts, span, held, least):
                    blocks[of].append({"span": span, "block": block, "words": found})
            yield pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(counts), pa.array([len(s) for s in spots], pa.int64()),
                pa.array([min(s, default=None) for s in spots], pa.int64()), pa.array([max(s, default=None) for s in spots], pa.int64()),
                pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(blocks, block_type),
                pa.array([None] * len(texts), pa.list_(pa.int64()))], names)
        none = [pa.array([None], t) for t in (*[pa.int64()] * 6, pa.string(), block_type)]
        yield pa.RecordBatch.from_arrays([*none, pa.array([total.tolist()], pa.list_(pa.int64()))], names)

    names = [c.split()[0] for c in ("row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks", "counts")]
    return document_bytes(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text"), "row").mapInArrow(run, schema)


def _ranks(scanned: DataFrame, templates: Templates) -> list[int]:
    """Place of each word number in the order from rare to frequent over all texts (ties: by number)."""
    counted = scanned.filter("counts is not null").select(F.posexplode("counts").alias("number", "n")).groupBy("number").agg(F.sum("n").alias("n"))
    n = {r["number"]: r["n"] for r in counted.collect()}  # as many rows as there are template words
    order = sorted(range(len(templates.numbers) + 1), key=lambda k: (n.get(k, 0), k))
    place = [0] * len(order)
    for k, number in enumerate(order):
        place[number] = k
    return place


def _literal(values: list[int]) -> Column:
    return F.lit(np.array(values, dtype=np.int32))


def matches(scanned: DataFrame, templates: Templates) -> DataFrame:
    """(row, span, block, family, label, containment): the best template of each family in each block."""
    ranks = _ranks(scanned, templates)
    least = {span: need for span, (_, need) in templates.spans().items()}
    prefixes = []
    for k, (label, family, span, numbers, need) in enumerate(templates.rows):
        ordered = sorted(ranks[n] for n in numbers)
        prefixes += [(span, word, at, k, label, family, need, ordered) for at, word in enumerate(ordered[: len(ordered) - need + 1])]
    index = scanned.sparkSession.createDataFrame(
        prefixes, "span int, word int, t_at int, template int, label string, family string, need int, t_words array<int>")
    held = scanned.filter(F.size("blocks") > 0).select("row", F.explode("blocks").alias("b")).select(
        "row", "b.span", "b.block", F.array_sort(F.transform("b.words", lambda w: F.get(_literal(ranks), w))).alias("words"))
    lowest = F.element_at(F.create_map(*[F.lit(x) for pair in least.items() for x in pair]), F.col("span"))
    front = held.select("*", F.posexplode(F.slice("words", 1, F.size("words") - lowest + 1)).alias("b_at", "word"))
    met = front.join(F.broadcast(index), ["span", "word"]).filter(F.col("b_at") <= F.size("words") - F.col("need"))
    pairs = met.groupBy("row", "span", "block", "template").agg(
        F.min("b_at").alias("b_at"), F.min("t_at").alias("t_at"),
        *[F.first(c).alias(c) for c in ("words", "t_words", "label", "family", "need")])
    left = 1 + F.least(F.size("words") - F.col("b_at") - 1, F.size("t_words") - F.col("t_at") - 1)
    checked = pairs.filter(left >= F.col("need")).withColumn("shared", F.size(F.array_intersect("words", "t_words"))).filter("shared >= need")
    best = F.max(F.struct((F.col("shared").cast("double") / F.size("t_words")).alias("containment"), "shared", "label"))
    return checked.groupBy("row", "span", "block", "family").agg(best.alias("best")).select(
        "row", "span", "block", "family", "best.label", "best.containment")


def find(docs: DataFrame, templates: Templates | None = None) -> DataFrame:
    """Licences of every document: the phrases of the contract and the notices that a block of it holds.

    ``score`` is 1 where a phrase stands, else the greatest containment of a template, 0 if none is met.
    """
    templates = templates or Templates()
    scanned = materialise(scan(docs, templates), "licence-blocks")
    found = matches(scanned, templates).groupBy("row").agg(F.collect_set("label").alias("met"), F.max("containment").alias("most"))
    base = F.filter(F.split("base_labels", ","), lambda x: x != "")
    every = F.array_sort(F.array_distinct(F.concat(base, F.coalesce("met", F.array().cast("array<string>")))))
    return scanned.filter("counts is null").join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"))


def sql(templates: Templates | None = None) -> str:
    """The same result in DuckDB's SQL: all blocks against all templates, nothing pruned."""
    t = templates or Templates()
    word = {n: w.decode() for w, n in t.numbers.items()}
    held = ", ".join(f"({k}, '{label}', '{family}', {span}, {len(ns)}, {need}, '{word[n]}')"
                     for k, (label, family, span, ns, need) in enumerate(t.rows) for n in ns)
    phrases = ", ".join(f"({[w.decode() for w in ws]}, '{label}')" for ws, label in t.phrases)
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    return rf"""
WITH t(template, label, family, span, size, need, word) AS (VALUES {held}),
ph(words, label) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tokens AS (SELECT r, unnest(range(len(w))) AS p, unnest(w) AS word FROM d),
base AS (
  SELECT r, p, ph.label FROM (SELECT d.r, d.w, x.p FROM d, (SELECT r, unnest(range(len(w))) AS p FROM d) x WHERE x.r = d.r) b
  JOIN ph ON b.w[b.p + 1] = ph.words[1] AND list_slice(b.w, b.p + 1, b.p + len(ph.words)) = ph.words),
based AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY r),
hits AS (SELECT r, p, t.* FROM tokens JOIN t USING (word)),
blocks AS (
  SELECT r, p // span AS block, * EXCLUDE (r, p) FROM hits UNION ALL SELECT r, p // span - 1, * EXCLUDE (r, p) FROM hits WHERE p >= span),
shared AS (
  SELECT r, span, block, family, label, template, count(DISTINCT word) AS shared, any_value(size) AS size FROM blocks
  GROUP BY r, span, block, family, label, template HAVING count(DISTINCT word) >= any_value(need)),
best AS (
  SELECT r, label, CAST(shared AS DOUBLE) / size AS containment,
    row_number() OVER (PARTITION BY r, span, block, family ORDER BY CAST(shared AS DOUBLE) / size DESC, shared DESC, label DESC) AS k FROM shared),
named AS (SELECT r, list(DISTINCT label) AS met, max(containment) AS most FROM best WHERE k = 1 GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_filter(string_split(coalesce(base_labels, ''), ','), lambda x: x <> ''), coalesce(met, [])))), ',')
    AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(most, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN based USING (r) LEFT JOIN named USING (r)
"""
