"""Source divergence audit by one-hot level products.

Within a language every kept term has a count in every source. A source's smoothed share
p of a term depends on the count alone, so a pair of sources is priced by its joint table
alone: how many terms have count a in one and b in the other. With one indicator row per
(source, count level) and one column per term, all joint tables of a language are the
product of that 0/1 matrix with its transpose.

The product is made in blocks: terms are dealt by hash into blocks of about ``TERMS``,
sources into tiles of about ``TILE``, and one task multiplies the indicators of one term
block for two tiles, prices the non-zero entries and adds them up per pair of sources. No
task ever holds more than a block of a tile pair, whatever the vocabulary, the number of
sources or the share of one of them. Products are of 0/1 values in single precision with
at most ``MOST_TERMS`` columns, so every sum is exact; prices are 64-bit integers.

A term that no source of the two tiles holds is priced by both sources' share at count
zero; such terms are counted, not listed: blocks give the difference to that price, and
the price times the number of kept terms is added at the end.

Defined cases: null text, lang and source are ''; doc_id is not read, so null ids and
repeated rows are documents like any other; long texts are read whole; equal values rank by
the item's UTF-8 bytes; a language without kept terms gives pairs of value 0; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, parts, rows_of

TERM = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UNIT = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
TERMS = 64
TILE = 512
#: Columns of one product; single precision counts exactly up to 2**24.
MOST_TERMS = 4096
#: Indicator rows of one side of a product.
_ROWS = 2048
#: Entries a task counts before it hands them on.
_HELD = 600_000
_LONG = 1 << 22


def _terms(text: bytes) -> Iterator[bytes]:
    low = text.lower()
    return (m[0] for m in TERM.finditer(low)) if len(low) > _LONG else TERM.findall(low)


def _by_term(lang: str, held: dict[str, tuple[Counter, Counter]]) -> pa.RecordBatch:
    """One row a term: its counts in the sources of ``held``."""
    sizes = [len(docs) for _, docs in held.values()]
    terms = pa.concat_arrays([pa.array(list(docs), pa.binary()) for _, docs in held.values()]).cast(pa.string()).dictionary_encode()
    n = np.concatenate([np.fromiter(map(n.__getitem__, docs), np.int64, len(docs)) for n, docs in held.values()])
    docs = np.concatenate([np.fromiter(docs.values(), np.int64, len(docs)) for _, docs in held.values()])
    source = pa.array(list(held), pa.string()).take(pa.array(np.repeat(np.arange(len(held)), sizes)))
    of = terms.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(of, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(terms.dictionary)))])
    cells = pa.StructArray.from_arrays([source.take(pa.array(order)), pa.array(n[order]), pa.array(docs[order])], ["source", "n", "docs"])
    per_term = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(per_term), pa.string()), terms.dictionary, per_term], ["lang", "term", "cells"])


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n, first): occurrences of every term kept in its language.

    A term is kept if it is in at least ``least`` documents of the language; ``first`` marks one row of each.
    The empty term stands for the group itself. Tasks count first and send one row a term, so each term's counts
    meet in one place, at most as many as there are tasks and sources.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, tuple[Counter, Counter]]] = {}
        size = 0
        for langs, sources, texts in rows_of(batches, "lang", "source", "text"):
            for lang, source, text in zip(langs, sources, texts):
                n, docs_of = held.setdefault(lang, {}).setdefault(source, (Counter({b"": 0}), Counter()))
                before = len(n)
                found = _terms(text)
                if isinstance(found, list):
                    n.update(found)
                    docs_of.update(set(found))
                else:
                    once = Counter(found)
                    n.update(once)
                    docs_of.update(once.keys())
                docs_of[b""] += 1
                size += len(n) - before
            if size > _HELD:
                yield from (_by_term(lang, of) for lang, of in held.items())
                held, size = {}, 0
        yield from (_by_term(lang, of) for lang, of in held.items())

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    rows = docs.select(filled("lang"), filled("source"), filled("text")).withColumn("text", F.col("text").cast("binary"))
    partial = rows.mapInArrow(run, "lang string, term string, cells array<struct<source:string,n:long,docs:long>>")
    met = partial.repartition(parts(docs.sparkSession), "lang", "term").select("lang", "term", F.explode("cells").alias("c"))
    cells = met.groupBy("lang", "term", "c.source").agg(F.sum("c.n").alias("n"), F.sum("c.docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    marked = cells.select(
        "*", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"),
        (F.min("source").over(of_term) == F.col("source")).alias("first"))
    return marked.filter((F.col("lang_docs") >= least) | (F.col("term") == "")).select("lang", "source", "term", "n", "lang_n", "first")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kept)); 1 where nothing is kept. Exact in decimals."""
    over = (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    whole = F.call_function("div", over, F.nullif(total + kept, F.lit(0)).cast("decimal(20,0)"))
    return F.lit(1).cast("long") + F.coalesce(whole, F.lit(0).cast("long"))


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def groups(counts: DataFrame) -> DataFrame:
    """(lang, source, total, kept, lang_total, tiles, p0, blocks, tile): one row per occurring group."""
    word = F.col("term") != ""
    of_source = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if(word & F.col("first")).alias("firsts"))
    of_lang = of_source.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.sum("firsts").alias("kept"), F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    return of_source.drop("firsts").join(of_lang, "lang").select(
        "*", share(F.lit(0).cast("long"), F.col("total"), F.col("kept")).alias("p0"),
        F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS)).cast("int").alias("blocks"),
        F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int").alias("tile"))


def _indicators(shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per (source, level) of ``shares`` (sources x terms): source, share, 0/1 row over the terms."""
    width = shares.shape[1]
    keys = (np.arange(len(shares), dtype=np.int64)[:, None] << 31) | shares
    levels, row = np.unique(keys, return_inverse=True)
    one_hot = np.zeros((len(levels), width), dtype=np.float32)
    one_hot[row.reshape(shares.shape), np.arange(width)[None, :]] = 1
    return levels >> 31, levels & ((1 << 31) - 1), one_hot


def joint_prices(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prices summed over the terms for all pairs of rows of ``left`` and ``right`` (sources x terms, shares).

    Returns (sources of left x sources of right): the price of left against right, and of right against left.
    """
    forth = np.zeros((len(left), len(right)), dtype=np.int64)
    back = np.zeros_like(forth)
    for at in range(0, left.shape[1], MOST_TERMS):
        a_of, a_share, a_hot = _indicators(left[:, at: at + MOST_TERMS])
        b_of, b_share, b_hot = _indicators(right[:, at: at + MOST_TERMS])
        for i in range(0, len(a_hot), _ROWS):
            for j in range(0, len(b_hot), _ROWS):
                joint = a_hot[i: i + _ROWS] @ b_hot[j: j + _ROWS].T
                x, y = np.nonzero(joint)
                n = joint[x, y].astype(np.int64)
                p, q = a_share[i + x], b_share[j + y]
                square = (p - q) ** 2
                where = a_of[i + x], b_of[j + y]
                np.add.at(forth, where, n * (square // q))
                np.add.at(back, where, n * (square // p))
    return forth, back


def pair_values(counts: DataFrame, of: DataFrame) -> DataFrame:
    """(lang, source, item, value): each source against each other one of its language, over all kept terms."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lang, low, high = (k.as_py() for k in key[:3])
        marks = table.filter(pc.is_null(table["term"]))
        cells = table.filter(pc.is_valid(table["term"]))
        names = marks["source"].to_pylist()
        zero = marks["p"].to_numpy()
        sides = marks["tile"].to_numpy()
        term = cells["term"].combine_chunks().dictionary_encode()
        width = len(term.dictionary)
        shares = np.repeat(zero[:, None], width, axis=1)
        place = {s: k for k, s in enumerate(names)}
        owner = np.array([place[s] for s in cells["source"].to_pylist()], dtype=np.int64)
        shares[owner, term.indices.to_numpy(zero_copy_only=False)] = cells["p"].to_numpy()
        a, b = np.flatnonzero(sides == low), np.flatnonzero(sides == high)
        forth, back = joint_prices(shares[a], shares[b])
        apart = (zero[a][:, None] - zero[b][None, :]) ** 2
        forth -= width * (apart // zero[b][None, :])
        back -= width * (apart // zero[a][:, None])
        x, y = (part.ravel() for part in np.meshgrid(a, b, indexing="ij"))
        rows = [(x, y, forth.ravel(), zero)] if low == high else [(x, y, forth.ravel(), zero), (y, x, back.ravel(), zero)]
        p, q, value = (np.concatenate([r[k] for r in rows]) for k in range(3))
        unlike = p != q
        p, q, value = p[unlike], q[unlike], value[unlike]
        all_names = np.array(names, dtype=object)
        return pa.table({
            "lang": pa.array([lang] * len(p), pa.string()), "source": pa.array(all_names[p], pa.string()), "item": pa.array(all_names[q], pa.string()),
            "over": pa.array(value), "empty": pa.array((zero[p] - zero[q]) ** 2 // zero[q])})

    def met(rows: DataFrame) -> DataFrame:
        """Each row for all tile pairs its own tile takes part in."""
        other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return other.select(
            "lang", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "block", "source", "tile", "term", "p")

    wide = counts.filter("term <> ''").join(of, ["lang", "source"])
    cells = wide.select(
        "lang", "source", "tile", "tiles", "term", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
        share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
    marks = of.select(
        "lang", "source", "tile", "tiles", F.lit(None).cast("string").alias("term"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("p0").alias("p"))
    priced = met(cells).unionByName(met(marks)).groupBy("lang", "low", "high", "block").applyInArrow(
        run, "lang string, source string, item string, over long, empty long")
    summed = priced.groupBy("lang", "source", "item").agg(F.sum("over").alias("over"), F.first("empty").alias("empty"))
    kept_of = of.groupBy("lang").agg(F.first("kept").alias("kept"))
    return summed.join(kept_of, "lang").select("lang", "source", "item", (F.col("over") + F.col("kept") * F.col("empty")).alias("value"))


def term_values(counts: DataFrame, of: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms that a source uses with a larger share than its language."""
    cells = counts.filter("n > 0").join(of, ["lang", "source"])
    shares = cells.select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    return shares.filter("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's language is from every other source's, and by which terms."""
    counts = materialise(term_counts(docs), "divergence-counts")
    of = materialise(groups(counts), "divergence-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = None
    for part, rows in (("pair", pair_values(counts, of)), ("term", term_values(counts, of))):
        ranked = rows.withColumn("rank", F.row_number().over(order))
        if part == "term":
            ranked = ranked.filter(F.col("rank") <= top_terms)
        ranked = ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        out = ranked if out is None else out.unionByName(ranked)
    return out


_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
SQL = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
tokens AS (SELECT r, lang, source, unnest(w) AS term FROM (SELECT *, row_number() OVER () AS r FROM d)),
kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
of_lang AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS total, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 1)) // CAST(coalesce(tot.total, 0) + o.v AS HUGEINT) AS p,
    1 + ({UNIT}::HUGEINT * (kept.n + 1)) // (o.total + o.v) AS q
  FROM g JOIN kept USING (lang) JOIN of_lang o USING (lang) LEFT JOIN tot ON tot.lang = g.lang AND tot.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT i.lang, i.source, j.source AS item, sum(((i.p - j.p) * (i.p - j.p)) // j.p) AS value
    FROM p i JOIN p j ON i.lang = j.lang AND i.term = j.term AND i.source <> j.source GROUP BY ALL) x
  ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM every)
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
