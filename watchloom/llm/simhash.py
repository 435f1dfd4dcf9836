"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits. Cut into s segments, two fingerprints that differ in at
most d bits agree in some segment but for at most ``d // s`` bits; the fewest
segments for which that is one bit are taken (3 for 4 bits). Each segment is
indexed once per bit position with that bit deleted (its wildcard), so segments
within one bit share an index key. Equal keys meet by an equality shuffle, whole
fingerprints are then compared.

Only distinct fingerprints are indexed. The members of a key are compared in numpy
and give a spanning forest of their links, not the pairs. Large keys are cut into
blocks, and a task compares two blocks: a hot key costs more tasks, never a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchloom.llm.common import components, document_bytes, materialise, parts, rows_of

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
#: Members of one index key that one side of a comparison holds.
BLOCK = 512
_CHUNK = 1 << 15


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of one text: A-Z lowered, words between ASCII white space, repeats counted; no word: zero."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[: len(found) - words] + 1).tolist()]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at: at + _CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, bits): one row per row of ``docs``; ``bits`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            bits = np.array([fingerprint(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bits)], ["doc_id", "bits"])

    return document_bytes(docs).mapInArrow(run, "doc_id long, bits long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one always differs by at most one bit."""
    n = distance // 2 + 1
    cuts = [round(BITS * k / n) for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variants(bits: np.ndarray, distance: int) -> np.ndarray:
    """One row per fingerprint, one column per (segment, deleted bit): the index keys."""
    out = []
    for first, width in segments(distance):
        part = (bits >> np.uint64(first)) & np.uint64((1 << width) - 1 if width < 64 else 2**64 - 1)
        for hole in range(width):
            kept = part & ~np.uint64(1 << hole)
            mixed = (kept ^ np.uint64((first * 64 + hole + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            out.append(mixed ^ (mixed >> np.uint64(29)))
    return np.stack(out, axis=1)


def index(distinct: DataFrame, distance: int) -> DataFrame:
    """(key, bits): every one-wildcard segment variant of every fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(bits), 4096):
                part = bits[at: at + 4096]
                keys = _variants(part, distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(part, keys.shape[1]).view(np.int64))], ["key", "bits"])

    return distinct.mapInArrow(run, "key long, bits long")


def _forest(left: np.ndarray, right: np.ndarray, distance: int, links: list[tuple[int, int]]) -> None:
    """Links of a spanning forest of the graph between two blocks (or within one, when they are the same)."""
    both = left if right is left else np.concatenate([left, right])
    near = np.bitwise_count(both[:, None] ^ both[None, :]) <= distance
    free = np.ones(len(both), dtype=bool)
    while free.any():
        front = np.array([int(np.argmax(free))])
        free[front] = False
        while len(front):
            reached = near[front] & free[None, :]
            new = np.flatnonzero(reached.any(axis=0))
            links.extend(zip(both[front[reached[:, new].argmax(axis=0)]].tolist(), both[new].tolist()))
            free[new] = False
            front = new


def _streamed(rows: DataFrame, unit: list[str], distance: int, most: int | None) -> DataFrame:
    """Links (a, b) within runs of rows of one unit; rows come grouped by ``unit``.

    Where a unit has over ``most`` members, they are handed on instead, as rows with
    their key and a null ``b``; so no more than ``most`` are ever held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held, last, key, over = 0, None, 0, False
        found: set[tuple[int, int]] = set()
        handed: list[tuple[int, np.ndarray]] = []

        def hand_on() -> None:
            handed.append((key, np.concatenate(kept)))
            kept.clear()

        def close() -> None:
            nonlocal over
            if over:
                if kept:
                    hand_on()
            elif held > 1:
                members = np.unique(np.concatenate(kept))
                made: list[tuple[int, int]] = []
                if len(members) == 2:
                    if int(members[0] ^ members[1]).bit_count() <= distance:
                        made.append((int(members[0]), int(members[1])))
                else:
                    _forest(members, members, distance, made)
                found.update((min(x), max(x)) for x in made)
            kept.clear()
            over = False

        def flush() -> pa.RecordBatch:
            pairs = np.array(sorted(found), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            keys = np.concatenate([np.zeros(len(pairs), np.int64), *(np.full(len(m), k, dtype=np.int64) for k, m in handed)])
            a = np.concatenate([pairs[:, 0], *(m.view(np.int64) for _, m in handed)])
            b = np.concatenate([pairs[:, 1], np.zeros(len(a) - len(pairs), np.int64)])
            found.clear()
            handed.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(a), pa.array(b, mask=np.arange(len(a)) >= len(pairs))], ["key", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [batch.column(c).to_numpy(zero_copy_only=False) for c in unit]
            bits = batch.column("bits").to_numpy(zero_copy_only=False).view(np.uint64)
            changes = np.zeros(len(bits) - 1, dtype=bool)
            for m in marks:
                changes |= m[1:] != m[:-1]
            edges = [0, *(np.flatnonzero(changes) + 1).tolist(), len(bits)]
            for a, b in zip(edges, edges[1:]):
                now = tuple(int(m[a]) for m in marks)
                if now != last:
                    close()
                    held, last, key = 0, now, now[0]
                kept.append(bits[a:b])
                held += b - a
                if most is not None and held > most:
                    over = True
                    hand_on()
            if len(found) > 200_000 or len(handed) > 200:
                yield flush()
        close()
        yield flush()

    return rows.mapInArrow(run, "key long, a long, b long")


def links(distinct: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join all that differ in at most ``distance`` bits.

    Keys with up to two blocks of members are settled where they meet; the members of
    larger ones are dealt to pairs of blocks.
    """
    spark = distinct.sparkSession
    n = parts(spark) * 2
    keyed = index(distinct.repartition(n), distance).repartition(n, "key").sortWithinPartitions("key")
    first = materialise(_streamed(keyed, ["key"], distance, 2 * block), "simhash-links")
    settled = first.filter("b is not null").select("a", "b")
    large = first.filter("b is null").select("key", F.col("a").alias("bits"))
    sizes = large.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("bits"), F.col("blocks").cast("long")).cast("int")
    members = large.join(sizes, "key").withColumn("own", own)
    # A member goes to every pair of blocks that holds its own: (i, j), i <= j.
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "bits")
    dealt = dealt.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return settled.union(_streamed(dealt, ["key", "i", "j"], distance, None).select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and class.

    Returns (doc_id, bits, fingerprint, component_id). ``component_id`` is the
    smallest doc_id reachable over links of at most ``distance`` bits. Null and
    empty texts have fingerprint zero and link like any other; rows without a
    doc_id take part and get the class of their fingerprint (null if no member has
    an id); repeated rows each give a row. Only ``doc_id`` and ``text`` are read,
    so further columns may have any name. An empty table gives no row.
    """
    marked = materialise(fingerprints(docs, words, seed), "simhash-bits")
    distinct = marked.groupBy("bits").agg(F.min("doc_id").alias("least"))
    found = links(distinct.select("bits"), distance)
    rooted = components(found, "simhash")
    # The root of a class is its smallest fingerprint; its name is the smallest doc_id of all members.
    classes = distinct.join(rooted.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_bits = classes.select("bits", "root").join(named, "root").select("bits", "component_id")
    digits = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return marked.join(by_bits, "bits").select(
        F.col("doc_id").cast(T.LongType()), "bits", digits.alias("fingerprint"), "component_id")
