"""Repeated passages by suffix arrays over shards of candidate text.

Removed is every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller doc_id. Three steps keep the sorted text small and exact:

1. Anchors. Every string of LENGTH bytes holds an anchor, the 24-byte piece with the
   least hash among the 27 in it; equal strings have equal anchors at equal places.
   Blocks of documents exchange short anchor hashes (four bytes each), and keep the
   anchors that a second document has.
2. Surroundings. The up to 76 bytes around a kept anchor hold every string it stands
   for. Blocks exchange a hash of each with their smallest doc_id: where a smaller
   document has the same surroundings, all strings in them are removed. What is left
   is one owner for each of different surroundings of one anchor.
3. Shards. Those that share an anchor share a shard. Each is cut to the stretch around
   its anchor that the others have some part of, stretches under LENGTH bytes go, and
   one of equal stretches stands for all. These are sorted by external induced sorting
   (``suffix_array``); neighbours that share LENGTH bytes form a class, and its strings
   are removed where a smaller doc_id is in the class.

Whole copies are found by their digest; only one copy per block gives anchors.
"""

from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import bucket_of, materialise, parts, rows_of
from watchloom.llm.suffix_array import equal_starts

LENGTH = 50
PIECE = 24
WINDOW = LENGTH - PIECE + 1
#: Entries that the queues of one shard hold in memory before they go to disk.
MEMORY = 4_000_000

_PRIME = 0x9E3779B97F4A7C15
_CHUNK = 1 << 19


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_PRIME, n, 1 << 64))


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every PIECE bytes."""
    h1 = data.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h = h16[:-8] * _power(8) + h8[16:]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text: of every WINDOW pieces the leftmost with the least hash."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data = np.frombuffer(text, dtype=np.uint8)
    low = np.uint64((1 << 20) - 1)
    places, hashes = [], []
    for start in range(0, len(data) - LENGTH + 1, _CHUNK):
        h = piece_hashes(data[start: start + _CHUNK + LENGTH - 1])
        m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        for step in (1, 2, 4, 8):
            m = np.minimum(m[:-step], m[step:])
        m = np.minimum(m[: len(m) - (WINDOW - 16)], m[WINDOW - 16:])
        at = (m & low).astype(np.int64)
        at = at[np.append(True, at[1:] != at[:-1])]
        places.append(at + start)
        hashes.append(h[at])
    at, h = np.concatenate(places), np.concatenate(hashes)
    fresh = np.append(True, at[1:] != at[:-1])
    return at[fresh], h[fresh]


def _wanted(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows that can hold a string, dealt to blocks."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", text.alias("text")).filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    return rows.withColumn("block", bucket_of(F.col("doc_id"), blocks)).repartition(blocks, "block")


def _first_copies(ids: list[int], texts: list[bytes]) -> dict[int, int]:
    """Row numbers of one copy of each text, the one with the smallest id; digest to row."""
    first: dict[bytes, int] = {}
    for k, text in enumerate(texts):
        digest = xxhash.xxh3_128_digest(text)
        if digest not in first or ids[k] < ids[first[digest]]:
            first[digest] = k
    return first


def shared_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, hashes): for every block the anchors of its own that another document has too, as packed uint32."""

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: dict[int, set[bytes]] = {}
        found: dict[int, list[np.ndarray]] = {}
        for block, texts in rows_of(batches, "block", "text"):
            for b, text in zip(block, texts):
                digest = xxhash.xxh3_128_digest(text)
                if digest not in copies.setdefault(b, set()):
                    copies[b].add(digest)
                    found.setdefault(b, []).append(np.unique(anchors(text)[1]))
        for b, hashes in found.items():
            value, count = np.unique(np.concatenate(hashes), return_counts=True)
            bucket = (value % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            short = (value >> np.uint64(32)).astype("<u4")[order]
            twice = (count[order] > 1).astype(np.uint8)
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            k = [j for j in range(buckets) if cuts[j + 1] > cuts[j]]
            yield pa.RecordBatch.from_arrays([
                pa.array([b] * len(k), pa.int32()), pa.array(k, pa.int32()),
                pa.array([short[cuts[j]: cuts[j + 1]].tobytes() for j in k], pa.binary()),
                pa.array([np.packbits(twice[cuts[j]: cuts[j + 1]]).tobytes() for j in k], pa.binary())], ["block", "bucket", "hashes", "twice"])

    def meet(group: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, dtype="<u4") for x in group.column("hashes").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(h)) for x, h in zip(group.column("twice").to_pylist(), lists)]
        every = np.concatenate(lists)
        order = np.argsort(every)
        value = every[order]
        fresh = np.append(True, value[1:] != value[:-1])
        firsts = np.flatnonzero(fresh)
        # Shared: offered by two blocks, or by one that has it twice.
        weight = np.add.reduceat(1 + np.concatenate(twice)[order].astype(np.int64), firsts)
        shared = np.empty(len(every), dtype=bool)
        shared[order] = np.repeat(weight > 1, np.diff(np.append(firsts, len(value))))
        ends = np.cumsum([len(h) for h in lists])
        answers = [h[shared[e - len(h): e]].tobytes() for h, e in zip(lists, ends.tolist())]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "hashes": pa.array(answers, pa.binary())})

    offered = rows.mapInArrow(offer, "block int, bucket int, hashes binary, twice binary")
    return offered.groupBy("bucket").applyInArrow(meet, "block int, bucket int, hashes binary").filter("octet_length(hashes) > 0")


def _occurrences(docs: pa.Table, keys: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes, np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """Of one copy of each text of a block: (doc_id, digest, text, places, hashes, start of the surroundings, their hash) of its anchors in ``keys``."""
    ids, texts = docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()
    for digest, k in _first_copies(ids, texts).items():
        text = texts[k]
        at, h = anchors(text)
        key = _key(h, buckets)
        mine = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
        at, h = at[mine], h[mine]
        low = np.maximum(0, at - (WINDOW - 1))
        around = [xxhash.xxh3_64_intdigest(text[a: p + LENGTH], p - a) for a, p in zip(low.tolist(), at.tolist())]
        yield ids[k], digest, text, at, h, low, around


def _key(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(32)) * np.uint64(buckets) + h % np.uint64(buckets)


def _unpacked(known: pa.Table, buckets: int) -> np.ndarray:
    lists = [np.frombuffer(x, dtype="<u4") for x in known.column("hashes").to_pylist()]
    return np.sort(np.concatenate([h.astype(np.uint64) * np.uint64(buckets) + np.uint64(b) for h, b in zip(lists, known.column("bucket").to_pylist())]))


#: What a block is told about surroundings of its own: a smaller document outside has the same; the anchor has others too.
_OUTSIDE, _OTHERS = 1, 2
_ENTRY = np.dtype([("anchor", "<u4"), ("around", "<u8"), ("doc", "<i8")])
_ANSWER = np.dtype([("anchor", "<u4"), ("around", "<u8"), ("says", "u1")])


def decided(rows: DataFrame, shared: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, says): per block what is known of the surroundings of its shared anchors, as packed (hash, flags).

    Blocks send each different surroundings once, as a hash with their smallest doc_id.
    """

    def tell(docs: pa.Table, known: pa.Table) -> pa.Table:
        names = ["block", "bucket", "entries"]
        if not docs.num_rows or not known.num_rows:
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.binary())], names=names)
        found = []
        for doc, _, _, _, h, _, around in _occurrences(docs, _unpacked(known, buckets), buckets):
            found.append((h, np.array(around, dtype=np.uint64), np.full(len(h), doc, dtype=np.int64)))
        h, around, doc = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((doc, around, h))
        h, around, doc = h[order], around[order], doc[order]
        fresh = np.append(True, (h[1:] != h[:-1]) | (around[1:] != around[:-1])) if len(h) else np.zeros(0, bool)
        h, around, doc = h[fresh], around[fresh], doc[fresh]
        entries = np.zeros(len(h), dtype=_ENTRY)
        entries["anchor"], entries["around"], entries["doc"] = h >> np.uint64(32), around, doc
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        k = [j for j in range(buckets) if cuts[j + 1] > cuts[j]]
        block = docs.column("block")[0].as_py()
        return pa.table([
            pa.array([block] * len(k), pa.int32()), pa.array(k, pa.int32()), pa.array([entries[order[cuts[j]: cuts[j + 1]]].tobytes() for j in k], pa.binary())], names=names)

    def meet(group: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, dtype=_ENTRY) for x in group.column("entries").to_pylist()]
        every = np.concatenate(lists)
        order = np.lexsort((every["doc"], every["around"], every["anchor"]))
        anchor, around, doc = (every[c][order] for c in ("anchor", "around", "doc"))
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new_around = np.append(True, new_anchor[1:] | (around[1:] != around[:-1]))
        first = np.flatnonzero(new_around)
        least = np.repeat(doc[first], np.diff(np.append(first, len(doc))))
        heads = np.flatnonzero(new_anchor)
        kinds = np.add.reduceat(new_around.astype(np.int64), heads)
        others = np.repeat(kinds > 1, np.diff(np.append(heads, len(doc))))
        says = np.zeros(len(every), dtype=np.uint8)
        # A block whose smallest document is not the smallest of all has it outside; ties cannot be, an id lies in one block.
        says[order] = (least < doc) * _OUTSIDE + others * _OTHERS
        told = np.zeros(len(every), dtype=_ANSWER)
        told["anchor"], told["around"], told["says"] = every["anchor"], every["around"], says
        ends = np.cumsum([len(x) for x in lists])
        answers = [told[e - len(x): e].tobytes() for x, e in zip(lists, ends.tolist())]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "says": pa.array(answers, pa.binary())})

    told = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(tell, "block int, bucket int, entries binary")
    return told.groupBy("bucket").applyInArrow(meet, "block int, bucket int, says binary")


def placed(rows: DataFrame, says: DataFrame, buckets: int, shards: int) -> DataFrame:
    """What every block makes of the answers, as rows of two kinds.

    (doc_id, digest, start, end) with a null ``around``: strings that a smaller document
    has with the same surroundings, runs merged. With ``around``: surroundings whose
    smallest document is this one, but whose anchor has others; ``start`` is their
    place and ``shard`` where they meet.
    """

    def place(docs: pa.Table, told: pa.Table) -> pa.Table:
        names = ["doc_id", "digest", "start", "end", "shard", "left", "around"]
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        out: list[list] = [[] for _ in names]
        if docs.num_rows and told.num_rows:
            lists = [np.frombuffer(x, dtype=_ANSWER) for x in told.column("says").to_pylist()]
            keys = np.sort(np.concatenate([
                x["anchor"].astype(np.uint64) * np.uint64(buckets) + np.uint64(b) for x, b in zip(lists, told.column("bucket").to_pylist())]))
            answers = np.concatenate(lists)
            answers = answers[np.argsort(answers["around"], kind="stable")]
            known, says_of = np.ascontiguousarray(answers["around"]), answers["says"]
            least = np.full(len(answers), np.iinfo(np.int64).max)
            found = []
            for doc, digest, text, at, h, low, hashes in _occurrences(docs, keys, buckets):
                where = np.searchsorted(known, np.array(hashes, dtype=np.uint64))  # all are known: the block sent them
                np.minimum.at(least, where, doc)
                found.append((doc, digest, text, at, h, low, where))
            for doc, digest, text, at, h, low, where in found:
                flags = says_of[where]
                smaller = ((flags & _OUTSIDE) > 0) | (least[where] < doc)
                ends = np.minimum(at + LENGTH, len(text))
                starts, reach = low[smaller], ends[smaller]  # both ascend
                fresh = np.append(True, starts[1:] > reach[:-1]) if len(starts) else np.zeros(0, bool)
                k = int(fresh.sum())
                tails = np.append(np.flatnonzero(fresh)[1:], len(starts)) - 1 if k else np.zeros(0, np.int64)
                _extend(out, [doc] * k, [digest] * k, starts[fresh].tolist(), reach[tails].tolist(), [None] * k, [None] * k, [None] * k)
                mine = ~smaller & ((flags & _OTHERS) > 0)
                begin, end = low[mine].tolist(), ends[mine].tolist()
                k = len(begin)
                _extend(out, [doc] * k, [digest] * k, begin, end, (h[mine] % np.uint64(shards)).tolist(), (at - low)[mine].tolist(),
                        [text[a:e] for a, e in zip(begin, end)])
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return rows.groupBy("block").cogroup(says.groupBy("block")).applyInArrow(
        place, "doc_id long, digest binary, start long, end long, shard int, left int, around binary")


def _extend(columns: list[list], *more: list) -> None:
    for column, values in zip(columns, more):
        column += values


def shared_reach(texts: list[bytes], left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and after the anchor, ``left`` bytes into each text, some other text has too (-1: the anchor is alone).

    Neighbours in the order of what follows (or, backwards, precedes) the anchor share most. Never too few: bytes past the
    end of a shorter neighbour count as zeros.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    anchor = np.cumsum(sizes) - sizes + left
    out = []
    for side, room in ((-1, left), (1, sizes - left - PIECE)):
        held = np.zeros((len(texts), LENGTH), dtype=np.uint8)
        for k in range(PIECE):
            held[:, k] = data[anchor + k]
        for k in range(WINDOW - 1):
            has = np.flatnonzero(room > k)
            held[has, PIECE + k] = data[anchor[has] + (PIECE + k if side > 0 else -1 - k)]
        order = np.argsort(held.view(f"S{LENGTH}").ravel())
        held = held[order]
        same = np.zeros(len(texts) + 1, dtype=np.int64)
        same[1:-1] = np.logical_and.accumulate(held[1:] == held[:-1], axis=1).sum(axis=1)
        most = np.empty(len(texts), dtype=np.int64)
        most[order] = np.maximum(same[:-1], same[1:])
        out.append(np.where(most < PIECE, -1, np.minimum(most - PIECE, room)))
    return out[0], out[1]


def sorted_hits(held: DataFrame, length: int = LENGTH, memory: int = MEMORY) -> DataFrame:
    """(doc_id, digest, start, end): runs of bytes whose strings a smaller document of the shard has."""

    def sort(group: pa.Table) -> pa.Table:
        docs, starts, digests = group.column("doc_id").to_numpy(), group.column("start").to_numpy(), group.column("digest").to_pylist()
        left, around = group.column("left").to_numpy(), group.column("around").to_pylist()
        before, after = shared_reach(around, left)
        mine = np.flatnonzero((before >= 0) & (before + after >= length - PIECE))  # others hold no string of another text
        low, high = (left - before)[mine], (left + PIECE + after)[mine]
        # Equal texts are sorted once, for the smallest document that has them.
        number: dict[bytes, int] = {}
        kind = np.array([number.setdefault(around[k][a:e], len(number)) for k, a, e in zip(mine.tolist(), low.tolist(), high.tolist())], dtype=np.int64)
        docs, starts, span = docs[mine], starts[mine] + low, high - low
        texts = list(number)
        ids = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(ids, kind, docs)
        rows, begin, end = _runs(texts, ids, length, memory)
        # Of a text its smallest documents lose what others have, all larger ones the whole.
        first, count = np.searchsorted(rows, kind), np.searchsorted(rows, kind, side="right") - np.searchsorted(rows, kind)
        whole = docs > ids[kind]
        count[whole] = 1
        who = np.repeat(np.arange(len(docs)), count)
        at = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count) + first[who]
        begin, end = (np.append(x, 0)[np.minimum(at, len(x))] for x in (begin, end))
        begin, end = np.where(whole[who], 0, begin), np.where(whole[who], span[who], end)
        return pa.table({
            "doc_id": pa.array(docs[who]), "digest": pa.array([digests[k] for k in mine[who].tolist()], pa.binary()),
            "start": pa.array(starts[who] + begin), "end": pa.array(starts[who] + end)})

    return held.groupBy("shard").applyInArrow(sort, "doc_id long, digest binary, start long, end long")


def _runs(texts: list[bytes], ids: np.ndarray, length: int, memory: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of a text, start, end), ascending: runs of its bytes whose strings a text of a smaller id has."""
    if not texts:
        return (np.zeros(0, np.int64),) * 3
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    text = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8).astype(np.int16) + 1
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    text[firsts + sizes - 1] = 0  # below every byte
    row = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(text)) - firsts[row] <= sizes[row] - 1 - length  # starts with a whole string
    owner = np.full(len(text), -1, dtype=np.int64)
    left: list[tuple[np.ndarray, np.ndarray]] = []
    folder = tempfile.mkdtemp(prefix="suffixes-")  # of this task alone

    def close(upto: int | None) -> None:
        """Settle all classes but the one that may go on."""
        if not left:
            return
        p, c = (np.concatenate(x) for x in zip(*left))
        done = c != upto if upto is not None else np.ones(len(c), dtype=bool)
        left[:] = [(p[~done], c[~done])] if not done.all() else []
        p, c = p[done], c[done]
        if len(p):
            starts = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            least = np.minimum.reduceat(ids[row[p]], starts)
            owner[p] = np.repeat(least, np.diff(np.append(starts, len(p))))

    def visit(positions: np.ndarray, classes: np.ndarray) -> None:
        mine = inside[positions]
        if mine.any():
            left.append((positions[mine], classes[mine]))
        if sum(len(p) for p, _ in left) > 200_000:
            close(int(classes[-1]))

    try:
        equal_starts(text, length, folder, visit, memory)
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    close(None)
    places = np.flatnonzero(inside & (owner >= 0) & (owner < ids[row]))
    if not len(places):
        return places, places, places
    heads = np.flatnonzero(np.append(True, (np.diff(places) > 1) | (row[places][1:] != row[places][:-1])))
    tails = np.append(heads[1:], len(places)) - 1
    own = row[places[heads]]
    return own, places[heads] - firsts[own], places[tails] - firsts[own] + length


def removed_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, spans): maximal removed runs [start, end) in bytes of the texts that are no whole copies."""
    spark = docs.sparkSession
    n = parts(spark) * 2
    rows = _wanted(docs, n)
    found = materialise(placed(rows, decided(rows, shared_anchors(rows, n), n), n, n), "passages-placed")
    hits = found.filter("around is null").select("doc_id", "digest", "start", "end")
    hits = hits.union(sorted_hits(found.filter("around is not null")))
    spans = F.array_sort(F.collect_set(F.struct("start", "end")))  # of one document
    return hits.groupBy("doc_id", "digest").agg(spans.alias("spans"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` without its repeated passages.

    Returns (doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256); ``kept`` are the
    remaining bytes. Null and empty texts, and those shorter than LENGTH bytes, stay
    whole. Rows without a doc_id are older than none and stay whole. Rows with the
    same doc_id belong to one document, so they take nothing from each other. Only
    ``doc_id`` and ``text`` are read, so further columns may have any name. An empty
    table gives no row.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", text.alias("text")).withColumn("sha", F.sha1("text"))
    oldest = rows.filter(F.octet_length("text") >= LENGTH).groupBy("sha").agg(F.min("doc_id").alias("oldest"))
    spans = removed_spans(docs)
    # The digest of the spans tells rows of one id apart; it is checked where the bytes are.
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("digest", "spans")).alias("found"))
    small = rows.select("doc_id", "sha").filter(F.octet_length("text") >= LENGTH).join(oldest, "sha").filter("oldest < doc_id").select("doc_id", "sha").distinct()
    copies = small.groupBy("doc_id").agg(F.collect_set("sha").alias("copies"))
    told = by_doc.join(copies, "doc_id", "full")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        for ids, texts, shas, found, copied in rows_of(batches, "doc_id", "text", "sha", "found", "copies"):
            out = []
            for doc, body, sha, spans_of, whole in zip(ids, texts, shas, found, copied):
                if whole and sha in whole:
                    kept, n = b"", 1
                else:
                    kept, n = body, 0
                    digest = xxhash.xxh3_128_digest(body) if spans_of else b""
                    mine = next((x["spans"] for x in spans_of or () if x["digest"] == digest), None)
                    if mine:
                        pieces, at = [], 0
                        for span in mine:
                            if span["start"] > at or not n:
                                n += 1
                                pieces.append(body[at: span["start"]])
                            at = max(at, span["end"])
                        kept = b"".join([*pieces, body[at:]])
                out.append((doc, len(body), len(body) - len(kept), n, kept, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names)

    return rows.join(told, "doc_id", "left").mapInArrow(
        keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
