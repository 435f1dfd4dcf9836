"""Best-fit packing planned on the histogram of lengths.

Documents are tokenised and cut into pieces where they lie; what leaves the tasks is
one small row per piece. The plan needs only how many pieces have each length: at
most ``capacity`` numbers, whatever the corpus. Best fit runs over those counts and
yields runs "the pieces of length l with ranks a to b take the place o of the
sequences s, s+1, ...". A piece then finds its run by its rank within its length.

Ranks need no global sort: a piece keeps its rank within the written file part and
length, and the parts' counts are summed up per length.
"""

from __future__ import annotations

import base64
import bisect
import json
import os
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchloom.llm.common import materialise, rows_of

CAPACITY = 2048
END_ID = 0


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The public vocabulary files are installed on every machine; only their place is asked for."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of the byte-level BPE in ``path``.

    The rank file beside the JSON holds the same vocabulary, and tiktoken encodes it
    several times faster with the same ids; where it is missing or refuses a text, and
    where a text holds one of the file's added tokens, the JSON file's own library encodes.
    """

    def __init__(self, path: str) -> None:
        self._path, self._slow, self._fast = path, None, None
        with open(path, encoding="utf-8") as file:
            self._added = [t["content"] for t in json.load(file).get("added_tokens") or []]
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding(
                "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def reference(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
        return self._slow.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if self._fast is None or any(token in text for token in self._added):
            return self.reference(text)
        try:
            return self._fast.encode_ordinary(text)
        except (ValueError, RuntimeError):
            return self.reference(text)


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for a shorter first piece."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, rank): ``rank`` counts within (part, length).

    The result must be written once before use, since ``part`` is the writing task's number.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = Encoder(path), TaskContext.get().partitionId(), Counter()
        for ids, texts in rows_of(batches, "doc_id", "text"):
            out: list[tuple] = []
            for doc, text in zip(ids, texts):
                tokens = array("I", encode(text or ""))
                tokens.append(end_id)
                raw = memoryview(np.frombuffer(tokens, dtype=np.uint32).astype("<u4"))
                for k, (start, length) in enumerate(cut(len(tokens), capacity)):
                    out.append((doc, k, start, length, zlib.crc32(raw[start: start + length]), part, seen[length]))
                    seen[length] += 1
            columns = list(zip(*out)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: runs (length, first rank, end rank, first sequence, offset).

    Sequences with equal room are kept as runs of consecutive numbers, so one step
    places many pieces. A step uses up either a run's sequences or the length's
    pieces, hence the plan's size depends on the number of lengths, not of pieces.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, how many)
    rooms: list[int] = []
    runs: list[tuple[int, int, int, int, int]] = []
    fresh = 0

    def put(room: int, run: tuple[int, int]) -> None:
        if room:
            if room not in free:
                free[room] = []
                bisect.insort(rooms, room)
            free[room].append(run)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = free[room].pop()
                used = min(many, left)
                if many > used:
                    free[room].append((first + used, many - used))
                if not free[room]:
                    del free[room]
                    rooms.pop(at)
            else:  # new sequences, as many as these pieces fill by themselves
                room, first = capacity, fresh
                used = -(-left // (capacity // length))
                fresh += used
            runs.append((length, rank, rank + used, first, capacity - room))
            put(room - length, (first, used))
            left -= used
            rank += used
    return runs


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Place every piece of every document: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is the end id alone. Rows without a doc_id and repeated rows
    are packed like any other. Only ``doc_id`` and ``text`` are read, so further
    columns may have any name. An empty table gives no row. Sequences are gapless
    from 0; their ids are consecutive numbers.
    """
    made = materialise(pieces(docs, path, capacity, end_id), "packing-pieces")
    per_part = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(plan(counts, capacity)), dtype=np.int64).reshape(-1, 5)
    ranked = made.join(firsts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Runs sorted by (length, first rank): find a piece's run by one search over the pair as a record.
        lengths = runs[:, 0]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            found = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                low, high = np.searchsorted(lengths, [value, value + 1])
                mine = length == value
                found[mine] = low + np.searchsorted(runs[low:high, 1], rank[mine], side="right") - 1
            sequence = runs[found, 3] + rank - runs[found, 1]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(runs[found, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
