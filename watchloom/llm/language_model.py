"""Language-model scores by a weighted backoff automaton.

The automaton's states are the empty context and the n-grams shorter than ``ORDER``; arcs
carry log-probabilities, failure arcs the backoff weight of a state. Where a state has no
arc for the next word, its failure arc is paid and the shorter context tried. One
left-to-right traversal of a document carries the state and adds up what is paid.

Every word of the corpus is counted, and every n-gram that occurs ``MIN_COUNT`` times in
the training texts is an arc, at any size of the corpus. The model is never in one place.
Texts are cut into blocks of documents. For each order, a block sends its different
n-grams, grouped by context, to buckets; a bucket adds up all blocks' counts and answers
each block with the counts of its own n-grams and the sums of their contexts. With these
a block has all arcs and failure arcs that its texts can take, and walks them. N-grams of
the next order are sent only where both parts occur ``MIN_COUNT`` times, which all of those
that can be arcs do.

A context that holds a large share of the corpus is dealt over several buckets by the word
that follows; blocks then ask all of them for their part of the context's sums.

Probabilities are interpolated absolute discounting over an add-half unigram distribution,
so they sum to one in every state.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchloom.llm.common import document_bytes, materialise, rows_of

ORDER = 3
MIN_COUNT = 2
DISCOUNT = 0.75
HELD_OUT = (5, 1)  # crc32(doc_id as text) mod 5 = 1 is only scored
END, START = b"\n", b"\r"  # no word holds white space
BLOCK_BYTES = 8 << 20  # text of a block, some 30 times as much memory; a longer document is a block of its own
BUCKET_TOKENS = 1 << 19  # tokens of the corpus for each bucket
_BLOCK = "block long, ids array<long>, held array<boolean>, sizes array<int>, words binary, tokens binary, n_tokens long"
_ASKED = "bucket int, block long, asked binary"
_ANSWER = "block long, level int, bucket int, n_words long, n_tokens long, answer binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def word_hash(word: bytes) -> int:
    """Signed 64-bit key of a word; two of a hundred million words collide with a chance below one in a thousand."""
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def held_out(doc_id: str = "doc_id"):
    modulus, rest = HELD_OUT
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == rest, F.lit(False))


class _Keys(dict):
    """Word to its key. Bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = key = word_hash(word)
        return key


_START_KEY, _END_KEY = (np.array([word_hash(w)], dtype=np.int64).view(np.uint64)[0] for w in (START, END))


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of 64-bit keys."""
    out = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
    return out ^ (out >> np.uint64(31))


# Bits of the last word's key that an n-gram has beside its context's whole key. A context of one word may be followed by
# a hundred million others (some 20 pairs of these would share a count), one of two or more words by a hundred thousand (0.005 pairs).
_WORD_FOLLOWER_BITS, _FOLLOWER_BITS = np.uint64(48), np.uint64(40)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0, byte by byte of all of them, compressed."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return struct.pack("<qb", len(values), width) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unpack(packed: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<qb", packed)
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        planes = pa.decompress(packed[9:], n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, dtype=np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def _join(*parts: np.ndarray) -> bytes:
    packed = [_pack(p) for p in parts]
    return b"".join(struct.pack("<q", len(p)) + p for p in packed)


def _split(joined: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(joined):
        size, = struct.unpack_from("<q", joined, at)
        out.append(_unpack(joined[at + 8:at + 8 + size]))
        at += 8 + size
    return out


def blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """The rows in blocks: words numbered by how often they are in the block, texts as such numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, made, size = _Keys(), 0, 0
        held: tuple[list, list, list, list] = ([], [], [], [])
        task = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            ids, flags, sizes, words = held
            found, at, n = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            number = np.empty(len(order), dtype=np.int64)
            number[order] = np.arange(len(order))
            row = {"block": (task << 32) + made, "ids": list(ids), "held": list(flags), "sizes": list(sizes),
                   "words": _pack(found[order].view(np.uint64)), "tokens": _pack(number[at]), "n_tokens": len(at)}
            for part in held:
                part.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for ids, texts, flags in rows_of(batches, "doc_id", "text", "held_out", at_most=64):
            for doc_id, text, flag in zip(ids, texts, flags):
                if size and size + len(text) > block_bytes:
                    yield flush()
                    made, size = made + 1, 0
                found = np.fromiter(map(keys.__getitem__, (START, *text.lower().split(), END)), dtype=np.int64)
                for part, value in zip(held, (doc_id, flag, len(found), found)):
                    part.append(value)
                size += len(text) + 1
        if size:
            yield flush()

    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                        ("words", pa.binary()), ("tokens", pa.binary()), ("n_tokens", pa.int64())])
    return rows.mapInArrow(run, _BLOCK)


@dataclass
class Level:
    """The n-grams of one order in a block."""

    key: np.ndarray  # as contexts
    last: np.ndarray  # number of the last word
    left: np.ndarray  # the n-gram without its last word, in the level before
    right: np.ndarray  # the n-gram without its first word, likewise
    at: np.ndarray  # n-gram that starts at each place of the block, or -1
    own: np.ndarray  # occurrences in the block's training texts
    n: np.ndarray | None = None  # in all training texts
    followed: np.ndarray | None = None  # as a context: occurrences of the n-grams kept, and how many those are
    followers: np.ndarray | None = None


class Block:
    """A block's texts and what the buckets have answered so far."""

    def __init__(self, row: dict, buckets: int, total: int) -> None:
        self.ids, self.held, self.sizes = row["ids"], row["held"], np.array(row["sizes"], dtype=np.int64)
        self.buckets, self.total = buckets, max(1, total)
        words, tokens = _unpack(row["words"]), _unpack(row["tokens"]).astype(np.int64)
        self.train = np.repeat(~np.array(self.held, dtype=bool), self.sizes)
        everything = np.arange(len(words))
        self.end = int(np.flatnonzero(words == _END_KEY)[0])
        self.levels = [Level(words, everything, everything, everything, tokens, np.bincount(tokens[self.train], minlength=len(words)))]

    def _next(self) -> Level:
        """N-grams of the next order, both parts of which are kept."""
        low = self.levels[-1]
        first, second = low.at[:-1], low.at[1:]
        places = np.flatnonzero((first >= 0) & (second >= 0) & ((first != self.end) if len(self.levels) == 1 else True))
        code, at = np.unique(first[places] * len(low.key) + second[places], return_inverse=True)
        left, right = np.divmod(code, max(1, len(low.key)))
        where = np.full(len(low.at), -1, dtype=np.int64)
        where[places] = at
        own = np.bincount(at[self.train[places]], minlength=len(code))
        words = self.levels[0].key
        return Level(_mixed(low.key[left], words[low.last[right]]), low.last[right], left, right, where, own)

    def _dealt(self, level: int) -> tuple[Level, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which contexts and n-grams go to which buckets, both in order of bucket and context."""
        if level == 1:
            grams, context = self.levels[0], self.levels[0]
            follower = np.zeros(len(grams.key), dtype=np.uint64)
            listed = np.arange(len(grams.key))
            spread = np.ones(len(grams.key), dtype=np.int64)
        else:
            grams, context = self._next(), self.levels[-1]
            follower = self.levels[0].key[grams.last] >> (np.uint64(64) - (_WORD_FOLLOWER_BITS if level == 2 else _FOLLOWER_BITS))
            listed = np.flatnonzero(context.last != self.end)
            spread = np.minimum(self.buckets, 1 + (4.0 * self.buckets / self.total * context.n).astype(np.int64))
        order = np.argsort(context.key, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        home = (context.key % np.uint64(self.buckets)).astype(np.int64)
        times = spread[listed]
        lists = np.repeat(listed, times)
        salt = np.arange(len(lists)) - np.repeat(np.cumsum(times) - times, times)
        width = max(1, len(context.key))
        list_place = (home[lists] + salt) % self.buckets * width + rank[lists]
        turn = np.argsort(list_place, kind="stable")
        lists, list_place = lists[turn], list_place[turn]
        if (times == 1).all():  # n-grams are in order of their contexts' numbers: whole runs move
            run = np.bincount(grams.left, minlength=len(context.key))
            begin, run = (np.cumsum(run) - run)[lists], run[lists]
            turn = np.repeat(begin - np.cumsum(run) + run, run) + np.arange(int(run.sum()))
            return grams, follower, lists, list_place, turn, np.repeat(list_place, run), np.arange(self.buckets + 1) * width
        gram_place = (home[grams.left] + (follower % spread[grams.left].astype(np.uint64)).astype(np.int64)) % self.buckets * width + rank[grams.left]
        turn = np.argsort(gram_place, kind="stable")
        return grams, follower, lists, list_place, turn, gram_place[turn], np.arange(self.buckets + 1) * width

    def ask(self, level: int) -> Iterator[tuple[int, bytes]]:
        """(bucket, question) for the n-grams of the order ``level``."""
        grams, follower, lists, list_place, turn, gram_place, borders = self._dealt(level)
        context = self.levels[-1]
        each = np.searchsorted(gram_place, list_place, "right") - np.searchsorted(gram_place, list_place, "left")
        from_list, from_gram = np.searchsorted(list_place, borders), np.searchsorted(gram_place, borders)
        for b in np.flatnonzero(np.diff(from_list)).tolist():
            keys = context.key[lists[from_list[b]:from_list[b + 1]]]
            mine = turn[from_gram[b]:from_gram[b + 1]]
            gaps = np.diff(keys, prepend=np.uint64(0))
            yield b, _join(gaps, each[from_list[b]:from_list[b + 1]], follower[mine] if level > 1 else mine[:0], grams.own[mine])

    def hear(self, level: int, answers: list[bytes]) -> None:
        """Takes the answers on the order ``level``, in order of the buckets."""
        grams, _, lists, _, turn, _, _ = self._dealt(level)
        heard = [_split(a) for a in answers]
        n, followed, followers = (np.concatenate([h[k] for h in heard] or [np.zeros(0, dtype=np.uint64)]).astype(np.int64) for k in range(3))
        if level == 1:
            grams.n = np.zeros(len(grams.key), dtype=np.int64)
            grams.n[lists] = followed
            return
        context = self.levels[-1]
        context.followed, context.followers = np.zeros((2, len(context.key)), dtype=np.int64)
        np.add.at(context.followed, lists, followed)
        np.add.at(context.followers, lists, followers)
        grams.n = np.zeros(len(grams.key), dtype=np.int64)
        grams.n[turn] = n
        kept = grams.n > 0
        number = np.append(np.where(kept, np.cumsum(kept) - 1, -1), -1)
        self.levels.append(Level(
            grams.key[kept], grams.last[kept], grams.left[kept], grams.right[kept], number[grams.at], grams.own[kept], grams.n[kept]))

    def walk(self, norm: float) -> Iterator[tuple[float, float, int]]:
        """(base score, score, known words) of every document, by one traversal each."""
        words = self.levels[0]
        low_p = (words.n + 0.5) / norm
        base, known = np.log10(low_p)[words.at], (words.n > 0)[words.at]
        arcs, fails = [base], [base]  # the empty context has an arc for every word
        low = words
        for k, level in enumerate(self.levels[1:], 1):
            weight = np.ones(len(low.key))
            led = low.followers > 0
            weight[led] = np.maximum(1e-12, 1 - (low.followed[led] - DISCOUNT * low.followers[led]) / low.n[led])
            p = (level.n - DISCOUNT) / low.n[level.left] + weight[level.left] * low_p[level.right]
            # By place of the next word: the arc of the context of k words, and its failure arc.
            arc, fail = np.full(len(words.at), np.nan), np.zeros(len(words.at))
            arc[k:] = np.append(np.log10(p), np.nan)[level.at[:len(arc) - k]]
            fail[k:] = np.append(np.log10(weight), 0.0)[low.at[:len(fail) - k]]
            arcs.append(arc)
            fails.append(fail)
            low, low_p = level, p
        longest = len(self.levels) - 1
        start = 0
        for size in self.sizes.tolist():
            own = slice(start + 1, start + size)
            arc, fail = [a[own].tolist() for a in arcs], [f[own].tolist() for f in fails]
            score, state = 0.0, min(1, longest)
            for i in range(size - 1):
                paid = arc[state][i]
                while paid != paid:  # no arc
                    score += fail[state][i]
                    state -= 1
                    paid = arc[state][i]
                score += paid
                if state < longest:
                    state += 1
            yield float(base[own].sum()), score, int(known[own].sum())
            start += size


def add_up(level: int, bucket: int, ids: list[int], asked: list[bytes]) -> pa.Table:
    """A bucket's answers: counts of the n-grams (zero where not kept), and the sums of their contexts."""
    questions = [_split(a) for a in asked]
    keys = [np.cumsum(q[0], dtype=np.uint64) for q in questions]
    context, context_at = np.unique(np.concatenate(keys), return_inverse=True)
    each = np.concatenate([q[1] for q in questions]).astype(np.int64)
    own = np.concatenate([q[3] for q in questions]).astype(np.int64)
    of = np.repeat(context_at, each)
    if level == 1:
        gram_at, first = of, np.zeros(len(context), dtype=np.int64)
        first[of] = np.arange(len(of))
    else:
        _, first, gram_at = np.unique(_mixed(context[of], np.concatenate([q[2] for q in questions])), return_index=True, return_inverse=True)
    n = np.bincount(gram_at, weights=own, minlength=len(first)).astype(np.int64)
    n[n < (MIN_COUNT if level > 1 else 1)] = 0
    followed = np.bincount(of[first], weights=n, minlength=len(context)).astype(np.int64)
    followers = np.bincount(of[first], weights=n > 0, minlength=len(context)).astype(np.int64)
    sums = (0, 0)
    if level == 1:
        real = context != _START_KEY
        sums = (int((real & (followed > 0)).sum()), int(followed[real].sum()))
    answers, list_end, gram_end = [], 0, 0
    for k, q in enumerate(questions):
        lists, grams = slice(list_end, list_end + len(q[0])), slice(gram_end, gram_end + len(q[3]))
        list_end, gram_end = lists.stop, grams.stop
        counts = n[gram_at[grams]] if level > 1 else n[:0]
        answers.append(_join(counts, followed[context_at[lists]], followers[context_at[lists]] if level > 1 else n[:0]))
    rows = len(ids)
    return pa.table({
        "block": pa.array(ids, pa.int64()), "level": pa.array([level] * rows, pa.int32()), "bucket": pa.array([bucket] * rows, pa.int32()),
        **{c: pa.array([v] + [0] * (rows - 1), pa.int64()) for c, v in zip(("n_words", "n_tokens"), sums)},
        "answer": pa.array(answers, pa.binary())})


@contextmanager
def _freeing(spark: SparkSession):
    """Shuffle files go as soon as the table that needs them is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _read(table: pa.Table, heard: pa.Table | None, level: int, buckets: int, total: int) -> Iterator[Block]:
    """The blocks of ``table``, told what was answered on the orders below ``level``."""
    for row in table.to_pylist():
        block = Block(row, buckets, total)
        for k in range(1, level):
            mine = heard.filter(pc.equal(heard["level"], k)).sort_by("bucket")
            block.hear(k, mine["answer"].to_pylist())
        yield block


def _questions(level: int, buckets: int, total: int):
    def run(table: pa.Table, heard: pa.Table | None = None) -> pa.Table:
        out = [(b, number, asked) for number, block in zip(table["block"].to_pylist(), _read(table, heard, level, buckets, total))
               for b, asked in block.ask(level)]
        columns = zip(*out) if out else ((), (), ())
        return pa.table({name: pa.array(c, t) for name, c, t in zip(
            ("bucket", "block", "asked"), columns, (pa.int32(), pa.int64(), pa.binary()))})

    return run


def _first_questions(buckets: int, total: int):
    ask = _questions(1, buckets, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from ask(pa.Table.from_batches([batch.slice(k, 1)])).to_batches()

    return run


def _answers(level: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        return add_up(level, key[0].as_py(), group["block"].to_pylist(), group["asked"].to_pylist())

    return run


def _walks(order: int, buckets: int, total: int, tokens: int, norm: float):
    def run(table: pa.Table, heard: pa.Table) -> pa.Table:
        rows = []
        for block in _read(table, heard, order + 1, buckets, total):
            for doc_id, held, size, (base, score, known) in zip(block.ids, block.held, block.sizes.tolist(), block.walk(norm)):
                rows.append((doc_id, held, size - 1, known, tokens, base, score))
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({c.split()[0]: pa.array(v, t) for c, v, t in zip(_SCORES.split(", "), zip(*rows) if rows else [()] * 7, types)})

    return run


def _together(made: DataFrame, answers: list[DataFrame], run, schema: str) -> DataFrame:
    """``run`` on each block and the answers to it."""
    heard = reduce(DataFrame.unionByName, answers).select("block", "level", "bucket", "answer")
    return made.groupBy("block").cogroup(heard.groupBy("block")).applyInArrow(run, schema)


def score(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Score every row of ``docs`` by a model of the rows that are not held out.

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score),
    the scores in log10. A null or empty text is its end alone; a text of any length is
    walked whole, in a block of its own if longer than ``block_bytes``. Rows without a doc_id
    are trained on and scored; repeated rows count and are scored each. Where nothing
    is left to learn from, every token has probability one. Only ``doc_id`` and
    ``text`` are read, so further columns may have any name. An empty table gives no row.
    """
    spark = docs.sparkSession
    with _freeing(spark):
        made = materialise(blocks(document_bytes(docs).withColumn("held_out", held_out()), block_bytes), "lm-blocks")
        total = made.agg(F.sum("n_tokens")).first()[0] or 0
        buckets = max(1, math.ceil(total / bucket_tokens))
        answers: list[DataFrame] = []
        for level in range(1, order + 1):
            if level == 1:
                asked = made.mapInArrow(_first_questions(buckets, total), _ASKED)
            else:
                asked = _together(made, answers, _questions(level, buckets, total), _ASKED)
            answers.append(materialise(asked.groupBy("bucket").applyInArrow(_answers(level), _ANSWER), f"lm-answers-{level}"))
        words, tokens = (x or 0 for x in answers[0].agg(F.sum("n_words"), F.sum("n_tokens")).first())
        norm = tokens + 0.5 * (words + 1)
        return materialise(_together(made, answers, _walks(order, buckets, total, tokens, norm), _SCORES), "lm-scores")
