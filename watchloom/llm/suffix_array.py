"""External induced sorting of suffixes with common-prefix lengths.

A text is an array of small integers. Suffixes are of type S or L as they are
smaller or larger than their successor; the leftmost ones of each S run are sorted
first (by a recursion on the names of the pieces between them), all others are
induced: in one sweep upwards and one downwards each extracted suffix puts its
predecessor into a priority queue. Queue entries carry (symbol, position, length of
the prefix shared with the entry before); since a sweep only ever adds at or beyond
the symbol it stands on, the queue is a row of first-in-first-out runs by symbol
range, which go to disk when they outgrow their share of memory. A run is extracted
as one numpy batch. Sorted suffixes leave as a stream of batches.

Memory holds the text, its types and the current run; queues and the sorted L
suffixes lie on disk. The recursion ends where names are unique or their string is
short enough to be sorted by doubling in memory.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np

#: Common prefixes longer than this are not told apart.
CAP = 64


class Runs:
    """Append-only runs of (key, position, prefix) rows by range of keys, in arrival order."""

    def __init__(self, folder: str, name: str, symbols: int, memory: int) -> None:
        self._folder, self._name, self._memory = folder, name, memory
        self.width = max(1, -(-symbols // 256))
        self._held: dict[int, list[np.ndarray]] = {}
        self._rows = 0
        self._open: dict[int, list[np.ndarray]] = {}
        self._range = -1

    def _path(self, part: int) -> str:
        return os.path.join(self._folder, f"{self._name}-{part}")

    def push(self, keys: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        """Rows sorted by key (stably); one batch."""
        if not len(keys):
            return
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            key = int(keys[a])
            rows = np.stack([np.full(b - a, key, dtype=np.int64), positions[a:b], prefixes[a:b]])
            part = key // self.width
            if part == self._range:
                self._open.setdefault(key, []).append(rows)
            else:
                self._held.setdefault(part, []).append(rows)
                self._rows += b - a
        if self._rows > self._memory:
            self._spill()

    def _spill(self) -> None:
        for part, rows in self._held.items():
            with open(self._path(part), "ab") as out:
                for r in rows:
                    np.ascontiguousarray(r.T).tofile(out)
        self._held.clear()
        self._rows = 0

    def take(self, key: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and prefixes pushed for ``key`` so far."""
        part = key // self.width
        if part != self._range:
            self._range, self._open = part, {}
            rows = []
            if os.path.exists(self._path(part)):
                rows.append(np.fromfile(self._path(part), dtype=np.int64).reshape(-1, 3).T)
                os.remove(self._path(part))
            held = self._held.pop(part, [])
            self._rows -= sum(r.shape[1] for r in held)
            rows += held
            if rows:
                every = np.concatenate(rows, axis=1)
                every = every[:, np.argsort(every[0], kind="stable")]
                cuts = [0, *(np.flatnonzero(every[0, 1:] != every[0, :-1]) + 1).tolist(), every.shape[1]]
                self._open = {int(every[0, a]): [every[:, a:b]] for a, b in zip(cuts, cuts[1:])}
        found = self._open.pop(key, None)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        every = found[0] if len(found) == 1 else np.concatenate(found, axis=1)
        return every[1], every[2]


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int = CAP) -> np.ndarray:
    """Common prefix length of the suffixes at ``a`` and ``b``, at most ``cap``."""
    out = np.zeros(len(a), dtype=np.int64)
    alive = np.flatnonzero(np.maximum(a, b) < len(text))
    for k in range(cap):
        x, y = a[alive] + k, b[alive] + k
        inside = (x < len(text)) & (y < len(text))
        alive, x, y = alive[inside], x[inside], y[inside]
        alive = alive[text[x] == text[y]]
        if not len(alive):
            break
        out[alive] = k + 1
    return out


class Sweep:
    """What one sweep remembers: the shortest prefix since the last entry of each symbol."""

    def __init__(self, queue: Runs, symbols: int, track: bool) -> None:
        self._queue, self._track = queue, track
        self._since = np.full(symbols, -1, dtype=np.int64)  # -1: none yet

    def extract(self, prefixes: np.ndarray, wanted: np.ndarray, keys: np.ndarray, before: np.ndarray) -> None:
        """A batch in order: ``prefixes`` shared with the one before; where ``wanted``, ``before`` is queued under ``keys``."""
        at = np.flatnonzero(wanted)
        if not self._track:
            order = at[np.argsort(keys[at], kind="stable")]
            self._queue.push(keys[order], before[order], np.zeros(len(order), dtype=np.int64))
            return
        if not len(at):
            if len(prefixes):
                known = self._since >= 0
                self._since[known] = np.minimum(self._since[known], prefixes.min())
            return
        order = np.argsort(keys[at], kind="stable")
        at = at[order]
        key = keys[at]
        # Least prefix over (previous entry of the same symbol, this one]: a sparse table of minima.
        first = np.ones(len(at), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        low = np.zeros(len(at), dtype=np.int64)
        low[1:] = at[:-1] + 1
        low[first] = 0
        least = _range_min(prefixes, low, at)
        seen = self._since[key]
        shared = np.where(first, np.where(seen < 0, -1, np.minimum(least, seen)), least)
        self._queue.push(key, before[at], np.minimum(shared + 1, CAP))
        last = np.append(np.flatnonzero(first)[1:] - 1, len(at) - 1)
        known = self._since >= 0
        self._since[known] = np.minimum(self._since[known], prefixes.min())
        tail = at[last] + 1
        rest = np.full(len(last), CAP, dtype=np.int64)
        some = tail < len(prefixes)
        rest[some] = _range_min(prefixes, tail[some], np.full(int(some.sum()), len(prefixes) - 1))
        self._since[key[last]] = rest


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low..high]) for each pair, low <= high."""
    if not len(low):
        return np.zeros(0, dtype=values.dtype)
    span = high - low + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.empty(len(low), dtype=values.dtype)
    table, k = values, 0
    for k in range(int(level.max()) + 1):
        mine = level == k
        if mine.any():
            out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k:])
    return out


def types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last is larger than the empty one."""
    n = len(text)
    down = np.ones(n, dtype=bool)  # text[i] != text[i + 1]: decided here, else as the next decided one
    down[:-1] = text[:-1] != text[1:]
    smaller = np.zeros(n, dtype=bool)
    smaller[:-1] = text[:-1] < text[1:]
    decided = np.flatnonzero(down)
    return smaller[decided[np.searchsorted(decided, np.arange(n))]]


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, prefixes: np.ndarray, symbols: int,
           folder: str, name: str, memory: int, track: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order, given the S seeds in ascending order with their prefixes.

    Yields batches (positions, prefix shared with the next larger suffix); ``seeds``
    need only be sorted by what the caller wants resolved. Prefixes are carried only if
    ``track``.
    """
    present = np.unique(text).tolist()
    heads = text[seeds]
    larger = Runs(folder, f"{name}-l", symbols, memory)
    kept = Runs(folder, f"{name}-k", symbols, memory)
    up = Sweep(larger, symbols, track)
    end = len(text) - 1
    ends_large = not small[end]

    def put(sweep: Sweep, positions: np.ndarray, shared: np.ndarray, s_type: bool) -> None:
        before = np.maximum(positions - 1, 0)
        wanted = (positions > 0) & (small[before] == s_type)
        sweep.extract(shared, wanted, text[before], before)  # small symbols are sorted by radix

    for c in present:
        last = -1
        if ends_large and text[end] == c:  # the last suffix follows the empty one
            put_first = np.array([end], dtype=np.int64)
            kept.push(np.array([c]), put_first, np.zeros(1, np.int64))
            put(up, put_first, np.zeros(1, np.int64), False)
            last = end
        while True:
            found, shared = larger.take(c)
            if not len(found):
                break
            shared = shared.copy()
            if last < 0:
                shared[0] = 0
            elif last == end and ends_large:
                shared[0] = 1
            kept.push(np.full(len(found), c), found, shared)
            put(up, found, shared, False)
            last = int(found[-1])
        low, high = np.searchsorted(heads, [c, c + 1])
        if high > low:
            mine, shared = seeds[low:high], prefixes[low:high].copy()
            shared[0] = common(text, np.array([last]), mine[:1])[0] if last >= 0 else 0
            put(up, mine, shared, False)
    smaller = Runs(folder, f"{name}-s", symbols, memory)
    downward = Sweep(smaller, symbols, track)
    for c in reversed(present):
        last = -1
        while True:
            found, shared = smaller.take(c)
            if not len(found):
                break
            shared = shared.copy()
            if last < 0:
                shared[0] = 0
            put(downward, found, shared, True)
            yield found, shared
            last = int(found[-1])
        found, ascending = kept.take(c)
        if len(found):
            # Kept prefixes are shared with the smaller neighbour; downwards they belong to the larger one.
            found = found[::-1].copy()
            shared = np.concatenate([[0], ascending[::-1][:-1]])
            if last >= 0:
                shared[0] = common(text, np.array([last]), found[:1])[0]
            put(downward, found, shared, True)
            yield found, shared


def _seed_order(text: np.ndarray, small: np.ndarray, symbols: int, folder: str, name: str, memory: int) -> np.ndarray:
    """The leftmost S suffixes in ascending order."""
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(starts) < 2:
        return starts.astype(np.int64)
    rough = starts[np.argsort(text[starts], kind="stable")].astype(np.int64)
    is_start = np.zeros(len(text) + 1, dtype=bool)
    is_start[starts] = True
    parts = [p[is_start[p]] for p, _ in induce(text, small, rough, np.zeros(len(rough), np.int64), symbols, folder, f"{name}-r", memory, track=False)]
    order = np.concatenate(parts)[::-1]
    # Pieces reach to the next start inclusive; the last one to the end of the text.
    follow = np.append(starts[1:], len(text) - 1)
    length = np.zeros(len(text), dtype=np.int64)
    length[starts] = follow - starts + 1
    length[starts[-1]] = len(text) - starts[-1] + 1  # like no other piece
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    pairs = np.flatnonzero(same)
    k = 0
    while len(pairs):
        inside = pairs[length[a[pairs]] > k]
        done = pairs[length[a[pairs]] <= k]
        x, y = a[inside] + k, b[inside] + k
        fits = (x < len(text)) & (y < len(text))
        equal = np.zeros(len(inside), dtype=bool)
        equal[fits] = text[x[fits]] == text[y[fits]]
        same[inside[~equal]] = False
        pairs = inside[equal]
        k += 1
        del done
    names = np.zeros(len(text), dtype=np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])
    reduced = names[starts]
    if reduced.max() + 1 == len(reduced):
        return order
    if len(reduced) <= memory:
        ranks = _doubling(reduced)
        return starts[np.argsort(ranks, kind="stable")].astype(np.int64)
    deeper = [p for p, _ in sorted_suffixes(reduced, folder, f"{name}-d", memory)]
    return starts[np.concatenate(deeper)[::-1]].astype(np.int64)


def _doubling(text: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes, in memory."""
    rank, step = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        after = np.zeros(len(text), dtype=np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (len(text) + 1) + after
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        if rank.max() + 1 == len(text) or step >= len(text):
            return rank
        step *= 2


def sorted_suffixes(text: np.ndarray, folder: str, name: str = "t", memory: int = 4_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches (positions, prefix shared with the next larger suffix) in descending order of the suffixes."""
    if not len(text):
        return
    symbols = int(text.max()) + 1
    small = types(text)
    seeds = _seed_order(text, small, symbols, folder, name, memory)
    prefixes = np.zeros(len(seeds), dtype=np.int64)
    if len(seeds) > 1:
        prefixes[1:] = common(text, seeds[:-1], seeds[1:])
    yield from induce(text, small, seeds, prefixes, symbols, folder, name, memory)


def equal_starts(text: np.ndarray, length: int, folder: str, visit: Callable[[np.ndarray, np.ndarray], None], memory: int = 4_000_000) -> None:
    """Calls ``visit(positions, class)`` with batches; equal classes share their first ``length`` symbols."""
    if length > CAP:
        raise ValueError(f"prefixes are told apart up to {CAP} symbols, not {length}")
    last = 0
    for positions, shared in sorted_suffixes(text, folder, memory=memory):
        classes = last + np.cumsum(shared < length)
        visit(positions, classes)
        last = int(classes[-1])
