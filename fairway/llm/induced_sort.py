"""Suffix sorting by induction, with queues that may spill to shared storage.

Suffixes are L-type (greater than the next one) or S-type. The S-type suffixes
that follow an L-type one (S*) are sorted first, by sorting their substrings
with the induction itself, naming them, and sorting the string of names; one
ascending pass then induces all L-type suffixes from them and a descending pass
all S-type ones from those (Nong, Zhang and Chan 2009; with queues in external
memory: Bingmann, Fischer and Osipov 2013).

The priority queue of a pass is a set of first-in first-out queues, one for each
first symbol: inside one symbol, tuples arrive in suffix order. Blocks of a queue
beyond ``memory`` entries are written to ``spill`` (a folder in the cluster's
shared storage) and read back when their symbol's turn comes.

Order is exact for the first ``depth`` symbols; deeper ties keep any order. That
bounds the recursion: names are refined by doubling until they span ``depth``.
"""

from __future__ import annotations

import io
import uuid

import numpy as np


class BucketQueue:
    """Priority queue over first symbols; positions in arrival order."""

    def __init__(self, symbols: int, memory: int, spill: str | None):
        self.blocks: list[list] = [[] for _ in range(symbols)]
        self.memory, self.spill, self.held = memory, spill, 0

    def push(self, positions: np.ndarray, symbols: np.ndarray) -> None:
        """Append positions, in order, to their symbols' queues."""
        if not len(positions):
            return
        order = np.argsort(symbols, kind="stable")
        positions, symbols = positions[order], symbols[order]
        at = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(positions)]):
            self.blocks[symbols[a]].append(positions[a:b])
        self.held += len(positions)
        if self.spill and self.held > self.memory:
            self._write()

    def _write(self) -> None:
        from fairway.llm.warc import _filesystem

        for queue in self.blocks:
            ready = [b for b in queue if isinstance(b, np.ndarray)]
            if sum(map(len, ready)) < max(64, self.memory // 64):
                continue
            path = f"{self.spill.rstrip('/')}/{uuid.uuid4().hex}"
            fs, place = _filesystem(path)
            fs.create_dir(place.rpartition("/")[0], recursive=True)
            buffer = io.BytesIO()
            np.save(buffer, np.concatenate(ready))
            with fs.open_output_stream(place) as out:
                out.write(buffer.getvalue())
            self.held -= sum(map(len, ready))
            queue[:] = [b for b in queue if not isinstance(b, np.ndarray)] + [path]

    def pop(self, symbol: int) -> np.ndarray:
        """All positions that wait in a symbol's queue, in arrival order."""
        queue, self.blocks[symbol] = self.blocks[symbol], []
        out = []
        for block in queue:
            if isinstance(block, str):
                from fairway.llm.warc import _filesystem

                fs, place = _filesystem(block)
                with fs.open_input_stream(place) as file:
                    out.append(np.load(io.BytesIO(file.read())))
                fs.delete_file(place)
            else:
                out.append(block)
                self.held -= len(block)
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def _types(text: np.ndarray) -> np.ndarray:
    """True for S-type positions; the empty suffix at the end is the smallest."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    if not len(differs):
        return np.zeros(n, bool)
    at = np.searchsorted(differs, np.arange(n))
    inside = at < len(differs)
    last = differs[np.minimum(at, len(differs) - 1)]
    return inside & (text[last] < text[np.minimum(last + 1, n - 1)])


def _induce(text, s_type, stars, symbols, memory, spill) -> np.ndarray:
    """All suffixes in order, induced from the S* positions in order."""
    n = len(text)
    queue = BucketQueue(symbols, memory, spill)
    star_symbols = text[stars]
    star_order = np.argsort(star_symbols, kind="stable")
    stars = stars[star_order]
    star_at = np.searchsorted(star_symbols[star_order], np.arange(symbols + 1))
    low: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    queue.push(np.array([n - 1]), text[n - 1:n])  # induced by the empty suffix
    for c in range(symbols):
        while len(now := queue.pop(c)):
            low[c].append(now)
            before = now[now > 0] - 1
            before = before[~s_type[before]]
            queue.push(before, text[before])
        before = stars[star_at[c]:star_at[c + 1]]
        before = before[before > 0] - 1
        queue.push(before, text[before])
    out: list[np.ndarray] = []
    queue = BucketQueue(symbols, memory, spill)
    for c in range(symbols - 1, -1, -1):
        high = []
        while len(now := queue.pop(c)):
            high.append(now)
            before = now[now > 0] - 1
            before = before[s_type[before]]
            queue.push(before, text[before])
        part = np.concatenate(low[c])[::-1] if low[c] else np.zeros(0, np.int64)
        before = part[part > 0] - 1
        before = before[s_type[before]]
        queue.push(before, text[before])
        out += [*high, part]
    return np.concatenate(out)[::-1]


def _refine(rank: np.ndarray, spans: int) -> np.ndarray:
    """Order of all suffixes of a string of names, exact over ``spans`` names."""
    n, step = len(rank), 1
    rank = rank.astype(np.int64)
    while True:
        follow = np.zeros(n, np.int64)
        follow[:-step] = rank[step:] + 1 if step < n else 0
        key = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= min(spans, n):
            return order


def suffix_order(text: np.ndarray, depth: int, memory: int = 1 << 24, spill: str | None = None) -> np.ndarray:
    """Start positions of all suffixes of ``text`` (small integers), in order
    of their first ``depth`` symbols at least."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    symbols = int(text.max()) + 1
    s_type = _types(text)
    star = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if len(star) > 1:
        # sort the S* substrings by induction, name them, sort the names
        order = _induce(text, s_type, star, symbols, memory, spill)
        is_star = np.zeros(n, bool)
        is_star[star] = True
        order = order[is_star[order]]
        number = np.cumsum(is_star) - 1
        end = np.append(star[1:] + 1, n)
        length = (end - star)[number[order]]
        same = np.zeros(len(order), bool)
        open_ = np.flatnonzero(length[1:] == length[:-1])
        k = 0
        a, b = order[:-1], order[1:]
        while len(open_):  # substrings equal so far
            done = length[open_] <= k
            same[open_[done] + 1] = True
            open_ = open_[~done]
            open_ = open_[text[a[open_] + k] == text[b[open_] + k]]
            k += 1
            if k > depth:  # longer than any string that matters
                same[open_ + 1] = True
                break
        names = np.empty(len(order), np.int64)
        names[number[order]] = np.cumsum(~same) - 1
        star = star[_refine(names, depth)]
    return _induce(text, s_type, star, symbols, memory, spill)


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of suffixes ``a`` and ``b``, at most ``most``."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(most):
        x, y = a[live] + k, b[live] + k
        ok = (x < len(text)) & (y < len(text))
        ok[ok] = text[x[ok]] == text[y[ok]]
        live = live[ok]
        if not len(live):
            break
        out[live] = k + 1
    return out
