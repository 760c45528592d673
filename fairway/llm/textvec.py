"""Vectorised helpers on whole text columns (used inside Spark tasks).

A text column arrives as one Arrow buffer of UTF-8 bytes plus row offsets.
The helpers find words, hash byte ranges and index hashes with numpy over the
whole buffer, so no Python code runs per character or per word. Byte ranges are
hashed by two polynomials modulo the prime 2^31 - 1 (62 bits together), which,
unlike a polynomial modulo 2^64, have no structured texts that always collide;
texts that differ are taken as equal with a chance below 1e-4 per ten million
distinct strings.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# Bytes that separate words: space and the range tab..carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of text handled at once; a longer single text is handled whole.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (multiply, shift, exclusive or)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


def _power(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        got = np.cumprod(steps, dtype=U64)
        if size <= 2 * SLICE_BYTES:
            _powers[base] = got
    return got[:n]


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes (a short, fixed length) at every position
    that has them: a polynomial modulo 2^64, cheaper than ``RangeHash``."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=sums[1:])
    return mix((sums[width:] - sums[:n]) * _power(_INVERSE, n))


# The prime 2^31 - 1 and two bases with their inverses.
_PRIME = (1 << 31) - 1
_BASES = [(b, pow(b, -1, _PRIME)) for b in (1_664_525_813, 1_013_904_223)]
_BYTES = [(_BYTE >> U64(s)) % U64(_PRIME - 1) + U64(1) for s in (2, 33)]
_residues: dict[int, np.ndarray] = {}


def _mod_prime(x: np.ndarray) -> np.ndarray:
    """``x`` (below 2^62) modulo 2^31 - 1."""
    x = (x & U64(_PRIME)) + (x >> U64(31))
    x = (x & U64(_PRIME)) + (x >> U64(31))
    return np.where(x >= U64(_PRIME), x - U64(_PRIME), x)


def _residue_powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo the prime, by doubling."""
    got = _residues.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        got, filled, step = np.ones(size, dtype=np.uint32), 1, base
        while filled < size:
            more = min(filled, size - filled)
            got[filled:filled + more] = _mod_prime(got[:more].astype(U64) * U64(step))
            filled, step = filled + more, step * step % _PRIME
        if size <= 2 * SLICE_BYTES:
            _residues[base] = got
    return got[:n]


class RangeHash:
    """Hashes of byte ranges of one buffer, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = []
        for (base, _), byte in zip(_BASES, _BYTES):
            sums = np.zeros(n + 1, dtype=U64)   # below 2^31 times n: no wrap
            np.cumsum(_mod_prime(byte[data] * _residue_powers(base, n)), out=sums[1:])
            self._sums.append(sums)
        self._n = n

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        one, two = (_mod_prime(_mod_prime(sums[ends] - sums[starts]) * _residue_powers(inverse, self._n + 1)[starts])
                    for sums, (_, inverse) in zip(self._sums, _BASES))
        return mix((one << U64(31) | two) + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


class Texts:
    """The bytes of a text column: ``data``, and ``starts``/``ends`` by row.
    A null text counts as empty (``null`` marks it)."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        self.null = column.is_null().to_numpy(zero_copy_only=False)
        column = pc.fill_null(column, "") if self.null.any() else column
        column = column.cast(pa.large_string())
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        low, high = (int(off[0]), int(off[-1])) if len(off) else (0, 0)
        self.data = np.frombuffer(data, dtype=np.uint8)[low:high] if data is not None and high > low \
            else np.zeros(0, dtype=np.uint8)
        self.starts = off[:-1] - low
        self.ends = off[1:] - low
        self.rows = len(column)

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        """Row that owns each byte position (positions ascend)."""
        return np.searchsorted(self.starts, positions, side="right") - 1

    def words(self, data: np.ndarray | None = None, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words; words never cross rows. ``inside``
        marks the bytes of a word (by default all but white space)."""
        data = self.data if data is None else data
        n = len(data)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word = ~SPACE[data] if inside is None else inside[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.starts] = True
        edge[n] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:n]
        return np.flatnonzero(first), np.flatnonzero(last) + 1


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut by rows so that a part has about ``most`` text bytes. At
    the end freed memory is given back."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker stays alive for
    later stages and would hold the largest amount it ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class HashIndex:
    """Open-addressing map from 64-bit hashes to dense numbers, looked up and
    filled in bulk. ``full`` tells that it holds ``most`` entries, after which
    the owner starts a new one: memory stays bounded."""

    def __init__(self, most: int = 1 << 20):
        self._mask = U64(4 * most - 1)
        self._keys = np.zeros(4 * most, dtype=U64)
        self._values = np.full(4 * most, -1, dtype=np.int32)
        self.size = 0
        self.most = most

    @property
    def full(self) -> bool:
        return self.size >= self.most

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 where it is not held."""
        slot = (hashes & self._mask).astype(np.int64)
        out = self._values[slot]
        wrong = np.flatnonzero((out >= 0) & (self._keys[slot] != hashes))
        while len(wrong):
            slot_w = (slot[wrong] + 1) & int(self._mask)
            slot[wrong] = slot_w
            out[wrong] = self._values[slot_w]
            wrong = wrong[(out[wrong] >= 0) & (self._keys[slot_w] != hashes[wrong])]
        return out

    def insert(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers for distinct new hashes, in the order given."""
        numbers = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        self.size += len(hashes)
        if 2 * self.size > len(self._keys):
            self._grow()
        self._put(hashes, numbers)
        return numbers

    def _put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        slot = (hashes & self._mask).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            at = slot[todo]
            free = self._values[at] < 0
            first = np.zeros(len(todo), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            take = free & first
            self._keys[at[take]] = hashes[todo[take]]
            self._values[at[take]] = numbers[todo[take]]
            todo = todo[~take]
            slot[todo] = (slot[todo] + 1) & int(self._mask)

    def _grow(self) -> None:
        held = self._values >= 0
        keys, values = self._keys[held], self._values[held]
        size = len(self._keys)
        while size < 4 * self.size:
            size *= 2
        self._mask = U64(size - 1)
        self._keys = np.zeros(size, dtype=U64)
        self._values = np.full(size, -1, dtype=np.int32)
        self._put(keys, values)


def entries_inside(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, index: HashIndex, ids: np.ndarray,
                   longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All vocabulary entries inside the byte ranges: (range, end position in
    the range, length, entry id), by end position, range, then longest first.
    ``index`` numbers the entries' hashes, ``ids`` gives the number's entry."""
    size = ends - starts
    at = np.cumsum(size) - size
    flat = np.arange(int(size.sum())) - np.repeat(at - starts, size)
    hashes = RangeHash(data[flat])
    found = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, ids.dtype),)]
    for length in range(1, min(longest, int(size.max(initial=0))) + 1):
        enough = np.flatnonzero(size >= length)
        k = size[enough] - length + 1
        owner = np.repeat(enough, k)
        begin = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        s = at[owner] + begin
        number = index.lookup(hashes(s, s + length))
        hit = number >= 0
        found.append((owner[hit], begin[hit] + length, np.full(int(hit.sum()), length), ids[number[hit]]))
    owner, pos, length, entry = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-length, owner, pos))
    return owner[order], pos[order], length[order], entry[order]
