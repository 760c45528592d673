"""Seekable compressed text: independent zstandard frames with cumulative counts.

A text is cut into frames of ``FRAME_UNITS`` code points. Each is compressed on
its own, and next to the frames stands the number of code points up to the end
of each, so any range of the text is read by decompressing the frames it
touches and nothing else. In tables a text is two columns: ``frames``
(array<binary>) and ``ends`` (array<bigint>). An empty text has no frames.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

FRAME_UNITS = 1 << 15
LEVEL = 3
COLUMNS = "frames array<binary>, ends array<bigint>"


def _units(data: bytes) -> int:
    """Code points of UTF-8 bytes: those that don't continue another."""
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def _offset(data: bytes, units: int) -> int:
    """Byte offset of code point ``units``."""
    if len(data) == 0 or units == 0:
        return 0
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return int(starts[units]) if units < len(starts) else len(data)


class Writer:
    """Collects UTF-8 pieces (whole code points each) into frames."""

    def __init__(self):
        self._zstd = zstandard.ZstdCompressor(level=LEVEL)
        self._held, self._size = [], 0
        self.frames: list[bytes] = []
        self.ends: list[int] = []

    def write(self, piece: bytes) -> None:
        units = _units(piece)
        while self._size + units >= FRAME_UNITS:
            cut = _offset(piece, FRAME_UNITS - self._size)
            self._held.append(piece[:cut])
            units -= FRAME_UNITS - self._size
            self._size = FRAME_UNITS
            piece = piece[cut:]
            self._flush()
        if units:
            self._held.append(piece)
            self._size += units

    def _flush(self) -> None:
        self.frames.append(self._zstd.compress(b"".join(self._held)))
        self.ends.append((self.ends[-1] if self.ends else 0) + self._size)
        self._held, self._size = [], 0

    def close(self) -> tuple[list[bytes], list[int]]:
        if self._size:
            self._flush()
        return self.frames, self.ends


def compressed(pieces: Iterable[bytes]) -> tuple[list[bytes], list[int]]:
    """Frames and ends of the text that ``pieces`` (whole code points) make."""
    writer = Writer()
    for piece in pieces:
        writer.write(piece)
    return writer.close()


def text_pieces(text: str) -> Iterator[bytes]:
    """``text`` as UTF-8, one frame's code points at a time."""
    for a in range(0, len(text), FRAME_UNITS):
        yield text[a:a + FRAME_UNITS].encode()


class Reader:
    """Reads ranges of a framed text, one decompressed frame at a time. The last
    frame is remembered: neighbouring ranges share it."""

    def __init__(self, frames: list[bytes], ends: list[int]):
        self.frames, self.ends = frames, ends
        self.units = ends[-1] if ends else 0
        self._zstd = zstandard.ZstdDecompressor()
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self._last[0] != i:
            self._last = i, self._zstd.decompress(self.frames[i])
        return self._last[1]

    def stream(self, first: int = 0, last: int | None = None) -> Iterator[bytes]:
        """UTF-8 of the code points ``first`` to ``last`` (exclusive) in order."""
        last = self.units if last is None else min(last, self.units)
        i = bisect_right(self.ends, first)
        while first < last:
            before, data = (self.ends[i - 1] if i else 0), self.frame(i)
            stop = min(last, self.ends[i])
            if first > before or stop < self.ends[i]:   # a cut frame
                data = data[_offset(data, first - before):_offset(data, stop - before)]
            yield data
            first, i = stop, i + 1

    def find(self, marker: bytes, first: int = 0) -> int:
        """Code point at which the ASCII ``marker`` first occurs at or after
        ``first``, also across frames; -1 if it does not."""
        at, tail = first, b""
        for data in self.stream(first):
            joined = tail + data
            hit = joined.find(marker)
            if hit >= 0:
                return at - _units(tail) + _units(joined[:hit])
            at += _units(data)
            # cut at a code point: the marker is ASCII, so it starts at its first byte
            keep = max(len(joined) - len(marker) + 1, 0)
            while keep < len(joined) and joined[keep] & 0xC0 == 0x80:
                keep += 1
            tail = joined[keep:]
        return -1
