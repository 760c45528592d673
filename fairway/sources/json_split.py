"""Reading large JSON files by many tasks.

A pretty-printed document, or an array of documents, cannot be cut at line feeds:
whether a byte is text or structure, and how deep it lies, depends on all bytes
before it. That dependence is a small automaton, so every byte range of a file can
be read on its own:

1. One task per range reads its bytes and writes the range's *map*: for each state
   in which it may begin (inside a string or not, after a backslash or not) the
   state in which it ends, the change of depth and its lowest point.
2. The maps of a file are composed by a prefix scan (a few numbers a range); every
   range now knows the state and the depth in which it begins.
3. One task per range reads it again and gives the documents that *begin* in it,
   reading on beyond its end to the last one's closing bracket.

A file that begins with ``[`` has its documents one level down, any other at the
top (one document, documents one after another, JSON Lines). What stands between
documents and is neither white space nor a comma is given as a document of its
own, as is a last document that is cut short, so that ingest quarantines it.
Depth never falls below 0, whatever closing brackets there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairway.operators.joins import materialize
from fairway.session import ship_package
from fairway.sources.files import list_files, open_input

RANGE_BYTES = 8 << 20
CHUNK = 1 << 20
# Beyond a range's end, reading begins with so many bytes and doubles.
READ_ON = 1 << 12
# Tasks at most, for each of the session's shuffle partitions.
TASKS = 4
STATES = 4   # 2 * inside a string + after a backslash

_QUOTE, _BACKSLASH = 34, 92
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_BETWEEN = np.zeros(256, bool)   # may stand between documents
_BETWEEN[[9, 10, 13, 32, ord(",")]] = True
_SCALAR = ~_BETWEEN & (_STEP == 0)


def _marks(data: np.ndarray, escaped: bool):
    """(places, steps, after a backslash at the end) of a chunk's marks: brackets
    (step 1 or -1, those in strings too) and the quotes that begin or end a string
    (step 0). Only these few bytes are looked at any further."""
    n = len(data)
    # comparisons are several times faster than a table lookup of every byte
    place = np.flatnonzero(reduce(np.logical_or, [data == mark for mark in b'"\\{}[]']))
    byte = data[place]
    slash = byte == _BACKSLASH
    if not n or not (escaped or slash.any()):
        return place, _STEP[byte], escaped and not n
    # the first place of the backslashes right before each mark, or the mark's own;
    # an entry after one backslash counts as one more
    behind = np.zeros(len(place), bool)
    behind[1:] = slash[:-1] & (np.diff(place) == 1)
    first = np.maximum.accumulate(np.where(behind, -1, place))
    odd = (place - first + (escaped & (first == 0))) % 2 == 1
    ends = bool(len(place) and slash[-1] and place[-1] == n - 1 and not odd[-1])
    kept = ~slash & ~((byte == _QUOTE) & odd)
    return place[kept], _STEP[byte[kept]], ends


def _depths(step: np.ndarray, depth: int) -> np.ndarray:
    """Depth after each step, held at 0."""
    raw = depth + np.cumsum(step, dtype=np.int64)
    return raw - np.minimum(np.minimum.accumulate(raw), 0) if len(raw) else raw


def chunk_maps(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By entry state: end state, change of depth, lowest point of the change (0 at most)."""
    end, change, low = (np.zeros(STATES, np.int64) for _ in range(3))
    for escaped in (0, 1):
        if escaped and len(data) and data[0] not in (_QUOTE, _BACKSLASH):
            for x in (end, change, low):   # a backslash before changes nothing
                x[1::2] = x[::2]
            break
        _, step, slash = _marks(data, bool(escaped))
        odd = np.cumsum(step == 0) % 2
        for quoted in (0, 1):
            state = 2 * quoted + escaped
            sums = np.cumsum(np.where(odd == quoted, step, 0), dtype=np.int64)
            end[state] = 2 * ((odd[-1] if len(odd) else 0) ^ quoted) + slash
            change[state], low[state] = (sums[-1], min(0, sums.min())) if len(sums) else (0, 0)
    return end, change, low


def compose(one, two):
    """The map of ``one`` followed by ``two`` (arrays ..., state)."""
    end1, change1, low1 = one
    end2, change2, low2 = (np.take_along_axis(x, end1, -1) for x in two)
    return end2, change1 + change2, np.minimum(low1, change1 + low2)


def prefix_scan(maps):
    """Composition of each range's map with all before it, in doubling steps."""
    n, d = len(maps[0]), 1
    while d < n:
        later = compose([m[:-d] for m in maps], [m[d:] for m in maps])
        maps = [np.concatenate([m[:d], x]) for m, x in zip(maps, later)]
        d *= 2
    return maps


# ------------------------------------------------------------------- ranges
def _chunks(file, start: int, end: int) -> Iterator[bytes]:
    while start < end:
        data = file.read_at(min(CHUNK, end - start), start)
        if not data:
            return
        yield data
        start += len(data)


def _pieces(file, start: int, end: int, size: int) -> Iterator[bytes]:
    """The range's own bytes, then what follows it, for as long as it is asked for."""
    yield from _chunks(file, start, end)
    ahead = READ_ON
    while end < size:
        data = file.read_at(min(ahead, CHUNK, size - end), end)
        if not data:
            return
        yield data
        end += len(data)
        ahead *= 2


def _opened(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(open file, row) of rows that begin with a path; a file is opened once for
    the rows in a row that name it."""
    for path, group in groupby(rows, lambda row: row[0]):
        with open_input(path) as file:
            for row in group:
                yield file, row


_MARK = b"\xef\xbb\xbf"


def _map_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for file, (path, start, end) in _opened(zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")))):
            whole, first = None, None
            for k, data in enumerate(_chunks(file, start, end)):
                here = chunk_maps(np.frombuffer(data, np.uint8))
                whole = here if whole is None else compose(whole, here)
                if first is None:
                    body = data[3:] if start == 0 and k == 0 and data.startswith(_MARK) else data
                    first = next(iter(body.strip(b" \t\r\n")[:1]), None)
            whole = chunk_maps(np.zeros(0, np.uint8)) if whole is None else whole
            out.append((path, start, end, first, *[w.tolist() for w in whole]))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]
        names = ["path", "start", "end", "first", "ends", "changes", "lows"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)], names=names)


def _enter(table: pa.Table) -> pa.Table:
    """State and depth in which each range of one file begins, and the depth of
    its documents."""
    table = table.sort_by("start")
    maps = [table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, STATES) for c in ("ends", "changes", "lows")]
    end, change, low = prefix_scan(maps)
    state = np.concatenate([[0], end[:-1, 0]])
    depth = np.concatenate([[0], np.maximum(change, change - low)[:-1, 0]])
    first = next((f for f in table.column("first").to_pylist() if f is not None), None)
    base = np.full(len(state), int(first == ord("[")), np.int64)
    return pa.table({"path": table.column("path"), "start": table.column("start"), "end": table.column("end"),
                     "state": state, "depth": depth, "base": base})


def documents_in(file, start: int, end: int, size: int, state: int, depth: int, base: int) -> Iterator[tuple[int, bytes]]:
    """(position, bytes) of the documents that begin in ``[start, end)``."""
    quoted, escaped = bool(state >> 1), bool(state & 1)
    held: list[bytes] | None = None   # the document being read
    place = at = start
    # was the byte before part of a document, and did it close one?
    was = closed = False
    mark = len(_MARK) if start <= len(_MARK) and file.read_at(len(_MARK), 0) == _MARK else 0
    if start > mark:
        last = file.read_at(1, start - 1)[0]
        was = quoted or depth > base or not (_BETWEEN[last] or _STEP[last])
        closed = not quoted and depth == base and _STEP[last] < 0
        was = was or closed
    for data in _pieces(file, start, end, size):
        raw = np.frombuffer(data, np.uint8)
        marks, step, escaped = _marks(raw, escaped)
        quote = step == 0
        inside = (np.cumsum(quote) + quoted) % 2 == 1
        quotes = marks[quote]
        brackets, step = marks[~quote & ~inside], step[~quote & ~inside]
        after = _depths(step, depth)
        before = np.concatenate([[depth], after])[:-1]
        opens = brackets[(step > 0) & (before == base)]
        closes = brackets[(step < 0) & (before > base) & (after == base)]
        # opening and closing brackets take turns: 1 from the one to the other
        change = np.zeros(len(raw) + 1, np.int8)
        change[0] = depth > base
        change[opens] += 1
        change[closes + 1] -= 1
        part = np.cumsum(change[:-1], dtype=np.int8) > 0
        between = np.flatnonzero(~part)
        text = ((np.searchsorted(quotes, between, "left") + quoted) % 2 == 1) | (
            (np.searchsorted(quotes, between, "right") + quoted) % 2 == 1)
        part[between] = text | _SCALAR[raw[between]]
        part[:max(mark - at, 0)] = False
        prior = np.concatenate([[was], part[:-1]])
        shut = np.concatenate([closes + 1, [0] if closed else []]).astype(np.int64)
        shut = shut[shut < len(raw)]
        turns = np.flatnonzero(part != prior)   # a document's first byte or the first after one
        begins = np.concatenate([turns[part[turns]], opens, shut[part[shut]]])
        edges = np.unique(np.concatenate([begins, turns]))
        begin = set(begins.tolist())
        done = 0
        for edge in [*edges.tolist(), len(data)]:
            if held is not None:
                held.append(data[done:edge])
            if edge == len(data):
                break
            if held is not None:
                yield place, b"".join(held)
                held = None
            if at + edge >= end:
                return
            if edge in begin:
                held, place = [], at + edge
            done = edge
        depth = int(after[-1]) if len(after) else depth
        quoted = bool(inside[-1]) if len(inside) else quoted
        was, closed = bool(part[-1]), bool(len(closes)) and closes[-1] == len(data) - 1
        at += len(data)
        if held is None and at >= end:
            return
    if held is not None:
        yield place, b"".join(held)


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "position", "value"]

    def send(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], names=names)

    rows, held = [], 0
    for batch in batches:
        for file, (path, start, end, size, state, depth, base) in _opened(zip(*(batch.column(c).to_pylist() for c in (
                "path", "start", "end", "size", "state", "depth", "base")))):
            for place, data in documents_in(file, start, end, size, state, depth, base):
                rows.append((path, place, data.decode("utf-8", "replace")))
                held += len(data)
                if held >= CHUNK:
                    yield send(rows)
                    rows, held = [], 0
    if rows:
        yield send(rows)


def read_documents(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path``, ``position`` (byte), ``value`` (text) of every document of the JSON
    files at ``path``, and ``landed`` (time and name of the file)."""
    ship_package(spark)
    files = materialize(list_files(spark, path).where("size > 0"), "json-files")
    ranges = files.select("path", "size", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = materialize(ranges.withColumn("end", F.least(F.col("start") + range_bytes, "size")), "json-ranges")
    tasks = max(1, min(ranges.count(), TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # a numbered range partitioning, or these few small rows would become one task
    dealt = ranges.repartitionByRange(tasks, "path", "start")
    maps = materialize(dealt.select("path", "start", "end").mapInArrow(
        _map_ranges, "path string, start long, end long, first long, ends array<long>, changes array<long>, lows array<long>"),
        "json-maps")
    entered = materialize(maps.groupBy("path").applyInArrow(
        _enter, "path string, start long, end long, state long, depth long, base long"), "json-entries")
    entered = entered.join(ranges.select("path", "start", "size"), ["path", "start"])
    found = entered.repartitionByRange(tasks, "path", "start").mapInArrow(
        _read_ranges, "path string, position long, value string")
    # one row for each file: sized like the listing of any scan
    about = files.select("path", F.struct("at", F.col("path").alias("file")).alias("landed"))
    return found.join(about, "path")
