"""Bounded-space online packing of token sequences.

Each partition keeps at most ``OPEN`` windows of ``WINDOW`` tokens open. A
document (its ids and one end id) is cut into full windows and a rest; the rest
goes to the open window it fills best. When none fits and no window may be
opened, the fullest window is emitted; a gap of more than ``SLACK`` tokens in
it is first filled with the head of the document. What stays open at the end
of the partitions is merged, ``GROUP`` partitions together: best fit by
decreasing length, then the emptiest windows are cut to fill the others. The
last window of a merge is cut at powers of two, which need no padding.

A partition holds its open windows only; a merge holds ``GROUP * OPEN`` windows.
Documents are dealt by input split, so reruns over the same files agree.

Defined cases: null and empty texts have the end id alone; repeated rows are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.llm.bpe_transducer import transducers
from fairway.llm.staging import ship, stage
from fairway.llm.textvec import Texts, slices

WINDOW = 2048
OPEN = 32
SLACK = 8
GROUP = 64
END_ID = 1

# a piece: (document id, start, ids as uint32, tokens of the document)
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("part", pa.int64()), ("ids", pa.binary())])
_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "part long, ids binary")


class _Rows:
    """Output rows; ``sequence`` numbers sequences from ``base``."""

    def __init__(self, base: int, part: int, keep_ids: bool):
        self.next, self.part, self.keep, self.rows = base, part, keep_ids, []

    def sequence(self, pieces, left_open: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            data = ids.tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(data), total, None if left_open else self.next,
                              offset, self.part, data if left_open or self.keep else None))
            offset += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], _SCHEMA)


def _cut(piece, n):
    doc, start, ids, total = piece
    return (doc, start, ids[:n], total), (doc, start + n, ids[n:], total)


class Packer:
    """Open windows, sorted by room: (room, number) with their pieces."""

    def __init__(self, emit, window: int, most: int):
        self.emit, self.window, self.most = emit, window, most
        self.room: list[tuple[int, int]] = []
        self.pieces: dict[int, list] = {}
        self.count = 0

    def add(self, piece) -> None:
        while len(piece[2]) >= self.window:
            whole, piece = _cut(piece, self.window)
            self.emit([whole])
        while n := len(piece[2]):
            at = bisect.bisect_left(self.room, (n, -1))
            if at < len(self.room):
                room, number = self.room.pop(at)
            elif len(self.room) < self.most:
                room, number = self.window, self.count
                self.pieces[number] = []
                self.count += 1
            else:
                room, number = self.room.pop(0)
                if room > SLACK:
                    head, piece = _cut(piece, room)
                    self.pieces[number].append(head)
                self.emit(self.pieces.pop(number))
                continue
            self.pieces[number].append(piece)
            if room == n:
                self.emit(self.pieces.pop(number))
            else:
                bisect.insort(self.room, (room - n, number))
            break


def _merge(pieces: list, rows: _Rows, window: int) -> None:
    packer = Packer(rows.sequence, window, len(pieces) + 1)
    for piece in sorted(pieces, key=lambda p: (-len(p[2]), p[0] is None, p[0] or 0, p[1])):
        packer.add(piece)
    left = [(room, packer.pieces[number]) for room, number in packer.room]
    first, last = 0, len(left) - 1
    while first < last:
        room, held = left[first]
        while room > SLACK and first < last:
            donor_room, donor = left[last]
            piece = donor.pop()
            if len(piece[2]) > room:
                piece, rest = _cut(piece, room)
                donor.append(rest)
            held.append(piece)
            room -= len(piece[2])
            left[last] = (donor_room + len(piece[2]), donor)
            if not donor:
                last -= 1
        rows.sequence(held)
        first += 1
    if first == last:
        room, held = left[first]
        if room <= SLACK:
            rows.sequence(held)
            return
        rest = window - room
        while rest:  # cut at powers of two
            size = 1 << rest.bit_length() - 1
            rest -= size
            part = []
            while size:
                piece = held.pop(0)
                if len(piece[2]) > size:
                    piece, tail = _cut(piece, size)
                    held.insert(0, tail)
                part.append(piece)
                size -= len(piece[2])
            rows.sequence(part)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
         window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row for each piece: ``id_col``, start, length, ids_crc32, doc_tokens,
    sequence_id, offset; with ``with_ids`` also the piece's ids (array<int>)."""

    def place(batches: Iterator[pa.RecordBatch]):
        fst = transducers(vocabulary)
        part = TaskContext.get().partitionId()
        rows = _Rows(part << 32, part, with_ids)
        packer = Packer(rows.sequence, window, OPEN)
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            _, row, n, ids = fst.encode(texts, True)
            tokens = np.bincount(row, weights=n, minlength=texts.rows).astype(np.int64)
            end = np.cumsum(tokens)
            for doc, a, b in zip(batch.column("id").to_pylist(), (end - tokens).tolist(), end.tolist()):
                own = np.empty(b - a + 1, np.uint32)
                own[:-1] = ids[a:b]
                own[-1] = END_ID
                packer.add((doc, 0, own, b - a + 1))
            if rows.rows:
                yield rows.batch()
        for held in packer.pieces.values():
            rows.sequence(held, left_open=True)
        if rows.rows:
            yield rows.batch()

    def merge(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        rows = _Rows(1 << 62 | group << 32, group, with_ids)
        cols = [table.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")]
        _merge([(d, s, np.frombuffer(i, np.uint32), t) for d, s, i, t in zip(*cols)], rows, window)
        return pa.Table.from_batches([rows.batch()])

    ship(docs.sparkSession)
    placed = stage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        place, _DDL), "packed")
    left = placed.where("sequence_id is null").withColumn("group", F.expr(f"part div {GROUP}"))
    rows = placed.where("sequence_id is not null").unionByName(left.groupBy("group").applyInArrow(merge, _DDL))
    out = [F.col("doc_id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        def unpack(batches):
            for b in batches:
                ids = [np.frombuffer(x, np.uint32).astype(np.int32) for x in b.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.list_(pa.int32()))],
                                                 names=b.schema.names)

        names = [f.name for f in _SCHEMA][:-2]
        kinds = ", ".join(f"{n} long" for n in names)
        return rows.select(*names, "ids").mapInArrow(unpack, kinds + ", ids array<int>").select(*out, "ids")
    return rows.select(*out)
