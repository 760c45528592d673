"""Removal of repeated passages by external induced suffix sorting.

A byte is removed when it lies in a string of ``LENGTH`` bytes that also starts
earlier (in a document before, or earlier in the same one). All documents are
searched; matches never cross documents.

1. *Anchors.* Every ``LENGTH``-byte string has one anchor inside, chosen by its
   content alone: the leftmost ``GRAM``-byte gram with the smallest hash. Equal
   strings therefore have equal anchors at equal places, and only strings around
   an anchor gram that is met twice can repeat. One pass counts the anchor grams
   of all documents. Its result is a bitmap of fixed size (``BITMAP_BITS``; a
   false positive costs work, never a result) and the list of very common grams,
   which a second choice of anchors avoids where it can.
2. *Shards.* The strings around each possibly repeated anchor travel, as one
   piece of text, to the shard of their gram. Equal pieces of one task travel
   once: the later ones are repeats and are settled at once.
3. *Suffixes.* In a shard, equal pieces are settled first; the suffixes of the
   rest are sorted by induction (``induced_sort``), neighbours' common prefixes
   give runs of equal ``LENGTH``-byte strings, and all but the first of a run are
   repeats. The number of shards follows from the bytes counted in the first
   pass (``PART_BYTES``). Shards hold whole grams, are held whole and are sorted
   in memory in parts of ``SHARD_BYTES``; only a part of over ``QUEUE`` entries,
   which a single gram makes, spills queues to the shared folder.
4. *Removal.* Covered ranges are merged by document and cut out of the text.

Defined cases: null and empty texts have nothing to remove. Documents come in
the order of their id. If ids repeat or are missing, documents are ordered by
id (missing ones last), then by the text's hash, and are searched as documents
of their own; of two equal rows the second is a repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.llm.induced_sort import common_prefix, suffix_order
from fairway.llm.staging import parts, shared_folder, ship, stage
from fairway.llm.textvec import U64, RangeHash, Texts, gram_hashes, mix, release_memory, slices

LENGTH = 100
GRAM = 40
BITMAP_BITS = 1 << 27
# A gram met more often is avoided as an anchor.
COMMON = 128
MOST_COMMON = 1_000_000
SHARD_BYTES = 1 << 20
QUEUE = 1 << 21
FLUSH_BYTES = 3 << 20
SLICE = 1 << 20
# Parts of the packed shuffles for each shuffle partition, at least: a part is held whole.
PARTS = 8
# Bytes of pieces (and anchors counted) of a part, on average, at most: parts grow with the input.
PART_BYTES = 8 << 20
ANCHOR_BYTES = 8   # a packed gram and its count
# Documents (with their ranges) sent to all tasks at most; beyond that a shuffle join.
BROADCAST_DOCS = 500_000
BROADCAST_BYTES = 64 << 20
_BLOCK = 1 << 20   # positions whose anchors are chosen at once
_LATE = U64(1 << 63)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """48-bit hash of the gram at every position that has one."""
    return gram_hashes(data, GRAM) >> U64(16)


def _spread(h: np.ndarray) -> np.ndarray:
    """48-bit hash by which anchors are counted and dealt. An anchor has the
    smallest hash of its window, so the hashes that choose anchors crowd near 0."""
    return mix(h + U64(0x2545F491)) >> U64(16)


def _window_minimum(key: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, key
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    n = len(key) - width + 1
    return np.minimum(out[:n], out[width - span:width - span + n])


def _held(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def anchored(texts: Texts, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of string starts that share an anchor: (first start, last start,
    anchor position, gram hash, whether a common gram was avoided)."""
    n = len(texts.data)
    outs = []
    whole = _gram_hashes(texts.data)
    width = LENGTH - GRAM + 1
    starts_in = np.zeros(n + 1, np.int32)   # +1 where valid starts begin, -1 where they end
    long_enough = texts.ends - texts.starts >= LENGTH
    np.add.at(starts_in, texts.starts[long_enough], 1)
    np.add.at(starts_in, texts.ends[long_enough] - LENGTH + 1, -1)
    valid_all = np.cumsum(starts_in[:-1]) > 0
    for base in range(0, max(n - LENGTH + 1, 0), _BLOCK):
        size = min(_BLOCK, n - LENGTH + 1 - base)
        valid = valid_all[base:base + size]
        if not valid.any():
            continue
        h = whole[base:base + size + width - 1]
        # smallest hash, then leftmost: 39 bits of hash above 24 of position
        key = (h >> U64(9)) << U64(24) | np.arange(len(h), dtype=U64)
        place = (_window_minimum(key, width) & U64(0xFFFFFF)).astype(np.int64)
        avoided = np.zeros(size, bool)
        if len(common):
            picked = np.zeros(len(h), bool)
            picked[place[valid]] = True
            at = np.flatnonzero(picked)
            late = np.zeros(len(h), bool)
            late[at[_held(common, _spread(h[at]))]] = True
            avoided = late[place]
            if avoided.any():
                # grams of the strings concerned that are common come last
                cover = np.zeros(len(h) + 1, np.int32)
                x = np.flatnonzero(avoided)
                np.add.at(cover, x, 1)
                np.add.at(cover, x + width, -1)
                near = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
                key[near[_held(common, _spread(h[near]))]] |= _LATE
                place = (_window_minimum(key, width) & U64(0xFFFFFF)).astype(np.int64)
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
        end = valid.copy()
        end[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
        x1, x2 = np.flatnonzero(new), np.flatnonzero(end)
        some = np.concatenate([[0], np.cumsum(avoided)])
        outs.append((x1 + base, x2 + base, place[x1] + base, _spread(h[place[x1]]), some[x2 + 1] > some[x1]))
    if not outs:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*outs))


def _planes(x: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1)[:, :size].T.tobytes()


def _unplanes(x: bytes, size: int) -> np.ndarray:
    n = len(x) // size
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(x, np.uint8).reshape(size, n).T
    return out.reshape(-1).view(U64)


def _part_ranges(n_parts: int, ascending: np.ndarray):
    part = ((ascending >> U64(16)) * U64(n_parts)) >> U64(32)
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    for a, b in zip(at, [*at[1:], len(part)]):
        yield int(part[a]), a, b


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(16)) * U64(BITMAP_BITS) >> U64(32)).astype(np.int64)


def _parts_for(n_parts: int, size: int) -> int:
    """Parts for ``size`` bytes: ``n_parts``, or more where these would be larger than ``PART_BYTES``."""
    return max(n_parts, -(-size // PART_BYTES))


def _counted(texts: DataFrame, n_parts: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bitmap of grams met twice or more, the common grams, ascending, and the
    bytes at most of the pieces around the anchors met twice."""
    none = np.zeros(0, U64)

    def run(batches: Iterator[pa.RecordBatch]):
        def send(held):
            h, n = np.unique(np.concatenate(held), return_counts=True)
            rows = [(p, _planes(h[a:b], 6), np.minimum(n[a:b], 255).astype(np.uint8).tobytes())
                    for p, a, b in _part_ranges(n_parts, h)]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                                   names=["part", "grams", "counts"])

        held, size = [], 0
        for batch in slices(batches, most=SLICE):
            h = anchored(Texts(batch.column("text")), none)[3]
            if len(h):
                held.append(h)
            size += len(h)
            if size >= 1 << 20:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)

    def total(table: pa.Table) -> pa.Table:
        h = np.concatenate([_unplanes(x, 6) for x in table.column("grams").to_pylist()])
        n = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8)
        order = np.argsort(h)
        h, n = h[order], n[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        n, h = np.add.reduceat(n, at), h[at]
        h, n = h[n > 1], n[n > 1]
        rows = [(-1, b"", int(g), int(c)) for g, c in zip(h[n > COMMON], n[n > COMMON])]
        rows.append((-2, b"", None, int(n.sum())))
        if len(h):  # this part's slice of the bitmap
            slot = _slot(h)
            first = int(slot[0]) >> 3
            bits = np.zeros(((int(slot[-1]) >> 3) - first + 1) * 8, np.uint8)
            bits[slot - first * 8] = 1
            rows.append((first, np.packbits(bits, bitorder="little").tobytes(), None, None))
        cols = list(zip(*rows)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                        names=["first", "bits", "gram", "n"])

    got = stage(texts.select("text").mapInArrow(run, "part int, grams binary, counts binary").groupBy("part").applyInArrow(
        total, "first long, bits binary, gram long, n long"), "grams")
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in got.where("first >= 0").select("first", "bits").toLocalIterator():
        some = np.frombuffer(bytes(r["bits"]), np.uint8)
        bitmap[r["first"]:r["first"] + len(some)] |= some
    least = COMMON
    grams = got.where("first = -1")
    while grams.where(F.col("n") > least).count() > MOST_COMMON:
        least *= 2
    common = grams.where(F.col("n") > least).select("gram").toPandas()["gram"].to_numpy(np.int64)
    met = got.where("first = -2").agg(F.sum("n")).first()[0] or 0
    return bitmap, np.sort(common.view(U64)), met * (2 * LENGTH - GRAM)


_PIECES = "part int, grams binary, docs binary, starts binary, leads binary, counts binary, text binary, covers binary"


def _send_side(n_parts: int, model):
    schema = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in
                                                ("grams", "docs", "starts", "leads", "counts", "text", "covers")]])

    def send(held):
        doc, x, lead, count, gram, identity, size = (np.concatenate([h[i] for h in held]) for i in range(7))
        text = np.concatenate([h[7] for h in held])
        at = np.cumsum(size) - size
        order = np.lexsort((x, doc, identity))
        later = np.zeros(len(order), bool)
        later[1:] = identity[order][1:] == identity[order][:-1]
        covered, kept = order[later], order[~later]
        rows = []
        if len(covered):
            # merge what touches, within each document
            covers = _merged(doc[covered], x[covered], x[covered] + size[covered])
            part = covers[0] % n_parts
            for p in np.unique(part):
                rows.append((int(p), *[None] * 6, np.stack([c[part == p] for c in covers]).tobytes()))
        kept = kept[np.argsort(gram[kept], kind="stable")]
        for p, a, b in _part_ranges(n_parts, gram[kept]):
            k = kept[a:b]
            n = size[k]
            flat = np.arange(int(n.sum())) + np.repeat(at[k] - (np.cumsum(n) - n), n)
            rows.append((p, _planes(gram[k], 6), _planes(doc[k], 8), _planes(x[k], 5), lead[k].astype(np.uint8).tobytes(),
                         count[k].astype(np.uint8).tobytes(), text[flat].tobytes(), None))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]):
        bitmap, common = model.value
        held, size = [], 0
        for batch in slices(batches, most=SLICE):
            texts = Texts(batch.column("text"))
            x1, x2, place, gram, avoided = anchored(texts, common)
            slot = _slot(gram)
            maybe = np.flatnonzero((bitmap[slot >> 3] >> (slot & 7) & 1).astype(bool) | avoided)
            if not len(maybe):
                continue
            x1, x2, place, gram = x1[maybe], x2[maybe], place[maybe], gram[maybe]
            row = texts.row_of(x1)
            n = x2 - x1 + LENGTH
            identity = mix(RangeHash(texts.data)(x1, x1 + n) ^ mix((place - x1).astype(U64) << U64(8) | (x2 - x1).astype(U64)))
            flat = np.arange(int(n.sum())) + np.repeat(x1 - (np.cumsum(n) - n), n)
            doc = batch.column("id").to_numpy()[row].astype(np.int64)
            held.append((doc, x1 - texts.starts[row], place - x1, x2 - x1 + 1, gram, identity, n, texts.data[flat]))
            size += int(n.sum())
            if size >= FLUSH_BYTES:
                yield send(held)
                held, size = [], 0
        if held:
            yield send(held)
        del held
        release_memory()

    return run


def _merged(doc, a, b):
    """Ranges [a, b) of each document, merged where they touch."""
    order = np.lexsort((b, a, doc))
    doc, a, b = doc[order], a[order], b[order]
    if not len(doc):
        return doc, a, b
    # running end within a document: shift documents apart
    number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    span = int(b.max()) + 1
    end = np.maximum.accumulate(b + number * span) - number * span
    new = np.ones(len(doc), bool)
    new[1:] = (number[1:] != number[:-1]) | (a[1:] > end[:-1])
    at = np.flatnonzero(new)
    return doc[at], a[at], end[np.append(at[1:], len(doc)) - 1]


def _piece_hashes(text, at, size):
    """Hash of each piece; pieces follow each other in ``text``."""
    out = np.zeros(len(at), U64)
    share = at // SLICE
    edges = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]])) if len(at) else []
    for a, b in zip(edges, [*edges[1:], len(at)]):
        low, high = at[a], at[b - 1] + size[b - 1]
        out[a:b] = RangeHash(text[low:high])(at[a:b] - low, at[a:b] - low + size[a:b])
    return out


def _settle_side(spill: str):
    def settle(table: pa.Table) -> pa.Table:
        """Covered ranges found in one shard."""
        covers = [np.frombuffer(x, np.int64).reshape(3, -1) for x in table.column("covers").to_pylist() if x]
        out = [tuple(c) for c in covers]
        table = table.filter(pa.compute.is_valid(table.column("grams")))
        if table.num_rows:
            col = lambda c: table.column(c).to_pylist()
            gram = np.concatenate([_unplanes(x, 6) for x in col("grams")])
            doc = np.concatenate([_unplanes(x, 8) for x in col("docs")]).view(np.int64)
            x = np.concatenate([_unplanes(x, 5) for x in col("starts")]).view(np.int64)
            lead = np.frombuffer(b"".join(col("leads")), np.uint8).astype(np.int64)
            count = np.frombuffer(b"".join(col("counts")), np.uint8).astype(np.int64)
            text = np.frombuffer(b"".join(col("text")), np.uint8)
            size = count + LENGTH - 1
            at = np.cumsum(size) - size
            identity = _piece_hashes(text, at, size) ^ mix(lead.astype(U64) << U64(8) | (count - 1).astype(U64))
            order = np.lexsort((x, doc, identity))
            later = np.zeros(len(order), bool)
            later[1:] = identity[order][1:] == identity[order][:-1]
            done, first = order[later], order[~later]
            out.append((doc[done], x[done], x[done] + size[done]))
            # grams with two or more different pieces, in parts of whole grams
            first = first[np.argsort(gram[first], kind="stable")]
            g = gram[first]
            begin = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            n = np.diff(np.append(begin, len(g)))
            first = first[np.repeat(n > 1, n)]
            if len(first):
                g = gram[first]
                begin = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
                load = np.add.reduceat(size[first], begin)
                share = (np.cumsum(load) - load) // SHARD_BYTES
                for s in np.unique(share):
                    own = begin[share == s]
                    a, b = own[0], np.append(begin, len(g))[np.flatnonzero(share == s)[-1] + 1]
                    out.append(_repeats(first[a:b], doc, x, count, size, at, text, spill))
        doc, a, b = _merged(*[np.concatenate(c) for c in zip(*out)]) if out else [np.zeros(0, np.int64)] * 3
        del out
        release_memory()
        return pa.table({"doc": doc, "a": a, "b": b})

    return settle


def _repeats(pieces, doc, x, count, size, at, text, spill):
    """Strings of ``pieces`` that are met earlier, as covered ranges."""
    n = size[pieces] + 1   # a separator after each piece
    end = np.cumsum(n)
    begin = end - n
    flat = np.arange(int(end[-1])) + np.repeat(at[pieces] - begin, n)
    own = np.zeros(int(end[-1]), np.int16)
    own[:] = text[np.minimum(flat, len(text) - 1)].astype(np.int16) + 1
    own[end - 1] = 0
    order = suffix_order(own, LENGTH, QUEUE, spill)
    # string starts only
    piece = np.repeat(np.arange(len(pieces)), n)
    inside = np.arange(len(own)) - begin[piece]
    order = order[inside[order] < count[pieces][piece[order]]]
    same = common_prefix(own, order[:-1], order[1:], LENGTH) >= LENGTH
    run = np.concatenate([[0], np.cumsum(~same)])
    where = pieces[piece[order]]
    d, s = doc[where], x[where] + inside[order]
    rank = np.lexsort((s, d, run))
    later = np.zeros(len(rank), bool)
    later[1:] = run[rank][1:] == run[rank][:-1]
    hit = rank[later]
    # one string may start at one place in two pieces' runs: same place is not earlier
    prior = rank[np.flatnonzero(later) - 1]
    first = rank[np.maximum.accumulate(np.where(later, 0, np.arange(len(rank))))][later]
    real = (d[hit] != d[first]) | (s[hit] != s[first])
    del prior
    hit = hit[real]
    return d[hit], s[hit], s[hit] + LENGTH


def _merge_docs(table: pa.Table) -> pa.Table:
    """One row for each document: merged ranges as bytes (starts, then ends)."""
    doc, a, b = _merged(*[table.column(c).to_numpy() for c in ("doc", "a", "b")])
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, int)
    packed = [np.stack([a[i:j], b[i:j]]).tobytes() for i, j in zip(at, np.append(at[1:], len(doc)))]
    return pa.table({"doc": pa.array(doc[at], pa.int64()), "ranges": pa.array(packed, pa.binary())})


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """``texts`` is (id, text) with different ids, not null. Returns (doc,
    ranges) of the documents that have something to remove."""
    spark = texts.sparkSession
    ship(spark)
    n_parts = PARTS * parts(spark)
    text_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about one anchor in half the grams of a string
    anchors = 2 * text_bytes // (LENGTH - GRAM + 2)
    *model, piece_bytes = _counted(texts, _parts_for(n_parts, anchors * ANCHOR_BYTES))
    n_parts = _parts_for(n_parts, piece_bytes)
    model = spark.sparkContext.broadcast(tuple(model))
    spill = shared_folder(spark, "queues")
    covers = stage(texts.mapInArrow(_send_side(n_parts, model), _PIECES).groupBy("part").applyInArrow(
        _settle_side(spill), "doc long, a long, b long"), "covers")
    return stage(covers.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(n_parts))).groupBy("part").applyInArrow(
        _merge_docs, "doc long, ranges binary"), "ranges")


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(own, id, text): ``own`` is the id itself, or the place in the documents'
    order where ids repeat or are missing."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ids = rows.select("id")
    if ids.where("id is null").limit(1).count() or \
            ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        ordered = rows.orderBy(F.col("id").asc_nulls_last(), F.xxhash64(F.coalesce("text", F.lit(""))))
        return stage(ordered.withColumn("own", F.monotonically_increasing_id()), "numbered").select("own", "id", "text")
    return rows.select(F.col("id").alias("own"), "id", "text")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False) -> DataFrame:
    """``id_col``, n_bytes, n_removed, n_spans, kept_sha256 for every row of
    ``docs``; with ``with_text`` also ``kept``, the remaining bytes."""
    rows = _numbered(docs, id_col, text_col)
    ranges = repeated_ranges(rows.select(F.col("own").alias("id"), "text"))
    size = ranges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("ranges")).alias("bytes")).first()
    if size["n"] <= BROADCAST_DOCS and (size["bytes"] or 0) <= BROADCAST_BYTES:
        ranges = F.broadcast(ranges)
    both = rows.join(ranges, rows.own == ranges.doc, "left").select("id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            raw = texts.data.tobytes()
            removed, spans, digest, kept = [], [], [], []
            for s, e, packed in zip(texts.starts.tolist(), texts.ends.tolist(), batch.column("ranges").to_pylist()):
                text = raw[s:e]
                n = 0
                if packed:
                    a, b = np.frombuffer(packed, np.int64).reshape(2, -1)
                    n = len(a)
                    text = b"".join(text[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(text)]))
                removed.append(e - s - len(text))
                spans.append(n)
                digest.append(hashlib.sha256(text).hexdigest())
                kept.append(text if with_text else None)
            yield pa.record_batch([batch.column("id"), pa.array(texts.ends - texts.starts), pa.array(removed, pa.int64()),
                                   pa.array(spans, pa.int64()), pa.array(digest, pa.string()),
                                   pa.array(kept, pa.binary())],
                                  names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = both.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary") \
        .withColumnRenamed("id", id_col)
    return out if with_text else out.drop("kept")
