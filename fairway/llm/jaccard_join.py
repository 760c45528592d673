"""N-gram Jaccard self-join with PartEnum signatures.

Texts are lower-cased (A-Z), cut into words and turned into sets of 5-word
shingles (64-bit hashes). Two texts link when their sets' Jaccard similarity
is at least 3/4.

Method (PartEnum, Arasu, Ganti and Kaushik 2006):

* *Size bands.* Sets are put in bands ``(U/16, U]``, ``U = 16, 256, 4096, ...``.
  A set above ``3U/4`` may have a partner in the next band and is signed there
  too, so linked sets share a band.
* *Partitions.* In a band the domain (the hash range) is cut into ``U``
  partitions (up to ``U = 16``: one for each value). A signature is the
  content of one non-empty partition. If ``s`` and ``t`` link, they differ in
  at most ``k = |s| // 3`` elements, so at most ``k`` partitions differ and
  all others agree: the enumerated subsets have one partition each.
* *Order.* Signatures have one global order: those met in few texts first,
  then by partition. Before the ``m``-th shared one, at most ``k`` of a set's
  signatures are not shared, so the first ``k + m`` of each set hold ``m``
  shared ones, ``m = |s| // 10 + 1``. Counts only choose the order; any order
  gives the same links.
* *Count.* A set with fewer than ``3 |s| // 40 + 1`` signatures that any other
  set has too cannot link (its partner has at least ``3/4`` of its size, hence
  as many shared ones) and goes no further.

Sets with one shared signature meet at a rendezvous (the smallest set
fingerprint in the signature's bucket, the same for most buckets of a group
of near copies) and are compared there exactly. Meetings that share sets are
joined while they have at most ``BLOCK`` sets, so that most sets travel once.
Within a meeting a pair is compared only while its members are in different
components, and only links leave the task: pairs are never written out.
Meetings above ``BLOCK`` sets or ``BLOCK_ITEMS`` items are cut into blocks. The
sets that stay outside the largest component are then dealt to blocks of their
own, as are the others, by size class; each such block is compared with each
other block whose sizes can link, one bounded group for each pair of blocks.

Defined cases: null, empty and blank texts have no shingles and no links;
fewer than five words make one shingle of the whole sequence; equal sets are
linked; repeated rows and ids give one row each; a row without an id takes no
part in links and has a null component id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.llm.components import connected_components
from fairway.llm.staging import parts, ship, small, stage
from fairway.llm.textvec import LOWER, U64, RangeHash, Texts, mix, release_memory, slices

SHINGLE_WORDS = 5
# A signature met in more texts than this is ordered last.
COMMON = 8
# Common signatures sent to the tasks at most (16 MB); COMMON doubles until they fit.
MOST_COMMON = 2_000_000
# Sets compared in one task at once.
BLOCK = 1000
# Items of the sets compared in one task at once, on average (a larger single set is held whole).
BLOCK_ITEMS = 1 << 20
# Sets link only within a ratio of 4/3: same or neighbouring classes of this ratio.
SIZE_CLASS = 1.4
# Places (a set in a meeting) sent to all tasks at most; beyond that shuffle joins fetch the texts.
BROADCAST_PLACES = 1_000_000
# Text bytes whose signatures make one part.
PART_BYTES = 8 << 20
# Signatures held before a task sends them on.
FLUSH = 1 << 20

_WEIGHTS = mix(np.arange(11, 11 + 8, dtype=U64)) | U64(1)


def shingle_sets(texts: Texts, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each row, and their number by row."""
    low = LOWER[texts.data]
    starts, ends = texts.words(low)
    rows = texts.row_of(starts)
    n_words = np.bincount(rows, minlength=texts.rows)
    h = RangeHash(low)(starts, ends)
    sizes = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    values = np.zeros(int(sizes.sum()), dtype=U64)
    offset = np.concatenate([[0], np.cumsum(sizes)])
    first = np.concatenate([[0], np.cumsum(n_words)])
    short = np.flatnonzero((n_words > 0) & (n_words < words))
    whole = np.ones(len(values), dtype=bool)
    for r in short:
        part = h[first[r]:first[r + 1]]
        values[offset[r]] = (part * _WEIGHTS[:len(part)]).sum(dtype=U64) + U64(len(part))
        whole[offset[r]] = False
    if len(h) >= words:
        last = len(h) - words + 1
        inside = rows[:last] == rows[words - 1:]
        total = h[:last] * _WEIGHTS[0]
        for j in range(1, words):
            total += h[j:last + j] * _WEIGHTS[j]
        values[whole] = total[inside]
    values = mix(values)
    for r in np.flatnonzero(sizes > 1):
        values[offset[r]:offset[r + 1]].sort()
    owner = np.repeat(np.arange(texts.rows), sizes)
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=texts.rows)


def fingerprints(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One hash for each row's set (0 for an empty set)."""
    out = np.zeros(len(sizes), dtype=U64)
    full = np.flatnonzero(sizes)
    if len(full):
        at = (np.cumsum(sizes) - sizes)[full]
        out[full] = mix(np.add.reduceat(mix(values + U64(77)), at) + sizes[full].astype(U64))
    return out


def signatures(values: np.ndarray, sizes: np.ndarray, common: np.ndarray,
               spare: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, is common) of the first ``spare * (k + m)`` signatures
    of every set in the global order, for its band and, near the band's top,
    the next."""
    band = np.full(len(sizes), 16, dtype=np.int64)
    while (low := band < sizes).any():
        band[low] *= 16
    outs = []
    for step in (1, 16):
        chosen = (sizes > 0) if step == 1 else (4 * sizes > 3 * band)
        inside = np.repeat(chosen, sizes)
        v = values[inside]
        if not len(v):
            continue
        row = np.repeat(np.flatnonzero(chosen), sizes[chosen])
        u = (band * step)[row].astype(U64)
        place = np.where(u > 16, ((v >> U64(32)) * u) >> U64(32), v)
        new = np.ones(len(v), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        sign = mix(np.add.reduceat(mix(v + U64(991)), at) ^ mix(place[at] + u[at] * U64(1_000_003))) >> U64(16)
        row = row[at]
        late = _held(common, sign)
        begin = np.ones(len(row), dtype=bool)
        begin[1:] = row[1:] != row[:-1]
        group = np.cumsum(begin) - 1
        heads = np.flatnonzero(begin)
        early_sum = np.cumsum(~late)
        early_before = (early_sum - ~late)[heads][group]
        early_all = np.add.reduceat((~late).astype(np.int64), heads)[group]
        nth_early = early_sum - early_before - 1
        position = np.arange(len(row)) - heads[group]
        nth = np.where(late, early_all + position - (nth_early + 1), nth_early)
        size = sizes[row]
        take = nth < np.floor(spare * (size // 3 + size // 10 + 1)).astype(np.int64)
        outs.append((row[take], sign[take], late[take]))
    if not outs:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*outs))


def _held(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    at = np.searchsorted(sorted_values, x)
    return sorted_values[np.minimum(at, len(sorted_values) - 1)] == x


def _planes(x: np.ndarray) -> bytes:
    """48-bit numbers as six byte planes: those of ascending numbers compress."""
    return x.view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _unplane(x: bytes) -> np.ndarray:
    n = len(x) // 6
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(x, dtype=np.uint8).reshape(6, n).T
    return out.reshape(-1).view(U64)


def _first_of_each(fp: np.ndarray) -> np.ndarray:
    mask = np.zeros(len(fp), dtype=bool)
    mask[np.unique(fp, return_index=True)[1]] = True
    return mask & (fp != 0)


def _only(values, sizes, keep):
    return values[np.repeat(keep, sizes)], np.where(keep, sizes, 0)


def _parts_of(n_parts: int, key: np.ndarray):
    """(part, first, end) of keys that ascend: a part is a range of the key's 48 bits."""
    part = ((key >> U64(16)) * U64(n_parts)) >> U64(32)
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    for a, b in zip(at, [*at[1:], len(part)]):
        yield int(part[a]), a, b


def _count_side(n_parts: int):
    schema = pa.schema([("part", pa.int32()), ("signs", pa.binary()), ("counts", pa.binary())])

    def send(held):
        sign, count = np.unique(np.concatenate(held), return_counts=True)
        rows = [(p, _planes(sign[a:b]), count[a:b].astype(np.uint32).tobytes())
                for p, a, b in _parts_of(n_parts, sign)]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema)

    def run(batches: Iterator[pa.RecordBatch]):
        held, n = [], 0
        for batch in slices(batches):
            values, sizes = shingle_sets(Texts(batch.column("text")))
            values, sizes = _only(values, sizes, _first_of_each(fingerprints(values, sizes)))
            sign = signatures(values, sizes, np.zeros(0, U64), 1.15)[1]
            held.append(sign)
            n += len(sign)
            if n >= FLUSH:
                yield send(held)
                held, n = [], 0
        if n:
            yield send(held)

    return run, "part int, signs binary, counts binary"


def _common_signatures(texts: DataFrame, n_parts: int) -> np.ndarray:
    """Signatures met in many distinct sets: counted over all texts, sums of
    packed counts by part. Only the common ones reach the driver, at most
    ``MOST_COMMON``."""
    run, schema = _count_side(n_parts)

    def total(table: pa.Table) -> pa.Table:
        sign = np.concatenate([_unplane(x) for x in table.column("signs").to_pylist()])
        count = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype=np.uint32)
        order = np.argsort(sign)
        sign, count = sign[order], count[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
        count = np.add.reduceat(count, at)
        many = count > COMMON
        out = pa.table({"sign": sign[at][many].view(np.int64), "n": count[many]})
        del table, sign, count, order, at, many
        release_memory()
        return out

    counts = stage(texts.select("text").mapInArrow(run, schema).groupBy("part").applyInArrow(
        total, "sign long, n long"), "common")
    least = COMMON
    while counts.where(F.col("n") > least).count() > MOST_COMMON:
        least *= 2
    got = counts.where(F.col("n") > least).select("sign").toPandas()["sign"].to_numpy(dtype=np.int64)
    return np.sort(got.view(U64))


def _meeting_side(n_parts: int, common):
    schema = pa.schema([("part", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()),
                        ("signs", pa.binary()), ("owners", pa.binary()), ("sets", pa.binary()),
                        ("late", pa.bool_())])

    def send(held):
        sign, owner, late = (np.concatenate(x) for x in zip(*held))
        rows = []
        for is_late in (False, True):
            s, o = sign[late == is_late], owner[late == is_late]
            # a common signature is dealt by owner too: no part holds all its owners
            key = mix(s + o) >> U64(16) if is_late else s
            order = np.argsort(key)
            s, o, key = s[order], o[order], key[order]
            for p, a, b in _parts_of(n_parts, key):
                sets, number = np.unique(o[a:b], return_inverse=True)
                rows.append((p, _planes(s[a:b]), number.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(),
                             sets.tobytes(), is_late))
        cols = list(zip(*rows))
        none = pa.nulls(len(rows), pa.int64())
        return pa.record_batch([pa.array(cols[0], pa.int32()), none, none, none,
                                *[pa.array(c, t) for c, t in zip(cols[1:], schema.types[4:])]], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]):
        held, n = [], 0
        known = common.value
        for batch in slices(batches):
            values, sizes = shingle_sets(Texts(batch.column("text")))
            fp = fingerprints(values, sizes)
            ids = batch.column("id").cast(pa.int64())
            fp[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            rows = batch.num_rows
            empty = pa.nulls(rows, pa.binary())
            yield pa.record_batch([pa.array(((fp + np.arange(rows, dtype=U64)) % U64(n_parts)).astype(np.int32)),
                                   ids, pa.array(sizes.astype(np.int64)), pa.array(fp.view(np.int64)),
                                   empty, empty, empty, pa.nulls(rows, pa.bool_())], schema=schema)
            values, sizes = _only(values, sizes, _first_of_each(fp))
            row, sign, late = signatures(values, sizes, known)
            held.append((sign, fp[row], late))
            n += len(sign)
            if n >= FLUSH:
                yield send(held)
                held, n = [], 0
        if n:
            yield send(held)

    return run, ("part int, id long, n long, fp long, signs binary, owners binary, sets binary, late boolean")


def _meet(table: pa.Table) -> pa.Table:
    """Buckets of one part. Kind 0: documents that pass through; 1: members of
    buckets of two or more, with their rendezvous; 2: members of common
    signatures; 3: a set and the number of its signatures that others have."""
    kinds, xs, ys = [], [], []

    def put(kind, x, y):
        kinds.append(np.full(len(x), kind, dtype=np.int32))
        xs.append(x.view(np.int64))
        ys.append(y.view(np.int64))

    packed = table.filter(pa.compute.is_valid(table.column("late")))
    for common in (False, True):
        some = packed.filter(pa.compute.equal(packed.column("late"), common))
        if not some.num_rows:
            continue
        s = np.concatenate([_unplane(x) for x in some.column("signs").to_pylist()])
        o = np.concatenate([np.frombuffer(y, dtype=U64)[np.ascontiguousarray(
            np.frombuffer(x, dtype=np.uint8).reshape(4, -1).T).reshape(-1).view(np.uint32)]
            for x, y in zip(some.column("owners").to_pylist(), some.column("sets").to_pylist())])
        order = np.lexsort((o, s))
        s, o = s[order], o[order]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
        s, o = s[new], o[new]
        if common:
            put(2, s, o)
            continue
        at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        n = np.diff(np.concatenate([at, [len(s)]]))
        keep = np.repeat(n > 1, n)
        x, y = np.repeat(o[at], n)[keep], o[keep]
        sets, count = np.unique(y, return_counts=True)
        put(3, count.astype(np.int64), sets)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.ones(len(x), dtype=bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        put(1, x[new], y[new])
    docs = table.filter(pa.compute.is_valid(table.column("fp")))
    del table, packed
    release_memory()
    n = sum(map(len, xs))
    return pa.table({
        "kind": pa.chunked_array([pa.array(np.zeros(docs.num_rows, np.int32)), *map(pa.array, kinds)], pa.int32()),
        "x": pa.chunked_array([*docs.column("id").chunks, *map(pa.array, xs)], pa.int64()),
        "y": pa.chunked_array([*docs.column("fp").chunks, *map(pa.array, ys)], pa.int64()),
        "n": pa.chunked_array([*docs.column("n").chunks, pa.nulls(n, pa.int64())], pa.int64())})


def _packed_sets(batch: pa.RecordBatch) -> list[bytes | None]:
    """Each text's set (48-bit items); none where it is not the set asked for."""
    values, sizes = shingle_sets(Texts(batch.column("text")))
    right = fingerprints(values, sizes).view(np.int64) == batch.column("fp").to_numpy()
    end = np.cumsum(sizes)
    return [_planes(values[e - n:e] >> U64(16)) if ok else None for e, n, ok in zip(end, sizes, right)]


def _set_side(batches: Iterator[pa.RecordBatch]):
    """Each text's set for every meeting it goes to."""
    for batch in slices(batches):
        packed = _packed_sets(batch)
        to = [t if p is not None else [] for t, p in zip(batch.column("to").to_pylist(), packed)]
        row = np.repeat(np.arange(batch.num_rows), list(map(len, to)))
        flat = [t for ts in to for t in ts]
        for a in range(0, len(flat), 2000):  # bounded batches
            some, rows = flat[a:a + 2000], row[a:a + 2000]
            yield pa.record_batch([
                pa.array([t["x"] for t in some], pa.int64()), pa.array([t["block"] for t in some], pa.int64()),
                batch.column("fp").take(pa.array(rows)), pa.array([t["root"] for t in some], pa.int64()),
                pa.array([t["visits"] for t in some], pa.bool_()), pa.array([packed[r] for r in rows], pa.binary())],
                names=["x", "block", "fp", "root", "visits", "items"])


def _item_side(batches: Iterator[pa.RecordBatch]):
    """Each text's set once."""
    for batch in slices(batches):
        out = pa.record_batch([batch.column("fp"), pa.array(_packed_sets(batch), pa.binary())], names=["fp", "items"])
        yield out.filter(pa.compute.is_valid(out.column("items")))


def _links_of(sets: list[np.ndarray], label: np.ndarray, visits: np.ndarray) -> np.ndarray:
    """Component label of each set after comparing all sets of different
    components, or, where some sets are visitors, every visitor with every
    other set. ``label`` holds known components."""
    label = label.copy()
    sizes = np.array([len(s) for s in sets])
    held = np.flatnonzero(~visits)
    if not len(held):
        return label
    items = np.concatenate([sets[i] for i in held])
    owner = np.repeat(held, sizes[held])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    at = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
    count = np.diff(np.concatenate([at, [len(items)]]))
    # most typical sets first: they link the group soonest
    weight = np.bincount(owner, np.repeat(count, count), len(sets)) / sizes
    value = items[at]
    for i in np.flatnonzero(visits) if visits.any() else np.argsort(-weight, kind="stable"):
        other = ~visits & (label != label[i])
        if not other.any():
            continue
        place = np.minimum(np.searchsorted(value, sets[i]), len(value) - 1)
        place = place[value[place] == sets[i]]
        a, n = at[place], count[place]
        index = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(owner[index], minlength=len(sets))
        hit = other & (100 * shared >= 75 * (sizes + sizes[i] - shared))
        for c in np.unique(label[hit]):
            label[label == c] = label[i]
    return label


def _compare(table: pa.Table) -> pa.Table:
    """One meeting block, or one pair of blocks: residents and visitors. Returns
    a link from each set to the first set of its component in the group."""
    fp = table.column("fp").to_numpy()
    root = table.column("root").to_numpy()
    visits = table.column("visits").to_numpy(zero_copy_only=False)
    sets = [_unplane(x) for x in table.column("items").to_pylist()]
    _, label = np.unique(root, return_inverse=True)
    label = _links_of(sets, label, visits)
    first = np.full(len(fp), np.iinfo(np.int64).max)
    np.minimum.at(first, label, fp)
    head = first[label]
    keep = head != fp
    del table, sets
    release_memory()
    return pa.table({"a": fp[keep], "b": head[keep]})


def _compared(texts: DataFrame, firsts: DataFrame, places: DataFrame) -> DataFrame:
    """Links found in meetings. ``firsts`` has one document of each set,
    ``places`` the meetings (x, block, root, visits) each set goes to."""
    texts = texts.where("id is not null")
    places = stage(places, "places")
    if places.count() <= BROADCAST_PLACES:
        to = places.groupBy("fp").agg(F.collect_list(F.struct("x", "block", "root", "visits")).alias("to"))
        to = stage(firsts.select("fp", "id").join(to, "fp"), "lists")
        sets = texts.join(F.broadcast(to), "id").select("text", "fp", "to").mapInArrow(
            _set_side, "x long, block long, fp long, root long, visits boolean, items binary")
    else:  # no lists: each set is made once and meets its places by shuffle
        wanted = firsts.select("fp", "id").join(places.select("fp").distinct(), "fp")
        items = texts.join(wanted, "id").select("text", "fp").mapInArrow(_item_side, "fp long, items binary")
        sets = places.join(items, "fp").select("x", "block", "fp", "root", "visits", "items")
    return sets.groupBy("x", "block").applyInArrow(_compare, "a long, b long")


def _block_pairs(tagged: DataFrame, main: DataFrame) -> DataFrame:
    """Groups (x, block, fp, root, visits) that compare the sets outside the
    largest component (``main``) of a large meeting with all its sets that their
    size lets them link to. ``tagged`` is (x, fp, n, root). Every group has one
    block of visitors and one of residents, or one block of its own."""
    dealt = tagged.join(small(main), "x").withColumn("out", F.col("root") != F.col("main")).withColumn(
        "class", F.floor(F.log("n") / F.log(F.lit(SIZE_CLASS))).cast("int"))
    cell = ["x", "out", "class"]
    cells = dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("load")).select(
        *cell, _blocks_of(F.col("m"), F.col("load")).alias("blocks"))
    cells = small(stage(cells, "cells"))
    dealt = stage(dealt.join(cells, cell).select(
        *cell, F.pmod(F.xxhash64("fp", F.lit("deal")), F.col("blocks")).cast("int").alias("no"), "fp", "root"), "dealt")
    blocks = cells.select(*cell, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("no"))
    a = blocks.where("out").select("x", F.col("class").alias("a_class"), F.col("no").alias("a_no"))
    both = a.join(blocks, "x").where("abs(a_class - class) <= 1").where(
        ~F.col("out") | (F.struct("a_class", "a_no") <= F.struct("class", "no")))
    both = stage(both.withColumn("block", F.monotonically_increasing_id()), "block-pairs")
    alone = F.col("out") & (F.col("a_class") == F.col("class")) & (F.col("a_no") == F.col("no"))
    come = both.where(~alone).select("x", F.lit(True).alias("out"), F.col("a_class").alias("class"),
                                     F.col("a_no").alias("no"), "block", F.lit(True).alias("visits"))
    stay = both.select("x", "out", "class", "no", "block", F.lit(False).alias("visits"))
    return dealt.join(come.unionByName(stay), [*cell, "no"]).select("x", "block", "fp", "root", "visits")


def _blocks_of(m, load):
    """Number of blocks for ``m`` sets of ``load`` items."""
    return F.greatest(F.ceil(m / BLOCK), F.ceil(load / BLOCK_ITEMS)).cast("int")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # parts of the packed signatures by measured bytes: none grows with the input
    text_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(parts(spark), -(-text_bytes // PART_BYTES))
    common = spark.sparkContext.broadcast(_common_signatures(texts, n_parts))
    run, schema = _meeting_side(n_parts, common)
    met = stage(texts.mapInArrow(run, schema).groupBy("part").applyInArrow(
        _meet, "kind int, x long, y long, n long"), "meetings")
    members = met.where("kind = 0").select(F.col("x").alias("id"), F.col("y").alias("fp"), "n")
    late = met.where("kind = 2").select(F.col("x").alias("sign"), F.col("y").alias("fp"))
    # one document and the size of each set; sets with too few shared signatures go no further
    classes = stage(members.where("fp <> 0").groupBy("fp").agg(F.min("id").alias("id"), F.max("n").alias("n")),
                    "classes")
    shared = met.where("kind = 3").select(F.col("y").alias("fp"), F.col("x").alias("c")).unionByName(
        late.select("fp", F.lit(1).cast("long").alias("c"))).groupBy("fp").agg(F.sum("c").alias("c"))
    able = stage(classes.join(shared, "fp").where("c >= floor(3 * n / 40) + 1").select("fp", "id", "n"), "able")
    size_of = able.select("fp", "n")
    late = late.join(size_of, "fp")
    heads = late.groupBy("sign").agg(F.min("fp").alias("x"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    met_pairs = met.where("kind = 1").select("x", F.col("y").alias("fp")).join(size_of, "fp").select("x", "fp", "n")
    pairs = stage(met_pairs.unionByName(
        late.join(heads, "sign").select("x", "fp", "n")).distinct(), "pairs")
    # a meeting joins the smallest one that shares a set with it, where the
    # sets of all that do so stay within a block
    least = pairs.groupBy("fp").agg(F.min("x").alias("g"))
    joint = pairs.join(least, "fp").groupBy("x").agg(F.min("g").alias("g"), F.count(F.lit(1)).alias("m"),
                                                     F.sum("n").alias("load"))
    fits = joint.groupBy("g").agg(F.sum("m").alias("m"), F.sum("load").alias("load")).where(
        (F.col("m") <= BLOCK) & (F.col("load") <= BLOCK_ITEMS)).select("g")
    joint = stage(joint.select("x", "g").join(fits, "g"), "joint")
    pairs = pairs.join(joint, "x", "left").select(F.coalesce("g", "x").alias("x"), "fp", "n").distinct()
    # meetings of one are dropped; large ones are cut into blocks
    sizes = pairs.groupBy("x").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("load")).where("m > 1").select(
        "x", _blocks_of(F.col("m"), F.col("load")).alias("blocks"))
    pairs = pairs.join(sizes, "x")
    pairs = stage(pairs.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long")), "blocks")
    links = stage(_compared(texts, able, pairs.select(
        "x", "block", "fp", F.col("fp").alias("root"), F.lit(False).alias("visits"))), "block-links")
    root = connected_components(links)
    large = pairs.where("blocks > 1")
    if large.limit(1).count():
        # sets outside the largest component of a large meeting meet its other blocks
        tagged = stage(large.join(root, large.fp == root.node, "left").select(
            "x", "fp", "n", F.coalesce("root", "fp").alias("root")), "tagged")
        by_root = tagged.groupBy("x", "root").agg(F.count(F.lit(1)).alias("c"))
        main = stage(by_root.groupBy("x").agg(F.max_by("root", F.struct("c", "root")).alias("main"),
                                              F.count(F.lit(1)).alias("roots")).where("roots > 1").drop("roots"), "main")
        more = _compared(texts, able, _block_pairs(tagged, main))
        # links found now join components found before
        for c in ("a", "b"):
            known = root.select(F.col("node").alias(c), F.col("root").alias("of"))
            more = more.join(known, c, "left").withColumn(c, F.coalesce("of", c)).drop("of")
        joined = connected_components(more)
        named = joined.select(F.col("node").alias("root"), F.col("root").alias("of"))
        alone = joined.join(root, "node", "left_anti")
        root = stage(root.join(named, "root", "left").select("node", F.coalesce("of", "root").alias("root"))
                     .unionByName(alone), "roots")
    # smallest id of each component
    rooted = classes.join(root, classes.fp == root.node).select("fp", "id", "root")
    top = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = rooted.join(top, "root").select("fp", "component_id")
    class_of = classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "id").alias("component_id"))
    out = members.join(class_of, "fp", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "id").alias("component_id"))
