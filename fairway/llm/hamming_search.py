"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into ``m`` segments of about ``log2(codes)`` bits, with one table
for each segment (Norouzi, Punjani and Fleet 2012). Codes within distance
``m * r + j`` of a query agree with it to within ``r`` in one of the first
``j + 1`` segments or to within ``r - 1`` in one of the others. So the search
probes segment after segment at radius 0, then at radius 1 and so on, verifies
the full distance of what it finds, and stops a query when its k-th verified
distance is covered. The result is exact; nothing is approximated.

Equal codes are searched once: each distinct code carries its ``k + 1``
smallest ids, which is all that any query can use. The query set is cut into
chunks. The task of a chunk holds its queries and what is nearest to them so
far; the codes, one bit for each component, stream past it in packs of
``PACK_BYTES`` and are searched in blocks of at most ``BLOCK`` codes, each with its
own tables. What a block finds bounds the search of the next. So a task's memory
depends on ``BLOCK`` and on its queries, and not on the number of codes.

Defined cases: a null vector has no code, is no query and no neighbour; a null
component counts as not positive; shorter vectors are padded with zero bits; a
row is never its own neighbour, rows that repeat an id count once; ties go to
the smaller id; fewer than ``k`` other rows give fewer neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairway.llm.staging import parts, ship, stage

K = 10
QUERY_STEP = 20
BLOCK = 1 << 20
INDEX_BYTES = 1 << 27    # of a block's tables, about: blocks of wide codes are smaller
CHUNK = (128, 1 << 15)   # queries of one task, at least and at most
COPIES = 32              # tasks that all codes are sent to, unless a chunk would pass its bound
MOST_SEGMENT = 16
ROW = 8                  # codes of one bucket that are fetched together (8 flags are looked at as one word)
PROBES = 1 << 14         # rows compared at once
PENDING = 1 << 16        # near codes held until they are counted
PACK_BYTES = 1 << 14


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, code): one character, 0 or 1, for each component's sign."""
    code = F.array_join(F.transform(vector_col, lambda x: F.when(x > 0, "1").otherwise("0")), "")
    rows = vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull())
    return rows.select(F.col(id_col).cast("long").alias("id"), code.alias("code")).distinct()


@lru_cache(maxsize=64)
def _flips(bits: int, weight: int) -> np.ndarray:
    """All numbers of ``bits`` bits with ``weight`` ones."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), weight)], dtype=np.int32)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as bytes, in whole words of 64 bits."""
    return np.packbits(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64))), axis=1)


def _codes(text: pa.Array, width: int) -> np.ndarray:
    """Packed codes of strings of 0 and 1, shorter ones padded with zero bits."""
    whole = "".join(pc.utf8_rpad(text, width, "0").to_pylist()).encode()
    return _packed((np.frombuffer(whole, np.uint8) - 48).reshape(len(text), width))


def _first(query: np.ndarray, k: int, *order: np.ndarray) -> np.ndarray:
    """Places of the first ``k`` entries of each query in the given order."""
    at = np.lexsort((*order[::-1], query))
    query = query[at]
    return at[np.arange(len(at)) - np.searchsorted(query, query) < k]


class MultiIndex:
    """Tables of one block. ``weight`` is how many ids a code stands for,
    ``first`` the smallest of them (by default the code's place)."""

    def __init__(self, bits: np.ndarray, weight: np.ndarray):
        self._build(_packed(bits), bits.shape[1], weight, np.arange(len(bits)))

    @classmethod
    def of_packed(cls, codes: np.ndarray, width: int, weight: np.ndarray, first: np.ndarray) -> MultiIndex:
        index = cls.__new__(cls)
        index._build(codes, width, weight, first)
        return index

    def _build(self, codes, width, weight, first):
        self.codes, self.width, self.weight, self.first = codes, width, weight, first
        s = int(np.clip(round(np.log2(max(len(codes) / ROW, 2))), 1, min(MOST_SEGMENT, width)))
        self.m = -(-width // s)
        edges = np.linspace(0, width, self.m + 1).astype(int)
        self.spans = [(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]
        self.words = codes.view(np.uint64)
        self.tables = [self._table(j) for j in range(self.m)]

    def _table(self, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First row of each bucket, the rows' codes and the codes' places; the
        last row of a bucket is filled up with places of -1."""
        segment = self._segment(self.codes, j)
        order = np.argsort(segment.astype(np.uint16), kind="stable").astype(np.int32)
        a, b = self.spans[j]
        n = np.bincount(segment, minlength=1 << (b - a))
        starts = np.zeros(len(n) + 1, np.int32)
        np.cumsum(-(-n // ROW), out=starts[1:])
        at = np.arange(len(order)) + (starts[:-1] * ROW - (np.cumsum(n) - n))[segment[order]]
        words = np.zeros((starts[-1] * ROW, self.words.shape[1]), np.uint64)
        words[at] = self.words[order]
        place = np.full(starts[-1] * ROW, -1, np.int32)
        place[at] = order
        return starts, words.reshape(-1, ROW * words.shape[1]), place

    def _segment(self, codes: np.ndarray, j: int) -> np.ndarray:
        a, b = self.spans[j]
        value = np.zeros(len(codes), np.int32)
        for i in range(a // 8, a // 8 + 3):  # 16 bits from within a byte on
            value = (value << 8) | (codes[:, i] if i < codes.shape[1] else 0)
        return (value >> (24 - a % 8 - (b - a))) & ((1 << (b - a)) - 1)

    def search(self, bits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of the ``k`` nearest codes of each query, ties to
        the smaller ``first``; codes beyond those that stand for ``k`` ids may be left out."""
        return self.find(_packed(bits), k, np.zeros((len(bits), self.width + 1), np.int64))

    def find(self, codes: np.ndarray, k: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``search``, of packed queries; ``counts`` has how many ids at each distance
        each query has found elsewhere, and codes that are not among all its first ``k``
        may be left out. Adds what is found to ``counts``."""
        radius = np.full(len(codes), self.width, np.int32)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))]
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def bound(query: np.ndarray) -> None:
            """Distance of the k-th id found so far."""
            radius[query] = np.minimum((counts[query].cumsum(axis=1) < k).sum(axis=1), self.width)

        def count(r: int, j: int) -> None:
            if not pending:
                return
            query, code, distance = (np.concatenate(x) for x in zip(*pending))
            pending.clear()
            ok = distance <= radius[query]
            query, code, distance = query[ok], code[ok], distance[ok]
            # a code is taken at the first segment and radius that finds it
            apart = codes[query] ^ self.codes[code]
            ok = np.ones(len(query), dtype=bool)
            for i in range(self.m):
                if i != j:
                    ok &= np.bitwise_count(self._segment(apart, i)) >= (r + 1 if i < j else r)
            query, code, distance = query[ok], code[ok], distance[ok]
            np.add.at(counts, (query, distance), self.weight[code])
            bound(np.unique(query))
            found.append((query, code, distance))
            if sum(len(x[0]) for x in found) > max(PENDING, 4 * k * len(codes)):
                found[:] = [self._nearest(found, k)]

        words = codes.view(np.uint64)
        bound(np.arange(len(codes)))
        active, step = np.arange(len(codes)), 0
        while len(active):
            r, j = divmod(step, self.m)
            bits = self.spans[j][1] - self.spans[j][0]
            if r <= bits:
                # where a radius needs half of all buckets, all codes not found yet are compared
                everything = 2 * self.m * comb(bits, r) >= 1 << bits
                near = self._scanned(words, active, radius) if everything else self._probed(
                    words, active, self._segment(codes, j), radius, _flips(bits, r), j)
                n = 0
                for got in near:
                    pending.append(got)
                    n += len(got[0])
                    if n > PENDING:
                        count(r, -1 if everything else j)
                        n = 0
                count(r, -1 if everything else j)
                if everything:
                    break
            # everything up to distance ``step`` has been found
            active = active[radius[active] > step]
            step += 1
        return self._nearest(found, k)

    def _nearest(self, found: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        query, code, distance = (np.concatenate(x) for x in zip(*found))
        keep = _first(query, k, distance, self.first[code])
        return query[keep], code[keep], distance[keep]

    def _probed(self, words, active, segment, radius, flips, j) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, code) within the radius in the buckets that the flips lead to."""
        starts, held, place = self.tables[j]
        size = max(1, PROBES // len(flips))
        active = active[np.argsort(segment[active])]  # like buckets one after the other
        for part in (active[i:i + size] for i in range(0, len(active), size)):
            for some in (flips[i:i + PROBES] for i in range(0, len(flips), PROBES)):
                value = (segment[part, None] ^ some).ravel()
                first = starts.take(value)
                n = starts.take(value + 1) - first
                ends = np.cumsum(n, dtype=np.int64)
                first = first - (ends - n)
                last = ends[len(some) - 1::len(some)]  # of each query
                for low in range(0, int(ends[-1]), PROBES):
                    high = min(low + PROBES, int(ends[-1]))
                    a, b = ends.searchsorted(low, "right"), ends.searchsorted(high) + 1
                    here = n[a:b].copy()
                    here[0] = ends[a] - low
                    here[-1] -= ends[b - 1] - high
                    row = np.repeat(first[a:b], here) + np.arange(low, high)
                    at, query, distance = self._near(held.take(row, axis=0), words, part, last - low, radius)
                    if len(at):
                        code = place[row[at // ROW] * ROW + at % ROW]
                        real = code >= 0
                        yield query[real], code[real], distance[real]

    def _near(self, rows, words, part, last, radius) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, query, distance) of the codes of ``rows`` within the radius. The rows
        up to ``last`` are those of each query of ``part``; ``rows`` is overwritten."""
        a, b = last.searchsorted(0, "right"), min(last.searchsorted(len(rows)) + 1, len(last))
        part, last = part[a:b], np.minimum(last[a:b], len(rows))
        width = words.shape[1]
        if len(part) * 32 > len(rows):
            rows ^= np.tile(np.repeat(words[part], np.diff(last, prepend=0), axis=0), ROW)
        else:
            low = 0
            for query, high in zip(part, last):
                rows[low:high] ^= words[query, 0] if width == 1 else np.tile(words[query], ROW)
                low = high
        apart = np.bitwise_count(rows)
        if width > 1:
            apart = apart.reshape(len(rows), ROW, width).sum(axis=2, dtype=np.int32)
        near = apart <= radius[part].max()
        at = np.flatnonzero(near.view(np.uint64))  # rows with one
        row, place = near[at].nonzero()
        row = at[row]
        query = part[last.searchsorted(row, "right")]
        distance = apart[row, place].astype(np.int64)
        at = row * ROW + place
        keep = distance <= radius[query]
        return at[keep], query[keep], distance[keep]

    def _scanned(self, words, active, radius) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, code) within the radius among all codes."""
        step = PROBES * ROW
        for query in active:
            for low in range(0, len(self.words), step):
                distance = np.bitwise_count(self.words[low:low + step] ^ words[query]).sum(axis=1, dtype=np.int64)
                at = np.flatnonzero(distance <= radius[query])
                yield np.full(len(at), query), low + at, distance[at]


def _packs(held: DataFrame, width: int) -> DataFrame:
    """``held`` (code, ids) as rows of about ``PACK_BYTES``: packed codes, their ids, how many ids each has."""
    most = PACK_BYTES

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _codes(batch.column("code"), width)
            ids = batch.column("ids")
            n = np.diff(ids.offsets.to_numpy()).astype(np.int32)
            values = ids.flatten().to_numpy().astype(np.int64)
            ends = np.cumsum(n)
            number = (codes.shape[1] + 4) * np.arange(1, len(n) + 1) + 8 * ends
            cuts = np.flatnonzero(np.diff(number // most, prepend=0, append=-1)).tolist()
            edges = sorted({0, len(n), *cuts})
            rows = [(codes[a:b].tobytes(), values[ends[a] - n[a]:ends[b - 1]].tobytes(), n[a:b].tobytes())
                    for a, b in zip(edges[:-1], edges[1:])]
            yield pa.record_batch([pa.array(x, pa.binary()) for x in zip(*rows)], names=["codes", "ids", "numbers"])

    return held.select("code", "ids").where("code IS NOT NULL").mapInArrow(run, "codes binary, ids binary, numbers binary")


def _searched(sent: DataFrame, width: int, k: int) -> DataFrame:
    """Of partitions of one chunk, its queries first and all packs after them: each
    query's code with the ids and distances of its ``k`` nearest."""
    words = -(-width // 64)
    block = min(BLOCK, max(1 << 12, INDEX_BYTES // (-(-width // MOST_SEGMENT) * (8 * words + 4) + 8 * words)))
    step = max(64, min(4096, (1 << 18) // width))

    def run(batches: Iterator[pa.RecordBatch]):
        texts: list[pa.Array] = []
        asked = None
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        packs: list[tuple[bytes, bytes, bytes]] = []
        size = 0

        def search() -> None:
            codes = np.frombuffer(b"".join(p[0] for p in packs), np.uint8).reshape(-1, asked.shape[1])
            ids = np.frombuffer(b"".join(p[1] for p in packs), np.int64)
            n = np.frombuffer(b"".join(p[2] for p in packs), np.int32)
            packs.clear()
            starts = np.cumsum(n) - n
            index = MultiIndex.of_packed(codes, width, n, ids[starts])
            for i, a in enumerate(range(0, len(asked), step)):
                query, distance, neighbor = best[i]
                some = asked[a:a + step]
                counts = np.zeros((len(some), width + 1), np.int64)
                np.add.at(counts, (query, distance), 1)
                q, c, d = index.find(some, k, counts)
                each = n[c]
                at = np.repeat(starts[c] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                query = np.concatenate([query, np.repeat(q, each)])
                distance = np.concatenate([distance, np.repeat(d, each)])
                neighbor = np.concatenate([neighbor, ids[at]])
                keep = _first(query, k, distance, neighbor)
                best[i] = query[keep], distance[keep], neighbor[keep]

        for batch in batches:
            queries = batch.column("query").drop_null()
            if len(queries):
                texts.append(queries)
            if len(queries) == len(batch) or not texts:
                continue
            if asked is None:
                asked = np.concatenate([_codes(x, width) for x in texts])
                best += [(np.zeros(0, np.int64),) * 3] * -(-len(asked) // step)
            for pack in zip(*[batch.column(c).drop_null().to_pylist() for c in ("codes", "ids", "numbers")]):
                packs.append(pack)
                size += len(pack[2]) // 4
                if size >= block:
                    search()
                    size = 0
        if packs:
            search()
        text = pa.concat_arrays(texts) if texts else pa.array([], pa.string())
        for i, (query, distance, neighbor) in enumerate(best):
            some = text.slice(i * step, step)
            offsets = pa.array(np.searchsorted(query, np.arange(len(some) + 1)).astype(np.int32))
            yield pa.record_batch([some, pa.ListArray.from_arrays(offsets, pa.array(neighbor)),
                                   pa.ListArray.from_arrays(offsets, pa.array(distance))],
                                  names=["code", "neighbor_id", "distance"])

    return sent.select("query", "codes", "ids", "numbers").mapInArrow(
        run, "code string, neighbor_id array<long>, distance array<long>")


def nearest(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``codes`` and ``queries`` are (id, code); returns query_id, rank,
    neighbor_id and distance of the ``k`` nearest other ids of each query."""
    spark = codes.sparkSession
    ship(spark)
    order = Window.partitionBy("code").orderBy("id")
    held = stage(codes.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).groupBy("code").agg(
        F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = stage(queries.select("id", "code"), "queries")
    size = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("code")).alias("width")).first()
    wanted = asked.select("code").distinct()
    n_queries = wanted.count()
    if not size["n"] or not n_queries:
        return asked.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("neighbor_id"),
                            F.lit(0).cast("long").alias("distance")).where("false")
    width = max(int(size["width"]), 1)
    chunks = max(min(-(-n_queries // CHUNK[0]), 2 * parts(spark), COPIES), -(-n_queries // CHUNK[1]))
    # one task for each chunk: its queries, then every pack
    packs = _packs(held, width).select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                                       F.lit(None).cast("string").alias("query"), "codes", "ids", "numbers")
    chunk = F.pmod(F.xxhash64("code"), F.lit(chunks)).cast("int").alias("chunk")
    sent = wanted.select(chunk, F.col("code").alias("query"), *[F.lit(None).cast("binary").alias(c)
                                                               for c in ("codes", "ids", "numbers")]).unionByName(packs)
    sent = sent.repartitionById(chunks, F.col("chunk")).sortWithinPartitions(F.col("query").isNull())
    found = stage(_searched(sent, width, k + 1), "nearest")
    rank = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    pairs = asked.withColumnRenamed("id", "query_id").join(found, "code").select(
        "query_id", F.inline(F.arrays_zip("neighbor_id", "distance")))
    return pairs.where("query_id <> neighbor_id").withColumn(
        "rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")


def search_table(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """Sign codes of every row; every row whose id is divisible by ``QUERY_STEP`` is a query."""
    codes = stage(sign_codes(vectors, id_col, vector_col), "sign-codes")
    return nearest(codes, codes.where(F.col("id") % QUERY_STEP == 0), k)
