"""Ranked lexical search by a dual-tree traversal, exact.

Every item (query) gets its ``k`` best documents. Items and documents are sparse
vectors over the items' terms: an item's coordinate is a term's weight times its
repeats, a document's is the term's saturated frequency. Over each of both sides
stands a binary tree whose nodes hold the maximum of every coordinate below them,
so the product of two nodes' vectors bounds every score between them. From the
roots down, a pair of nodes goes on only if its bound reaches the weakest k-th
score of the node's items; otherwise its whole batch of pairs is done. Only what
is left at the leaves is scored, in whole numbers.

On Spark: items are taken in blocks of ``ITEM_BYTES`` (a stated query set; each
block's terms and vectors are broadcast, bounded by the block). For a block, one
pass over the documents writes their frequencies of the block's terms; document
counts of terms come from that table by partial aggregation. A ``SEEDS``-th of
the documents is searched first: its k-th scores are floors from which all other
tasks start, so a task sends on few candidates whatever its number. Tasks build
trees over blocks of at most ``DOC_ROWS`` documents or ``DOC_ENTRIES`` entries, one
at a time: nothing grows with a partition. The last step ranks the candidates.

Weights follow BM25 in 64-bit whole numbers: ``w = floor(1000 ln((2N+2)/(2df+1)))``
in doubles, document factor ``m = 25 + (75 n N) div L``, score the sum of
``w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's terms with repeats.

Defined cases: null and empty texts have no term: such documents are not
counted and such items have no rows; equal scores by ascending id, null ids
last; repeated rows are documents (items) of their own; an empty table gives
no rows; further columns are ignored. Terms are told apart by 62-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairway.llm.staging import ship, stage
from fairway.llm.textvec import LOWER, U64, HashIndex, RangeHash, Texts, mix, release_memory, slices

K = 10
ITEM_BYTES = 2 << 20
SEEDS = 32
DOC_ROWS = 2048
DOC_ENTRIES = 1 << 18
DOC_LEAF, ITEM_LEAF = 16, 4
EXPAND = 1 << 20      # products formed at once
AXES = 32             # of the projection by which trees put like vectors together

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every term occurrence."""
    low = LOWER[texts.data]
    s, e = texts.words(low, _TERM)
    return (RangeHash(low)(s, e) if len(s) else np.zeros(0, U64)), texts.row_of(s)


# ------------------------------------------------------------------- trees
def _levels(n: int, leaf: int) -> int:
    return max(0, math.ceil(math.log2(max(n, 1) / leaf)))


def _bounds(n: int, level: int) -> np.ndarray:
    """Borders of the nodes of a level; each level halves the one above."""
    return (np.arange((1 << level) + 1, dtype=np.int64) * n) >> level


def _project(owner: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Vectors on ``AXES`` axes by hashed signs, scaled to length 1."""
    h = mix(term.astype(U64) + U64(0x51ED27))
    axis, sign = (h >> U64(8)).astype(np.int64) % AXES, np.where(h & U64(1), 1.0, -1.0)
    out = np.bincount(owner * AXES + axis, weights=sign * value, minlength=n * AXES).reshape(n, AXES)
    return out / np.maximum(np.sqrt((out ** 2).sum(axis=1, keepdims=True)), 1e-300)


def tree_order(points: np.ndarray, levels: int) -> np.ndarray:
    """An order in which the nodes of each level hold points close together:
    every node is split at the median of its widest axis."""
    n = len(points)
    order = np.arange(n)
    for level in range(levels):
        border, inner = _bounds(n, level), _bounds(n, level + 1)
        for i in range(1 << level):
            a, mid, b = border[i], inner[2 * i + 1], border[i + 1]
            if b - a < 2:
                continue
            own = points[order[a:b]]
            axis = int(own.var(axis=0).argmax())
            order[a:b] = order[a:b][np.argsort(own[:, axis], kind="stable")]
    return order


def _maxima(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their largest value."""
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.maximum.reduceat(value, first) if len(first) else value


class ItemTree:
    """Items as rows (item, term, value), ``value`` a whole number, in a tree.
    Per level and term: the nodes that hold the term and their maxima."""

    def __init__(self, n_items: int, n_terms: int, item: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.n, self.n_terms = n_items, n_terms
        self.levels = _levels(n_items, ITEM_LEAF)
        self.order = tree_order(_project(item, term, value.astype(float), n_items), self.levels)
        place = np.empty(n_items, np.int64)
        place[self.order] = np.arange(n_items)
        # the largest sum a score can take decides whether doubles are exact
        self.heaviest = int(np.bincount(item, weights=value.astype(float), minlength=max(n_items, 1)).max(initial=0))
        self.by_term = [self._grouped(np.searchsorted(_bounds(n_items, level), place[item], "right") - 1, term, value)
                        for level in range(self.levels + 1)]
        self.exact = self._grouped(place[item], term, value)

    def _grouped(self, node, term, value):
        count = max(self.n, 1) + 1
        key, most = _maxima(term * count + node, value)
        return np.searchsorted(key // count, np.arange(self.n_terms + 1)), key % count, most

    def thresholds(self, level: int, weakest: np.ndarray) -> np.ndarray:
        """Weakest k-th score among each node's items (``weakest`` in tree order)."""
        return np.minimum.reduceat(weakest, _bounds(self.n, level)[:-1])


def _products(owner, term, value, grouped, keep=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Owner, its value, other node and its value for all entries that meet in
    a term, at most about ``EXPAND`` at once."""
    at, node, most = grouped
    size = at[term + 1] - at[term]
    part = (np.cumsum(size) - size) // EXPAND
    for a, b in zip(*(lambda c: ([0, *c], [*c, len(size)]))(np.flatnonzero(np.diff(part)) + 1)):
        s = size[a:b]
        where = np.arange(int(s.sum())) + np.repeat(at[term[a:b]] - (np.cumsum(s) - s), s)
        own, other = np.repeat(owner[a:b], s), node[where]
        if keep is not None:
            left = np.flatnonzero(keep(own, other))
            yield own[left], np.repeat(value[a:b], s)[left], other[left], most[where[left]]
        else:
            yield own, np.repeat(value[a:b], s), other, most[where]


class Search:
    """The k best documents of each item among the blocks given so far."""

    def __init__(self, tree: ItemTree, k: int, floors: np.ndarray):
        self.tree, self.k = tree, k
        self.floor = np.maximum(floors[tree.order], 1)   # a score must be above 0
        self.weakest = self.floor.copy()
        self.held = [np.zeros(0, np.int64)] * 4          # item place, score, no id, id
        self.scored = 0                                  # pairs whose score was formed

    def add(self, ids: np.ndarray, no_id: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """A block of documents; entries (document number, term, impact)."""
        tree, n = self.tree, len(ids)
        if not n or not tree.n or not len(doc):
            return
        levels = _levels(n, DOC_LEAF)
        order = tree_order(_project(doc, term, impact.astype(float), n), levels)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        entries = [None] * (levels + 1)
        key, value = place[doc] * tree.n_terms + term, impact
        for level in range(levels, -1, -1):
            node = np.searchsorted(_bounds(n, level), key // tree.n_terms, "right") - 1 if level == levels \
                else key // tree.n_terms >> 1
            key, value = _maxima(node * tree.n_terms + key % tree.n_terms, value)
            entries[level] = key // tree.n_terms, key % tree.n_terms, value
        alive, parent = np.ones((1, 1), bool), (0, 0)
        for step in range(max(levels, tree.levels) + 1):
            dl, il = min(step, levels), min(step, tree.levels)
            rows, cols = np.arange(1 << dl) >> (dl - parent[0]), np.arange(1 << il) >> (il - parent[1])
            alive = alive[rows[:, None], cols[None, :]]
            owner, terms, most = entries[dl]
            some = np.flatnonzero(alive.any(axis=1)[owner])
            bound = np.zeros(alive.size)
            for own, x, other, y in _products(owner[some], terms[some], most[some], tree.by_term[il]):
                bound += np.bincount((own << il) + other, weights=x.astype(float) * y, minlength=alive.size)
            alive &= bound.reshape(alive.shape) * (1 + 1e-9) >= tree.thresholds(il, self.weakest)[None, :]
            parent = dl, il
            if not alive.any():
                return
        self._score(ids, no_id, place[doc], order, term, impact, alive, levels)

    def _score(self, ids, no_id, at, order, term, impact, alive, levels) -> None:
        tree, n = self.tree, len(ids)
        d_leaf = np.searchsorted(_bounds(n, levels), np.arange(n), "right") - 1
        i_leaf = np.searchsorted(_bounds(tree.n, tree.levels), np.arange(tree.n), "right") - 1
        some = np.flatnonzero(alive.any(axis=1)[d_leaf[at]])
        some = some[np.argsort(at[some], kind="stable")]
        at, term, impact = at[some], term[some], impact[some]
        self.scored += int(alive.sum()) * DOC_LEAF * ITEM_LEAF
        safe = tree.heaviest * int(impact.max(initial=0)) < 1 << 53
        keys, sums = [], []
        for own, x, other, y in _products(at, term, impact, tree.exact, lambda o, i: alive[d_leaf[o], i_leaf[i]]):
            pair, inverse = np.unique(own * tree.n + other, return_inverse=True)
            if safe:
                total = np.bincount(inverse, weights=x * y.astype(float), minlength=len(pair)).astype(np.int64)
            else:
                total = np.zeros(len(pair), np.int64)
                np.add.at(total, inverse, x * y)
            keys.append(pair)
            sums.append(total)
        pair, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        score = np.zeros(len(pair), np.int64)
        np.add.at(score, inverse, np.concatenate(sums))   # a document may lie in two parts
        item, doc = pair % tree.n, order[pair // tree.n]
        good = score >= self.weakest[item]
        self._keep(item[good], score[good], no_id[doc[good]].astype(np.int64), ids[doc[good]])

    def _keep(self, *new: np.ndarray) -> None:
        item, score, none, doc = (np.concatenate(x) for x in zip(self.held, new))
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        first = np.searchsorted(item, np.arange(self.tree.n))
        best = np.arange(len(item)) - first[item] < self.k
        self.held = [item[best], *(x[order][best] for x in (score, none, doc))]
        counts = np.bincount(self.held[0], minlength=self.tree.n)
        full = np.flatnonzero(counts >= self.k)
        last = np.cumsum(counts)[full] - 1
        self.weakest[full] = np.maximum(self.floor[full], self.held[1][last])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Item number, document id, whether it is null, score."""
        item, score, none, doc = self.held
        return self.tree.order[item], doc, none.astype(bool), score


# ------------------------------------------------------------------- Spark
def _item_entries(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct term hashes, and (item, term number, repeats) of a block's items."""
    hashes, item = term_hashes(Texts(pa.array(texts, pa.string())))
    terms, number = np.unique(hashes, return_inverse=True)
    pairs, repeats = np.unique(item * max(len(terms), 1) + number, return_counts=True)
    return terms, pairs // max(len(terms), 1), pairs % max(len(terms), 1), repeats.astype(np.int64)


_cached: dict[str, object] = {}


def _once(path: str, make):
    """``make()`` of the newest broadcast of its kind, kept in a worker."""
    kind = path.rsplit("/", 1)[-1]
    if kind not in _cached:
        _cached.clear()
        _cached[kind] = make()
    return _cached[kind]


def frequencies(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``id``, ``n`` (all its terms) and the repeats ``tfs`` of the given
    ``terms`` in every document that has a term, as a written table."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]):
        def made():
            index = HashIndex(max(1 << 10, 1 << (len(sent.value) - 1).bit_length()))
            index.insert(sent.value)
            return index

        index = _once(sent._path, made)
        width = max(len(sent.value), 1)
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            hashes, row = term_hashes(texts)
            n = np.bincount(row, minlength=texts.rows)
            number = index.lookup(hashes).astype(np.int64)
            hit = number >= 0
            pairs, tf = np.unique(row[hit] * width + number[hit], return_counts=True)
            some = np.flatnonzero(n)
            at = np.searchsorted(pairs, np.append(some * width, texts.rows * width)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))) for x in (pairs % width, tf)]
            yield pa.record_batch([batch.column("id").take(pa.array(some)), pa.array(n[some].astype(np.int64)), *lists],
                                  names=["id", "n", "terms", "tfs"])
        release_memory()

    rows = docs.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")
    return stage(rows, "frequencies")


def term_weights(held: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and each given term's weight."""
    total = held.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    got = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toPandas()
    df = np.zeros(n_terms, np.int64)
    df[got["term"].to_numpy()] = got["df"].to_numpy()
    count = int(total["docs"])
    w = [math.floor(1000 * math.log((2 * count + 2) / (2 * int(d) + 1))) for d in df]
    return count, int(total["terms"] or 0), np.array(w, np.int64)


def _searched(held: DataFrame, model, counts: tuple[int, int], k: int, floors: np.ndarray) -> DataFrame:
    """``item`` (its number), ``doc``, ``score``: the best documents of each task."""
    sent = held.sparkSession.sparkContext.broadcast(floors)
    n_docs, n_terms = counts

    def run(batches: Iterator[pa.RecordBatch]):
        tree = _once(model._path, lambda: ItemTree(*model.value))
        search = Search(tree, k, sent.value)
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            part = np.maximum(np.arange(len(sizes)) // DOC_ROWS, (np.cumsum(sizes) - sizes) // DOC_ENTRIES)
            cuts = np.flatnonzero(np.diff(part)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(sizes)]):
                rows = batch.slice(int(a), int(b - a))
                no_id = rows.column("id").is_null().to_numpy(zero_copy_only=False)
                ids = rows.column("id").fill_null(0).to_numpy()
                doc = np.repeat(np.arange(rows.num_rows), sizes[a:b])
                tf = rows.column("tfs").flatten().to_numpy().astype(np.int64)
                m = 100 - 75 + (75 * rows.column("n").to_numpy() * n_docs) // n_terms
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
                search.add(ids, no_id, doc, rows.column("terms").flatten().to_numpy().astype(np.int64), impact)
        item, doc, none, score = search.result()
        yield pa.record_batch([pa.array(item), pa.array(doc, mask=none), pa.array(score)], names=["item", "doc", "score"])
        release_memory()

    return held.mapInArrow(run, "item long, doc long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, texts: list[str | None], k: int = K) -> DataFrame:
    """``item`` (place in ``texts``), ``rank``, ``doc`` and ``score`` of the best
    rows of ``docs`` (id, text) for one block of items."""
    terms, item, term, repeats = _item_entries(texts)
    held = frequencies(docs, terms)
    n_docs, n_terms, w = term_weights(held, len(terms))
    used = w[term] > 0
    model = docs.sparkSession.sparkContext.broadcast(
        (len(texts), max(len(terms), 1), item[used], term[used], (repeats * w[term])[used]))
    # k-th scores among a part of the documents are floors for all of them
    seeds = held.where(F.pmod(F.xxhash64("id", "n"), F.lit(SEEDS)) == 0)
    floors = np.zeros(len(texts), np.int64)
    for r in _ranked(_searched(seeds, model, (n_docs, n_terms), k, floors), k).where(F.col("rank") == k).collect():
        floors[r["item"]] = r["score"]
    return _ranked(_searched(held, model, (n_docs, n_terms), k, floors), k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_col``, rank, ``id_col`` (a long) and score: the ``k`` best rows of
    ``docs`` for each row of ``items`` with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = items.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item_id"),
                                                                F.col(item_text_col).alias("text"))
    kind = asked.schema["item_id"].dataType.simpleString()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    found = None
    for block in range(blocks):
        # a block of the stated query set: about ITEM_BYTES of its texts
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item long, item_id {kind}")
        part = search_block(rows, [r["text"] for r in own], k).join(F.broadcast(names), "item")
        part = part.select(F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
        found = part if found is None else found.unionByName(part)
    return found
