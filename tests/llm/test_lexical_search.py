import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fairway.llm import lexical_search

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    held = [(i, t) for i, t in ((i, terms(x)) for i, x in docs) if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = Counter(term for _, t in held for term in set(t))
    out = []
    for item, text in items:
        scores = []
        for doc, t in held:
            tf, m = Counter(t), 25 + (75 * len(t) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (
                (10 ** 9 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in terms(text) if tf[x])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, rank + 1, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Été", "漢字", "x1", "DON'T", "a_b"]
    return [(i, " ".join(rng.choices(words, weights=[1 / (1 + j) for j in range(len(words))], k=rng.randint(1, 40))))
            for i in range(n)]


@pytest.mark.parametrize("rows,leaf,seeds,item_bytes", [(2048, 16, 32, 1 << 20), (16, 2, 2, 1 << 20), (8, 1, 1, 400)])
def test_equals_brute_force(spark, make_docs, monkeypatch, rows, leaf, seeds, item_bytes):
    for name, value in (("DOC_ROWS", rows), ("DOC_LEAF", leaf), ("SEEDS", seeds), ("ITEM_BYTES", item_bytes),
                        ("EXPAND", 50), ("ITEM_LEAF", 2)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(rows)
    docs = [*corpus(rng, 150), (200, None), (201, ""), (202, " -- "), (None, "w0 w1 漢字"), (5, "w3 w3 漢字"), (5, "w3 w3 漢字"),
            (203, "w1 " * 20_000), *((300 + i, "same words w7 w8") for i in range(30))]
    items = [*corpus(rng, 25), (100, None), (101, ""), (102, "unknown"), (103, "same words"), (104, "same words"), (105, "w0 w0 W0")]
    table = make_docs(items).select("doc_id", "text").toDF("item_id", "text")
    got = lexical_search.search(make_docs(docs, 3).withColumnRenamed("lang", "score"), table).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)


def test_empty_tables(spark, make_docs):
    docs, none = make_docs([(1, "a b")]), make_docs([])
    items = docs.select("doc_id", "text").toDF("item_id", "text")
    assert lexical_search.search(none, items).count() == 0
    got = lexical_search.search(docs, items.limit(0))
    assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_batches_are_pruned():
    """Documents of other topics are done in whole batches, never scored."""
    rng = np.random.default_rng(1)
    items, docs, topics, width = 64, 20_000, 64, 40
    item = np.repeat(np.arange(items), 10)
    term = item % topics * width + rng.integers(0, width, len(item))
    key, most = lexical_search._maxima(term * items + item, np.full(len(item), 5000))
    tree = lexical_search.ItemTree(items, topics * width, key % items, key // items, most)
    search = lexical_search.Search(tree, 10, np.zeros(items, np.int64))
    for a in range(0, docs, 2000):
        doc = np.repeat(np.arange(2000), 15)
        own = rng.integers(0, topics, 2000)[doc] * width + rng.integers(0, width, len(doc))
        pair = np.unique(doc * 10_000 + own)
        search.add(np.arange(a, a + 2000), np.zeros(2000, bool), pair // 10_000, pair % 10_000,
                   rng.integers(1, 1_000_000, len(pair)))
    assert search.scored < items * docs / 3
    assert (np.bincount(search.result()[0], minlength=items) == 10).all()


def test_very_heavy_items_stay_exact():
    tree = lexical_search.ItemTree(2, 1, np.array([0, 1]), np.array([0, 0]), np.array([1 << 40, 3]))
    search = lexical_search.Search(tree, 1, np.zeros(2, np.int64))
    search.add(np.array([7, 8]), np.zeros(2, bool), np.array([0, 1]), np.array([0, 0]), np.array([999_999, 1_000_001]))
    got = sorted(zip(*(x.tolist() for x in search.result())))
    assert got == [(0, 8, False, (1 << 40) * 1_000_001), (1, 8, False, 3_000_003)]
