import random
import re

import numpy as np
import pytest

from fairway.llm import jaccard_join
from fairway.llm.components import connected_components


def brute(rows):
    """component id and set size of every row, from all pairs."""
    sets = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and \
                    100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted(((doc, len(sets[i]), None if doc is None else least[find(i)]) for i, (doc, _) in enumerate(rows)),
                  key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(rng, words, share):
    return [rng.choice(["zip", "zap", f"w{rng.randint(0, 9999)}"]) if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    rows, passage = [], [f"p{i}" for i in range(30)]
    for group in range(12):
        base = [f"g{group}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 8, 40, 150, 700]))]
        for _ in range(rng.randint(1, 9)):
            words = edited(rng, base, rng.choice([0, 0, 0.005, 0.02, 0.05, 0.1]))
            if rng.random() < 0.4:
                words = passage + words
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block,common", [(1000, 8), (3, 2)])
def test_matches_all_pairs(spark, make_docs, monkeypatch, seed, block, common):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    rows = corpus(seed)
    assert got(jaccard_join.near_duplicates(make_docs(rows))) == brute(rows)


def test_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "é É"),
            (8, "é É"), (8, "é É"), (None, "one two"), (9, "a b c d e f"), (9, "x y z"),
            (10, " ".join(f"w{i}" for i in range(30_000))), (11, " ".join(f"w{i}" for i in range(28_000)))]
    docs = make_docs(rows).withColumnRenamed("lang", "fp").withColumnRenamed("source", "id")
    assert got(jaccard_join.near_duplicates(docs)) == brute(rows)


def test_empty_table(spark, make_docs):
    assert jaccard_join.near_duplicates(make_docs([])).count() == 0


def test_signatures_cover_every_linked_pair():
    """Any two sets at the threshold share enough of their first signatures."""
    rng = np.random.default_rng(3)
    for size in (4, 9, 40, 255, 256, 257, 1000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            drop = len(a) // 7
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, drop).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared < 75 * (len(a) + len(b) - shared):
                continue
            values, sizes = np.concatenate([a, b]), np.array([len(a), len(b)])
            row, sign, _ = jaccard_join.signatures(values, sizes, np.zeros(0, np.uint64))
            both = np.intersect1d(sign[row == 0], sign[row == 1])
            assert len(both) >= 3 * len(a) // 40 + 1


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 8), (3, 9), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20), (5, 5)]
    df = spark.createDataFrame(links, "a long, b long")
    assert sorted((r.node, r.root) for r in connected_components(df).collect()) == [
        (1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 1), (20, 20), (21, 20), (22, 20), (23, 20), (24, 20)]


def boilerplate(n, shared, own):
    """Texts that share a long passage and stay below the threshold."""
    rng = random.Random(n)
    passage = " ".join(f"p{i}" for i in range(shared))
    return [(i, passage + " " + " ".join(f"d{rng.randint(0, 10**9)}" for _ in range(own))) for i in range(n)]


def test_groups_of_a_large_meeting_are_bounded(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 15)
    groups, compared = [], jaccard_join._compared

    def seen(texts, firsts, places):
        groups.append(places.groupBy("x", "block").count().agg({"count": "max"}).first()[0])
        return compared(texts, firsts, places)

    monkeypatch.setattr(jaccard_join, "_compared", seen)
    rows = boilerplate(120, 80, 20)
    rows += [(200 + i, rows[i][1] + " end") for i in range(0, 60, 7)]
    assert got(jaccard_join.near_duplicates(make_docs(rows))) == brute(rows)
    assert len(groups) == 2 and max(groups) <= 4 * 15


@pytest.mark.parametrize("most,lists", [(1_000_000, True), (150, False)])
def test_places_are_sent_within_a_bound(spark, make_docs, monkeypatch, most, lists):
    """The bound is on all places together: 81 sets have more places than that."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 15)
    for name in ("BROADCAST_PLACES", "BROADCAST_IDS"):
        monkeypatch.setattr(jaccard_join, name, most, raising=False)
    sent, collect_list = [], jaccard_join.F.collect_list
    monkeypatch.setattr(jaccard_join.F, "collect_list", lambda c: sent.append(c) or collect_list(c))
    rounds, compared = [], jaccard_join._compared
    monkeypatch.setattr(jaccard_join, "_compared", lambda texts, firsts, places: rounds.append(places.count())
                        or compared(texts, firsts, places))
    rows = boilerplate(80, 80, 20) + [(200, boilerplate(80, 80, 20)[5][1] + " end")]
    rows.append(rows[-1])
    assert got(jaccard_join.near_duplicates(make_docs(rows))) == brute(rows)
    # how many places a round has depends on the hashes: lists go out just where they fit
    assert len(rounds) == 2 and len(sent) == sum(n <= most for n in rounds)
    assert lists == (len(sent) == 2) and max(rounds) > 150
