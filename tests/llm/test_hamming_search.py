import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairway.llm import hamming_search as hs


def brute(rows, k):
    codes = {}
    width = max((len(v) for _, v in rows if v is not None), default=0)
    for i, v in rows:
        if v is not None and i is not None:
            codes.setdefault(i, "".join("1" if x is not None and x > 0 else "0" for x in v).ljust(width, "0"))
    out = []
    for q in codes:
        if q % hs.QUERY_STEP == 0:
            near = sorted((sum(a != b for a, b in zip(codes[q], c)), i) for i, c in codes.items() if i != q)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("width,block", [(64, 1 << 20), (64, 100), (9, 50), (130, 1 << 20)])
def test_matches_brute_force(spark, monkeypatch, width, block):
    monkeypatch.setattr(hs, "BLOCK", block)
    rng = random.Random(width + block)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in rng.choice(centres)]) for i in range(600)]
    rows += [(i, [1.0] * width) for i in range(600, 700)]  # one very common code
    rows += [(700, None), (None, [1.0] * width), (720, [1.0]), (740, [None] * width), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumnRenamed("label", "code")
    got = sorted((r.query_id, r["rank"], r.neighbor_id, r.distance) for r in hs.search_table(df).collect())
    assert got == brute(rows, hs.K)


def test_stops_as_soon_as_the_kth_is_covered():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (5000, 64)).astype(np.uint8)
    near = bits[:50].copy()
    near[:, 0] ^= 1
    index = hs.MultiIndex(np.concatenate([bits, near]), np.ones(5050, int))
    q, c, d = index.search(bits[:50], 2)
    assert sorted(zip(q, c, d)) == sorted([(i, i, 0) for i in range(50)] + [(i, 5000 + i, 1) for i in range(50)])


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert hs.search_table(spark.createDataFrame([], schema)).count() == 0
    assert hs.search_table(spark.createDataFrame([(20, [1.0])], schema)).count() == 0
    assert hs.search_table(spark.createDataFrame([(20, [1.0]), (3, [-1.0])], schema)).count() == 1


def test_rows_sent_to_python_stay_small(spark, monkeypatch):
    frame, longest = type(spark.range(1)), []
    plain = frame.mapInArrow

    def noted(df, *args, **kwargs):
        longest.append(df.agg(F.max(F.length(F.to_json(F.struct(*df.columns))))).first()[0])
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", noted)
    sign = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (F.xxhash64("vec_id", i) % 2).cast("double"))
    vectors = spark.range(8000).withColumnRenamed("id", "vec_id").withColumn("embedding", sign)
    assert hs.search_table(vectors).count() == 400 * hs.K
    assert max(longest) < 100_000  # all codes in one row have 8000 * 64


@pytest.mark.parametrize("width,n,same", [(64, 3000, 0), (64, 3000, 20), (130, 2000, 0), (9, 300, 0), (500, 1000, 0)])
@pytest.mark.parametrize("probes,pending", [(1 << 14, 1 << 16), (7, 5)])
def test_blocks_with_weights_and_like_segments(monkeypatch, width, n, same, probes, pending):
    monkeypatch.setattr(hs, "PROBES", probes)
    monkeypatch.setattr(hs, "PENDING", pending)
    rng, k = np.random.default_rng(width + same), 5
    bits = rng.integers(0, 2, (n, width)).astype(np.uint8)
    bits[:, :same] = 0  # one bucket has all codes
    weight, first = rng.integers(1, 4, n), rng.permutation(n)
    asked = bits[:12].copy()
    asked[:, -3:] ^= 1
    apart = (asked[:, None] != bits).sum(axis=2)
    counts = np.zeros((len(asked), width + 1), np.int64)
    counts[6:, 2] = k  # these have found all they need within 2
    query, code, distance = hs.MultiIndex.of_packed(hs._packed(bits), width, weight, first).find(hs._packed(asked), k, counts)
    for i in range(len(asked)):
        order = np.lexsort((first, apart[i]))
        order = order[:np.searchsorted(weight[order].cumsum(), k) + 1]
        if i >= 6:
            order = order[apart[i, order] <= 2]
        got = code[query == i]
        assert got[:len(order)].tolist() == order.tolist()
        assert (distance[query == i] == apart[i, got]).all() and len(got) <= k
