import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fairway.llm import toxicity
from fairway.llm.textvec import Texts

SYLLABLES = ["tion", "the", "ing", "wh", "sh", "er", "on", "é", "漢", "an", "in", "re"]
INSULTS = ["grumbox", "flarnwit", "snedgehead"]


def prose(rng, n, insults=0):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for _ in range(insults):
        words.insert(rng.randint(0, len(words)), rng.choice(INSULTS))
    return " ".join(words)


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture()
def labelled(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, make_docs, labelled):
    rng = random.Random(5)
    toxic = {i: int(rng.random() < 0.3) for i in range(500)}
    rows = [(i, prose(rng, rng.randint(5, 120), 2 * t)) for i, t in toxic.items()]
    odd = [(1000, None), (1001, ""), (1002, prose(rng, 20_000)), (1003, prose(rng, 20_000, 3)), (None, "grumbox"),
           (1004, "a Grumbox!"), (1004, "a Grumbox!")]
    # labels without id or value, and a second label of an id, do no harm
    labels = labelled([(i, 1, t) for i, t in toxic.items()] + [(None, 1, 1), (7, 1, None), (8, 0, 0)])
    docs = make_docs(rows + odd).withColumnRenamed("lang", "score").withColumnRenamed("source", "label")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and held_out(r.doc_id))
    by_id = {r.doc_id: r.predicted for r in got}
    held = [(by_id[i], t) for i, t in toxic.items() if held_out(i)]
    assert len(held) > 60 and np.mean([a == b for a, b in held]) >= 0.98
    assert [by_id[i] for i in (1000, 1001, 1002, 1003, 1004, None)] == [0, 0, 0, 1, 1, 1]


def test_held_out_labels_are_not_read(spark, make_docs, labelled):
    rng = random.Random(6)
    toxic = {i: i % 2 for i in range(120)}
    docs = make_docs([(i, prose(rng, 30, t)) for i, t in toxic.items()])
    one, two = (sorted(map(tuple, toxicity.score_toxicity(docs, labelled(
        [(i, 1, 1 - t if swap and held_out(i) else t) for i, t in toxic.items()])).collect())) for swap in (False, True))
    assert one == two


def test_little_or_nothing_to_learn(spark, make_docs, labelled):
    docs = make_docs([(1, "a"), (2, None)])
    assert [r.score for r in toxicity.score_toxicity(docs, labelled([])).collect()] == [0, 0]
    assert {round(r.score, 6) for r in toxicity.score_toxicity(docs, labelled([(3, 1, 1), (4, 1, 1)])).collect()} == {1}
    few = toxicity.score_toxicity(docs, labelled([(1, 1, 1), (2, 1, 0), (3, 1, 0), (4, 1, 0)])).collect()
    assert all(0 < r.score < 1 for r in few)
    assert toxicity.score_toxicity(make_docs([]), labelled([(1, 1, 1), (3, 1, 0)])).count() == 0


def test_features_are_the_distinct_grams_of_each_text():
    texts = ["Abc, x", "", None, "漢字漢字漢字", "a" * 50]
    row, bucket = toxicity.features(Texts(pa.array(texts)))
    counts = np.bincount(row, minlength=len(texts))

    def grams(t):
        t = " " + "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in t or "") + " "
        return {t[i:i + n] for n in toxicity.SIZES for i in range(len(t) - n + 1)}

    assert counts.tolist() == [len(grams(t)) for t in texts]
    alone = [set(toxicity.features(Texts(pa.array([t], pa.string())))[1].tolist()) for t in texts]
    assert [set(bucket[row == i].tolist()) for i in range(len(texts))] == alone


def test_minimise_finds_the_bottom():
    a = np.diag([1.0, 10.0, 100.0])
    x = toxicity.minimise(lambda v: (float(v @ a @ v) / 2 + 1 - v[0], a @ v - np.array([1.0, 0, 0])), np.ones(3), 100)
    assert np.allclose(x, [1, 0, 0], atol=0.02)
