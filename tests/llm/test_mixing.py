import random
import re

import pytest

from fairway.llm import mixing


def targets(sizes):
    """Targets by source from the contract's rule."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    out, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            rest -= out[s]
            free.discard(s)
    return out


@pytest.mark.parametrize("shape", ["plain", "capped", "one", "nulls"])
def test_targets_and_taken(spark, make_docs, shape):
    rng = random.Random(shape)
    rows = []
    for i in range(400):
        source = {"plain": f"s{rng.randint(0, 6)}", "one": "only", "capped": rng.choice(["a", "b"] + ["z"] * 30),
                  "nulls": rng.choice([None, "null", "x", ""])}[shape]
        text = None if rng.random() < 0.02 else " ".join("w" for _ in range(rng.choice([0, 1, 5, 30, 200, 1000])))
        rows.append((i, text, None, source))
    got = mixing.mix_sources(make_docs(rows)).collect()
    assert sorted(r.doc_id for r in got) == list(range(400))
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, _ in rows}
    source = {r[0]: r[3] for r in rows}
    total = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    want = targets(total)
    taken = dict.fromkeys(total, 0)
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == total[s]
        assert r.target == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[s] += r.taken
    for s in total:
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], 5)
    again = mixing.mix_sources(make_docs(rows, parts=5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_rates_are_exponentially_tilted(spark):
    """The fitted rates meet the target and log rates are linear in size."""
    cells = spark.createDataFrame([("a", 10, 50), ("a", 100, 30), ("a", 400, 4)], "source string, size long, n long")
    total = 10 * 50 + 100 * 30 + 400 * 4
    wanted = spark.createDataFrame([("a", float(total), 1.5 * total)], "source string, total double, target double")
    r = mixing.balance(cells, wanted).first()
    from math import exp
    got = sum(n * s * min(3, exp(r.b * s / r.scale)) for s, n in ((10, 50), (100, 30), (400, 4)))
    assert got == pytest.approx(1.5 * total, rel=1e-6)


def test_cells_in_parts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "CELL", 7)
    rows = [(i, "w " * 10, None, "ab"[i % 2]) for i in range(200)]
    got = mixing.mix_sources(make_docs(rows)).collect()
    for s, want in targets({"a": 1000, "b": 1000}).items():
        assert abs(sum(r.taken for r in got if r.doc_id % 2 == (s == "b")) - want) <= 10


def test_copies_and_empty(spark, make_docs):
    docs = make_docs([(1, "a b", None, "x"), (1, "a b", None, "x"), (2, "c d", None, "y"), (None, "e", None, "y")])
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    plan = {s: sum(r.taken for r in mixing.mix_sources(docs).collect() if r.source_size == n) for s, n in (("x", 4), ("y", 3))}
    got = out.collect()
    assert {s: sum(len(r.text.split()) for r in got if r.source == s) for s in "xy"} == plan


def test_rows_without_an_id_are_taken_as_planned(spark, make_docs):
    rows = [(None, f"{i} " + "w " * (i % 7), None, "xyz"[i % 3]) for i in range(120)]
    docs = make_docs(rows, 3)
    plan = mixing.mix_sources(docs).collect()
    got = mixing.mixed_documents(docs).collect()
    words = lambda t: len(t.split())
    taken = {s: sum(words(r.text) for r in got if r.source == s) for s in "xyz"}
    want = targets({s: sum(words(t) for _, t, _, q in rows if q == s) for s in "xyz"})
    for s in "xyz":
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], 8)
    assert sum(r.taken for r in plan) == sum(taken.values()) and len(got) > 40
    again = mixing.mixed_documents(make_docs(rows, 5)).collect()
    assert sorted(r.text for r in again) == sorted(r.text for r in got)


def test_very_long_text(spark, make_docs):
    rows = [(1, "w " * 300_000, None, "x"), *((i, "w " * 100, None, "y") for i in range(2, 3002))]
    got = {r.doc_id: r for r in mixing.mix_sources(make_docs(rows)).collect()}
    assert got[1]["size"] == 300_000 and got[1].taken % 300_000 == 0
    assert sum(r.taken for r in got.values()) > 0


def test_empty(spark, make_docs):
    assert mixing.mix_sources(make_docs([])).count() == 0
    assert mixing.mix_sources(make_docs([(1, None, None, "x"), (2, "", None, None)])).count() == 2
