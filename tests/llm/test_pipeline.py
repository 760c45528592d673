import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from fairway.llm import mixing, quality, secrets
from tests.llm.test_jaccard_join import brute


def corpus():
    rng = random.Random(21)
    words = [a + b for a in ("ba", "cor", "den", "fil", "gam") for b in ("ter", "low", "ning", "est", "us", "al")]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randint(0, 9)) + ("." if i % 8 == 7 else "") for i in range(n))

    rows = [(i, prose(rng.randint(60, 250)), "xa", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " one more", "xa", "s1") for i in range(8)]          # near copies
    rows += [(200 + i, " ".join(w + "###" for w in prose(90).split()), "xb", "s2") for i in range(6)]
    rows += [(300 + i, prose(80) + f' token = "{rng.getrandbits(160):040x}" end', "xa", None) for i in range(5)]
    rows += [(400, None, None, None), (401, "", "xa", "s0"), (402, "short", "xa", "s0"), (3, rows[3][1], "xa", "s3"),
             (None, prose(100), None, "s0")]
    return rows


@pytest.fixture(scope="module")
def steps(spark, make_docs, tmp_path_factory):
    """Every stage's rows, each written and read again."""
    docs, out = make_docs(corpus()), []
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        function(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)


def test_quality_stage(spark, make_docs, steps):
    kept = {r.doc_id for r in quality.judge(make_docs(corpus())).where("kept").collect()}
    want = sorted(((i, t, s) for i, t, _, s in corpus() if i in kept), key=str)
    assert rows_of(steps[0]) == want
    assert not kept & {*range(200, 206), 400, 401, 402} and kept >= set(range(60))


def test_one_of_each_group_stays(steps):
    rows = [(i, t) for i, t, _ in rows_of(steps[0])]
    # a row without an id is a document of its own, with the largest key
    keys = {i if i is not None else 10**6 + n: (i, t) for n, (i, t) in enumerate(rows)}
    roots = {c for i, _, c in brute([(k, t) for k, (_, t) in keys.items()]) if i == c}
    assert [(i, t) for i, t, _ in rows_of(steps[1])] == sorted((keys[k] for k in roots), key=str)
    assert not any(i is not None and 100 <= i < 108 for i, _, _ in rows_of(steps[1]))


def test_secrets_are_gone(spark, steps):
    before, after = rows_of(steps[1]), rows_of(steps[2])
    assert [r[0] for r in before] == [r[0] for r in after]
    assert secrets.secret_digest(steps[2]).where("n_assign + n_hex + n_access > 0").count() == 0
    assert [a for a, b in zip(after, before) if a[1] != b[1]] and all("<secret>" in a[1] for a, b in zip(after, before)
                                                                      if a[1] != b[1])


def test_mix_takes_the_planned_copies(spark, steps):
    plan = [(r.doc_id, r.taken // r["size"]) for r in mixing.mix_sources(steps[2]).collect() if r["size"]]
    got = [r[0] for r in rows_of(steps[3])]
    assert sorted(got, key=str) == sorted((i for i, n in plan for _ in range(n)), key=str)


def test_packed_ids_are_the_documents(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(zlib.crc32(np.array([*library.encode(r.text, add_special_tokens=False).ids, 1], np.uint32).tobytes())
                  for r in steps[3].collect())
    pieces = steps[4].collect()
    assert sum(r.length for r in pieces) == sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1
                                                for r in steps[3].collect())
    whole = [r.ids_crc32 for r in pieces if r.length == r.doc_tokens]
    assert len(whole) >= len(want) // 2 and set(whole) <= set(want)


def test_columns_and_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "target_mix",
                                                      "packing"]
    for df in steps[:-1]:
        assert df.columns == corpus_pipeline.COLUMNS
    assert "pipeline" in entry.queries() and {f"op{n}_" for n in range(1, 14)} == {
        q[:q.index("_") + 1] for q in entry.queries() if q.startswith("op")}


def test_rows_that_share_an_id_are_documents_of_their_own(spark, make_docs):
    rng = random.Random(4)
    a, b, c = (" ".join(f"{x}{rng.randint(0, 10**6)}" for _ in range(60)) for x in "abc")
    rows = [(1, a, "xa", "s0"), (3, a + " more", "xa", "s0"), (3, b, "xa", "s0"), (3, c, "xa", "s1"), (3, c, "xa", "s1"),
            (5, b + " more", "xa", "s1"), (None, a, "xa", "s1")]
    docs = make_docs(rows)
    left = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert rows_of(left) == sorted([(1, a, "s0"), (3, b, "s0"), (3, c, "s1")], key=str)
    many = [(7, f"{i} " + "w " * 9, "xa", "only") for i in range(40)]
    taken = corpus_pipeline.target_mix(spark, make_docs(many), "").collect()
    assert sorted(r.text for r in taken) == sorted(t for _, t, _, _ in many)
