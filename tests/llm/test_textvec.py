import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fairway.llm import bpe_transducer, jaccard_join, quality
from fairway.llm.textvec import RangeHash, Texts, gram_hashes


def thue_morse(n):
    """The sequence of length ``n`` over a/b and its complement: they have equal
    polynomial hashes modulo 2^64 from 1,024 letters on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096, 8192])
def test_structured_strings_do_not_collide(spark, make_docs, n):
    one, two = thue_morse(n)
    data = np.frombuffer((one + two).encode(), np.uint8)
    a, b = RangeHash(data)(np.array([0, n]), np.array([n, 2 * n]))
    assert a != b
    # as words (shingle sets of two documents), as lines and as pieces
    got = jaccard_join.near_duplicates(make_docs([(1, one), (2, two), (3, one)])).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}
    judged = quality.judge(make_docs([(1, f"{one}\n{two}"), (2, f"{one}\n{one}")])).collect()
    assert {r.doc_id: r.n_dup_lines for r in judged} == {1: 0, 2: 1}
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, fst = Tokenizer.from_file(path), bpe_transducer.Transducers(path)
    _, row, count, ids = fst.encode(Texts(pa.array([one, two])), True)
    first = int(count[row == 0].sum())
    assert [ids[:first].tolist(), ids[first:].tolist()] == [library.encode(x, add_special_tokens=False).ids for x in (one, two)]


def test_hashes_depend_on_the_bytes_alone():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    data[150_000:150_500] = data[700:1200]
    hashes = RangeHash(data)
    s = np.array([700, 150_000, 700, 701, 0, 5])
    e = np.array([1200, 150_500, 1199, 1200, 0, 5])
    h = hashes(s, e)
    assert h[0] == h[1] and len(set(h[[0, 2, 3, 4]].tolist())) == 4 and h[4] == h[5]
    assert RangeHash(data[700:1200])(np.array([0]), np.array([500]))[0] == h[0]
    grams = gram_hashes(data, 40)
    assert len(grams) == len(data) - 39 and grams[700] == grams[150_000] and len(gram_hashes(data[:39], 40)) == 0
