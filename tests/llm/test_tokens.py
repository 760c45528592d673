import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fairway.llm import bpe_transducer, packing, token_counts
from fairway.llm.textvec import Texts

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def fuzz(n, seed):
    rng = random.Random(seed)
    bits = ["a", "'", "'s", "'re", "'ll", "'v", "'r", " ", "  ", "\n", "\t", " ", "　", "é", "ß", "1", "23", "²",
            "!", "...", "👍🏽", "漢字", "\x00", "<|endoftext|>", "<|endof", "the", " hello", "’", "lll", "_____", "aaaaaa",
            "\r\n", "\x85", "​", " '", "Ⅷ", "ǅ"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [256, 3])
def test_transducers_equal_the_library(library, monkeypatch, chunk):
    monkeypatch.setattr(bpe_transducer, "CHUNK", chunk)
    texts = [None, "", *fuzz(1500, 4), "x" * 5000, " " * 700 + "end", "ab'" * 300]
    fst = bpe_transducer.Transducers(public_tokenizers.path(NAME))
    _, row, n, ids = fst.encode(Texts(pa.array(texts)), True)
    at = np.concatenate([[0], np.cumsum(n)])
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    for i, text in enumerate(texts):
        assert ids[at[first[i]]:at[first[i + 1]]].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_every_code_point_in_context(library):
    fst = bpe_transducer.Transducers(public_tokenizers.path(NAME))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 60_000):
        texts = [f"a{c}1{c}! {c}'s" for c in points[a:a + 60_000]]
        _, row, n = fst.encode(Texts(pa.array(texts)))
        want = np.array([len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)])
        assert (np.bincount(row, weights=n, minlength=len(texts)) == want).all()


def test_counts(spark, make_docs, library):
    texts = [None, "", "<|endoftext|>", *fuzz(200, 9), "word " * 600]
    docs = make_docs([*enumerate(texts), (1, "")]).withColumnRenamed("lang", "n_tokens")
    for r in token_counts.count_tokens(docs).collect():
        t = texts[r.doc_id] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512)
    assert token_counts.count_tokens(make_docs([])).count() == 0


@pytest.mark.parametrize("parts,most", [(1, 32), (5, 2)])
def test_packing_keeps_every_id_once(spark, make_docs, library, monkeypatch, parts, most):
    monkeypatch.setattr(packing, "OPEN", most)
    rng = random.Random(parts)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gämma", "δ"]) for _ in range(rng.choice([0, 3, 80, 900, 4000]))))
            for i in range(90)] + [(90, None), (91, "")]
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], np.uint32) for i, t in rows}
    got = packing.pack(make_docs(rows, parts), with_ids=True).collect()
    padding = total = 0
    sequences = {}
    for doc, own in ids.items():
        place = 0
        for r in sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start):
            part = own[place:place + r.length]
            assert r.start == place and r.doc_tokens == len(own) and r.ids == part.tolist()
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            place += r.length
        assert place == len(own)
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        place = 0
        for offset, length in sorted(spans):
            assert offset == place
            place += length
        assert place <= packing.WINDOW
        total += place
        padding += 0 if place & (place - 1) == 0 else packing.WINDOW - place
    assert padding <= 0.01 * total


def test_packing_empty_and_repeated(spark, make_docs):
    assert packing.pack(make_docs([])).count() == 0
    assert packing.pack(make_docs([(1, "a"), (1, "a"), (None, "b")])).count() == 3
