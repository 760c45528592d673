import random
import zlib

import numpy as np
import pyarrow as pa

from fairway.llm import language_id
from fairway.llm.textvec import Texts

SYLLABLES = {"xa": ["tion", "the", "ing", "wh", "sh", "er"], "xb": ["ung", "ich", "sch", "ein", "keit", "ver"],
             "xc": ["aux", "que", "oi", "ment", "eau", "é"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy(spark, make_docs):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang := rng.choice(list(SYLLABLES)), rng.randint(5, 60)), lang, f"s{i % 3}") for i in range(300)]
    odd = [(1000, None, "xa"), (1001, "", "xa"), (1002, "123 !?", None), (1003, prose(rng, "xb", 20), None),
           (1003, prose(rng, "xb", 20), None), (1004, prose(rng, "xc", 30_000), None), (1005, "日", None)]
    got = {}
    for r in language_id.predict_languages(make_docs(rows + odd)).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        got[r.doc_id] = r.lang_pred
    held = [(i, lang) for i, _, lang, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i] == lang for i, lang in held]) >= 0.98
    assert [got[i] for i in range(1000, 1005)] == ["und", "und", "und", "xb", "xc"] and got[1005] in SYLLABLES


def test_labels_of_held_out_documents_are_not_read(spark, make_docs):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang := rng.choice(list(SYLLABLES)), 30), lang) for i in range(80)]
    swapped = [(i, t, "never" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    one, two = (sorted(map(tuple, language_id.predict_languages(make_docs(x)).collect())) for x in (rows, swapped))
    assert one == two


def test_forward_sums_all_segmentations():
    vocab = language_id.pieces(language_id.VOCABULARY)
    words = ["a", "the", "antidote", "é", "x" * 60]
    data, s, e, _ = language_id._spaced(Texts(pa.array(words)))
    lattice = language_id.Lattice(vocab, data, s, e)
    rng = np.random.default_rng(0)
    p = rng.random(len(vocab.strings)) / 50
    got = lattice.forward(p[lattice.piece][:, None])[2][:, 0]
    number = {x: i for i, x in enumerate(vocab.strings)}
    for w, log in zip(words, got):
        w = b" " + w.encode()
        total = [1.0] + [0.0] * len(w)
        for j in range(1, len(w) + 1):
            total[j] = sum(total[i] * p[number[w[i:j]]] for i in range(j) if w[i:j] in number)
        assert np.isclose(log, np.log(total[-1]))


def test_nothing_to_learn_and_empty(spark, make_docs):
    assert [r.lang_pred for r in language_id.predict_languages(make_docs([(1, "abc")])).collect()] == ["und"]
    assert language_id.predict_languages(make_docs([])).count() == 0
