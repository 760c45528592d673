import hashlib
import random

import numpy as np
import pytest

from fairway.llm import induced_sort, repeats


def brute(rows):
    """Rows in the documents' order -> expected result."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, int)
        for k in range(len(data) - repeats.LENGTH + 1):
            w = data[k:k + repeats.LENGTH]
            if w in seen:
                cover[k] += 1
                cover[k + repeats.LENGTH] -= 1
            seen.add(w)
        gone = np.cumsum(cover[:-1]) > 0
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([60, 99, 100, 101, 300]))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choice("xyz漢 ") for _ in range(rng.randint(0, 200))))
        rows.append((i, "".join(parts)))
    return rows + [(n, "a" * 1000), (n + 1, "ab" * 400), (n + 2, None), (n + 3, ""), (n + 4, "a" * 99), (n + 5, rows[3][1])]


@pytest.mark.parametrize("seed,common,flush", [(1, 128, 1 << 24), (2, 2, 1 << 24), (3, 128, 1000), (4, 1, 500)])
def test_matches_brute_force(spark, make_docs, monkeypatch, seed, common, flush):
    monkeypatch.setattr(repeats, "COMMON", common)
    monkeypatch.setattr(repeats, "FLUSH_BYTES", flush)
    rows = corpus(seed)
    got = sorted((tuple(r) for r in repeats.without_repeats(make_docs(rows, 3)).collect()), key=str)
    assert got == brute(rows)


def test_blocks_and_spilling_queues(spark, make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK", 700)
    monkeypatch.setattr(repeats, "QUEUE", 200)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000)
    monkeypatch.setattr(repeats, "SLICE", 900)
    rows = corpus(9)
    got = sorted((tuple(r) for r in repeats.without_repeats(make_docs(rows, 2)).collect()), key=str)
    assert got == brute(rows)


def test_repeated_and_missing_ids(spark, make_docs):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(150))
    got = repeats.without_repeats(make_docs([(1, text), (1, text), (None, text), (None, None)])).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == [(0, 0), (150, 0), (150, 150), (150, 150)]
    assert [r.n_removed for r in got if r.doc_id is None and r.n_bytes] == [150]
    assert repeats.without_repeats(make_docs([])).count() == 0


def test_kept_bytes(spark, make_docs):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(120))
    got = {r.doc_id: bytes(r.kept) for r in
           repeats.without_repeats(make_docs([(1, text), (2, "start " + text + " end")]), with_text=True).collect()}
    assert got == {1: text.encode(), 2: b"start  end"}


@pytest.mark.parametrize("memory", [1 << 20, 8])
def test_induced_order(tmp_path, memory):
    rng = random.Random(memory)
    for _ in range(150):
        text = np.array([rng.randint(0, rng.choice([1, 3, 200])) for _ in range(rng.randint(1, 80))])
        order = induced_sort.suffix_order(text, 100, memory, f"file://{tmp_path}/q")
        assert list(order) == sorted(range(len(text)), key=lambda i: list(text[i:]))


def test_number_of_shards_grows_with_the_repeats(spark, make_docs, monkeypatch):
    parts, side = [], repeats._send_side
    monkeypatch.setattr(repeats, "_send_side", lambda n, model: parts.append(n) or side(n, model))
    monkeypatch.setattr(repeats, "PART_BYTES", 1000, raising=False)
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(3000)) for _ in range(20)]
    rows = [(i, texts[i % 20] + str(i)) for i in range(60)]
    got = sorted((tuple(r) for r in repeats.without_repeats(make_docs(rows, 2)).collect()), key=str)
    assert got == brute(rows)
    # 60 texts of 3000 bytes, each string in at least one piece
    assert parts[0] * 1000 >= 60 * 2900
