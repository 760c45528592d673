import hashlib
import random

import pytest

from fairway.llm import fill_middle, frames


def expected(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, out, p, m = "plain", text, None, None
    elif h4 % 100 < 20:
        form, out, p, m = "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", a, b - a
    else:
        form, out, p, m = "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", a, b - a
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
    return (n, form, p, m, *sha), out


@pytest.mark.parametrize("units", [1, 3, 7, 1 << 15])
def test_equals_brute_force(spark, make_docs, monkeypatch, units):
    monkeypatch.setattr(frames, "FRAME_UNITS", units)
    rng = random.Random(units)
    rows = [(i, "".join(rng.choice(["a", "é", "漢", "👍", "<", "P", ">", "<P", " "]) for _ in range(rng.randint(0, 40))))
            for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "<M>"), (1003, "a<S>b"), (None, "without an id"), (3, "again"), (3, "again"),
             (1004, "ab👍" * (60_000 if units > 7 else 300))]
    docs = make_docs(rows).withColumnRenamed("lang", "frames").withColumnRenamed("source", "form")
    got = sorted((tuple(r) for r in fill_middle.fill_in_middle(docs).collect()), key=repr)
    assert got == sorted(((i, *expected(i, t)[0]) for i, t in rows), key=repr)
    assert {"psm", "spm", "plain"} == {r[2] for r in got}
    made = fill_middle.texts(fill_middle.transformed(fill_middle.planned(fill_middle.framed(docs)))).collect()
    assert sorted((r.id or -1, r.output) for r in made) == sorted((i or -1, expected(i, t)[1]) for i, t in rows)


def test_empty_table(spark, make_docs):
    got = fill_middle.fill_in_middle(make_docs([]))
    assert got.count() == 0 and got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                                                "restored_sha256"]


def test_only_touched_frames_are_decompressed(monkeypatch):
    monkeypatch.setattr(frames, "FRAME_UNITS", 100)
    text = "".join(chr(0x61 + i % 26) + "é" for i in range(5000))
    reader = frames.Reader(*frames.compressed(frames.text_pieces(text)))
    opened = []
    plain = frames.Reader.frame
    monkeypatch.setattr(frames.Reader, "frame", lambda self, i: opened.append(i) or plain(self, i))
    assert reader.units == 10_000 and len(reader.frames) == 100
    assert b"".join(reader.stream(4_250, 4_430)).decode() == text[4_250:4_430] and opened == [42, 43, 44]
    assert b"".join(reader.stream()).decode() == text
    assert b"".join(reader.stream(10_000, 10_000)) == b"" == b"".join(reader.stream(5, 5))


def test_marks_across_frames(monkeypatch):
    for units in range(1, 6):
        monkeypatch.setattr(frames, "FRAME_UNITS", units)
        for before in ("", "é", "<", "<<", "a<Pé<"):
            reader = frames.Reader(*frames.compressed(frames.text_pieces(f"{before}<P>z")))
            assert reader.find(b"<P>") == len(before)
            assert reader.find(b"<S>") == -1
