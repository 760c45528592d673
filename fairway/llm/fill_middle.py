"""Fill-in-the-middle transformation over seekable compressed frames.

``framed`` stores every text once as independent zstandard frames with
cumulative code point counts (``frames``). ``planned`` draws form and cuts from
the id's SHA-256 with SQL functions, without touching a text. ``transformed``
reads the frames: the frames that hold a cut are decompressed for the selection,
all others stream through in order, and the output is framed again. ``restored``
rebuilds the text from output and form alone: it looks for the marks in the
output's frames and streams the parts in their first order.

One document is one row of compressed frames; a task holds one decompressed
frame and the frames of the batch of rows it was given. Nothing is shuffled.

Defined cases: null texts are empty; empty texts and texts that hold a mark
are plain; a null id draws like the empty text; rows that repeat an id draw the
same numbers and are each transformed; an empty table gives no rows; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairway.llm.frames import COLUMNS, Reader, compressed, text_pieces
from fairway.llm.staging import ship, stage

SEED = "1"
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_PERCENT = 10     # of documents that stay as they are
SPM_PERCENT = 20       # of transformed ones: suffix first
ROWS = 256             # rows sent on at once


def _frame_column(rows: list[list[bytes]], ends: list[list[int]]) -> list[pa.Array]:
    return [pa.array(rows, pa.list_(pa.binary())), pa.array(ends, pa.list_(pa.int64()))]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def framed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The store: ``id``, ``marked`` (the text holds a mark), ``frames`` and
    ``ends`` of every row, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in _cut(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            marked = [any(m.decode() in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts]
            stored = [compressed(text_pieces(t)) for t in texts]
            yield pa.record_batch([batch.column("id"), pa.array(marked, pa.bool_()),
                                   *_frame_column([x[0] for x in stored], [x[1] for x in stored])],
                                  names=["id", "marked", "frames", "ends"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return stage(rows.mapInArrow(run, f"id {kind}, marked boolean, {COLUMNS}"), "frames")


def planned(store: DataFrame) -> DataFrame:
    """``store`` with n, form, prefix_chars and middle_chars."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)

    def drawn(i: int) -> Column:
        return F.conv(F.substring(digest, 8 * i - 7, 8), 16, 10).cast("long")

    n = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0).cast("long"))
    rows = store.select("*", n.alias("n"), (drawn(1) % (n + 1)).alias("a"), (drawn(2) % (n + 1)).alias("b"),
                        drawn(3).alias("h3"), drawn(4).alias("h4"))
    form = F.when((F.col("n") == 0) | F.col("marked") | (F.col("h3") % 100 >= 100 - PLAIN_PERCENT), "plain").when(
        F.col("h4") % 100 < SPM_PERCENT, "spm").otherwise("psm")
    rows = rows.withColumn("form", form)
    moved = F.col("form") != "plain"
    return rows.select("id", "n", "form", F.when(moved, F.least("a", "b")).alias("prefix_chars"),
                       F.when(moved, F.abs(F.col("a") - F.col("b"))).alias("middle_chars"), "frames", "ends")


def _arranged(text: Reader, form: str, prefix: int | None, middle: int | None) -> Iterator[bytes]:
    """The output's bytes in order."""
    if form == "plain":
        yield from text.stream()
        return
    parts = {PREFIX: (0, prefix), SUFFIX: (prefix + middle, text.units), MIDDLE: (prefix, prefix + middle)}
    for mark in (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE):
        yield mark
        yield from text.stream(*parts[mark])


def _original(output: Reader, form: str) -> Iterator[bytes]:
    """The text's bytes in order, from an output and its form."""
    if form == "plain":
        yield from output.stream()
        return
    at, places = 0, {}
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    for mark in order:
        at = output.find(mark, at)
        if at < 0:
            raise ValueError(f"an output of form {form} without {mark.decode()}")
        places[mark] = at
        at += len(mark)
    stops = dict(zip(order, [places[order[1]], places[order[2]], output.units]))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.stream(places[mark] + len(mark), stops[mark])


def _sha256(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


KEPT = ["id", "n", "form", "prefix_chars", "middle_chars"]


def transformed(plan: DataFrame) -> DataFrame:
    """The outputs: rows of ``planned`` with ``frames`` and ``ends`` of the
    output instead of the text's, and ``output_sha256``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in _cut(batches):
            frames, ends, digests = [], [], []
            for form, prefix, middle, held, at in zip(*(batch.column(c).to_pylist() for c in (
                    "form", "prefix_chars", "middle_chars", "frames", "ends"))):
                text = Reader(held, at)
                digest = hashlib.sha256()

                def pieces():
                    for piece in _arranged(text, form, prefix, middle):
                        digest.update(piece)
                        yield piece

                made = compressed(pieces())
                frames.append(made[0])
                ends.append(made[1])
                digests.append(digest.hexdigest())
            yield pa.record_batch([*(batch.column(c) for c in KEPT), pa.array(digests, pa.string()),
                                   *_frame_column(frames, ends)], names=[*KEPT, "output_sha256", "frames", "ends"])

    ship(plan.sparkSession)
    kind = plan.schema["id"].dataType.simpleString()
    return plan.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, "
                                f"output_sha256 string, {COLUMNS}")


def restored(outputs: DataFrame) -> DataFrame:
    """Rows of ``transformed`` with ``restored_sha256`` of the text rebuilt from
    output and form; the frames end here."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in _cut(batches):
            digests = [_sha256(_original(Reader(held, at), form)) for form, held, at in zip(
                *(batch.column(c).to_pylist() for c in ("form", "frames", "ends")))]
            yield pa.record_batch([*(batch.column(c) for c in [*KEPT, "output_sha256"]), pa.array(digests, pa.string())],
                                  names=[*KEPT, "output_sha256", "restored_sha256"])

    kind = outputs.schema["id"].dataType.simpleString()
    return outputs.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, "
                                   "output_sha256 string, restored_sha256 string")


def texts(outputs: DataFrame) -> DataFrame:
    """``id``, ``form`` and the output as text, for rows of ``transformed``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in _cut(batches):
            whole = [b"".join(Reader(held, at).stream()).decode() for held, at in zip(
                batch.column("frames").to_pylist(), batch.column("ends").to_pylist())]
            yield pa.record_batch([batch.column("id"), batch.column("form"), pa.array(whole, pa.string())],
                                  names=["id", "form", "output"])

    kind = outputs.schema["id"].dataType.simpleString()
    return outputs.mapInArrow(run, f"id {kind}, form string, output string")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n, form, prefix_chars, middle_chars, output_sha256 and
    restored_sha256 of every row of ``docs``."""
    outputs = transformed(planned(framed(docs, id_col, text_col)))
    return restored(outputs).withColumnRenamed("id", id_col)
