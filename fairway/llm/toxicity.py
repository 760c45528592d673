"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

Features are the character n-grams (``SIZES``) that a text holds at all, hashed
to ``BUCKETS``: A-Z lower-cased, every other ASCII character but letters and
digits read as a blank, one blank before and after the text. A feature's value
is its naive Bayes log-count ratio ``r`` (share of label 1 texts' features over
share of label 0 texts'), and logistic regression learns weights on these
values, so that an n-gram that both classes use alike counts for nothing
(Wang and Manning 2012).

Training: at most ``SAMPLE_DOCS`` labelled texts of each label, those with the
smallest id hash, out of the rows that may be learned from. Only n-grams whose
ratio is ``MIN_Z`` standard errors from 0 are features, at most ``FEATURES``
of them, the surest first. Counting and every gradient are distributed passes
over the sample; what reaches the driver is one number for each feature. The
intercept is set back to the label shares of all labelled rows.

Defined cases: null texts are empty; empty texts get the score of a text
without features; rows that repeat an id are scored each and share a label;
several labels of one id: the highest; labels without an id or value are left
out; without rows of both labels every score is the share of label 1 (0 without
any); an empty table gives no rows; a null id is not held out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.llm.staging import ship, stage
from fairway.llm.textvec import LOWER, U64, Texts, mix, release_memory, slices

SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 20
FEATURES = 1 << 14
SAMPLE_DOCS = 4000
MIN_Z = 4.0
SMOOTHING = 1.0
PENALTY = 1.0          # of the squared weights, against the sum of losses
ROUNDS = 30
TOLERANCE = 1e-4       # relative change of the loss at which the fit ends
HELD_OUT = 2           # crc32(id as text) mod 4 of rows that are not learned from
THRESHOLD = 0.3
SLICE = 1 << 20

_BLANK = LOWER.astype(np.uint32)
_BLANK[[b for b in range(128) if not chr(b).isalnum()]] = 32


def _characters(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between two blanks, and each one's row."""
    data = texts.data
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    size = lead[texts.ends] - lead[texts.starts]
    end = np.cumsum(size + 2)
    row = np.repeat(np.arange(texts.rows), size + 2)
    out = np.full(int(end[-1]) if len(end) else 0, 32, np.uint32)
    inside = np.ones(len(out), bool)
    inside[end - 1] = inside[end - size - 2] = False
    out[inside] = np.where(points < 128, _BLANK[np.minimum(points, 127)], points)
    return out, row


def _grams(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every n-gram, one size at a time."""
    points, row = _characters(texts)
    held = np.zeros(len(points), U64)
    for n in range(1, max(SIZES) + 1):
        here = len(points) - n + 1
        if here <= 0:
            return
        held = held[:here] * U64(0x9E3779B97F4A7C15) + points[n - 1:].astype(U64) + U64(1)
        if n in SIZES:
            bucket = (mix(held + U64(n)) >> U64(44)).astype(np.int64)
            own = row[:here] == row[n - 1:]
            yield bucket[own], row[:here][own]


def features(texts: Texts, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) of the n-grams; ``wanted`` marks the buckets to keep."""
    pairs = [np.zeros(0, np.int64)]
    for bucket, row in _grams(texts):
        if wanted is not None:
            keep = np.flatnonzero(wanted[bucket])
            bucket, row = bucket[keep], row[keep]
        pairs.append(np.unique(row * BUCKETS + bucket))
    pairs = np.unique(np.concatenate(pairs))
    return pairs // BUCKETS, pairs % BUCKETS


def learnable(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``id`` and ``label`` (0 or 1) of the labelled ids that may be learned from."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) == 1).cast("int").alias("label"))
    rows = rows.where(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) != HELD_OUT)
    return rows.groupBy("id").agg(F.max("label").alias("label"))


def training_sample(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``label`` and ``text`` of the bounded training sample, as a written table."""
    # a top-k for each label, so no task gets all ids of one
    zeros, ones = (known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS) for v in (0, 1))
    ids = zeros.unionByName(ones)
    # at most SAMPLE_DOCS ids of each label: the texts stay where they are
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return stage(rows.join(F.broadcast(ids), "id").select("label", "text"), "toxic-sample")


def _counts(sample: DataFrame) -> DataFrame:
    """``bucket``, ``ones``, ``zeros``: sample texts of each label that hold it."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((2, BUCKETS), np.int32)
        for batch in slices(batches, most=SLICE):
            row, bucket = features(Texts(batch.column("text")))
            label = batch.column("label").to_numpy()[row]
            for value in (0, 1):
                total[value] += np.bincount(bucket[label == value], minlength=BUCKETS).astype(np.int32)
        seen = np.flatnonzero(total.any(axis=0))
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[1, seen]), pa.array(total[0, seen])],
                              names=["bucket", "ones", "zeros"])
        release_memory()

    parts = sample.mapInArrow(run, "bucket int, ones int, zeros int")
    return parts.groupBy("bucket").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def ratios(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that are features and their naive Bayes log-count ratios."""
    counted = stage(_counts(sample), "gram-counts")
    total = counted.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return np.zeros(0, np.int64), np.zeros(0)
    one, zero = F.col("ones") + SMOOTHING, F.col("zeros") + SMOOTHING
    r = F.log(one / (total["ones"] + SMOOTHING * total["n"])) - F.log(zero / (total["zeros"] + SMOOTHING * total["n"]))
    best = counted.select("bucket", r.alias("r"), (F.abs(r) / F.sqrt(1 / one + 1 / zero)).alias("z")) \
        .where(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "bucket").limit(FEATURES)
    got = best.orderBy("bucket").toPandas()
    return got["bucket"].to_numpy().astype(np.int64), got["r"].to_numpy()


def _bucket_table(buckets: np.ndarray) -> np.ndarray:
    """Feature number of each bucket, -1 without one."""
    table = np.full(BUCKETS, -1, np.int32)
    table[buckets] = np.arange(len(buckets))
    return table


def _rows_of_features(sample: DataFrame, buckets: np.ndarray) -> DataFrame:
    """``label`` and ``held`` (feature numbers) of each sample text, written."""
    sent = sample.sparkSession.sparkContext.broadcast(buckets)

    def run(batches: Iterator[pa.RecordBatch]):
        table = _bucket_table(sent.value)
        for batch in slices(batches, most=SLICE):
            texts = Texts(batch.column("text"))
            row, bucket = features(texts, table >= 0)
            at = np.searchsorted(row, np.arange(texts.rows + 1)).astype(np.int32)
            yield pa.record_batch([batch.column("label"), pa.ListArray.from_arrays(pa.array(at), pa.array(table[bucket]))],
                                  names=["label", "held"])
        release_memory()

    return stage(sample.mapInArrow(run, "label int, held array<int>"), "toxic-features")


def _probability(odds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-odds))


def _loss(rows: DataFrame, r: np.ndarray) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """Sum of log losses and its gradient at weights and intercept (last), each
    one distributed pass over ``rows``."""
    context = rows.sparkSession.sparkContext
    n = len(r)

    def at(weights: np.ndarray) -> tuple[float, np.ndarray]:
        sent = context.broadcast((weights[:-1] * r, weights[-1], r))

        def run(batches: Iterator[pa.RecordBatch]):
            weight, intercept, r = sent.value
            total, gradient = 0.0, np.zeros(n + 1)
            for batch in batches:
                held = batch.column("held")
                sizes = np.diff(held.offsets.to_numpy())
                flat = held.flatten().to_numpy()
                row = np.repeat(np.arange(batch.num_rows), sizes)
                value = np.bincount(row, weights=weight[flat], minlength=batch.num_rows) + intercept
                y = batch.column("label").to_numpy()
                total += float(np.logaddexp(0, np.where(y == 1, -value, value)).sum())
                miss = _probability(value) - y
                gradient[:-1] += np.bincount(flat, weights=miss[row], minlength=n) * r
                gradient[-1] += miss.sum()
            where = np.flatnonzero(gradient)
            yield pa.record_batch([pa.array(np.append(where, -1).astype(np.int32)),
                                   pa.array(np.append(gradient[where], total))], names=["i", "x"])

        got = rows.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        sent.destroy()
        place, value = got["i"].to_numpy(), got["x"].to_numpy()
        gradient = np.zeros(n + 1)
        gradient[place[place >= 0]] = value[place >= 0]
        total = float(value[place < 0].sum())
        gradient[:-1] += PENALTY * weights[:-1]
        return total + PENALTY / 2 * float(weights[:-1] @ weights[:-1]), gradient

    return at


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Limited-memory quasi-Newton steps; a step that does not lower the loss is
    cut to a quarter."""
    x, pairs = start, []
    value, gradient = loss(x)
    for _ in range(rounds):
        direction, kept = -gradient, []
        for s, y in reversed(pairs):
            a = (s @ direction) / (s @ y)
            direction = direction - a * y
            kept.append(a)
        if pairs:
            s, y = pairs[-1]
            direction = direction * (s @ y) / (y @ y)
        else:
            direction = direction / max(1.0, float(np.abs(gradient).sum()))
        for (s, y), a in zip(pairs, reversed(kept)):
            direction = direction + (a - (y @ direction) / (s @ y)) * s
        step = 1.0
        for _ in range(8):
            new = loss(x + step * direction)
            if new[0] < value:
                break
            step /= 4
        else:
            break
        s, y = step * direction, new[1] - gradient
        if s @ y > 1e-12:
            pairs = [*pairs[-9:], (s, y)]
        change = value - new[0]
        x, value, gradient = x + s, *new
        if change <= TOLERANCE * value:
            break
    return x


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, their weights, intercept) of the classifier."""
    known = stage(learnable(labels, id_col, label_col), "toxic-labels")
    share = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    none = np.zeros(0, np.int64), np.zeros(0)
    if len(share) < 2:
        return *none, np.inf if 1 in share else -np.inf
    sample = training_sample(docs, known, id_col, text_col)
    taken = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = float(np.log(share[1] / share[0]))
    if len(taken) < 2:
        return *none, prior
    buckets, r = ratios(sample)
    odds = float(np.log(taken[1] / taken[0]))
    fitted = minimise(_loss(_rows_of_features(sample, buckets), r), np.append(np.zeros(len(r)), odds))
    return buckets, fitted[:-1] * r, float(fitted[-1]) + prior - odds


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> DataFrame:
    """``id_col``, held_out, score and predicted for every row of ``docs``."""
    ship(docs.sparkSession)
    buckets, weights, intercept = train(docs, labels, id_col, text_col, label_col)
    sent = docs.sparkSession.sparkContext.broadcast((buckets, weights))

    def run(batches: Iterator[pa.RecordBatch]):
        buckets, weights = sent.value
        table = np.zeros(BUCKETS)
        table[buckets] = weights
        wanted = table != 0
        for batch in slices(batches, most=SLICE):
            texts = Texts(batch.column("text"))
            row, bucket = features(texts, wanted)
            value = np.bincount(row, weights=table[bucket], minlength=texts.rows) + intercept
            score = _probability(value)
            yield pa.record_batch([batch.column("id"), batch.column("held_out"), pa.array(score),
                                   pa.array((score >= THRESHOLD).astype(np.int32))],
                                  names=["id", "held_out", "score", "predicted"])
        release_memory()

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.pmod(
        F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
