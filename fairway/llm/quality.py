"""Quality rules as weak supervision.

Each rule looks at one statistic of a text and votes *good* or *bad* or
abstains. Expectation-maximisation over all texts estimates how accurate each
rule is and how many texts are good; a text is kept when the posterior
probability that it is good is at least one half. Votes are aggregated by
vote pattern (at most ``3 ** len(RULES)`` patterns) before anything reaches the
driver, so the fit costs the same at any size.

Model: class ``y`` good or bad; a rule that votes is right with probability
``a1`` on good and ``a0`` on bad texts. A bad text breaks few rules, so ``a0``
may be small, but never below ``1 - a1``: a good vote never counts against a
text. An abstention says nothing.

Defined cases: null, empty and blank texts have no words and fail the base
rule; a repeated row is scored like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.llm.staging import ship, stage
from fairway.llm.textvec import SPACE, U64, RangeHash, Texts, mix, slices

ACCURACY = (0.9, 0.995)
ROUNDS = 100
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_ends"]


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode())] = True
    return out


_SYMBOL = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_MARK = _table("!\"#$%&'()*+-/:;<=>@[\\]^_`{|}~")
_END = _table(".?!")


def _votes(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """0 abstains, 1 good, 2 bad."""
    return np.where(bad, 2, np.where(good, 1, 0))


#: name -> votes from the statistics (arrays by name); w is n_words, at least 1.
RULES = {
    "length": lambda s, w: _votes(s["n_words"] >= 60, s["n_words"] < 20),
    "word_length": lambda s, w: _votes((s["word_chars"] >= 3 * w) & (s["word_chars"] <= 9 * w),
                                       (s["word_chars"] < 2 * w) | (s["word_chars"] > 13 * w)),
    "symbols": lambda s, w: _votes(s["n_symbols"] <= 0.02 * w, s["n_symbols"] > 0.15 * w),
    "duplicate_lines": lambda s, w: _votes(s["n_dup_lines"] <= 0.1 * s["n_lines"],
                                           s["n_dup_lines"] > 0.3 * s["n_lines"]),
    "repeated_words": lambda s, w: _votes(s["n_repeat_words"] <= 0.15 * w, s["n_repeat_words"] > 0.4 * w),
    "upper_case": lambda s, w: _votes(s["n_upper"] <= 0.15 * s["n_letters"], s["n_upper"] > 0.5 * s["n_letters"]),
    "digits": lambda s, w: _votes(s["n_digits"] <= 0.05 * s["word_chars"], s["n_digits"] > 0.3 * s["word_chars"]),
    "marks": lambda s, w: _votes(s["n_marks"] <= 0.03 * s["word_chars"], s["n_marks"] > 0.08 * s["word_chars"]),
    "sentences": lambda s, w: _votes(s["n_ends"] >= w / 60, s["n_ends"] * 400 < w),
}


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal to another, equal to an earlier one) for each key."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later, any_ = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    """Whole-text statistics by row."""
    data, rows = texts.data, texts.rows
    n = len(data)

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[texts.ends] - sums[texts.starts]

    word = ~SPACE[data]
    starts, ends = texts.words()
    owner = texts.row_of(starts)
    n_words = np.bincount(owner, minlength=rows).astype(np.int64)
    hashes = RangeHash(data)
    salt = mix(np.arange(1, rows + 1, dtype=U64))
    out = {"n_words": n_words, "word_chars": count(word & ((data & 0xC0) != 0x80)), "n_symbols": count(_SYMBOL[data])}
    # lines: pieces between line feeds, cut at row borders
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:][data == 10] = True
    cut[texts.starts] = True
    cut[n] = False
    at = np.flatnonzero(cut)
    row = texts.row_of(at)
    end = np.minimum(np.append(at[1:], n), texts.ends[row]) if len(at) else at
    feed = (end > at) & (data[np.maximum(end - 1, 0)] == 10) if n else np.zeros(len(at), bool)
    words_before = np.concatenate([[0], np.cumsum(word, dtype=np.int64)])
    full = words_before[end] > words_before[at]
    at, end, row = at[full], (end - feed)[full], row[full]
    later = _repeats(hashes(at, end) ^ salt[row])[1]
    out["n_dup_lines"] = np.bincount(row[later], minlength=rows)
    out["n_lines"] = np.bincount(row, minlength=rows)
    covered = np.zeros(len(starts), dtype=bool)
    if len(starts) >= 3:
        h = hashes(starts, ends)
        last = len(h) - 2
        inside = np.flatnonzero(owner[:last] == owner[2:])
        key = mix(h[inside] * U64(3) + mix(h[inside + 1]) * U64(5) + mix(mix(h[inside + 2]))) ^ salt[owner[inside]]
        twice = inside[_repeats(key)[0]]
        for j in range(3):
            covered[twice + j] = True
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=rows)
    upper = count(_UPPER[data])
    out |= {"n_upper": upper, "n_letters": upper + count(_LOWER[data]), "n_digits": count(_DIGIT[data]),
            "n_marks": count(_MARK[data]), "n_ends": count(_END[data])}
    return out


def patterns(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all rules as one number in base 3."""
    w = np.maximum(stats["n_words"], 1)
    code = np.zeros(len(w), dtype=np.int64)
    for rule in RULES.values():
        code = code * 3 + rule(stats, w)
    return code


def _decode(codes: np.ndarray) -> np.ndarray:
    m = len(RULES)
    return (codes[:, None] // 3 ** np.arange(m - 1, -1, -1)) % 3


def fit(codes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation on counted vote patterns: share of good texts
    and each rule's accuracy on good and on bad ones."""
    votes = _decode(codes)
    good, bad = votes == 1, votes == 2
    share, a1, a0 = 0.8, np.full(len(RULES), 0.97), np.full(len(RULES), 0.3)
    for _ in range(ROUNDS):
        p = posterior(codes, share, a1, a0) * counts
        q = counts - p
        before = share
        # Laplace counts keep estimates of rules that rarely vote in range
        share = float(np.clip((p.sum() + 8) / (counts.sum() + 10), 0.5, 0.999))
        a1 = np.clip((p @ good + 9) / (p @ (good | bad) + 10), *ACCURACY)
        a0 = np.clip((q @ bad + 3) / (q @ (good | bad) + 10), 1.01 - a1, ACCURACY[1])
        if abs(share - before) < 1e-9:
            break
    return share, a1, a0


def posterior(codes: np.ndarray, share: float, a1: np.ndarray, a0: np.ndarray) -> np.ndarray:
    votes = _decode(codes)
    logit = np.log(share / (1 - share)) + (votes == 1) @ np.log(a1 / (1 - a0)) + (votes == 2) @ np.log((1 - a1) / a0)
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def _score(batches: Iterator[pa.RecordBatch]):
    for batch in slices(batches):
        stats = statistics(Texts(batch.column("text")))
        cols = [batch.column("id"), *[pa.array(stats[c].astype(np.int64)) for c in BASE],
                pa.array(_base_failed(stats)), pa.array(patterns(stats).astype(np.int32))]
        yield pa.record_batch(cols, names=["id", *BASE, "base_failed", "pattern"])


def _fitted(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of every pattern met (bounded by the number of rules)."""
    got = scored.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("pattern")
    codes, counts = got["pattern"].to_numpy(np.int64), got["n"].to_numpy(np.float64)
    return (codes, posterior(codes, *fit(codes, counts))) if len(codes) else (codes, counts)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, posterior ``quality`` and ``kept`` for every row of ``docs``."""
    ship(docs.sparkSession)
    schema = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    scored = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _score, f"id {schema}, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, pattern int"), "quality")
    codes, good = _fitted(scored)
    spark = docs.sparkSession
    table = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, good)], "pattern int, quality double")
    return scored.join(F.broadcast(table), "pattern").select(
        F.col("id").alias(id_col), *BASE, "base_failed", "quality",
        (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are."""
    ship(docs.sparkSession)
    votes = stage(docs.select(F.lit(0).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _score, f"id int, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, pattern int")
        .groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "patterns")
    got = votes.toPandas().sort_values("pattern")
    codes, counts = got["pattern"].to_numpy(np.int64), got["n"].to_numpy(np.float64)
    kept = np.zeros(3 ** len(RULES), dtype=bool)
    if len(codes):
        kept[codes] = posterior(codes, *fit(codes, counts)) >= 0.5

    def run(batches):
        for batch in slices(batches, text_col):
            stats = statistics(Texts(batch.column(text_col)))
            yield batch.filter(pa.array(kept[patterns(stats)] & ~_base_failed(stats)))

    return docs.mapInArrow(run, docs.schema)
