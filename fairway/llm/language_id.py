"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary
(the pieces of ``VOCABULARY`` and all single bytes). A word, with the blank
before it, may be segmented into pieces in many ways; its probability is the
sum over all segmentations of the product of their pieces, by the forward
algorithm. A text's likelihood is the product over its words; the posterior
over languages (prior: share of the training texts) gives prediction and score.

Training: expectation-maximisation with the forward-backward algorithm on word
counts of a bounded sample, ``SAMPLE_DOCS`` training texts of each language
with the smallest id hash. Each round is one distributed pass over the word
counts; what reaches the driver is one number for each piece and language.

Words met before come from a bounded index, new ones are scored together.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
ties go to the first language by name; without any training text all are
``und``; repeated rows are predicted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairway.llm.staging import ship, small, stage
from fairway.llm.textvec import U64, HashIndex, RangeHash, Texts, entries_inside, slices

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_DOCS = 2000
ROUNDS = 4
# Pseudo-count of every piece, spread over the vocabulary.
SMOOTHING = 0.05
HELD_OUT = 2   # crc32(id as text) mod 4 of documents that are not learned from
UNKNOWN = "und"
INDEX_ENTRIES = 1 << 20
_RESCALE = 16

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Pieces:
    """The fixed vocabulary as byte strings: single bytes, then pieces (a blank
    marks a word's start)."""

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        own = {model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.strings = [bytes([b]) for b in range(256)] + sorted(x for x in own if len(x) > 1 and b" " not in x[1:])
        self.longest = max(map(len, self.strings))
        ends = np.cumsum([len(x) for x in self.strings])
        data = np.frombuffer(b"".join(self.strings), np.uint8)
        self.index = HashIndex(1 << 17)
        self.index.insert(RangeHash(data)(np.concatenate([[0], ends[:-1]]), ends))
        self.ids = np.arange(len(self.strings), dtype=np.int32)


_pieces: dict[str, Pieces] = {}


def pieces(name: str) -> Pieces:
    if name not in _pieces:
        _pieces[name] = Pieces(name)
    return _pieces[name]


def _spaced(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words with a blank before each: (bytes, starts, ends, rows)."""
    s, e = texts.words()
    size = e - s + 1
    end = np.cumsum(size)
    data = texts.data[np.minimum(np.arange(int(size.sum())) - np.repeat(end - size - s + 1, size), len(texts.data) - 1)]
    data[end - size] = 32
    return data, end - size, end, texts.row_of(s)


class Lattice:
    """All segmentations of many words at once."""

    def __init__(self, vocab: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.size = ends - starts
        self.word, self.pos, self.length, self.piece = entries_inside(
            data, starts, ends, vocab.index, vocab.ids, vocab.longest)
        longest = int(self.size.max(initial=0))
        self.level = np.searchsorted(self.pos, np.arange(1, longest + 2))
        self.base = np.concatenate([[0], np.cumsum(self.size + 1)])
        self.longest = longest

    def _at(self, i):
        return slice(self.level[i - 1], self.level[i])

    def forward(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``weights``: probability of each lattice edge by channel. Returns the
        scaled forward values by position, the log scale at each position and
        the log probability of each word."""
        channels = weights.shape[1]
        alpha = np.zeros((int(self.base[-1]), channels))
        alpha[self.base[:-1]] = 1
        scale = np.zeros_like(alpha)
        for i in range(1, self.longest + 1):
            at = self._at(i)
            word, before = self.word[at], self.base[self.word[at]] + i - self.length[at]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            here = self.base[word[first]] + i
            # values are kept relative to the scale of the position before
            now = scale[here - 1]
            shift = np.exp(scale[before] - np.repeat(now, np.diff(np.append(first, len(word))), axis=0))
            alpha[here] = np.add.reduceat(weights[at] * alpha[before] * shift, first, axis=0)
            scale[here] = now
            if i % _RESCALE == 0:
                value = np.maximum(alpha[here], 1e-300)
                alpha[here], scale[here] = 1, now + np.log(value)
        end = self.base[:-1] + self.size
        return alpha, scale, np.log(np.maximum(alpha[end], 1e-300)) + scale[end]

    def expected(self, weights: np.ndarray) -> np.ndarray:
        """Expected use of each edge given its word (one channel)."""
        alpha, scale, total = self.forward(weights[:, None])
        log_alpha = np.log(np.maximum(alpha[:, 0], 1e-300)) + scale[:, 0]
        beta = np.full(int(self.base[-1]), -np.inf)
        beta[self.base[:-1] + self.size] = 0
        log_w = np.log(np.maximum(weights, 1e-300))
        use = np.zeros(len(weights))
        for i in range(self.longest, 0, -1):
            at = self._at(i)
            here = self.base[self.word[at]] + i
            value = beta[here] + log_w[at]
            np.logaddexp.at(beta, here - self.length[at], value)
            use[at] = np.exp(np.minimum(value + log_alpha[here - self.length[at]] - total[self.word[at], 0], 0))
        return use


def _training_words(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, word, n) over the bounded training sample."""
    key = F.col(id_col).cast("string")
    allowed = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()) \
        .where(F.pmod(F.crc32(key.cast("binary")), F.lit(4)) != HELD_OUT)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    # a bounded table: the texts themselves are not shuffled
    ids = stage(allowed.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id")).distinct().withColumn(
        "nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_DOCS).select("id", "lang"), "lang-sample")
    sample = allowed.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .join(small(ids), ["id", "lang"], "left_semi")
    words = sample.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
                          .alias("word"))
    return stage(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "lang-words")


def train(words: DataFrame, vocabulary: str = VOCABULARY) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and piece probabilities (piece, language)."""
    spark = words.sparkSession
    shares = sorted((r["lang"], r["n"]) for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    langs = [x[0] for x in shares]
    if not langs:
        return [], np.zeros(0), np.zeros((0, 0))
    number = {lang: i for i, lang in enumerate(langs)}
    size = len(pieces(vocabulary).strings)
    table = np.full((size, len(langs)), 1.0 / size)
    for step in range(ROUNDS):
        model = spark.sparkContext.broadcast(table)

        def use(batches: Iterator[pa.RecordBatch]):
            vocab = pieces(vocabulary)
            total = np.zeros((size, len(langs)))
            for batch in slices(batches, "word", 1 << 20):
                data, s, e, _ = _spaced(Texts(batch.column("word")))
                lang = np.array([number[x] for x in batch.column("lang").to_pylist()])
                lattice = Lattice(vocab, data, s, e)
                p = model.value[lattice.piece, lang[lattice.word]]
                # the first round starts from pieces that are longer than chance has them
                p = p * 10.0 ** (lattice.length - 1) if step == 0 else p
                n = batch.column("n").to_numpy()
                np.add.at(total, (lattice.piece, lang[lattice.word]), lattice.expected(p) * n[lattice.word])
            piece, lang = np.nonzero(total)
            yield pa.record_batch([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)),
                                   pa.array(total[piece, lang])], names=["piece", "lang", "n"])

        got = stage(words.mapInArrow(use, "piece int, lang int, n double").groupBy("piece", "lang").agg(
            F.sum("n").alias("n")), "piece-counts").toPandas()
        counts = np.full((size, len(langs)), SMOOTHING)
        counts[got["piece"].to_numpy(), got["lang"].to_numpy()] += got["n"].to_numpy()
        table = counts / counts.sum(axis=0)
    total = np.array([x[1] for x in shares], dtype=float)
    return langs, np.log(total / total.sum()), table


class _Scorer:
    """Log probabilities of words by language, remembered by hash."""

    def __init__(self, vocab: Pieces, table: np.ndarray):
        self.vocab, self.table = vocab, table
        self._reset()

    def _reset(self):
        self.index = HashIndex(INDEX_ENTRIES)
        self.logs = np.zeros((0, self.table.shape[1]), np.float32)

    def texts(self, texts: Texts) -> np.ndarray:
        if self.index.full:
            self._reset()
        data, s, e, row = _spaced(texts)
        out = np.zeros((texts.rows, self.table.shape[1]))
        if not len(s):
            return out
        hashes = RangeHash(data)(s, e)
        number = self.index.lookup(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            logs = []
            ns, ne = s[new[first]], e[new[first]]
            for a in range(0, len(fresh), 50_000):
                lattice = Lattice(self.vocab, data, ns[a:a + 50_000], ne[a:a + 50_000])
                logs.append(lattice.forward(self.table[lattice.piece])[2])
            self.index.insert(fresh)
            self.logs = np.concatenate([self.logs, *[x.astype(np.float32) for x in logs]])
            number[new] = self.index.lookup(hashes[new])
        for c in range(out.shape[1]):
            out[:, c] = np.bincount(row, weights=self.logs[number, c], minlength=texts.rows)
        return out


def _without_letter(texts: Texts) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_LETTER[texts.data])])
    none = sums[texts.ends] == sums[texts.starts]
    for r in np.flatnonzero(none):
        text = texts.data[texts.starts[r]:texts.ends[r]].tobytes().decode("utf-8", "replace")
        none[r] = not any(ch.isalpha() for ch in text)
    return none


_scorers: dict[int, _Scorer] = {}


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      vocabulary: str = VOCABULARY) -> DataFrame:
    """``id_col``, held_out, lang_pred and score for every row of ``docs``."""
    ship(docs.sparkSession)
    langs, prior, table = train(_training_words(docs, id_col, text_col, lang_col), vocabulary)
    model = docs.sparkSession.sparkContext.broadcast((prior, table))

    def run(batches: Iterator[pa.RecordBatch]):
        prior, table = model.value
        if model._path not in _scorers:
            _scorers.clear()
            _scorers[model._path] = _Scorer(pieces(vocabulary), table) if langs else None
        scorer = _scorers[model._path]
        names = np.array([*langs, UNKNOWN], dtype=object)
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            if langs:
                log = scorer.texts(texts) + prior
                best = log.argmax(axis=1)
                score = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, score = np.zeros(texts.rows, np.int64), np.zeros(texts.rows)
            none = texts.null | _without_letter(texts) | (not langs)
            best[none], score[none] = len(langs), 0.0
            yield pa.record_batch([batch.column("id"), batch.column("held_out"), pa.array(names[best], pa.string()),
                                   pa.array(score)], names=["id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.pmod(
        F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double") \
        .withColumnRenamed("id", id_col)
