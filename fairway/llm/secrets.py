"""Secret scan with SQL functions only: base patterns, and character Markov
models of random strings and of ordinary words compared by log-likelihood
ratio.

Base spans come from three patterns; a match that is too short is dropped
after matching (leftmost, non-overlapping by kind). The models add spans of
kind ``markov``: whole runs of ``RUN`` that no base span touches and whose
log-likelihood ratio, summed over character pairs, exceeds both ``LEAST_TOTAL``
and ``LEAST_PER_PAIR`` for each pair.

Both models are character bigrams that fall back on single characters (weight
``BACK_OFF``). They are trained on
labelled samples of bounded size: texts of the ``SAMPLE_DOCS`` documents with
the smallest id hash, whose words are ordinary unless a base span covers them
(then random) or they are as long as a run and mix digits or cases (then
unlabelled), and ``SAMPLE_STRINGS`` strings dealt uniformly over each of
``ALPHABETS`` by a hash (random). The fitted table has one number for each pair
of the 68 symbols.

Positions are code points, end exclusive. Defined cases: null and empty texts
have no spans; repeated rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns and least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

# Runs that the models judge; any hex or access span lies in such a run.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
LEAST_TOTAL = 12.0
LEAST_PER_PAIR = 0.4
SAMPLE_DOCS = 2000
BACK_OFF = 4.0
SAMPLE_STRINGS = 500
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "0123456789" + _LETTERS.upper() + _LETTERS + "+/_.=-"
ALPHABETS = ("0123456789abcdef", _LETTERS.upper() + "234567", "0123456789" + _LETTERS.upper() + _LETTERS,
             "0123456789" + _LETTERS.upper() + _LETTERS + "+/", "0123456789" + _LETTERS.upper() + _LETTERS + "_-")
_K = len(SYMBOLS)
# Matches placed together before whole groups are: keeps placing linear in practice.
_GROUP = 512


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _matches(pattern: str, when: str) -> Column:
    return F.expr(f"CASE WHEN {when} THEN regexp_extract_all(text, {_literal(pattern)}, 0) "
                  "ELSE CAST(array() AS array<string>) END")


def _placed(pattern: str, found: str) -> Column:
    """Spans (start, end, s) of the matches in column ``found``: the texts
    between matches and the matches themselves alternate, so their lengths
    add up to positions. Groups of matches are placed first, then shifted."""
    span = "struct<`start`:bigint,`end`:bigint,s:string>"
    none = f"CAST(array() AS array<{span}>)"
    return F.expr(f"""CASE WHEN size({found}) = 0 THEN {none} ELSE flatten(aggregate(
      transform(sequence(0, (size({found}) - 1) div {_GROUP}), g -> aggregate(
        zip_with(slice(split(text, {_literal(pattern)}, -1), g * {_GROUP} + 1,
                       least({_GROUP}, size({found}) - g * {_GROUP})),
                 slice({found}, g * {_GROUP} + 1, {_GROUP}), (a, b) -> struct(length(a) AS a, length(b) AS b, b AS s)),
        struct(0L AS p, {none} AS spans),
        (t, x) -> struct(t.p + x.a + x.b AS p, concat(t.spans, array(
          struct(t.p + x.a AS `start`, t.p + x.a + x.b AS `end`, x.s AS s))) AS spans))),
      struct(0L AS p, CAST(array() AS array<array<{span}>>) AS spans),
      (t, x) -> struct(t.p + x.p AS p, concat(t.spans, array(transform(x.spans, y -> struct(
        y.`start` + t.p AS `start`, y.`end` + t.p AS `end`, y.s AS s)))) AS spans)).spans) END""")


def base_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text``, ``assign``, ``access``, ``hex`` and ``runs`` (arrays of spans)."""
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "has_run", F.expr(f"text RLIKE {_literal(RUN)}")).select(
        "id", "text",
        _matches(ASSIGN, "contains(text, '=') OR contains(text, ':')").alias("m_assign"),
        _matches(ACCESS, "contains(text, 'AKIA')").alias("m_access"),
        _matches(HEX, "has_run").alias("m_hex"), _matches(RUN, "has_run").alias("m_runs"))
    placed = found.select("id", "text", _placed(ASSIGN, "m_assign").alias("assign"),
                          _placed(ACCESS, "m_access").alias("access"),
                          _placed(HEX, "m_hex").alias("hex"), _placed(RUN, "m_runs").alias("runs"))
    return placed.withColumn("assign", F.expr(
        f"filter(assign, x -> length(regexp_extract(x.s, {_literal(ASSIGN)}, 1)) >= {ASSIGN_VALUE})"))


_SYMBOL_NUMBER = "array(" + ",".join(str(SYMBOLS.find(chr(i))) if chr(i) in SYMBOLS else "-1"
                                     for i in range(128)) + ")"


def _codes(s: str) -> str:
    """Symbol numbers of an ASCII string over SYMBOLS."""
    return f"filter(transform(split({s}, ''), c -> element_at({_SYMBOL_NUMBER}, ascii(c) + 1)), n -> n >= 0)"


def train(samples: DataFrame) -> list[float]:
    """Log-ratio table (``68 * 68`` numbers) from rows (``s``, ``random``)."""
    pairs = samples.select("random", F.expr(_codes("s")).alias("c")).where("size(c) > 1").select(
        "random", F.expr(f"explode(transform(sequence(1, size(c) - 1), i -> c[i - 1] * {_K} + c[i]))").alias("pair"))
    count = {(r["random"], r["pair"]): r["n"] for r in
             pairs.groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n")).collect()}
    # pairs not seen fall back on how often their second symbol is seen at all
    first, second = ({(kind, x): sum(n for (k, pair), n in count.items() if k == kind and
                                     (pair // _K if part == 0 else pair % _K) == x)
                      for kind in (True, False) for x in range(_K)} for part in (0, 1))
    whole = {kind: sum(n for (k, _), n in count.items() if k == kind) for kind in (True, False)}

    def log_p(kind: bool, a: int, b: int) -> float:
        share = (second[kind, b] + 0.5) / (whole[kind] + _K / 2)
        return math.log((count.get((kind, a * _K + b), 0) + BACK_OFF * share) / (first[kind, a] + BACK_OFF))

    return [log_p(True, a, b) - log_p(False, a, b) for a in range(_K) for b in range(_K)]


def labelled_samples(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Bounded labelled sample (``s``, ``random``), see the module's text."""
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct() \
        .orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(SAMPLE_DOCS)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), "id", "left_semi")
    # of rows that share an id always the same one, so reruns agree
    chosen = chosen.groupBy("id").agg(F.max_by("text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("text"))
    spans = base_spans(chosen, "id", "text")
    word = "[A-Za-z0-9+/_=-]{4,}"
    random = spans.select(F.explode(F.expr(
        f"concat(transform(assign, x -> regexp_extract(x.s, {_literal(ASSIGN)}, 1)), "
        "transform(access, x -> x.s), transform(hex, x -> x.s))")).alias("s")).where("s RLIKE '[0-9]'")
    plain = spans.select(F.explode(F.expr(
        f"filter(regexp_extract_all(regexp_replace(text, {_literal(ASSIGN)}, ' '), '{word}', 0), "
        f"w -> NOT (w RLIKE '{ACCESS}') AND NOT (w RLIKE '{HEX}') AND "
        "(length(w) < 20 OR w RLIKE '^[A-Z]?[a-z]+$' OR w RLIKE '^[A-Z]+$'))")).alias("s"))
    dealt = None
    for alphabet in ALPHABETS:
        one = spark.range(SAMPLE_STRINGS).select(F.expr(
            f"array_join(transform(sequence(1, 40), i -> substring('{alphabet}', "
            f"CAST(pmod(xxhash64(id, i), {len(alphabet)}) AS int) + 1, 1)), '')").alias("s"))
        dealt = one if dealt is None else dealt.unionByName(one)
    return random.unionByName(dealt).withColumn("random", F.lit(True)).unionByName(
        plain.withColumn("random", F.lit(False)))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 table: list[float] | None = None) -> DataFrame:
    """``id_col``, ``text_col`` and ``spans``: array of (start, end, kind number
    in ``KINDS``, matched string), by start, then kind, then end."""
    if table is None:
        table = train(labelled_samples(docs, id_col, text_col))
    ratios = F.array(*[F.lit(x) for x in table])
    spans = base_spans(docs, id_col, text_col).withColumn("base", F.expr(
        "concat(" + ", ".join(f"transform({k}, x -> struct(x.`start`, x.`end`, {n} AS kind, x.s))"
                              for n, k in enumerate(KINDS[:3])) + ")"))
    spans = spans.withColumn("codes", F.expr(
        "transform(filter(runs, r -> NOT exists(base, b -> b.`start` < r.`end` AND r.`start` < b.`end`)), "
        f"r -> struct(r.`start`, r.`end`, r.s, {_codes('r.s')} AS c))"))

    def ratio(r: Column) -> Column:
        c = r["c"]
        return F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda total, i:
                           total + ratios[F.get(c, i - 1) * _K + F.get(c, i)])

    rated = F.transform("codes", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"),
                                                    r["s"].alias("s"), ratio(r).alias("llr")))
    extra = F.expr(f"transform(filter(rated, r -> r.llr >= {LEAST_TOTAL} AND r.llr >= {LEAST_PER_PAIR} * "
                   "(length(r.s) - 1)), r -> struct(r.`start`, r.`end`, 3 AS kind, r.s))")
    return spans.withColumn("rated", rated).select(
        F.col("id").alias(id_col), F.col("text").alias(text_col),
        F.expr("array_sort(base, (l, r) -> CASE WHEN l.`start` <> r.`start` THEN CAST(sign(l.`start` - r.`start`) "
               "AS int) ELSE l.kind - r.kind END)").alias("base"), extra.alias("extra")).withColumn(
        "spans", F.expr("array_sort(concat(base, extra), (l, r) -> CASE WHEN l.`start` <> r.`start` THEN "
                        "CAST(sign(l.`start` - r.`start`) AS int) ELSE l.kind - r.kind END)")).select(
        id_col, text_col, "base", "spans")


def _joined(column: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return (f"array_join(transform({column}, x -> concat_ws(':', {names}[x.kind], "
            "CAST(x.`start` AS string), CAST(x.`end` AS string))), ',')")


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and joined spans for every row of ``docs``."""
    spans = secret_spans(docs, id_col, text_col)
    return spans.select(id_col, *[F.expr(f"CAST(size(filter(base, x -> x.kind = {n})) AS bigint)").alias(f"n_{k}")
                                  for n, k in enumerate(KINDS[:3])],
                        F.sha2(F.expr(_joined("base")), 256).alias("base_sha256"),
                        F.expr(_joined("spans")).alias("spans"))


def masked(docs: DataFrame, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every secret span of ``text_col`` replaced by ``mark``;
    overlapping spans are replaced once. Other columns stay."""
    names = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"),
                         F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    table = train(labelled_samples(packed.select("key", "text"), "key", "text"))
    spans = secret_spans(packed, "row", "text", table)
    # spans ascend by start: keep the text before each, skip what it covers
    cut = F.expr(f"""CASE WHEN size(spans) = 0 THEN row.`{text_col}` ELSE
      aggregate(spans, struct('' AS kept, 0L AS p),
        (t, x) -> struct(
          CASE WHEN x.`start` >= t.p THEN concat(t.kept, substring(text, CAST(t.p AS int) + 1,
            CAST(x.`start` - t.p AS int)), '{mark}') ELSE t.kept END AS kept, greatest(t.p, x.`end`) AS p),
        t -> concat(t.kept, substring(text, CAST(t.p AS int) + 1, length(text)))) END""")
    return spans.select(*[F.col("row")[c].alias(c) for c in names], cut.alias(text_col)).select(*docs.columns)
