"""Driver queries over the operators of this subpackage, each over its whole
table with production parameters, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fairway.llm import (
    fill_middle,
    hamming_search,
    jaccard_join,
    language_id,
    lexical_search,
    mixing,
    packing,
    quality,
    repeats,
    secrets,
    token_counts,
    toxicity,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.search_table(_table(spark, sf_dir, "embeddings"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(_table(spark, sf_dir, "documents"))


def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(_table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hamming_search": op1_hamming_search,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_entropy_mix": op4_entropy_mix,
    "op5_token_counts": op5_token_counts,
    "op6_secret_scan": op6_secret_scan,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_fill_middle": op12_fill_middle,
    "op13_toxicity": op13_toxicity,
}

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {
    "op1_hamming_search": """
WITH codes AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: coalesce(x > 0, false)) AS c
               FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
  list_sum(list_transform(list_zip(q.c, v.c), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS distance
  FROM codes q JOIN codes v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank,
       neighbor_id, CAST(distance AS BIGINT) AS distance
FROM pairs QUALIFY rank <= 10""",
    "op2_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles,
       least(w.doc_id, (SELECT min(y) FROM reach WHERE x = w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes USING (doc_id)""",
    # base 32 of the SHA-1: five bits at a time out of two hexadecimal digits
    "op7_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
           FROM pages),
b AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first, array_to_string(list_transform(range(32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((((strpos('0123456789abcdef', substr(h, 5 * i // 4 + 1, 1)) - 1) * 16
    + strpos('0123456789abcdef', substr(h, 5 * i // 4 + 2, 1)) - 1) >> (3 - (5 * i) % 4)) & 31 AS INTEGER), 1)), '')
  AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b""",
    "op11_lexical_search": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS t FROM documents),
total AS (SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n),
m AS (SELECT doc_id, 100 - 75 + ((75 * len(t) * n) // l) AS m FROM d, total WHERE len(t) > 0),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""",
    "op12_fill_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
           FROM documents),
e AS (SELECT *, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) % (length(t) + 1) AS a,
             CAST('0x' || h[9:16] AS BIGINT) % (length(t) + 1) AS b, CAST('0x' || h[17:24] AS BIGINT) AS h3,
             CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                     THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             substr(t, 1, least(a, b)) AS p, substr(t, 1 + least(a, b), abs(a - b)) AS m,
             substr(t, 1 + greatest(a, b)) AS s FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM f""",
}
