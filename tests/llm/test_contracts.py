"""Cases that every operator has to stand: extra columns with clashing names,
empty tables, and tables of a run that go with it."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fairway.llm import hamming_search, language_id, mixing, packing, quality, repeats, secrets, staging, warc
from fairway.operators.joins import run_scope
from tests.conftest import SF001

CLASHES = ["id", "key", "row", "size", "target", "copies", "__copies", "seed", "part", "group", "n", "own", "ranges",
           "pattern", "quality", "kept", "held_out", "score", "word", "span", "spans", "sign", "fp", "x", "block", "code",
           "query_id", "rank", "start", "length", "payload", "path", "position", "__key", "component_id"]

DOCS = {
    "op3": (language_id.predict_languages, ["doc_id", "held_out", "lang_pred"]),
    "op4": (mixing.mix_sources, ["doc_id", "size", "source_size", "taken"]),
    "op4-rows": (mixing.mixed_documents, ["doc_id", "text"]),
    "op6": (secrets.secret_digest, ["doc_id", "base_sha256", "spans"]),
    "op8": (packing.pack, ["doc_id", "start", "length", "ids_crc32"]),
    "op9": (quality.judge, ["doc_id", "n_words", "kept"]),
    "op10": (repeats.without_repeats, ["doc_id", "n_removed", "kept_sha256"]),
    "stage-near": (lambda d: corpus_pipeline.one_of_each_group(None, d, ""), ["doc_id", "text"]),
    "stage-secrets": (lambda d: corpus_pipeline.without_secrets(None, d, ""), ["doc_id", "text"]),
    "stage-mix": (lambda d: corpus_pipeline.target_mix(None, d, ""), ["doc_id", "text"]),
    "stage-quality": (lambda d: corpus_pipeline.good_quality(None, d, ""), ["doc_id", "text"]),
}


def clashing(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in df.columns])


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    # some ids missing or repeated, so that surrogate keys are made too
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = table.limit(4).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    return staging.stage(table.unionByName(odd), "odd-documents")


@pytest.mark.parametrize("name", DOCS)
def test_clashing_column_names(spark, docs, name):
    function, columns = DOCS[name]
    assert rows(function(clashing(docs)), columns) == rows(function(docs), columns) != []


def test_clashing_column_names_of_other_tables(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").limit(40)
    columns = ["page_id", "payload_digest", "record_type", "refers_to"]
    assert rows(warc.archived_pages(clashing(pages)), columns) == rows(warc.archived_pages(pages), columns)
    vectors = spark.read.parquet(f"{SF001}/embeddings.parquet")
    columns = ["query_id", "rank", "neighbor_id"]
    assert rows(hamming_search.search_table(clashing(vectors)), columns) == rows(hamming_search.search_table(vectors), columns)


@pytest.mark.parametrize("name", [n for n in DOCS if n.startswith("stage")])
def test_stages_on_an_empty_table_and_a_very_long_text(spark, make_docs, name):
    function, columns = DOCS[name]
    empty = function(make_docs([]))
    assert empty.count() == 0 and empty.columns == corpus_pipeline.COLUMNS
    long = " ".join(f"Word{i % 9173} goes on, and number {i} ends here.\n" for i in range(40_000))
    got = function(make_docs([(1, long, "en", "s"), (2, None, "en", "s"), (3, "", None, None), (4, long[:400_000], "en", "s")]))
    ids = {r.doc_id for r in got.collect()}
    # the rules reject the repetitive text; the mix may leave a document out
    assert ids <= {1, 2, 3, 4} and (name in ("stage-quality", "stage-mix") or ids >= {1, 4})


def test_pipeline_over_a_whole_table(spark):
    with run_scope():
        out = corpus_pipeline.run(spark, SF001)
        pieces = out.collect()
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    at = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert len(pieces) > 50 and max(at.values()) <= 2048


def test_written_tables_go_with_their_run(spark, make_docs):
    folder = f"{staging.ensure_checkpoint_dir(spark).removeprefix('file:')}/llm"
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    with run_scope():
        assert mixing.mix_sources(make_docs([(1, "a b", None, "x")])).count() == 1
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before
