"""Training-data pipeline over ``documents``: each stage is one operator of
``fairway.llm``; every stage's result is written as Parquet and read again as
the next stage's documents. ``run`` returns the last stage's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairway.llm.jaccard_join import near_duplicates
from fairway.llm.mixing import mixed_documents
from fairway.llm.packing import pack
from fairway.llm.quality import keep_good
from fairway.llm.secrets import masked
from fairway.llm.staging import keyed, small, stage
from fairway.operators.joins import current_scope, run_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules keep. Null, empty and
    blank texts go; rows that repeat an id are judged each; an empty table gives
    no rows; further columns are left out."""
    return keep_good(docs.select(*COLUMNS))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest
    id (none counts as the largest). Rows that repeat an id and rows without one
    are documents of their own; texts without a word are near to nothing and stay;
    an empty table gives no rows; further columns are left out."""
    named = keyed(docs.select(*COLUMNS), "doc_id", "__key")
    kept = stage(near_duplicates(named, "__key").where("__key = component_id").select("__key"), "kept")
    return named.join(small(kept), "__key", "left_semi").select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; all documents stay, null and empty
    texts and repeated rows as they are; further columns are left out."""
    return masked(docs.select(*COLUMNS)).withColumn(
        "n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*COLUMNS)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the entropy-balanced mix takes it. Rows that
    repeat an id and rows without one are documents of their own; a null source is
    a source; texts without words weigh nothing and are not taken; an empty table
    gives no rows; further columns are left out."""
    return mixed_documents(docs.select(*COLUMNS)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, packed into training sequences. Null and
    empty texts are packed as their end mark; repeated rows are packed each; an
    empty table gives no rows."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_quality),
    ("near_duplicates", one_of_each_group),
    ("secret_scan", without_secrets),
    ("target_mix", target_mix),
    ("packing", packed),
]

# The entropy-balanced mix and the expectation-maximised verdict have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, outer = spark.read.parquet(f"{sf_dir}/documents.parquet"), current_scope()
    for name, function in STAGES[:-1]:
        with run_scope():  # a stage's own tables go when its result is written
            docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}", outer)
    return STAGES[-1][1](spark, docs, sf_dir)
