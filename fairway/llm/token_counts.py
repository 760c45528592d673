"""Token counts of whole texts by compiled finite-state transducers.

See ``bpe_transducer``. Texts are handled in slices; one very long text is cut
into chunks inside its slice, so its length costs memory in proportion only.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted like any other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairway.llm.bpe_transducer import transducers
from fairway.llm.staging import ship
from fairway.llm.textvec import Texts, slices

LIMIT = 512


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = "byte_bpe_50k.json", limit: int = LIMIT) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit of every row of ``docs``.
    ``vocabulary`` names a file of the public tokenizers."""

    def run(batches):
        fst = transducers(vocabulary)
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            _, row, n = fst.encode(texts)
            tokens = np.bincount(row, weights=n, minlength=texts.rows).astype(np.int64)
            yield pa.record_batch([batch.column("id"), pa.array(texts.ends - texts.starts), pa.array(tokens),
                                   pa.array(tokens > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed(
        "id", id_col)
