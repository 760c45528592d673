"""Mixing sources to target token shares by entropy balancing.

Every source gets a target number of words (weights 5, 2, 1 repeating over the
sources by code point, null last; no target above ``MOST_COPIES`` times its
source, the excess is shared again by weight). Document rates ``r`` in
``[0, MOST_COPIES]`` are the ones closest to 1 in relative entropy whose words
meet the target:

    minimise  sum r ln r - r + 1   subject to  sum r * size = target

The dual has one multiplier ``b`` for each source and the solution is the tilted
rate ``r = min(MOST_COPIES, exp(b * size / scale))``. Newton steps, kept inside
a bracket, find all multipliers together: each step is one distributed
aggregation over the histogram (source, size, documents), whose height is
bounded by the different sizes, not by the documents.

Rates become whole copies source by source: from the largest size to the
smallest, each histogram cell takes the whole number of copies next to its
expected words plus what the cells before left over, so a source misses its
target by little more than its smallest texts can mend. Within a cell, copies
go to documents by the rank of a hash, so reruns agree; cells of many documents
are split into parts of about ``CELL`` documents first.

Defined cases: a null text has size 0 and no copies; a null source is a source
of its own, last; repeated rows are documents of their own (rows equal in all
columns read here share their rank order, so reruns still agree); an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairway.llm.staging import keyed, ship, small, stage

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
CELL = 4096
# Newton stops when every source is this close to its target (share), or after STEPS.
TOLERANCE = 1e-9
STEPS = 60
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` has one row for each source (source, total). Adds
    ``target``. Sources reach their bound in order of bound by weight, so a
    running sum over sources (one row each) gives the level at which the rest
    stop."""
    bound = float(MOST_COPIES)
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sources.withColumn("weight", weights[F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))])
    ranked = ranked.withColumn("full_at", bound * F.col("total") / F.col("weight"))
    upto = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(1))
    level = (F.sum("total").over(all_rows) - F.coalesce(F.sum(bound * F.col("total")).over(upto), F.lit(0.0))) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    # the first source that the level does not fill sets it for all after it
    staged = ranked.withColumn("level", level)
    staged = staged.withColumn("set", F.min(F.when(F.col("level") < F.col("full_at"), F.col("full_at"))).over(all_rows))
    staged = staged.withColumn("level", F.max(F.when(F.col("full_at") == F.col("set"), F.col("level"))).over(all_rows))
    return staged.select("source", "total", F.when(
        F.col("set").isNull() | (F.col("full_at") < F.col("set")), bound * F.col("total")).otherwise(
        F.col("level") * F.col("weight")).alias("target"))


def _rate(b, size, scale):
    return F.when(b.isNull(), F.lit(float(MOST_COPIES))).otherwise(
        F.least(F.lit(float(MOST_COPIES)), F.exp(F.least(b * size / scale, F.lit(50.0)))))


def balance(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """Multiplier ``b`` and ``scale`` of each source. ``cells`` is the histogram
    (source, size, n), ``wanted`` has (source, total, target). ``b`` is null
    where the target is the bound itself: every document is taken that often."""
    scales = cells.where("size > 0").groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"))
    state = wanted.join(scales, wanted.source.eqNullSafe(scales.source)).select(
        wanted.source, "target", "scale",
        F.when(F.col("target") >= MOST_COPIES * F.col("total") * (1 - 1e-12), F.lit(None)).otherwise(F.lit(0.0))
        .cast("double").alias("b"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        F.lit(1.0).alias("miss"))
    state = stage(state, "balance")
    open_cells = cells.where("size > 0")
    for _ in range(STEPS):
        s = F.broadcast(state.where("b is not null")) if state.count() <= 100_000 else state.where("b is not null")
        both = open_cells.join(s, open_cells.source.eqNullSafe(s.source)).select(
            s.source, "target", "scale", "b", "low", "high", "n", "size")
        rate, x = _rate(F.col("b"), F.col("size"), F.col("scale")), F.col("size") / F.col("scale")
        grown = both.groupBy("source", "target", "scale", "b", "low", "high").agg(
            F.sum(F.col("n") * rate * F.col("size")).alias("got"),
            F.sum(F.when(rate < MOST_COPIES, F.col("n") * rate * F.col("size") * x).otherwise(0.0)).alias("slope"))
        miss = F.col("got") - F.col("target")
        grown = grown.withColumn("low", F.when(miss <= 0, F.col("b")).otherwise(F.col("low"))) \
            .withColumn("high", F.when(miss >= 0, F.col("b")).otherwise(F.col("high"))) \
            .withColumn("step", F.when(F.col("slope") > 0, F.col("b") - miss / F.col("slope")))
        # outside the bracket, halve it; without a bracket, go on by growing steps
        half = F.when(F.col("low").isNull(), F.col("high") * 2 - 1).when(
            F.col("high").isNull(), F.col("low") * 2 + 1).otherwise((F.col("low") + F.col("high")) / 2)
        inside = F.col("step").isNotNull() & (F.col("step") > F.coalesce("low", F.col("high") * 4 - 4)) & \
            (F.col("step") < F.coalesce("high", F.col("low") * 4 + 4))
        near = F.abs(miss) / F.greatest(F.col("target"), F.lit(1.0))
        new = grown.select("source", "target", "scale",
                           F.when(near <= TOLERANCE, F.col("b")).when(inside, F.col("step")).otherwise(half).alias("b"),
                           "low", "high", near.alias("miss"))
        state = stage(new.unionByName(state.where("b is null")), "balance")
        worst = state.where("b is not null").agg(F.max("miss")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("source", "b", "scale")


def _copies(key, pdf):
    """Whole copies of each cell of one source, largest sizes first."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values(["size", "part"], ascending=[False, True])
    carry, left, out = 0.0, pdf["size"].to_numpy(), []
    for size, n, rate in zip(left, pdf["n"].to_numpy(), pdf["rate"].to_numpy()):
        low = int(np.floor(rate + 1e-9))
        high = min(MOST_COPIES, low + (rate - low > 1e-9))
        want = n * rate * size + carry
        take = int(min(max(round(want / size), n * low), n * high)) if size else 0
        carry = want - take * size if size else carry
        out.append(take)
    # what is left goes to the smallest cells that still have room
    for i in range(len(out) - 1, -1, -1):
        size, n = left[i], pdf["n"].iloc[i]
        if size and abs(carry) >= size / 2:
            new = int(min(max(out[i] + round(carry / size), 0), n * MOST_COPIES))
            carry -= (new - out[i]) * size
            out[i] = new
    return pd.DataFrame({"group": pdf["group"], "size": left, "part": pdf["part"], "copies": out})


def planned(sizes: DataFrame) -> DataFrame:
    """Rows of ``sizes`` (id, source, size, seed) with source_size, target and copies."""
    ship(sizes.sparkSession)
    counted = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted, "cells")
    wanted = stage(targets(counted.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("double").alias("total"))),
                   "targets")
    fitted = balance(counted, wanted)
    # parts of a cell: each document's part by hash, so that no part is large
    parted = counted.withColumn("parts", F.ceil(F.col("n") / CELL).cast("long")).select("source", "size", "parts")
    rows = sizes.join(parted, sizes.source.eqNullSafe(parted.source) & (sizes["size"] == parted["size"])).select(
        sizes.id, sizes.source, sizes["size"], "seed",
        F.pmod(F.xxhash64("seed"), F.col("parts")).cast("int").alias("part"))
    rows = stage(rows.withColumn("group", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))), "sized")
    cells = rows.groupBy("group", "source", "size", "part").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.join(fitted, cells.source.eqNullSafe(fitted.source), "left").select(
        "group", "size", "part", "n", _rate(F.col("b"), F.col("size"), F.col("scale")).alias("rate"))
    copies = cells.where("size > 0").groupBy("group").applyInPandas(
        _copies, "group string, size long, part int, copies long")
    copies = copies.join(cells.select("group", "size", "part", "n"), ["group", "size", "part"])
    order = Window.partitionBy("group", "size", "part").orderBy("seed", "id")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    taken = ranked.join(copies, ["group", "size", "part"], "left").select(
        "id", "source", "size", F.coalesce(
            F.expr("copies div n") + F.when(F.col("rank") <= F.col("copies") % F.col("n"), 1).otherwise(0),
            F.lit(0)).cast("long").alias("copies"))
    return taken.join(F.broadcast(wanted) if wanted.count() <= 100_000 else wanted,
                      taken.source.eqNullSafe(wanted.source)).select(
        "id", taken.source, "size", F.col("total").cast("long").alias("source_size"), "target", "copies")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, key_col: str | None = None) -> DataFrame:
    text = F.col(text_col)
    return stage(docs.select(F.col(key_col or id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                             word_count(text).alias("size"),
                             # rows without an id draw by their text
                             F.xxhash64(F.coalesce(F.col(id_col).cast("string"), text, F.lit("")), F.lit("mix"))
                             .alias("seed")), "sizes")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """``id_col``, size, source_size, target and taken words of every row."""
    plan = planned(_sized(docs, id_col, text_col, source_col))
    return plan.select(F.col("id").alias(id_col), "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows that repeat
    an id and rows without one are documents of their own."""
    # the rows travel as one column, so no name of theirs can clash
    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"),
                         F.struct(*docs.columns).alias("row"))
    rows = keyed(packed, "id", "key")
    plan = planned(_sized(rows, "id", "text", "source", "key"))
    plan = small(stage(plan.where("copies > 0").select(F.col("id").alias("key"), "copies"), "plan"))
    return rows.select("key", "row").join(plan, "key").select(
        "row", F.explode(F.expr("sequence(1, int(copies))"))).select("row.*")
