"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length per source. Whole passes over a source
come first; the rest of its target is spread over the lengths in proportion,
and what remains of the budget is fitted by a bounded-knapsack dynamic
program over the lengths. Seeded hashes then pick that many documents of each
length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_rows, text_bytes

#: Fixed values of the mix: the sources' weights in order, repeating; the share of all words to take; passes at most.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_PASSES = 2

#: Words of remaining budget that the dynamic program fits exactly.
KNAPSACK_WORDS = 65_536


def sizes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, size): words ``[^\\x20\\x09-\\x0D]+`` of the whole text, 0 for NULL."""
    def run(batches):
        for b in batches:
            n = [len(x.split()) if x else 0 for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "size"])
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), text_bytes(docs, text).alias("raw"))
    return map_rows(src, run, "doc_id long, source string, size long")


def targets(per: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES) -> DataFrame:
    """``per`` (source, source_size; one row per source) plus each source's target.

    Sources in code point order, NULL last, take the weights in turn. A target
    is level * weight up to ``max_passes`` times its source's size; the level
    rises until the targets sum to ``share`` of all words, or all are full.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())     # one narrow row per source
    turn = F.array(*[F.lit(float(x)) for x in weights])
    per = cut(per.withColumn("weight", F.element_at(turn, (F.row_number().over(w) - 1) % len(weights) + 1)), "sources")
    full = F.col("source_size") * max_passes
    total = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:                                              # the full sources only grow in number
        over = full <= F.lit(level) * F.col("weight")
        r = per.agg(F.sum(F.when(over, full).otherwise(0)).alias("capped"), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not r["open"]:
            break
        new = (total - r["capped"]) / r["open"]
        if new <= level:
            break
        level = new
    return per.withColumn("target", F.least(full.cast("double"), F.lit(level) * F.col("weight"))).drop("weight")


def fit_lengths(length: np.ndarray, count: np.ndarray, budget: int, knapsack_words: int = KNAPSACK_WORDS) -> np.ndarray:
    """How many documents of each length to take so that the words come as
    near ``budget`` as the fit allows (of two equally near sums, the lower).

    Longest first, each length gets its share of the budget by running total
    (the proportional part, which leaves less than a document); the dynamic
    program then refits up to ``knapsack_words`` of budget: what remains plus
    documents given back. Lengths of 0 take no part.
    """
    take = np.zeros(len(length), dtype=np.int64)
    order = [i for i in np.argsort(-length, kind="stable") if length[i] > 0 and count[i] > 0]
    words = int(sum(int(length[i]) * int(count[i]) for i in order))
    if budget <= 0 or not order:
        return take
    if budget >= words:
        take[order] = count[order]
        return take
    want = got = 0
    for i in order:
        n, size = int(count[i]), int(length[i])
        want += n * size
        take[i] = min(n, max(0, (want * budget // words - got) // size))
        got += int(take[i]) * size
    # Give back shortest documents first until the free budget is worth a knapsack.
    free = budget - got
    for i in reversed(order):
        back = min(int(take[i]), max(0, knapsack_words - free) // int(length[i]))
        take[i] -= back
        free += back * int(length[i])
    cap = 2 * free                                           # a sum above 2 * free is farther off than 0
    reach, made = 1, np.full(cap + 1, -1, dtype=np.int64)    # bit s: s words can be made; by which chunk first
    chunks: list[tuple[int, int]] = []
    limit = (1 << (cap + 1)) - 1
    for i in order:
        left, k = int(count[i] - take[i]), 1
        while left and int(length[i]) * min(k, left) <= cap:
            n = min(k, left)
            new = (reach << (n * int(length[i]))) & limit & ~reach
            if new:
                bits = np.flatnonzero(np.unpackbits(np.frombuffer(new.to_bytes(cap // 8 + 1, "little"), np.uint8), bitorder="little"))
                made[bits] = len(chunks)
                reach |= new
            chunks.append((i, n))
            left, k = left - n, k * 2
        if reach >> free & 1:
            break
    below = (reach & ((1 << (free + 1)) - 1)).bit_length() - 1
    above = reach >> (free + 1)
    s = free + (above & -above).bit_length() if above else below
    s = s if s - free < free - below else below
    while s > 0:
        i, n = chunks[made[s]]
        take[i] += n
        s -= n * int(length[i])
    return take


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    passes = int(target // size) if size else 0
    extra = fit_lengths(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(round(target - passes * size)))
    return pdf.assign(passes=passes, extra=extra)[["source", "size", "n", "source_size", "target", "passes", "extra"]]


def mix(docs: DataFrame, seed: int = 42, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): one row per document.

    ``taken`` counts words with repeats: size times 0, 1, ... ``max_passes``.
    Reruns agree: picks follow ``xxhash64(seed, doc_id)``, then doc_id; rows
    equal in all of these are interchangeable. NULL or blank text has size 0
    and takes nothing; a NULL source is a source of its own; NULL ids are
    picked like others. Only id, source and text are read.

    The knapsack sees one row per distinct length of a source: d lengths need
    at least d * d / 2 words, so that table stays small. Ranks within a length
    use about sqrt(n) hash buckets of sqrt(n) documents, so copies by the
    million of one length are never sorted in one task.
    """
    rows = cut(sizes(docs, text, doc_id, source), "sizes")
    hist = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    per = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = targets(per, weights, share, max_passes)
    joined = hist.join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = cut(joined.groupBy("source").applyInPandas(
        _plan, "source string, size long, n long, source_size long, target double, passes int, extra long"), "plan")
    # rank of a document in its (source, size), by hash: bucket first, then within the bucket
    p = plan.select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.ceil(F.sqrt("n")).cast("int").alias("buckets"))
    keyed = rows.join(p, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z")
    keyed = keyed.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("bucket", F.pmod("h", "buckets").cast("int")).drop("buckets")
    keyed = cut(keyed, "keyed")
    group = ["source", "size"]
    filled = keyed.groupBy(*group, "bucket").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    filled = filled.withColumn("before", F.coalesce(before, F.lit(0)))
    quota = plan.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "source_size", "target", "passes", "extra")
    filled = filled.join(quota, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z", "m")
    filled = filled.select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("bucket").alias("_b"), "source_size", "target", "passes", (F.col("extra") - F.col("before")).alias("room"))
    rank = F.row_number().over(Window.partitionBy(*group, "bucket").orderBy("h", "doc_id"))
    ranked = keyed.withColumn("rank", rank)
    out = ranked.join(filled, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("bucket") == F.col("_b")))
    copies = F.col("passes") + F.when(F.col("rank") <= F.col("room"), 1).otherwise(0)
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"))
