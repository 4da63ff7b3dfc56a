"""Hard-negative mining by a vertical (BOND) scan.

Vectors become integers (floor(scale * x)), so scores are exact inner products.
Tasks read the rows in blocks whose dimensions are columns. For each anchor a
block's dimensions are read in the order of the anchor's components, largest
magnitude first. After every few dimensions a candidate's score lies between
its partial sum plus the least and plus the most that the remaining dimensions
can add (from each column's minimum and maximum in the block). Candidates
whose bounds cannot matter any more leave the bitmap; the rest get exact scores:

* positives: rows of the anchor's label whose upper bound reaches the k-th best lower bound found so far;
* negatives: rows of other labels that can lie in the score window of some
  positive, and that can reach the k-th best of that window found so far.

Anchors come in blocks of ``anchor_block`` (keyset pages by id), which bounds
what is broadcast; each block makes two passes over all rows. A task returns at
most k rows for each anchor (or anchor and positive), and a ranked window merges them.

Defined results: rows with a NULL id, label or vector, or with a NULL or
non-finite component or one whose integer exceeds ``LIMIT`` in magnitude, take
no part. Rows with one id count once (the one with the smallest label, then
vector). Of vectors of unlike length the shorter one goes on with zeros.
Equal scores: smaller id first. Extra columns are not read. An anchor without a positive has no rows.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import scratch_path

from .common import cut

#: Largest integer component: 2,048 products of two of them still fit 64 bits.
LIMIT = 2 ** 26
#: Rows of a block, and dimensions read between two prunings.
BLOCK_ROWS, STEP = 16_384, 8
NOTHING = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Rule:
    """How many positives and negatives, and the window of a negative's score in percent of the positive's."""
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90

    def windows(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest integer score s with low*p <= 100*s <= high*p."""
        return -(-self.low * scores // 100), self.high * scores // 100


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """(id, label, q) of the rows that take part, one row per id."""
    x = F.col(f"`{vector}`")
    value = lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))
    fine = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) <= F.lit(LIMIT / scale), F.lit(False)))
    q = F.when(fine, F.transform(x, value))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), q.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("q").isNotNull())
    return rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q")


class Block:
    """Rows with their dimensions as columns, and each dimension's range."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.least, self.most = columns.min(axis=1), columns.max(axis=1)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the rows that ``prune(low, high)`` leaves at every step."""
        dims = min(len(anchor), len(self.columns))
        order = np.argsort(-np.abs(anchor[:dims]), kind="stable")
        ends = anchor[order] * self.least[order], anchor[order] * self.most[order]
        rest_low = np.append(np.cumsum(np.minimum(*ends)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(np.maximum(*ends)[::-1])[::-1], 0)
        score = np.zeros(len(rows), np.int64)
        whole = len(rows) == len(self.ids)
        for s in range(0, dims, STEP):
            for d in order[s:s + STEP]:
                if anchor[d]:
                    score += anchor[d] * (self.columns[d] if whole else self.columns[d][rows])
            done = min(s + STEP, dims)
            keep = prune(score + rest_low[done], score + rest_high[done])
            if not keep.all():
                rows, score, whole = rows[keep], score[keep], False
                if not len(rows):
                    break
        return rows, score


def blocks(batches, size: int = BLOCK_ROWS):
    """Arrow batches of (id, label, q) as blocks of about ``size`` rows."""
    def made(parts):
        width = max((int(np.diff(o).max()) for _, _, o, _ in parts if len(o) > 1), default=0)
        columns = np.zeros((width, sum(len(i) for i, *_ in parts)), np.int64)
        at = 0
        for ids, _, offsets, values in parts:
            n = np.diff(offsets)
            if (n == width).all():
                columns[:, at:at + len(ids)] = values.reshape(len(ids), width).T
            else:
                row = np.repeat(np.arange(len(ids)), n)
                columns[np.arange(len(values)) - np.repeat(offsets[:-1], n), at + row] = values
            at += len(ids)
        return Block(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), columns)

    parts, held = [], 0
    for b in batches:
        if b.num_rows:
            q = b.column(2)
            offsets = q.offsets.to_numpy().astype(np.int64)
            parts.append((b.column(0).to_numpy(), b.column(1).to_numpy(), offsets - offsets[0], q.flatten().to_numpy()))
            held += b.num_rows
            if held >= size:
                yield made(parts)
                parts, held = [], 0
    if parts:
        yield made(parts)


def _kth(x: np.ndarray, k: int) -> int:
    """The k-th largest of x, or a value below all if x has fewer."""
    return int(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else NOTHING


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.lexsort((ids, -scores))[:k]
    return scores[first], ids[first]


def _positive_rows(anchors: tuple, rule: Rule, size: int):
    """Each anchor's best rows of its label, of those in a task."""
    def run(batches):
        ids, labels, vectors = anchors
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
        for block in blocks(batches, size):
            of_label = {x: np.flatnonzero(block.labels == x) for x in np.unique(block.labels).tolist()}
            for n in range(len(ids)):
                rows = of_label.get(int(labels[n]))
                if rows is None:
                    continue
                rows = rows[block.ids[rows] != ids[n]]
                floor = [_kth(best[n][0], rule.positives)]
                def prune(low, high, floor=floor):
                    floor[0] = max(floor[0], _kth(low, rule.positives))
                    return high >= floor[0]
                rows, score = block.scan(vectors[n], rows, prune)
                best[n] = _best(np.concatenate([best[n][0], score]), np.concatenate([best[n][1], block.ids[rows]]), rule.positives)
        of = np.repeat(ids, [len(s) for s, _ in best])
        yield pa.RecordBatch.from_arrays([pa.array(of), *(pa.array(np.concatenate([b[k] for b in best] or [of])) for k in (1, 0))],
                                         names=["anchor_id", "positive_id", "positive_score"])
    return run


def _negative_rows(anchors: tuple, found: dict, rule: Rule, size: int):
    """For each anchor and positive the best rows of other labels in the positive's window, of those in a task."""
    def run(batches):
        ids, labels, vectors = anchors
        best: dict = {}
        for block in blocks(batches, size):
            unlike = {x: np.flatnonzero(block.labels != x) for x in np.unique(labels).tolist()}
            for n in range(len(ids)):
                p_ids, p_scores = found.get(int(ids[n]), ((), np.empty(0, np.int64)))
                low_ok, high_ok = rule.windows(np.asarray(p_scores))
                asked = [k for k in range(len(p_ids)) if low_ok[k] <= high_ok[k]]
                if not asked:
                    continue
                floor = {k: max(int(low_ok[k]), _kth(best[n, k][0], rule.negatives) if (n, k) in best else NOTHING) for k in asked}
                def prune(low, high):
                    keep = np.zeros(len(low), bool)
                    for k in asked:
                        sure = low[(low >= floor[k]) & (high <= high_ok[k])]
                        floor[k] = max(floor[k], _kth(sure, rule.negatives))
                        keep |= (high >= floor[k]) & (low <= high_ok[k])
                    return keep
                rows, score = block.scan(vectors[n], unlike[int(labels[n])], prune)
                for k in asked:
                    fits = (score >= low_ok[k]) & (score <= high_ok[k])
                    if fits.any():
                        s, i = best.get((n, k), (score[:0], score[:0]))
                        best[n, k] = _best(np.concatenate([s, score[fits]]), np.concatenate([i, block.ids[rows[fits]]]), rule.negatives)
        keys = list(best)
        sizes = [len(best[k][0]) for k in keys]
        of = [np.repeat(np.array([f(n, k) for n, k in keys], np.int64), sizes) for f in
              (lambda n, k: ids[n], lambda n, k: found[int(ids[n])][0][k], lambda n, k: found[int(ids[n])][1][k])]
        got = [np.concatenate([best[k][x] for k in keys] or [np.empty(0, np.int64)]) for x in (1, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (*of, *got)],
                                         names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def _top(df: DataFrame, keys: list[str], score: str, row_id: str, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(row_id))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _anchor_blocks(rows: DataFrame, is_anchor: Column, size: int):
    """Anchors as numpy arrays (ids, labels, padded vectors), ``size`` at a time in the order of their ids."""
    last = None
    while True:
        page = rows.where(is_anchor) if last is None else rows.where(is_anchor & (F.col("id") > F.lit(last)))
        t = page.orderBy("id").limit(size).toArrow()
        if t.num_rows:
            vectors = [np.asarray(v.values, dtype=np.int64) for v in t.column("q")]
            out = np.zeros((len(vectors), max(map(len, vectors))), np.int64)
            for n, v in enumerate(vectors):
                out[n, :len(v)] = v
            yield t.column("id").to_numpy(), t.column("label").to_numpy(), out
        if t.num_rows < size:
            return
        last = t.column("id")[-1].as_py()


def mine(df: DataFrame, is_anchor: Column | None = None, rule: Rule = Rule(), vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label", scale: int = 256, anchor_block: int = 8192, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id`` (default: divisible by
    100). The anchors are the query set; they are compared with all rows."""
    spark = df.sparkSession
    asked = is_anchor if is_anchor is not None else F.col("id") % 100 == 0
    rows = cut(integer_vectors(df, vec_id, vector, label, scale), "vectors")
    path = scratch_path(spark, "mined")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    pairs = ["anchor_id", "positive_id"]
    for anchors in _anchor_blocks(rows, asked, anchor_block):
        near = rows.mapInArrow(_positive_rows(anchors, rule, block_rows), "anchor_id long, positive_id long, positive_score long")
        # at most anchor_block * positives rows
        t = _top(near, pairs[:1], "positive_score", "positive_id", rule.positives).orderBy("anchor_id", "rank").toArrow()
        of, cuts = np.unique(t.column("anchor_id").to_numpy(), return_index=True)
        cuts = [*cuts.tolist(), t.num_rows]
        p_ids, p_scores = t.column("positive_id").to_numpy(), t.column("positive_score").to_numpy()
        found = {a: (p_ids[x:y], p_scores[x:y]) for a, x, y in zip(of.tolist(), cuts, cuts[1:])}
        hard = rows.mapInArrow(_negative_rows(anchors, found, rule, block_rows),
                               "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        best = _top(hard, pairs, "negative_score", "negative_id", rule.negatives)
        best.select(*pairs, "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
