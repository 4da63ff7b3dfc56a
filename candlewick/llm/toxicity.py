"""Toxicity by cumulative-link ordinal regression on sparse word features.

P(grade > k) = sigmoid(w . x - theta_k) with one weight vector for all
thresholds; the output is the grade, the expected severity and P(toxic).
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alnum_words, annotate, map_rows, text_bytes
from .common import cut as written

#: Severity grades: 0 none, then toxic with rising amounts of evidence.
GRADES = 4


def signs(raw: bytes | None) -> Counter:
    """Counts of the words and, marked by ``^``, of the first four bytes of
    those that have as many: rare forms of a telling stem share its prefix."""
    out = Counter(alnum_words(raw))
    stems: Counter = Counter()
    for w, n in out.items():
        if len(w) >= 4:
            stems[b"^" + w[:4]] += n
    out.update(stems)
    return out


@dataclass(frozen=True)
class OrdinalModel:
    """Weight of log(1 + count) for each word; rising thresholds."""

    words: tuple[bytes, ...]
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5

    def make(self):
        """A function text -> (grade, expected severity, P(toxic), toxic)."""
        value = dict(zip(self.words, self.weights.tolist()))
        theta, cut = self.thresholds, self.cut

        def judge(raw: bytes | None) -> tuple[int, float, float, bool]:
            found = signs(raw)
            s = sum(value[w] * math.log1p(found[w]) for w in sorted(value.keys() & found.keys()))
            above = 1.0 / (1.0 + np.exp(np.clip(theta - s, -500, 500)))     # P(grade > k)
            toxic = bool(above[0] >= cut)
            return max(1, int((above >= 0.5).sum())) if toxic else 0, float(above.sum()), float(above[0]), toxic
        return judge


def _word_counts(batches):
    for b in batches:
        ids, toxic, words, counts = [], [], [], []
        for i, t, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            for w, n in signs(raw).items():
                ids.append(i), toxic.append(t), words.append(w), counts.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(toxic, pa.int64()), pa.array(words, pa.binary()), pa.array(counts, pa.int64())],
                                         names=["row", "toxic", "word", "n"])


def _solve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, grades: int, l2: float = 1e-5, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Cumulative-link fit by Adam on the weighted mean log-likelihood."""
    k = grades - 1
    w = np.zeros(x.shape[1])
    share = np.array([(weight * (y > j)).sum() / weight.sum() for j in range(k)])
    theta = -np.log(np.clip(share, 1e-4, 1 - 1e-4) / (1 - np.clip(share, 1e-4, 1 - 1e-4)))
    gaps = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 0.05))])          # rising by construction
    par = np.concatenate([w, gaps])
    m, v = np.zeros_like(par), np.zeros_like(par)
    rows = np.arange(len(y))
    for t in range(1, steps + 1):
        w, th = par[:-k], np.cumsum(np.concatenate([par[-k:-k + 1] if k > 1 else par[-1:], np.exp(par[len(par) - k + 1:])]))
        s = x @ w
        f = 1.0 / (1.0 + np.exp(np.clip(-(th[None, :] - s[:, None]), -500, 500)))         # P(grade <= j)
        cum = np.concatenate([np.zeros((len(y), 1)), f, np.ones((len(y), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(y), 1)), f * (1 - f), np.zeros((len(y), 1))], axis=1)
        p = np.maximum(cum[rows, y + 1] - cum[rows, y], 1e-12)
        c = weight / weight.sum() / p
        gs = c * (slope[rows, y + 1] - slope[rows, y])                                    # d(-log p)/ds
        gw = x.T @ gs + l2 * w
        gt = np.zeros((len(y), k + 2))
        gt[rows, y + 1] -= c * slope[rows, y + 1]
        gt[rows, y] += c * slope[rows, y]
        gt = gt[:, 1:-1].sum(axis=0)
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, tail[:1], tail[1:] * np.exp(par[len(par) - k + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return par[:-k], np.cumsum(np.concatenate([par[-k:-k + 1] if k > 1 else par[-1:], np.exp(par[len(par) - k + 1:])]))


def _best_cut(logit: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The probability that parts the sample with the least weighted error, in
    the middle of the widest gap where several do."""
    values, at = np.unique(logit, return_inverse=True)
    if len(values) < 2:
        return 0.5
    bad = np.bincount(at, weight * toxic, len(values))
    good = np.bincount(at, weight * ~toxic, len(values))
    error = np.cumsum(bad)[:-1] + good.sum() - np.cumsum(good)[:-1]         # cutting above values[i]
    gap = np.where(error <= error.min() + 1e-9, np.diff(values), -1.0)
    i = int(np.argmax(gap))
    return float(1.0 / (1.0 + np.exp(-(values[i] + values[i + 1]) / 2)))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic",
        max_per_class: int = 4_000, max_words: int = 500, min_documents: int = 5, min_evidence: float = 24.0, least: float = 0.1) -> OrdinalModel:
    """Fit on a bounded sample: ``max_per_class`` labelled documents of each
    class, those with the smallest ``xxhash64(doc_id)`` modulo 2**40, weighted
    back to their class's share.

    Words (and word beginnings, see ``signs``) enter when at least ``min_documents`` sampled texts hold them and
    their log-likelihood ratio against the label reaches ``min_evidence``; the
    ``max_words`` strongest are fitted. Words that merely ride along (with
    copies of toxic texts, say) get small weights: those under ``least`` of
    the largest are dropped and the others refitted. Grades: 0 for labels 0;
    toxic documents are cut into thirds by their amount of evidence words (1,
    2, 3; without any evidence 1). Labels with NULL id or value are left out, several labels of
    an id count as the largest; without both classes nothing is toxic.
    """
    spark = docs.sparkSession
    lab = (labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{toxic}`").cast("int").alias("toxic")).dropna()
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("toxic", (F.col("toxic") > 0).cast("long")))
    ids = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).join(lab, "doc_id").distinct()
    size = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = OrdinalModel((), np.zeros(0), np.full(GRADES - 1, 30.0))
    if len(size) < 2:
        return none
    # Ids beyond about twice the bound in hash order go before the ranking, whatever the number of tasks.
    hashed, parts = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), 1 << 40
    edge = {t: min(parts, 1 + 2 * max_per_class * parts // n) for t, n in size.items()}
    near = ids.where(hashed < F.when(F.col("toxic") == 1, F.lit(edge[1])).otherwise(F.lit(edge[0])))
    w = Window.partitionBy("toxic").orderBy(hashed, "doc_id")
    ranked = near.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_per_class).select("doc_id", "toxic")
    chosen = ranked.collect()                                # 2 x max_per_class ids
    small = F.broadcast(spark.createDataFrame(chosen, ranked.schema))
    sample = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_bytes(docs, text).alias("raw")).join(small, "doc_id")
    # A row is a distinct text: copies would make their words look telling.
    sample = sample.groupBy(F.md5("raw").alias("row"), "toxic").agg(F.min("raw").alias("raw")).select("row", "toxic", "raw")
    counts = map_rows(sample, _word_counts, "row string, toxic long, word binary, n long")
    counts = written(counts, "toxic-words")
    total = {r["toxic"]: r["n"] for r in counts.select("row", "toxic").distinct().groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return none
    n1, n0 = total[1], total[0]
    a, b = F.col("a"), F.col("b")
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    n = n1 + n0
    per = counts.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where(a + b >= min_documents)
    df = a + b
    g2 = 2 * (term(a, df * n1 / n) + term(b, df * n0 / n) + term(n1 - a, (n - df) * n1 / n) + term(n0 - b, (n - df) * n0 / n))
    top = (per.withColumn("g2", g2).where(F.col("g2") >= min_evidence).orderBy(F.col("g2").desc(), "word").limit(max_words)
           .withColumn("positive", a / n1 > b / n0).collect())
    if not top:
        return none
    words = tuple(bytes(r["word"]) for r in top)
    at = {x: i for i, x in enumerate(words)}
    positive = np.array([r["positive"] for r in top])
    vocab = F.broadcast(spark.createDataFrame([(bytearray(x),) for x in words], "word binary"))
    held = counts.join(vocab, "word").groupBy("row", "toxic").agg(F.collect_list(F.struct("word", "n")).alias("hits"))
    rows = counts.select("row", "toxic").distinct().join(held, ["row", "toxic"], "left").orderBy("row", "toxic").collect()  # at most 2 x max_per_class rows
    x = np.zeros((len(rows), len(words)))
    for i, r in enumerate(rows):
        for h in r["hits"] or ():
            x[i, at[bytes(h["word"])]] = np.log1p(h["n"])
    is_toxic = np.array([r["toxic"] for r in rows])
    weight = np.where(is_toxic == 1, size[1] / n1, size[0] / n0)
    keep = positive                                          # first guess at the evidence: every word that leans to toxic
    for _ in range(2):
        amount = np.expm1(x[:, keep]).sum(axis=1)
        told = amount[(is_toxic == 1) & (amount > 0)]
        edges = np.quantile(told, [1 / 3, 2 / 3]) if len(told) else np.array([1.0, 1.0])
        y = np.where(is_toxic == 1, 1 + np.searchsorted(edges, amount, side="right") * (amount > 0), 0)
        fitted, theta = _solve(x, y, weight, GRADES)
        strong = np.abs(fitted) >= least * np.abs(fitted).max()
        words, x, fitted = tuple(w for w, k in zip(words, strong) if k), x[:, strong], fitted[strong]
        keep = fitted > 0
    fitted, theta = _solve(x, y, weight, GRADES)
    return OrdinalModel(words, fitted, theta, _best_cut(x @ fitted - theta[0], is_toxic == 1, weight))


def grade(docs: DataFrame, model: OrdinalModel, text: str = "text",
          names: tuple[str, str, str, str] = ("grade", "expected_severity", "p_toxic", "toxic")) -> DataFrame:
    """``docs`` plus severity grade, expected severity (sum over k of
    P(grade > k)), P(grade > 0) and whether that reaches the model's cut (the
    grade is 0 exactly where it does not).

    The whole text is read. NULL and empty texts have no features and get the
    base rate. Rows are judged one by one; other columns pass through.
    """
    return annotate(docs, text, model.make, [(names[0], T.LongType()), (names[1], T.DoubleType()), (names[2], T.DoubleType()), (names[3], T.BooleanType())])
