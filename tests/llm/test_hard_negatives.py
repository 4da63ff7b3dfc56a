"""Vertical scan against plain integer arithmetic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import hard_negatives as H
from candlewick.llm.queries import op13_hard_negatives
from tests.llm.helpers import SF001, rows

VEC = "vec_id long, embedding array<float>, label int"


def brute(data, scale=256, rule=H.Rule()):
    kept = {}
    for i, v, label in data:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) or abs(x) > H.LIMIT / scale for x in v):
            continue
        q = [int(np.floor(scale * float(x))) for x in v]
        kept[i] = min(kept.get(i, (label, q)), (label, q))
    def score(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, q) in kept.items():
        if a % 100:
            continue
        ranked = sorted(((-score(q, v), i, l) for i, (l, v) in kept.items() if i != a))
        for s, p, _ in [r for r in ranked if r[2] == label][:rule.positives]:
            fit = [(i, -n) for n, i, l in ranked if l != label and rule.low * -s <= 100 * -n <= rule.high * -s][:rule.negatives]
            out += [(a, p, k + 1, i, -s, n) for k, (i, n) in enumerate(fit)]
    return sorted(out, key=repr)


def table(spark, data):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in data], VEC)


def f4(v):
    return [float(np.float32(x)) for x in v]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    out = [(i, f4(rng.normal(0, 0.2, 16)), int(rng.integers(0, 4))) for i in range(0, 700)]
    common = f4(rng.normal(0, 0.2, 16))                                   # one vector for a third of the rows: ties
    return [(i, common if i % 3 == 0 else v, label) for i, v, label in out]


def test_equals_brute_force_at_any_block_size(spark, data):
    want = brute(data)
    assert want
    for anchors, size in ((3, 64), (8192, 16_384)):
        assert rows(H.mine(table(spark, data).repartition(3), anchor_block=anchors, block_rows=size)) == want


def test_odd_rows(spark, data):
    odd = data[:150] + [
        (None, [0.1] * 16, 1), (800, None, 1), (801, [0.1] * 16, None), (802, [0.1, None], 1), (803, [float("nan")] * 16, 1), (804, [float("inf")], 2),
        (900, [], 1), (901, [0.5, 0.25], 2), (1000, [0.1] * 20, 1), (200, [0.2] * 16, 1), (200, [0.1] * 16, 1), (200, [0.1] * 16, 3), (300, [1e9] * 16, 1)]
    df = table(spark, odd).withColumn("rank", F.lit("x")).withColumn("id", F.lit(1)).withColumn("q", F.lit(2))
    assert rows(H.mine(df)) == brute([(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v], y) for i, v, y in odd])
    empty = H.mine(spark.createDataFrame([], VEC))
    assert empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and empty.count() == 0


def test_query(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in emb])
    assert rows(op13_hard_negatives(spark, SF001)) == want


def test_pruning_keeps_every_possible_row():
    rng = np.random.default_rng(4)
    block = H.Block(np.arange(500), np.zeros(500), rng.integers(-300, 300, (24, 500)))
    anchor = rng.integers(-300, 300, 24)
    full = anchor @ block.columns
    best = np.sort(full)[-3]
    got, score = block.scan(anchor, np.arange(500), lambda low, high: high >= best)
    assert (score == full[got]).all() and set(np.flatnonzero(full >= best)) <= set(got.tolist()) and len(got) == 3
