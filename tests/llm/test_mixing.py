import itertools

import numpy as np

from candlewick.llm import mixing, queries
from tests.llm.helpers import SF001, empty_docs, odd_docs, rows


def brute_targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(size.values()), set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * size[s]
            left -= 2 * size[s]
        open_ -= over
    return out


def test_query_contract(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    out = queries.op3_mixing(spark, SF001).toPandas()
    assert sorted(out.doc_id) == sorted(docs)
    size = {}
    for r in out.itertuples():
        assert r.size == len([x for x in __import__("re").split(r"[\x20\x09-\x0D]+", docs[r.doc_id].text or "") if x])
        size[docs[r.doc_id].source] = size.get(docs[r.doc_id].source, 0) + r.size
    want = brute_targets(size)
    for s, g in out.groupby("source"):
        assert (g.source_size == size[s]).all() and np.allclose(g.target, want[s], rtol=1e-9)
        assert abs(g.taken.sum() - want[s]) <= max(1.0, 0.01 * want[s])
    assert (out.taken % out["size"].clip(lower=1) == 0).all() and (out.taken <= 2 * out["size"]).all()
    again = queries.op3_mixing(spark, SF001).toPandas()
    assert again.sort_values("doc_id").reset_index(drop=True).equals(out.sort_values("doc_id").reset_index(drop=True))


def test_fit_is_the_best_subset_sum():
    rng = np.random.default_rng(3)
    for _ in range(40):
        length = rng.permutation(np.arange(0, 12))[:5]
        count = rng.integers(0, 4, 5)
        for budget in range(0, int((length * count).sum()) + 2, 3):
            take = mixing.fit_lengths(length, count, budget)
            assert (take >= 0).all() and (take <= count).all()
            sums = {sum(int(a) * int(b) for a, b in zip(length, c)) for c in itertools.product(*[range(n + 1) for n in count])}
            assert int((take * length).sum()) == min(sums, key=lambda s: (abs(s - budget), s))


def test_large_counts_meet_the_budget():
    length, count = np.arange(1, 3000), np.full(2999, 1000)
    for budget in (1, 10**6 + 1, 3_333_333_333):
        assert int((mixing.fit_lengths(length, count, budget) * length).sum()) == budget


def test_odd_rows_and_copies(spark):
    d = odd_docs(spark)
    out = rows(mixing.mix(d))
    assert len(out) == d.count()
    assert all(t <= 2 * z for _, _, z, _, _, t in out)
    sizes = {}
    for _, s, z, _, _, _ in out:
        sizes[s] = sizes.get(s, 0) + z
    assert {(s, n) for _, s, _, n, _, _ in out} == set(sizes.items())
    hot = spark.range(3000).selectExpr("id as doc_id", "'one two three' as text", "if(id % 3 = 0, 'b', 'a') as source")
    a = mixing.mix(hot).toPandas()
    for s, g in a.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 3


def test_empty_table(spark):
    assert mixing.mix(empty_docs(spark)).count() == 0
