import random

import numpy as np
import xxhash

from candlewick.llm import queries, simhash
from candlewick.llm.components import components
from tests.llm.helpers import DOC, SF001, empty_docs, odd_docs, rows


def brute_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, bits=3):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    fps = [brute_fingerprint(r.text) for r in docs]
    comp = brute_components(fps, [r.doc_id for r in docs])
    want = sorted((r.doc_id, f"{f:016x}", c) for r, f, c in zip(docs, fps, comp))
    assert sorted(map(tuple, queries.op10_simhash(spark, SF001).collect())) == want


def test_chains_and_hot_buckets(spark, monkeypatch):
    """Near copies by the hundred around one value, in chunks of few rows."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rnd = random.Random(5)
    base, fps = rnd.getrandbits(64), set()
    for _ in range(150):
        base ^= 1 << rnd.randrange(64)
        fps.add(base)
        fps.add(base ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    fps |= {rnd.getrandbits(64) for _ in range(100)} | {0, 1, 7, 15, 2**64 - 1}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    root = {int(np.int64(r.node).astype(np.uint64)): int(np.int64(r.root).astype(np.uint64)) for r in components(simhash.links(df)).collect()}
    got = [root.get(x, x) for x in fps]
    want = brute_components(fps, list(range(len(fps))))
    groups = lambda labels: sorted(sorted(i for i, y in enumerate(labels) if y == x) for x in set(labels))
    assert groups(got) == groups(want)


def test_block_masks_hold_the_pigeonhole():
    masks = [np.int64(m).astype(np.uint64) for m in simhash.block_masks(6, 3)]
    rnd = random.Random(1)
    for _ in range(300):
        flips = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(int(m) & flips == 0 for m in masks)
    assert len(masks) == 20


def test_odd_rows(spark):
    d = odd_docs(spark)
    out = {}
    for i, f, c in rows(simhash.near_duplicates(d)):
        out.setdefault(i, []).append((f, c))
    assert len(out[4]) == 2 and out[4] == [out[5][0]] * 2 and out[5][0][1] == 4
    assert out[1] == out[2] == out[3] == [(0, 1)]
    assert out[None][0][1] is None and len(out) == 9
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (True, 1), (True, 4), (True, 6), (True, 7), (True, 8)]


def test_absent_and_repeated_ids_lose_no_text(spark):
    absent = spark.createDataFrame([(None, "first text of its own kind"), (None, "quite another matter altogether here"), (None, "third thing, unlike both others")], "doc_id long, text string")
    assert simhash.keep_one(absent).count() == 3
    twice = spark.createDataFrame([(1, "text A of some words that stand here"), (2, "another B with words that differ much"), (2, "text A of some words that stand here")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[:6]) for r in simhash.keep_one(twice).collect()) == [(1, "text A"), (2, "anothe")]


def test_columns_of_any_name_and_type_come_out_as_they_were(spark):
    from pyspark.sql import functions as F
    d = spark.createDataFrame([(i, f"text number {i // 2} with words {i // 2} of its own {i // 2}") for i in range(8)], "doc_id long, text string")
    d = (d.withColumn("_rn", F.col("doc_id") + 100).withColumn("_kept_id", F.lit("k")).withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id")))
         .withColumn("row_number", F.col("doc_id") * 2).withColumn("at", F.lit("x")).withColumn("component_id", F.lit(None).cast("int")))
    out = {r.doc_id: r for r in simhash.keep_one(d).collect()}
    assert sorted(out) == [0, 2, 4, 6]
    assert all(out[r.doc_id] == r for r in d.collect() if r.doc_id in out)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    assert simhash.keep_one(empty_docs(spark)).columns == [c.split()[0] for c in DOC.split(", ")]


def test_components_do_not_end_unfinished(spark):
    import pytest

    from candlewick.llm.components import components
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(chain, max_rounds=1)
    assert {tuple(r) for r in components(chain).collect()} == {(i, 0) for i in range(1, 41)}
