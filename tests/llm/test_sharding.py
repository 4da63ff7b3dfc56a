"""Minimax partition against a plain search over all groups."""

import os
import zlib

import pytest
from pyspark.sql import functions as F

from candlewick.llm import sharding as S
from candlewick.llm.queries import op11_sharding
from tests.llm.helpers import DOC, ODD, SF001, empty_docs, odd_docs


def minimax(sizes, n):
    """Smallest largest sum of n contiguous runs, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(n):
        new = [0] + [float("inf")] * len(sizes)
        for j in range(1, len(sizes) + 1):
            run = 0
            for i in range(j - 1, -1, -1):
                run += sizes[i]
                if run >= new[j]:
                    break
                new[j] = min(new[j], max(best[i], run))
        best = new
    return best[-1]


def group_table(docs):
    g = docs.select(S.key_of().alias("key"), S.size_of().alias("size")).groupBy("key").agg(F.sum("size").alias("size")).collect()
    return dict(sorted((r["key"], r["size"]) for r in g))


def check(docs, made, shards):
    groups = group_table(docs)
    heavy, left = [], sum(groups.values())
    for k, v in sorted(groups.items(), key=lambda x: (-x[1], x[0])):
        if v * (shards - len(heavy)) <= left or len(heavy) == shards - 1:
            break
        heavy.append(k)
        left -= v
    assert list(made.heavy) == heavy
    light = [v for k, v in groups.items() if k not in heavy]
    want = minimax(light, shards - len(heavy)) if light else 0
    got = S.assign(docs, made).select(S.key_of().alias("key"), S.size_of().alias("size"), F.col(S.assign(docs, made).columns[-1]).alias("s")).collect()
    per, of = {}, {}
    for r in got:
        per[r["s"]] = per.get(r["s"], 0) + r["size"]
        of.setdefault(r["key"], set()).add(r["s"])
    assert all(len(x) == 1 for x in of.values()) and all(0 <= s < shards for s in per)
    assert max([v for s, v in per.items() if s >= len(heavy)], default=0) == want
    runs = [next(iter(of[k])) for k in groups if k not in heavy]
    assert runs == sorted(runs)
    return per


@pytest.mark.parametrize("shards", [1, 2, 5, 16, 300])
def test_capacity_is_the_least(spark, shards):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    check(docs, S.fit(docs, shards), shards)


def test_ranges_are_split_until_exact(spark, monkeypatch):
    monkeypatch.setattr(S, "FIRST_BITS", 3)
    monkeypatch.setattr(S, "SPLIT_BITS", 2)
    monkeypatch.setattr(S, "FETCH_GROUPS", 3)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    check(docs, S.fit(docs, 16), 16)


def test_hot_group_gets_its_own_shard_and_the_rest_stay_even(spark):
    docs = spark.createDataFrame([(i, "the same text" * 9 if i % 3 == 0 else f"text {i}", "en", "a", 0) for i in range(900)], DOC)
    made = S.fit(docs, 8)
    per = check(docs, made, 8)
    assert len(made.heavy) == 1 and max(v for s, v in per.items() if s) < 1.1 * min(v for s, v in per.items() if s)


def test_odd_rows_and_columns(spark):
    docs = odd_docs(spark).withColumn("shard", F.lit("mine")).withColumn("slot", F.lit(1)).withColumn("key", F.lit(2)).withColumn("place", F.lit(3))
    out = S.place_documents(docs, 4).collect()
    assert len(out) == len(ODD)
    want = sorted(((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in ODD), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=repr) == want
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in out)
    for s in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    check(docs.drop("shard"), S.fit(docs, 4), 4)
    kept = S.assign(docs, S.fit(docs, 4))
    assert kept.columns == [*docs.columns, "_shard"] and {r["shard"] for r in kept.collect()} == {"mine"}
    assert S.place_documents(empty_docs(spark), 4).collect() == []


def test_query_and_files(spark, tmp_path):
    out = op11_sharding(spark, SF001)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    made = S.fit(docs, 16)
    S.write(docs, made, os.path.join(str(tmp_path), "out"))
    back = spark.read.parquet(os.path.join(str(tmp_path), "out"))
    assert sorted(r["doc_id"] for r in back.collect()) == sorted(r["doc_id"] for r in docs.collect())
    assert {(r["doc_id"], r["shard"]) for r in out.collect()} == {(r["doc_id"], r["shard"]) for r in back.collect()}
