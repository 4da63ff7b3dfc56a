"""Landing sources, sinks, filters and ordering helpers."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from candlewick.operators.filters import drop_incomplete, in_list, lookback, search
from candlewick.operators.ordering import head, paginate, tail, top_k
from candlewick.plans.ingest import krw_markets
from candlewick.sources.landing import (land_batch, read_landing, read_sentiment_landing, sentiment_from_landing,
                                        union_history)
from candlewick.sources.sinks import append_landing, conform, ensure_table
from candlewick.streaming.hot_path import refresh_on_landing


def test_land_batch_plain_and_wrapped(spark):
    docs = spark.createDataFrame([(json.dumps([{"market": "KRW-BTC", "b": 1, "a": 2}, {"market": "BTC-ETH"}]),),
                                  (json.dumps({"data": [{"value": "40", "value_classification": "Fear",
                                                         "timestamp": "1700000000"}]}),)], "value string")
    plain = land_batch(docs.limit(1), "/v1/ticker", ingested_at=F.lit(None).cast("timestamp"))
    rows = plain.collect()
    assert len(rows) == 2 and rows[0]["payload"] == '{"a":2,"b":1,"market":"KRW-BTC"}'   # keys normalized
    assert krw_markets(plain).count() == 1
    wrapped = land_batch(docs.where(F.col("value").startswith("{")), "fng", items_path="$.data")
    assert wrapped.count() == 1


def test_sentiment_landing_and_append(spark, tmp_dir):
    land = spark.createDataFrame([('{"value": "40", "value_classification": "Fear"}', "Fear",
                                   dt.datetime(2024, 1, 2, 0, 0))], "payload string, value_classification string, timestamp timestamp")
    r = sentiment_from_landing(land).first()
    assert r["fng_value"] == 40 and str(r["date"]) == "2024-01-02"
    path = os.path.join(tmp_dir, "landing")
    rows = spark.createDataFrame([("{}", "/v1/ticker", dt.datetime(2024, 1, 1)), ("{}", "/v1/x", dt.datetime(2024, 1, 2))],
                                 "payload string, endpoint string, ingested_at timestamp")
    append_landing(rows, path)
    append_landing(rows, path)
    assert read_landing(spark, path, "/v1/ticker").count() == 2
    assert read_landing(spark, path, "/v1/ticker").rdd.getNumPartitions() >= 1
    land.write.parquet(os.path.join(tmp_dir, "fng"))
    assert read_sentiment_landing(spark, os.path.join(tmp_dir, "fng")).count() == 1


def test_filters(spark):
    df = spark.createDataFrame([("KRW-BTC", 1, dt.datetime(2024, 1, 10)), ("krw-eth", None, dt.datetime(2023, 1, 1))],
                               "symbol string, x int, ts timestamp")
    assert search(df, "symbol", "krw BTC").count() == 1
    assert drop_incomplete(df).count() == 1
    assert lookback(df, "ts", 30, as_of="2024-01-20 00:00:00").count() == 1
    many = [f"S{i}" for i in range(2000)] + ["KRW-BTC"]
    assert in_list(df, "symbol", many).count() == 1                          # long list: semi join
    assert in_list(df, "symbol", ["krw-eth"]).count() == 1


def test_ordering(spark):
    df = spark.range(10).withColumn("v", F.col("id") % 3)
    rows, total = paginate(df, ["-v", "id"], page=2, size=4)
    assert total.first()["count"] == 10 and [r["id"] for r in rows.collect()] == [4, 7, 0, 3]
    assert [r["id"] for r in top_k(df, 2, "-id").collect()] == [9, 8]
    assert [r["id"] for r in head(df, 2, "id").collect()] == [0, 1]
    assert [r["id"] for r in tail(df, 2, "id").collect()] == [8, 9]


def test_union_conform_and_table(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    u = union_history(a, b)
    assert u.count() == 2
    c = conform(u, spark.createDataFrame([], "s string, k long").schema)
    assert c.columns == ["s", "k"] and dict(c.dtypes)["k"] == "bigint"
    ensure_table(spark, "cw_trend_test", "symbol string, trend_score int", os.path.join(tmp_dir, "tbl"))
    ensure_table(spark, "cw_trend_test", "symbol string, trend_score int", os.path.join(tmp_dir, "tbl"))
    assert spark.table("cw_trend_test").columns == ["symbol", "trend_score"]


def test_refresh_on_landing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "land")
    spark.createDataFrame([("{}", "/v1/ticker", dt.datetime(2024, 1, 1))],
                          "payload string, endpoint string, ingested_at timestamp").write.parquet(src)
    seen = []
    refresh_on_landing(spark, src, "payload string, endpoint string, ingested_at timestamp",
                       lambda df, i: seen.append(df.count()), os.path.join(tmp_dir, "ck"))
    assert seen == [1]
