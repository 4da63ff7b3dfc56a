"""Versioned mart overwrite and the serving reads (reference API fixtures)."""

import datetime as dt

from candlewick.plans import serving
from candlewick.sources.sinks import current_version, overwrite_mart, read_current


def stats(spark):
    now = dt.datetime(2025, 10, 10, 10, 10, 10)
    return spark.createDataFrame(
        [("KRW-BTC", 1000000.0, 10.0, "upbit", now, now), ("KRW-ETH", 500000.0, 50.0, "upbit", now, now)],
        "symbol string, acc_trade_price_24h double, acc_trade_volume_24h double, source string, "
        "ts_event timestamp, created_at timestamp")


def test_market_stats_reads(spark):
    rows, total = serving.market_stats_list(stats(spark))
    assert total.first()["count"] == 2 and rows.count() == 2
    rows, total = serving.market_stats_list(stats(spark), symbol="KRW-BTC")
    assert total.first()["count"] == 1
    eth = serving.market_stats_detail(stats(spark), "KRW-ETH").first()
    assert str(eth["acc_trade_price_24h"]) == "500000.00000000"
    assert serving.market_stats_detail(stats(spark), "KRW-DOGE").isEmpty()        # not found


def test_realtime_price(spark):
    snap = spark.createDataFrame([("KRW-BTC", 999999.0, dt.datetime(2025, 10, 10, 10, 10, 10))],
                                 "symbol string, price double, ts timestamp")
    r = serving.realtime_price(snap, "KRW-BTC").first()
    assert r["price"] == 999999.0 and r["symbol"] == "KRW-BTC"
    assert serving.realtime_price(snap, "KRW-ETH").isEmpty()


def test_versioned_overwrite_keeps_old_on_empty(spark, tmp_dir):
    path = tmp_dir + "/mart"
    v1 = overwrite_mart(stats(spark), path, version=1)
    assert current_version(spark, path) == "1" and read_current(spark, path).count() == 2
    assert overwrite_mart(stats(spark).limit(0), path, version=2) is None           # empty input: no write
    assert current_version(spark, path) == v1
    overwrite_mart(stats(spark).where("symbol = 'KRW-BTC'"), path, version=3)
    assert read_current(spark, path).count() == 1


def test_rewritten_version_without_rows_keeps_the_mart(spark, tmp_dir):
    path = tmp_dir + "/mart"
    overwrite_mart(stats(spark), path, version=1)
    assert overwrite_mart(stats(spark).limit(0), path, version=1) is None
    assert overwrite_mart(stats(spark).where("symbol = 'none'"), path, version=1, unique=["symbol"]) is None
    assert read_current(spark, path).count() == 2
    assert overwrite_mart(stats(spark).where("symbol = 'KRW-BTC'"), path, version=1) == "1"       # a replay with other rows
    assert read_current(spark, path).count() == 1
    assert overwrite_mart(stats(spark).limit(0), path, version=2, require_rows=False) == "2" and read_current(spark, path).count() == 0


def test_repeated_keys_keep_the_mart(spark, tmp_dir):
    import os

    import pytest
    path = tmp_dir + "/mart"
    overwrite_mart(stats(spark), path, version=1, unique=["symbol"])
    twice = stats(spark).unionByName(stats(spark)).selectExpr("*", "source AS _again")
    with pytest.raises(ValueError, match="2 values of symbol"):
        overwrite_mart(twice, path, version=2, unique=["symbol"])
    assert current_version(spark, path) == "1" and read_current(spark, path).count() == 2
    assert len([n for n in os.listdir(path) if n.startswith("v=")]) == 1                         # nothing is left behind
    assert overwrite_mart(twice, path, version=3, unique=()) == "3"


def test_old_versions_are_dropped(spark, tmp_dir):
    import os
    path = tmp_dir + "/mart"
    for n in range(5):
        overwrite_mart(stats(spark), path, version=f"day/{n}", keep=2)
    assert current_version(spark, path) == "day_4" and len([n for n in os.listdir(path) if n.startswith("v=")]) == 2
