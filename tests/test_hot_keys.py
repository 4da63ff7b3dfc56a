"""Hot keys: cutting every key into small chunks leaves every result unchanged."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["trend_report", "feature_mart", "macd", "rsi_strict", "ma_cross_events", "atr", "roc_lag_features"]


def rows(spark, name):
    df = E.queries()[name](spark, SF)
    out = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(out, key=lambda t: tuple((v is None, "" if v is None else str(v)) for v in t))


@pytest.mark.parametrize("name", NAMES)
def test_small_chunks_same_result(spark, name):
    base = rows(spark, name)
    spark.conf.set("spark.candlewick.chunkRows", "150")
    try:
        hot = rows(spark, name)
    finally:
        spark.conf.unset("spark.candlewick.chunkRows")
    assert hot == base
