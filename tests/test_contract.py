"""Contract rules: one accepted and one rejected message per rule."""

import json
import re

import pytest
from pyspark.sql import functions as F

from candlewick.functions.timestamps import epoch_ms_to_ts_seconds, epoch_s_to_ts, smart_timestamp, weekday_name
from candlewick.operators import contract as C
from candlewick.streaming.hot_path import parse_stream, route_by_type

TRADE_WIRE = {"type": "trade", "code": "KRW-BTC", "trade_price": 100.5, "trade_volume": 2.0, "ask_bid": "BID",
              "trade_timestamp": 1700000000123}
TRADE_CANON = {"type": "trade", "symbol": "KRW-BTC", "trade_price": 100.5, "trade_volume": 2.0, "side": "ASK",
               "timestamp": "2023-11-14T22:13:20.123Z"}
TICKER = {"type": "ticker", "code": "KRW-ETH", "opening_price": 1.0, "high_price": 2.0, "low_price": 0.5,
          "trade_price": 1.5, "change": "RISE", "change_price": 0.5, "signed_change_rate": 0.5,
          "acc_trade_volume_24h": 10.0, "timestamp": "1700000000123"}
BOOK = {"type": "orderbook", "code": "KRW-XRP", "total_ask_size": 1.0, "total_bid_size": 2.0,
        "orderbook_units": [{"ask_price": 1.0, "bid_price": 0.9, "ask_size": 3.0, "bid_size": 4.0}],
        "timestamp": 1700000000123}


def check(spark, msgs):
    rows = [(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(msgs)]
    df = spark.createDataFrame(rows, "offset long, value string").withColumn("topic", F.lit("t")) \
              .withColumn("partition", F.lit(0))
    return {r["offset"]: r for r in parse_stream(df).collect()}


def with_(base, **kw):
    d = dict(base)
    for k, v in kw.items():
        if v is None:
            d.pop(k, None)
        else:
            d[k] = v
    return d


def test_accepted(spark):
    out = check(spark, [TRADE_WIRE, TRADE_CANON, TICKER, BOOK, with_(TRADE_WIRE, trade_price="12.5")])
    assert all(r["errors"] == [] for r in out.values())
    assert out[0]["trade"]["symbol"] == "KRW-BTC" and out[0]["trade"]["side"] == "BID"
    assert out[1]["trade"]["side"] == "ASK"
    assert out[0]["trade"]["timestamp"] == out[1]["trade"]["timestamp"]      # ms and ISO agree, ms kept
    assert out[2]["ticker"]["open_price"] == 1.0                              # alias -> canonical
    assert out[3]["orderbook"]["orderbook_units"][0]["bid_size"] == 4.0
    assert out[4]["trade"]["trade_price"] == 12.5                             # numeric text accepted


@pytest.mark.parametrize("msg,reason", [
    (with_(TRADE_WIRE, trade_price=None), "trade_price: required"),
    (with_(TRADE_WIRE, code=123), "symbol: invalid str"),
    (with_(TRADE_WIRE, ask_bid="SELL"), "side: invalid enum"),
    (with_(TRADE_WIRE, trade_price="abc"), "trade_price: invalid float"),
    (with_(TICKER, change="UP"), "change: invalid enum"),
    (with_(TICKER, timestamp="not a time"), "timestamp: invalid ts"),
    (with_(BOOK, orderbook_units=[{"ask_price": 1.0}]), "orderbook_units: invalid levels"),
    ('{"type": "trade", "code": ', "malformed json"),
])
def test_rejected(spark, msg, reason):
    r = check(spark, [msg])[0]
    assert r["errors"][0] == reason


def test_unknown_type_skipped(spark):
    r = check(spark, [{"type": "candle", "code": "X"}])[0]
    assert r["errors"] == [] and r["trade"] is None and r["ticker"] is None


def test_route_by_type(spark):
    df = spark.createDataFrame([(0, json.dumps(TRADE_WIRE)), (1, json.dumps(TICKER))], "offset long, value string") \
              .withColumn("topic", F.lit("in")).withColumn("partition", F.lit(0))
    out = {r["topic"]: r for r in route_by_type(parse_stream(df)).collect()}
    assert set(out) == {"upbit-trades", "upbit-tickers"}
    assert json.loads(out["upbit-trades"]["value"])["symbol"] == "KRW-BTC"     # canonical names out


def test_time_functions(spark):
    r = spark.createDataFrame([("1700000000999", 1700000000999, "1700000000", None)], "a string, b long, s string, n string") \
             .select(smart_timestamp("a").alias("a"), smart_timestamp(F.lit("2023-11-14T22:13:20.999+09:00")).alias("iso"),
                     epoch_ms_to_ts_seconds("b").alias("sec"), epoch_s_to_ts("s").alias("es"),
                     epoch_s_to_ts("n").alias("zero"), weekday_name(F.weekday(F.lit("2024-01-01").cast("date"))).alias("wd"),
                     F.unix_millis(smart_timestamp("a")).alias("ms")).first()
    assert r["ms"] == 1700000000999
    assert r["sec"].microsecond == 0                                         # integer division drops the fraction
    assert str(r["zero"]).startswith("1970-01-01")
    assert r["wd"] == "Mon"


def test_every_step_of_the_check_is_compiled(spark):
    """The JVM leaves methods of 8,000 bytes and more to its interpreter."""
    checked = C.check_messages(C.parse_messages(spark.range(1).selectExpr("string(id) AS value"), "value"))
    code = spark._jvm.PythonSQLUtils.explainString(checked._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8_000
