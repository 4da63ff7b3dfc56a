"""Market series derived from the driver tables.

* candles: ``orders`` grouped by (symbol, day); symbol is a column of the
  caller's choice (``o_orderpriority`` by default, ``o_custkey`` for many
  keys); open/close are the prices at the smallest/largest ``o_orderkey``.
* sentiment: a daily 0-100 index from ``lineitem`` per ship day with the
  public five-band classification.
* ticks: ``events`` as a 24h-stats stream (symbol = event type, price =
  value, volume = ``props.k``).
* landing rows: the above wrapped as JSON payloads with an endpoint tag.

All of these are partial aggregates or projections: map-side combine keeps
the shuffle to one row per (key, day) per task, whatever the key skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.sources.landing import CANDLE_ENDPOINT, TICKER_ENDPOINT

# The sentiment index bands (upper bound inclusive) and names.
SENTIMENT_BANDS = [
    (24, "Extreme Fear"),
    (44, "Fear"),
    (55, "Neutral"),
    (75, "Greed"),
    (100, "Extreme Greed"),
]


def candles(orders: DataFrame, symbol: str = "o_orderpriority") -> DataFrame:
    """Daily OHLCV per symbol: symbol, date, open, high, low, close, volume."""
    return (orders
            .groupBy(F.col(symbol).cast("string").alias("symbol"),
                     F.to_date("o_orderdate").alias("date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def sentiment_class(value) -> F.Column:
    v = F.col(value) if isinstance(value, str) else value
    out = None
    for hi, name in SENTIMENT_BANDS:
        out = F.when(v <= hi, F.lit(name)) if out is None else out.when(v <= hi, F.lit(name))
    return out


def sentiment(lineitem: DataFrame) -> DataFrame:
    """date, fng_value INT (0-100), fng_class per ship day."""
    daily = (lineitem.groupBy(F.to_date("l_shipdate").alias("date"))
             .agg(F.count(F.lit(1)).alias("_n"), F.sum("l_linenumber").alias("_s")))
    val = F.pmod(F.col("_n") * F.lit(37) + F.col("_s"), F.lit(101)).cast("int")
    return daily.select("date", val.alias("fng_value")).withColumn("fng_class", sentiment_class("fng_value"))


def ticks(events: DataFrame) -> DataFrame:
    """symbol, ts_event, event_id, acc_trade_price_24h, acc_trade_volume_24h."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("ts_event"),
        "event_id",
        F.col("value").alias("acc_trade_price_24h"),
        F.get_json_object("props", "$.k").cast("double").alias("acc_trade_volume_24h"))


def epoch_millis(ts) -> F.Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(c.cast("timestamp"))


def ticker_landing(events: DataFrame) -> DataFrame:
    """Ticker API items as landing rows: payload JSON, endpoint, ingested_at."""
    payload = F.to_json(F.struct(
        F.col("event_type").alias("market"),
        F.col("value").alias("acc_trade_price_24h"),
        F.get_json_object("props", "$.k").cast("double").alias("acc_trade_volume_24h"),
        epoch_millis("ts").alias("timestamp")))
    return events.select(payload.alias("payload"), F.lit(TICKER_ENDPOINT).alias("endpoint"),
                                 F.col("ts").cast("timestamp").alias("ingested_at"))


def candle_landing(candle_df: DataFrame, ingested_at=None) -> DataFrame:
    """Daily candle API items as landing rows (payload uses the API names)."""
    payload = F.to_json(F.struct(
        F.col("symbol").alias("market"),
        F.date_format("date", "yyyy-MM-dd'T'00:00:00").alias("candle_date_time_utc"),
        F.col("open").alias("opening_price"),
        F.col("high").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("close").alias("trade_price"),
        F.col("volume").alias("candle_acc_trade_volume")))
    ing = ingested_at if ingested_at is not None else F.col("date").cast("timestamp")
    return candle_df.select(payload.alias("payload"), F.lit(CANDLE_ENDPOINT).alias("endpoint"),
                            ing.alias("ingested_at"))
