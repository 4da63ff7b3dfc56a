"""Landing (bronze) sources (SRC-01..07).

Landing tables are Parquet with ``payload STRING, endpoint STRING,
ingested_at TIMESTAMP``, partitioned by ``endpoint`` and ``ingest_date`` so
that the endpoint filter and a lookback prune whole directories.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.json import json_fields

# The exchange source tag, the API endpoint tags and the
# quote-currency prefix of the markets the original collected.
SOURCE_TAG = "upbit"
TICKER_ENDPOINT = "/v1/ticker"
CANDLE_ENDPOINT = "/v1/candles/days"
MARKET_PREFIX = "KRW-"

LANDING_SCHEMA = "payload STRING, endpoint STRING, ingested_at TIMESTAMP"
CANDLE_FIELDS = {
    "symbol": ("$.market", "string"),
    "date": ("$.candle_date_time_utc", "date"),
    "open": ("$.opening_price", "double"),
    "high": ("$.high_price", "double"),
    "low": ("$.low_price", "double"),
    "close": ("$.trade_price", "double"),
    "volume": ("$.candle_acc_trade_volume", "double"),
}


def read_landing(spark: SparkSession, path: str, endpoint: str | None = None) -> DataFrame:
    """Scan landing rows of one endpoint; the filter prunes partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("endpoint") == endpoint) if endpoint else df


def candles_from_landing(landing: DataFrame, symbol: str | None = None) -> DataFrame:
    """Typed OHLCV from candle payloads (SRC-02 projection), keeping
    ``ingested_at`` (and the partition day) for dedupe and lookback, where the
    landing has them."""
    keep = [c for c in ("ingested_at", "ingest_date") if c in landing.columns]
    out = json_fields(landing.select("payload", *keep), "payload", CANDLE_FIELDS).drop("payload")
    return out.where(F.col("symbol") == symbol) if symbol else out


def read_candle_landing(spark: SparkSession, path: str, market: str | None = None) -> DataFrame:
    """Daily candles landing (``market, payload, candle_date_time_utc``, with
    or without an ingest time) to typed OHLCV."""
    df = spark.read.parquet(path)
    if market:
        df = df.where(F.col("market") == market)
    return candles_from_landing(df)


def sentiment_from_landing(df: DataFrame) -> DataFrame:
    """Sentiment landing to ``date, fng_value INT, fng_class`` (SRC-03), plus
    ``ingested_at`` where the landing has it."""
    out = json_fields(df, "payload", {"fng_value": ("$.value", "int"),
                                      "_cls": ("$.value_classification", "string")})
    return out.select(F.to_date("timestamp").alias("date"), "fng_value",
                      F.coalesce("value_classification", "_cls").alias("fng_class"),
                      *[c for c in ("ingested_at",) if c in df.columns])


def read_sentiment_landing(spark: SparkSession, path: str) -> DataFrame:
    return sentiment_from_landing(spark.read.parquet(path))


def land_batch(responses: DataFrame, endpoint: str, text_col: str = "value",
               items_path: str = "$", ingested_at=None) -> DataFrame:
    """API response documents to one landing row per array element (SRC-06).

    ``responses`` has one JSON document per row (e.g. ``spark.read.text(dir,
    wholetext=True)``); ``items_path`` is ``$`` for a top-level array or
    ``$.data`` for a wrapped one. Payload key order is normalized.
    """
    items = F.try_variant_get(F.try_parse_json(F.col(text_col)), items_path, "array<variant>")
    ts = ingested_at if ingested_at is not None else F.current_timestamp()
    return responses.select(F.explode(items).alias("_item")) \
                    .select(F.to_json("_item").alias("payload"), F.lit(endpoint).alias("endpoint"),
                            ts.alias("ingested_at"))


def union_history(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name of pages, chunks, history and updates (SRC-07,
    SET-01); follow with a dedupe."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
