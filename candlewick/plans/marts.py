"""Composite pipelines (PIP-01..06), each a lazy DataFrame plan.

Where the original looped over seven hard-coded symbols in Python, every
pipeline here runs all keys at once: one shuffle by symbol feeds every
indicator, and nothing is collected to the driver. Pass ``symbols`` to keep
the original list as a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.json import json_fields
from candlewick.functions.timestamps import epoch_ms_to_ts_seconds
from candlewick.operators.dedupe import dedupe_latest, latest_per_key, min_history, newest_n_per_key
from candlewick.operators.ewm import Macd
from candlewick.operators.filters import drop_incomplete, in_list, lookback
from candlewick.operators.indicators import (atr, bollinger, golden_cross_flag, ma_cross, moving_averages, rsi,
                                              trend_score)
from candlewick.operators.joins import join_on_day
from candlewick.operators.profile import correlation_matrix, describe, mean_by_hour, mean_by_weekday, null_profile
from candlewick.operators.windows import Spec, apply_specs, chain, combine, expand_features, rolling_mean
from candlewick.sources.landing import SOURCE_TAG, TICKER_ENDPOINT

# The seven markets the original scanners were limited to.
MAJOR_SYMBOLS = ["KRW-BTC", "KRW-ETH", "KRW-XRP", "KRW-SOL", "KRW-DOGE", "KRW-ADA", "KRW-AVAX"]

TICKER_FIELDS = {
    "symbol": ("$.market", "string"),
    "acc_trade_price_24h": ("$.acc_trade_price_24h", "decimal(30,8)"),
    "acc_trade_volume_24h": ("$.acc_trade_volume_24h", "decimal(30,8)"),
    "_ts_ms": ("$.timestamp", "bigint"),
}


def _prepare_candles(candles: DataFrame, symbols: Sequence[str] | None, days: int | None, as_of,
                     min_rows: int | None) -> DataFrame:
    """Symbol list, lookback, one row per symbol and day (the newest ingest,
    where there is an ingest time), history filter."""
    dedupe = "ingested_at" in candles.columns
    df = candles
    if symbols:
        df = in_list(df, "symbol", symbols)
    if days is not None and "ingested_at" in df.columns:
        df = lookback(df, "ingested_at", days, as_of)
    if dedupe:
        # re-polls append the same day again: keep the newest ingest (DED-01)
        newest = ["ingested_at"] if "ingested_at" in df.columns else []
        rest = [c for c in df.columns if c not in ("symbol", "date", "ingested_at")]
        df = dedupe_latest(df, ["symbol", "date"], newest + rest).drop("ingested_at")
    if min_rows:
        df = min_history(df, "symbol", min_rows)
    return df


def newest_of(tickers: DataFrame) -> DataFrame:
    """The newest ticker of each symbol: by ingest time, then exchange time, then amounts."""
    return latest_per_key(tickers, "symbol", ["ingested_at", "_ts_ms", "acc_trade_price_24h", "acc_trade_volume_24h"])


def newest_tickers(landing: DataFrame) -> DataFrame:
    """The newest ticker item per market, typed, with the times that decide."""
    t = landing.where(F.col("endpoint") == TICKER_ENDPOINT).select("payload", "ingested_at")
    return newest_of(json_fields(t, "payload", TICKER_FIELDS).drop("payload"))


def market_stats_of(newest: DataFrame, source: str = SOURCE_TAG, created_at=None) -> DataFrame:
    return newest.select(
        "symbol", "acc_trade_price_24h", "acc_trade_volume_24h", F.lit(source).alias("source"),
        epoch_ms_to_ts_seconds("_ts_ms").alias("ts_event"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"))


def build_market_stats_24h(landing: DataFrame, source: str = SOURCE_TAG, created_at=None) -> DataFrame:
    """PIP-01: newest ticker item per market from the landing table.

    Output: symbol, acc_trade_price_24h, acc_trade_volume_24h (decimal(30,8)),
    source, ts_event (epoch ms truncated to seconds), created_at.
    """
    return market_stats_of(newest_tickers(landing), source, created_at)


FEATURE_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume", "fng_value", "fng_class",
                   "rsi_14", "macd", "macd_signal", "bb_upper", "bb_lower", "ma_7", "ma_30"]


def feature_days(candles: DataFrame, sentiment: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """One row per symbol and day that both sides have. Both may hold
    re-polled days: the newest ingest of each counts (without an ingest time the largest row)."""
    c = _prepare_candles(candles, symbols, None, None, None)
    newest = [x for x in ("ingested_at", "fng_value", "fng_class") if x in sentiment.columns]
    s = dedupe_latest(sentiment.select("date", *newest), "date", newest).select("date", "fng_value", "fng_class")
    return join_on_day(c, s)


def feature_specs() -> list[Spec]:
    """The window features; they look back ``max(lookback)`` days."""
    return [rsi("close", 14, "strict"), bollinger("close", 20, 2.0), Spec([{"ma_7": rolling_mean("close", 7), "ma_30": rolling_mean("close", 30)}], 29)]


def build_feature_mart(candles: DataFrame, sentiment: DataFrame, symbols: Sequence[str] | None = None,
                       updated_at=None) -> DataFrame:
    """PIP-02: candles joined with the daily sentiment, then RSI(14, strict),
    MACD(12, 26, 9), Bollinger(20, 2), MA 7/30; rows with any NULL dropped.
    All indicators share one numbering and one chunk layout."""
    feats = apply_specs(feature_days(candles, sentiment, symbols), "symbol", "date", *feature_specs(), recurrences=[Macd("close")])
    out = drop_incomplete(feats.select(*FEATURE_COLUMNS))
    return out.withColumn("updated_at", updated_at if updated_at is not None else F.current_timestamp())


def _with_history_filter(c: DataFrame, spec: Spec, min_rows: int | None) -> DataFrame:
    """Indicators for keys with at least ``min_rows`` rows (FLT-06); the count
    comes with the numbering of the rows."""
    return apply_specs(c, "symbol", "date", spec, min_rows=min_rows or 0)


def trend_rows(candles: DataFrame, symbols: Sequence[str] | None = None, days: int | None = None,
               as_of=None, min_rows: int = 60) -> DataFrame:
    """Every row of the trend indicators: MA 5/20/60, neutral RSI(14) and the
    golden-cross flag, for symbols with at least ``min_rows`` days."""
    c = _prepare_candles(candles, symbols, days, as_of, None)
    spec = chain(combine(moving_averages("close", (5, 20, 60)), rsi("close", 14, "neutral")),
                 golden_cross_flag("ma_5", "ma_20"))
    return _with_history_filter(c, spec, min_rows)


def build_trend_report(candles: DataFrame, symbols: Sequence[str] | None = None, days: int | None = None,
                       as_of=None, min_rows: int = 60, digits: int = 2, created_at=None) -> DataFrame:
    """PIP-03: latest row per symbol with MA 5/20/60, RSI, golden cross and
    the 0-100 trend score. Moving averages and RSI are rounded to ``digits``."""
    rows = trend_rows(candles, symbols, days, as_of, min_rows)
    last = latest_per_key(rows.select("symbol", "date", "close", "ma_5", "ma_20", "ma_60", "rsi_14",
                                      "is_golden_cross"), "symbol", "date")
    scored = last.withColumn("trend_score", trend_score())
    return scored.select(
        "symbol", F.col("close").alias("close_price"),
        *[F.round(c_, digits).alias(c_) for c_ in ("ma_5", "ma_20", "ma_60", "rsi_14")],
        "is_golden_cross", "trend_score",
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"))


def build_anomaly_baseline(candles: DataFrame, symbols: Sequence[str] | None = None, days: int | None = None,
                           as_of=None, min_rows: int = 30, digits: int = 2, updated_at=None) -> DataFrame:
    """PIP-04: per symbol the 30-row mean volume (WIN-13) and the 14-row ATR
    (WIN-12) at the latest row (WIN-15), rounded to ``digits`` (SCL-05)."""
    c = _prepare_candles(candles, symbols, days, as_of, None)
    spec = combine(Spec([{"avg_volume_30d": rolling_mean("volume", 30)}], 29),
                   atr("high", "low", "close", 14, name="atr_14d"))
    rows = _with_history_filter(c, spec, min_rows)
    last = latest_per_key(rows.select("symbol", "date", "avg_volume_30d", "atr_14d"), "symbol", "date")
    return last.select("symbol", F.round("avg_volume_30d", digits).alias("avg_volume_30d"),
                       F.round("atr_14d", digits).alias("atr_14d"),
                       (updated_at if updated_at is not None else F.current_timestamp()).alias("updated_at"))


def ma_cross_events(series: DataFrame, key: str, ts: str, price: str, short: int = 5, long: int = 20) -> DataFrame:
    """Every golden/dead cross over the full history (WIN-14)."""
    rows = apply_specs(series, key, ts, ma_cross(price, short, long, name="kind", short_name="ma_short", long_name="ma_long"))
    return rows.where(F.col("kind").isNotNull()).select(key, ts, "kind", "ma_short", "ma_long")


def cross_message(key, kind, ma_short, ma_long, time, short: int = 5, long: int = 20) -> F.Column:
    """The text of a cross alert."""
    return F.format_string("%s %s cross: MA%d %s, MA%d %s at %s", F.col(key).cast("string"), F.col(kind), F.lit(short),
                           F.format_number(ma_short, 0), F.lit(long), F.format_number(ma_long, 0), F.col(time).cast("string"))


def detect_ma_cross(series: DataFrame, key: str, ts: str, price: str, short: int = 5, long: int = 20,
                    tiebreak: str | Sequence[str] | None = None, time: str | None = None) -> DataFrame:
    """PIP-05: per key, the newest ``long + 1`` rows, MA short/long, the last
    two complete rows, and a golden/dead alert row with its message.
    ``tiebreak`` (e.g. topic, partition and offset) orders rows with equal
    ``ts``; ``time`` is the column told as event time (default ``ts``).

    One exchange: the newest rows are limited in every task before it, and all
    further windows run on what is left of each key (``long + 1`` rows)."""
    order = [ts, *([tiebreak] if isinstance(tiebreak, str) else tiebreak or [])]
    told = [] if time in (None, *order) else [time]
    recent = newest_n_per_key(series.select(key, *order, *told, price), key, order, long + 1)
    w = Window.partitionBy(key).orderBy(*order)
    mas = recent.select("*", rolling_mean(price, short)(w).alias("ma_short"), rolling_mean(price, long)(w).alias("ma_long"))
    mas = mas.where(F.col("ma_short").isNotNull() & F.col("ma_long").isNotNull())
    last = mas.select("*", F.lag("ma_short").over(w).alias("_ps"), F.lag("ma_long").over(w).alias("_pl"),
                      F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(o).desc() for o in order])).alias("_back"))
    golden = (F.col("_ps") <= F.col("_pl")) & (F.col("ma_short") > F.col("ma_long"))
    dead = (F.col("_ps") >= F.col("_pl")) & (F.col("ma_short") < F.col("ma_long"))
    kind = F.when(golden, F.lit("golden")).when(dead, F.lit("dead"))
    out = last.where(F.col("_back") == 1).select(key, F.col(time or ts).alias("event_time"), "ma_short", "ma_long", kind.alias("kind"))
    msg = cross_message(key, "kind", "ma_short", "ma_long", "event_time", short, long)
    return out.where(F.col("kind").isNotNull()).select(key, "kind", "event_time", "ma_short", "ma_long", msg.alias("message"))


# The columns of the correlation matrix, in order.
CORRELATION_COLUMNS = ["acc_trade_price_24h", "acc_trade_volume_24h", "price_ma5", "volume_ma5", "price_ma20", "volume_ma20",
                       "price_roc1", "price_roc5", "price_lag1", "volume_lag1", "price_lag3", "volume_lag3", "hour_of_day"]


def explore_symbol(mart: DataFrame, symbol: str | None, price: str = "acc_trade_price_24h",
                   volume: str = "acc_trade_volume_24h", ts: str = "ts_event", key: str = "symbol") -> dict[str, DataFrame]:
    """PIP-06: profile one symbol's series (or all with ``symbol=None``)."""
    df = mart.where(F.col(key) == symbol) if symbol else mart
    feats = apply_specs(df, key, [ts, *(["event_id"] if "event_id" in df.columns else [])],
                        expand_features(price, volume, ts))
    corr_cols = [price, volume, *CORRELATION_COLUMNS[2:]]
    return {
        "describe": describe(df, [price, volume]),
        "nulls": null_profile(feats),
        "features": feats,
        "by_hour": mean_by_hour(feats, ts, volume),
        "by_weekday": mean_by_weekday(feats, ts, "price_roc1"),
        "correlation": correlation_matrix(feats, corr_cols),
    }
