"""Mart refresh jobs: what the reference's daily DAGs do, as Spark jobs.

Each job reads the landing table (partition-pruned to its endpoint), builds
its mart with :mod:`candlewick.plans.marts` and replaces the mart with a
versioned overwrite that enforces the mart's key (no empty-table window; an empty input keeps the old
version, FLT-09). Each returns the version written or None. They can run on
a schedule or from :func:`candlewick.streaming.hot_path.refresh_on_landing`
when new landing files arrive (STR-07); the market stats are then kept up from
the newly landed rows alone.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.dedupe import dedupe_latest, newest_n_per_key
from candlewick.operators.ewm import Macd
from candlewick.operators.filters import drop_incomplete
from candlewick.operators.series import join_null_safe, resume
from candlewick.operators.windows import apply_specs
from candlewick.plans import marts
from candlewick.sources.landing import (CANDLE_ENDPOINT, TICKER_ENDPOINT, candles_from_landing, read_landing,
                                        read_sentiment_landing)
from candlewick.session import scratch_path
from candlewick.sources.sinks import append_run, conform, current_version, overwrite_mart, read_current
from candlewick.streaming.hot_path import refresh_on_landing

# The marts' columns and types.
STATS_MART = ("symbol string, acc_trade_price_24h decimal(30,8), acc_trade_volume_24h decimal(30,8), source string, "
              "ts_event timestamp, created_at timestamp")
TREND_MART = ("symbol string, close_price decimal(20,4), ma_5 decimal(20,4), ma_20 decimal(20,4), ma_60 decimal(20,4), "
              "rsi_14 decimal(10,2), is_golden_cross boolean, trend_score int, created_at timestamp")
BASELINE_MART = "symbol string, avg_volume_30d decimal(30,8), atr_14d decimal(30,8), updated_at timestamp"
FEATURE_MART = ("symbol string, date date, open double, high double, low double, close double, volume double, fng_value int, "
                "fng_class string, rsi_14 double, macd double, macd_signal double, bb_upper double, bb_lower double, ma_7 double, "
                "ma_30 double, updated_at timestamp")


def _candles(spark: SparkSession, landing_path: str) -> DataFrame:
    """Typed candles with their ingest time (dedupe happens in the marts)."""
    return candles_from_landing(read_landing(spark, landing_path, CANDLE_ENDPOINT))


def refresh_market_stats(spark: SparkSession, landing_path: str, mart_path: str, version=None):
    """PIP-01 daily job: newest ticker per market -> ``market_stats_24h``."""
    return overwrite_mart(conform(marts.build_market_stats_24h(read_landing(spark, landing_path, TICKER_ENDPOINT)), STATS_MART),
                          mart_path, version, unique=["symbol"])


def refresh_trend_report(spark: SparkSession, landing_path: str, mart_path: str,
                         symbols: Sequence[str] | None = None, days: int | None = 200, as_of=None, version=None):
    """PIP-03 job: 200-day lookback on ingest time, then the trend report."""
    return overwrite_mart(conform(marts.build_trend_report(_candles(spark, landing_path), symbols, days, as_of), TREND_MART),
                          mart_path, version, unique=["symbol"])


def refresh_anomaly_baseline(spark: SparkSession, landing_path: str, mart_path: str,
                             symbols: Sequence[str] | None = None, days: int | None = 60, as_of=None, version=None):
    """PIP-04 job: 60-day lookback, 30-day volume mean and 14-day ATR."""
    return overwrite_mart(conform(marts.build_anomaly_baseline(_candles(spark, landing_path), symbols, days, as_of), BASELINE_MART),
                          mart_path, version, unique=["symbol"])


def refresh_feature_mart(spark: SparkSession, candle_landing_path: str, sentiment_landing_path: str,
                         mart_path: str, symbols: Sequence[str] | None = None, version=None):
    """PIP-02 job: candles x sentiment -> feature mart."""
    fm = marts.build_feature_mart(_candles(spark, candle_landing_path),
                                  read_sentiment_landing(spark, sentiment_landing_path), symbols)
    return overwrite_mart(conform(fm, FEATURE_MART), mart_path, version, unique=["symbol", "date"])


#: Rows of a symbol that its newest trend row and baseline depend on: the longest window, one row more for lags and crosses.
TREND_TAIL, BASELINE_TAIL = 61, 31


def _from_tail(candles: DataFrame, mart_path: str, version, depth: int, schema: str, build) -> str | None:
    """Keep a newest-row mart up from new candles and a stored tail: each
    symbol's last ``depth`` days (the newest ingest of each) lie beside the mart
    (``_tail``), the new candles are merged into them, and the mart is built from the
    merged tail. Re-polled and late days inside the tail count; days older than it cannot matter any more."""
    spark, stored = candles.sparkSession, os.path.join(mart_path, "_tail")
    rows = candles.select("symbol", "date", "open", "high", "low", "close", "volume", "ingested_at")
    if current_version(spark, stored) is not None:
        rows = read_current(spark, stored).unionByName(rows)
    days = dedupe_latest(rows, ["symbol", "date"], ["ingested_at", "open", "high", "low", "close", "volume"])
    if overwrite_mart(newest_n_per_key(days, "symbol", "date", depth), stored, version, unique=["symbol", "date"]) is None:
        return None
    return overwrite_mart(conform(build(read_current(spark, stored)), schema), mart_path, version, unique=["symbol"])


def update_trend_report(candles: DataFrame, mart_path: str, version=None) -> str | None:
    """PIP-03 from a day's new candles (symbol, date, prices, volume, ingested_at): equal to a run over all of them."""
    return _from_tail(candles, mart_path, version, TREND_TAIL, TREND_MART, marts.build_trend_report)


def update_anomaly_baseline(candles: DataFrame, mart_path: str, version=None) -> str | None:
    """PIP-04 from a day's new candles: equal to a run over all of them."""
    return _from_tail(candles, mart_path, version, BASELINE_TAIL, BASELINE_MART, marts.build_anomaly_baseline)


def update_feature_mart(candles: DataFrame, sentiment: DataFrame, mart_path: str, version) -> str | None:
    """PIP-02 from new days only: the mart grows by a run's rows (``read_runs``).

    Beside it lie, per symbol, the last days that the windows look back on and
    the MACD state after them (``_tail``, one write, so that both move together). Days up to a symbol's newest known one are not taken again:
    a corrected past needs ``refresh_feature_mart``. Rows without all features
    (the warm-up) count for the state and are not in the mart, as in a whole run."""
    spark = candles.sparkSession
    tail_path = os.path.join(mart_path, "_tail")
    specs = marts.feature_specs()
    back = max(s.lookback for s in specs)
    cols = ["symbol", "date", "open", "high", "low", "close", "volume", "fng_value", "fng_class"]
    days = marts.feature_days(candles, sentiment).select(*cols)
    known = current_version(spark, tail_path) is not None
    stored = read_current(spark, tail_path) if known else None
    tail = stored.select(*cols) if known else days.limit(0)
    seeds = stored.groupBy("symbol").agg(F.first("_seed0").alias("_seed0")) if known else None
    last = tail.groupBy("symbol").agg(F.max("date").alias("_last"))
    new = join_null_safe(days, last, ["symbol"], "left").where(F.col("_last").isNull() | (F.col("date") > F.col("_last"))).drop("_last")
    path = scratch_path(spark, "new-days")
    new.write.parquet(path)
    new = spark.read.schema(new.schema).parquet(path)
    lines, after = resume(new, "symbol", "date", [Macd("close")], seeds)
    both = tail.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    feats = apply_specs(both, "symbol", "date", *specs).where("_new")
    rows = join_null_safe(feats, lines.select("symbol", "date", "macd", "macd_signal"), ["symbol", "date"]).select(*marts.FEATURE_COLUMNS)
    done = append_run(conform(drop_incomplete(rows).withColumn("updated_at", F.current_timestamp()), FEATURE_MART), mart_path, version, unique=["symbol", "date"])
    kept = seeds.join(after.withColumnsRenamed({"symbol": "s", "_seed0": "t"}), F.col("symbol").eqNullSafe(F.col("s")), "left_anti").unionByName(after) if known else after
    rest = newest_n_per_key(both.drop("_new"), "symbol", "date", back)
    overwrite_mart(join_null_safe(rest, kept, ["symbol"]), tail_path, version, unique=["symbol", "date"])
    return done


def update_market_stats(landed: DataFrame, mart_path: str, version=None) -> str | None:
    """PIP-01 kept up from newly landed rows: the newest poll of each symbol in
    ``landed`` against the newest one known so far, which lies beside the mart with the times that
    decide (``_newest``). Late and repeated polls change nothing, and a replayed batch gives the same mart. The work is that of
    the landed rows and of one row per symbol."""
    spark, known = landed.sparkSession, os.path.join(mart_path, "_newest")
    new = marts.newest_tickers(landed)
    if current_version(spark, known) is not None:
        new = marts.newest_of(read_current(spark, known).unionByName(new))
    if overwrite_mart(new, known, version, unique=["symbol"]) is None:
        return None
    return overwrite_mart(conform(marts.market_stats_of(read_current(spark, known)), STATS_MART), mart_path, version, unique=["symbol"])


def stats_on_landing(spark: SparkSession, landing_path: str, schema: str, mart_path: str, checkpoint: str):
    """STR-07 wired up: whenever files have landed, take their rows (and no
    others) into the market stats, with the batch id as version."""
    return refresh_on_landing(spark, landing_path, schema,
                              lambda batch, batch_id: update_market_stats(batch, mart_path, f"batch-{batch_id}"), checkpoint)
