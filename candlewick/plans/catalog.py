"""The registered query set: one Spark plan per operator family, each with
an SQL twin that an independent engine can run on the same tables.

Every query reads the driver tables (or data Spark derives from them) in
full. Spark results are shaped by :func:`candlewick.plans.compare.shape`;
the SQL twins round and format identically.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.json import json_fields
from candlewick.functions.timestamps import epoch_s_to_ts, iso_text
from candlewick.operators import contract as C
from candlewick.operators.dedupe import dedupe_latest, enforce_unique, latest_two, min_history, newest_n_per_key, unique_violations
from candlewick.operators.ewm import ewm_mean, macd
from candlewick.operators.filters import search
from candlewick.operators.indicators import atr, bollinger, rsi
from candlewick.operators.joins import detect_anomalies, join_calls_events, orphan_events
from candlewick.operators.ordering import after, head, order_by, page_index, paginate, tail, top_k, with_total
from candlewick.operators.profile import correlation_matrix, describe, mean_by_hour, mean_by_weekday, null_profile, quantile_row
from candlewick.operators.windows import (Spec, apply_specs, diff, expand_features, rate_of_change, rolling_mean,
                                          rolling_std)
from candlewick.functions.scalar import thousands, to_json_payload
from candlewick.plans import jobs, marts, serving
from candlewick.plans.compare import shape
from candlewick.plans.ingest import ingest
from candlewick.sources import derived, landing, messages
from candlewick.sources.sinks import append_landing, conform, ensure_table, overwrite_mart, read_current, read_mart, read_runs
from candlewick.session import scratch_path
from candlewick.sources.tables import table
from candlewick.streaming import replay
from candlewick.streaming.hot_path import TOPICS, periodic_cross_check

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _candles(spark, sf) -> DataFrame:
    return derived.candles(table(spark, sf, "orders"))


# -- shared SQL fragments (DuckDB dialect) ------------------------------------

SQL_CANDLES = """
candles AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""

SQL_SENTIMENT = """
sentiment AS (
  SELECT date, fng_value,
         CASE WHEN fng_value <= 24 THEN 'Extreme Fear' WHEN fng_value <= 44 THEN 'Fear'
              WHEN fng_value <= 55 THEN 'Neutral' WHEN fng_value <= 75 THEN 'Greed'
              ELSE 'Extreme Greed' END AS fng_class
  FROM (SELECT CAST(l_shipdate AS DATE) AS date,
               CAST((count(*) * 37 + sum(l_linenumber)) % 101 AS INTEGER) AS fng_value
        FROM lineitem GROUP BY 1))"""


def _w(n: int, part: str = "symbol", order: str = "date") -> str:
    return f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _roll(fn: str, x: str, n: int, part: str = "symbol", order: str = "date") -> str:
    w = _w(n, part, order)
    return f"CASE WHEN count({x}) OVER {w} = {n} THEN {fn}({x}) OVER {w} END"


# -- PIP-03 trend report --------------------------------------------------------

SQL_TREND_ROWS = f"""
WITH {SQL_CANDLES},
hist AS (SELECT * FROM candles WHERE symbol IN (SELECT symbol FROM candles GROUP BY symbol HAVING count(*) >= 60)),
d AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS dlt FROM hist),
g AS (SELECT *, CASE WHEN dlt > 0 THEN dlt ELSE 0.0 END AS gain,
                CASE WHEN dlt < 0 THEN -dlt ELSE 0.0 END AS loss FROM d),
m AS (SELECT symbol, date, close,
             {_roll('avg', 'close', 5)} AS ma_5, {_roll('avg', 'close', 20)} AS ma_20,
             {_roll('avg', 'close', 60)} AS ma_60,
             {_roll('avg', 'gain', 14)} AS ag, {_roll('avg', 'loss', 14)} AS al FROM g),
r AS (SELECT *, COALESCE(100.0 - 100.0 / (1.0 + ag / NULLIF(al, 0.0)), 50.0) AS rsi_14 FROM m),
x AS (SELECT *, COALESCE(lag(ma_5) OVER (PARTITION BY symbol ORDER BY date) <= lag(ma_20) OVER (PARTITION BY symbol ORDER BY date)
                         AND ma_5 > ma_20, false) AS is_golden_cross,
             row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rk FROM r),
report AS (
  SELECT symbol, close AS close_price, round(ma_5, 4) AS ma_5, round(ma_20, 4) AS ma_20,
         round(ma_60, 4) AS ma_60, round(rsi_14, 4) AS rsi_14, is_golden_cross,
         CAST((CASE WHEN ma_5 > ma_20 THEN 30 ELSE 0 END) + (CASE WHEN ma_20 > ma_60 THEN 30 ELSE 0 END)
              + (CASE WHEN rsi_14 > 50 THEN 20 ELSE 0 END) + (CASE WHEN is_golden_cross THEN 20 ELSE 0 END)
              AS INTEGER) AS trend_score
  FROM x WHERE rk = 1)"""


def _trend(spark, sf):
    return marts.build_trend_report(_candles(spark, sf), digits=4) \
        .drop("created_at")


@register("trend_report", SQL_TREND_ROWS + "\nSELECT * FROM report")
def q_trend_report(spark, sf):
    """PIP-03 flagship: latest MA 5/20/60, neutral RSI, golden cross, score."""
    return _trend(spark, sf)


@register("trend_top_picks", SQL_TREND_ROWS + "\nSELECT * FROM report ORDER BY trend_score DESC, symbol LIMIT 3")
def q_trend_top_picks(spark, sf):
    """ORD-03: top 3 by score (symbol breaks ties)."""
    return top_k(_trend(spark, sf), 3, "-trend_score", "symbol")


@register("trend_search", SQL_TREND_ROWS +
          "\nSELECT * FROM report WHERE contains(lower(symbol), 't') AND contains(lower(symbol), 'n')")
def q_trend_search(spark, sf):
    """FLT-07: case-insensitive search, terms ANDed."""
    return search(_trend(spark, sf), "symbol", "T n")


# -- PIP-02 feature mart --------------------------------------------------------

SQL_FEATURES = f"""
WITH RECURSIVE {SQL_CANDLES}, {SQL_SENTIMENT},
j AS (SELECT c.symbol, c.date, c.open, c.high, c.low, c.close, c.volume, s.fng_value, s.fng_class,
             row_number() OVER (PARTITION BY c.symbol ORDER BY c.date) - 1 AS rn
      FROM candles c JOIN sentiment s ON c.date = s.date),
e AS (SELECT symbol, rn, close AS e12, close AS e26 FROM j WHERE rn = 0
      UNION ALL
      SELECT j.symbol, j.rn, (1 - 2.0 / 13) * e.e12 + (2.0 / 13) * j.close,
             (1 - 2.0 / 27) * e.e26 + (2.0 / 27) * j.close
      FROM e JOIN j ON j.symbol = e.symbol AND j.rn = e.rn + 1),
m AS (SELECT j.*, e.e12 - e.e26 AS macd FROM j JOIN e ON j.symbol = e.symbol AND j.rn = e.rn),
sg AS (SELECT symbol, rn, macd AS sig FROM m WHERE rn = 0
       UNION ALL
       SELECT m.symbol, m.rn, (1 - 2.0 / 10) * sg.sig + (2.0 / 10) * m.macd
       FROM sg JOIN m ON m.symbol = sg.symbol AND m.rn = sg.rn + 1),
d AS (SELECT m.*, sg.sig AS macd_signal, m.close - lag(m.close) OVER (PARTITION BY m.symbol ORDER BY m.date) AS dlt
      FROM m JOIN sg ON m.symbol = sg.symbol AND m.rn = sg.rn),
g AS (SELECT *, CASE WHEN dlt > 0 THEN dlt ELSE 0.0 END AS gain,
                CASE WHEN dlt < 0 THEN -dlt ELSE 0.0 END AS loss FROM d),
f AS (SELECT *, {_roll('avg', 'gain', 14)} AS ag, {_roll('avg', 'loss', 14)} AS al,
             {_roll('avg', 'close', 20)} AS mid, {_roll('stddev_samp', 'close', 20)} AS sd,
             {_roll('avg', 'close', 7)} AS ma_7, {_roll('avg', 'close', 30)} AS ma_30 FROM g),
o AS (SELECT symbol, date, open, high, low, close, volume, fng_value, fng_class,
             CASE WHEN al = 0 THEN (CASE WHEN ag > 0 THEN 100.0 END) ELSE 100.0 - 100.0 / (1.0 + ag / al) END AS rsi_14,
             macd, macd_signal, mid + sd * 2.0 AS bb_upper, mid - sd * 2.0 AS bb_lower, ma_7, ma_30 FROM f)
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume, fng_value, fng_class,
       round(rsi_14, 6) AS rsi_14, round(macd, 4) AS macd, round(macd_signal, 4) AS macd_signal,
       round(bb_upper, 2) AS bb_upper, round(bb_lower, 2) AS bb_lower, round(ma_7, 4) AS ma_7, round(ma_30, 4) AS ma_30
FROM o
WHERE rsi_14 IS NOT NULL AND macd IS NOT NULL AND macd_signal IS NOT NULL AND bb_upper IS NOT NULL
  AND bb_lower IS NOT NULL AND ma_7 IS NOT NULL AND ma_30 IS NOT NULL
"""


@register("feature_mart", SQL_FEATURES)
def q_feature_mart(spark, sf):
    """PIP-02: candles x sentiment, RSI/MACD/Bollinger/MA, complete rows only."""
    fm = marts.build_feature_mart(_candles(spark, sf), derived.sentiment(table(spark, sf, "lineitem")))
    return _features_shape(fm)


def _features_shape(fm: DataFrame) -> DataFrame:
    return shape(fm.drop("updated_at"), {"rsi_14": 6, "macd": 4, "macd_signal": 4, "bb_upper": 2,
                                         "bb_lower": 2, "ma_7": 4, "ma_30": 4})


# -- PIP-04 anomaly baseline and alerts ---------------------------------------

SQL_BASELINE = f"""
{SQL_CANDLES},
hist AS (SELECT * FROM candles WHERE symbol IN (SELECT symbol FROM candles GROUP BY symbol HAVING count(*) >= 30)),
t AS (SELECT *, greatest(high - low, abs(high - lag(close) OVER (PARTITION BY symbol ORDER BY date)),
                         abs(low - lag(close) OVER (PARTITION BY symbol ORDER BY date))) AS tr FROM hist),
a AS (SELECT symbol, date, {_roll('avg', 'volume', 30)} AS v30, {_roll('avg', 'tr', 14)} AS atr,
             row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rk FROM t),
baseline AS (SELECT symbol, round(v30, 4) AS avg_volume_30d, round(atr, 4) AS atr_14d FROM a WHERE rk = 1)"""


def _baseline(spark, sf, candles: DataFrame | None = None):
    c = candles if candles is not None else _candles(spark, sf)
    return marts.build_anomaly_baseline(c, digits=4).drop("updated_at")


@register("anomaly_baseline", "WITH " + SQL_BASELINE + "\nSELECT * FROM baseline")
def q_anomaly_baseline(spark, sf):
    """PIP-04: 30-day mean volume and 14-day ATR at the latest row."""
    return _baseline(spark, sf)


@register("anomaly_alerts", "WITH " + SQL_BASELINE + """
SELECT c.symbol, strftime(c.date, '%Y-%m-%d') AS date, c.volume, round(c.high - c.low, 2) AS range,
       round(c.volume / b.avg_volume_30d, 6) AS volume_ratio, round((c.high - c.low) / b.atr_14d, 6) AS move_ratio,
       CASE WHEN c.volume > b.avg_volume_30d * 1.5 AND (c.high - c.low) > b.atr_14d * 2.0 THEN 'volume+move'
            WHEN c.volume > b.avg_volume_30d * 1.5 THEN 'volume' ELSE 'move' END AS kind
FROM candles c JOIN baseline b ON c.symbol = b.symbol
WHERE c.volume > b.avg_volume_30d * 1.5 OR (c.high - c.low) > b.atr_14d * 2.0""")
def q_anomaly_alerts(spark, sf):
    """JON-03: daily candles against the per-symbol baseline."""
    candles = _candles(spark, sf)                       # one candle plan feeds both sides
    c = candles.withColumn("range", F.col("high") - F.col("low"))
    out = detect_anomalies(c, _baseline(spark, sf, candles), vol_mult=1.5, atr_mult=2.0)
    return shape(out.select("symbol", "date", "volume", "range", "volume_ratio", "move_ratio", "kind"),
                 {"range": 2, "volume_ratio": 6, "move_ratio": 6})


# -- single indicators over the candle series ----------------------------------

@register("ma_cross_events", f"""
WITH {SQL_CANDLES},
m AS (SELECT symbol, date, {_roll('avg', 'close', 5)} AS ma_short, {_roll('avg', 'close', 20)} AS ma_long FROM candles),
l AS (SELECT *, lag(ma_short) OVER (PARTITION BY symbol ORDER BY date) AS ps,
                lag(ma_long) OVER (PARTITION BY symbol ORDER BY date) AS pl FROM m),
k AS (SELECT *, CASE WHEN COALESCE(ps <= pl AND ma_short > ma_long, false) THEN 'golden'
                     WHEN COALESCE(ps >= pl AND ma_short < ma_long, false) THEN 'dead' END AS kind FROM l)
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, kind, round(ma_short, 4) AS ma_short, round(ma_long, 4) AS ma_long
FROM k WHERE kind IS NOT NULL""")
def q_ma_cross_events(spark, sf):
    """WIN-14: every golden/dead cross of MA 5 over MA 20."""
    out = marts.ma_cross_events(_candles(spark, sf), "symbol", "date", "close")
    return shape(out, {"ma_short": 4, "ma_long": 4})


@register("rolling_stats", f"""
WITH {SQL_CANDLES}
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, close,
       round({_roll('avg', 'close', 5)}, 4) AS ma_5, round({_roll('avg', 'close', 20)}, 4) AS ma_20,
       round({_roll('stddev_samp', 'close', 20)}, 2) AS std_20,
       close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS diff_1
FROM candles""")
def q_rolling_stats(spark, sf):
    """WIN-01..03: rolling mean, sample std, first difference."""
    sp = Spec([{"ma_5": rolling_mean("close", 5), "ma_20": rolling_mean("close", 20),
                "std_20": rolling_std("close", 20), "diff_1": diff("close")}], 19)
    out = apply_specs(_candles(spark, sf), "symbol", "date", sp)
    return shape(out.select("symbol", "date", "close", "ma_5", "ma_20", "std_20", "diff_1"),
                 {"ma_5": 4, "ma_20": 4, "std_20": 2})


@register("rsi_strict", f"""
WITH {SQL_CANDLES},
d AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS dlt FROM candles),
g AS (SELECT *, CASE WHEN dlt > 0 THEN dlt ELSE 0.0 END AS gain, CASE WHEN dlt < 0 THEN -dlt ELSE 0.0 END AS loss FROM d),
f AS (SELECT symbol, date, {_roll('avg', 'gain', 14)} AS ag, {_roll('avg', 'loss', 14)} AS al FROM g)
SELECT symbol, strftime(date, '%Y-%m-%d') AS date,
       round(CASE WHEN al = 0 THEN (CASE WHEN ag > 0 THEN 100.0 END) ELSE 100.0 - 100.0 / (1.0 + ag / al) END, 6) AS rsi_14,
       round(COALESCE(100.0 - 100.0 / (1.0 + ag / NULLIF(al, 0.0)), 50.0), 6) AS rsi_neutral
FROM f""")
def q_rsi(spark, sf):
    """WIN-06/07: strict and neutral RSI(14) on every row."""
    out = apply_specs(_candles(spark, sf), "symbol", "date", rsi("close", 14, "strict"),
                      rsi("close", 14, "neutral", name="rsi_neutral"))
    return shape(out.select("symbol", "date", "rsi_14", "rsi_neutral"), {"rsi_14": 6, "rsi_neutral": 6})


SQL_EWM = f"""
WITH RECURSIVE {SQL_CANDLES},
j AS (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn FROM candles),
e AS (SELECT symbol, rn, close AS e12, close AS e26 FROM j WHERE rn = 0
      UNION ALL
      SELECT j.symbol, j.rn, (1 - 2.0 / 13) * e.e12 + (2.0 / 13) * j.close,
             (1 - 2.0 / 27) * e.e26 + (2.0 / 27) * j.close
      FROM e JOIN j ON j.symbol = e.symbol AND j.rn = e.rn + 1),
m AS (SELECT j.symbol, j.date, j.rn, e.e12, e.e26, e.e12 - e.e26 AS macd FROM j JOIN e ON j.symbol = e.symbol AND j.rn = e.rn),
sg AS (SELECT symbol, rn, macd AS sig FROM m WHERE rn = 0
       UNION ALL
       SELECT m.symbol, m.rn, (1 - 2.0 / 10) * sg.sig + (2.0 / 10) * m.macd
       FROM sg JOIN m ON m.symbol = sg.symbol AND m.rn = sg.rn + 1),
out AS (SELECT m.*, sg.sig AS macd_signal FROM m JOIN sg ON m.symbol = sg.symbol AND m.rn = sg.rn)
"""


@register("ewm_mean", SQL_EWM + """
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, round(e12, 4) AS ema_12, round(e26, 4) AS ema_26 FROM out""")
def q_ewm(spark, sf):
    """WIN-08: EWM(span 12, 26), adjust=False, blocked parallel scan."""
    out = ewm_mean(_candles(spark, sf), "symbol", "date", {"ema_12": ("close", 12), "ema_26": ("close", 26)})
    return shape(out.select("symbol", "date", "ema_12", "ema_26"), {"ema_12": 4, "ema_26": 4})


@register("macd", SQL_EWM + """
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, round(macd, 4) AS macd, round(macd_signal, 4) AS macd_signal FROM out""")
def q_macd(spark, sf):
    """WIN-09: MACD(12, 26) and its signal EWM(9)."""
    out = macd(_candles(spark, sf), "symbol", "date", "close")
    return shape(out.select("symbol", "date", "macd", "macd_signal"), {"macd": 4, "macd_signal": 4})


@register("bollinger", f"""
WITH {SQL_CANDLES},
f AS (SELECT symbol, date, {_roll('avg', 'close', 20)} AS mid, {_roll('stddev_samp', 'close', 20)} AS sd FROM candles)
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, round(mid + sd * 2.0, 2) AS bb_upper,
       round(mid - sd * 2.0, 2) AS bb_lower, round(mid, 4) AS bb_mid FROM f""")
def q_bollinger(spark, sf):
    """WIN-10: 20-row mean +/- 2 sample deviations."""
    out = apply_specs(_candles(spark, sf), "symbol", "date", bollinger("close", 20, 2.0, mid="bb_mid"))
    return shape(out.select("symbol", "date", "bb_upper", "bb_lower", "bb_mid"),
                 {"bb_upper": 2, "bb_lower": 2, "bb_mid": 4})


@register("atr", f"""
WITH {SQL_CANDLES},
t AS (SELECT *, greatest(high - low, abs(high - lag(close) OVER (PARTITION BY symbol ORDER BY date)),
                         abs(low - lag(close) OVER (PARTITION BY symbol ORDER BY date))) AS tr FROM candles)
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, round(tr, 2) AS tr, round({_roll('avg', 'tr', 14)}, 4) AS atr_14
FROM t""")
def q_atr(spark, sf):
    """WIN-11/12: true range and its 14-row mean."""
    out = apply_specs(_candles(spark, sf), "symbol", "date", atr("high", "low", "close", 14, name="atr_14"))
    return shape(out.select("symbol", "date", "tr", "atr_14"), {"tr": 2, "atr_14": 4})


# -- tick features and profiles over events ------------------------------------

def _ticks(spark, sf) -> DataFrame:
    return derived.ticks(table(spark, sf, "events"))


def _tick_features(spark, sf) -> DataFrame:
    return apply_specs(_ticks(spark, sf), "symbol", ["ts_event", "event_id"],
                       expand_features("acc_trade_price_24h", "acc_trade_volume_24h", "ts_event"))


SQL_TICKS = """
ticks AS (SELECT event_type AS symbol, ts AS ts_event, event_id, value AS acc_trade_price_24h,
                 CAST(json_extract_string(props, '$.k') AS DOUBLE) AS acc_trade_volume_24h FROM events)"""


def _troll(x: str, n: int) -> str:
    return _roll("avg", x, n, "symbol", "ts_event, event_id")


def _tlag(x: str, k: int) -> str:
    return f"lag({x}, {k}) OVER (PARTITION BY symbol ORDER BY ts_event, event_id)"


SQL_TICK_FEATURES = f"""
{SQL_TICKS},
feats AS (
  SELECT symbol, ts_event, event_id, acc_trade_price_24h, acc_trade_volume_24h,
         {_troll('acc_trade_price_24h', 5)} AS price_ma5, {_troll('acc_trade_volume_24h', 5)} AS volume_ma5,
         {_troll('acc_trade_price_24h', 10)} AS price_ma10, {_troll('acc_trade_volume_24h', 10)} AS volume_ma10,
         {_troll('acc_trade_price_24h', 20)} AS price_ma20, {_troll('acc_trade_volume_24h', 20)} AS volume_ma20,
         (acc_trade_price_24h / {_tlag('acc_trade_price_24h', 1)} - 1) * 100 AS price_roc1,
         (acc_trade_price_24h / {_tlag('acc_trade_price_24h', 3)} - 1) * 100 AS price_roc3,
         (acc_trade_price_24h / {_tlag('acc_trade_price_24h', 5)} - 1) * 100 AS price_roc5,
         CAST(hour(ts_event) AS INTEGER) AS hour_of_day, CAST(isodow(ts_event) - 1 AS INTEGER) AS day_of_week,
         {_tlag('acc_trade_price_24h', 1)} AS price_lag1, {_tlag('acc_trade_volume_24h', 1)} AS volume_lag1,
         {_tlag('acc_trade_price_24h', 2)} AS price_lag2, {_tlag('acc_trade_volume_24h', 2)} AS volume_lag2,
         {_tlag('acc_trade_price_24h', 3)} AS price_lag3, {_tlag('acc_trade_volume_24h', 3)} AS volume_lag3
  FROM ticks)"""

FEATURE_DIGITS = {"price_ma5": 4, "volume_ma5": 4, "price_ma10": 4, "volume_ma10": 4, "price_ma20": 4,
                  "volume_ma20": 4, "price_roc1": 6, "price_roc3": 6, "price_roc5": 6}


@register("roc_lag_features", "WITH " + SQL_TICK_FEATURES + """
SELECT symbol, strftime(ts_event, '%Y-%m-%d %H:%M:%S.%f') AS ts_event, event_id, acc_trade_price_24h, acc_trade_volume_24h,
       round(price_ma5, 4) AS price_ma5, round(volume_ma5, 4) AS volume_ma5, round(price_ma10, 4) AS price_ma10,
       round(volume_ma10, 4) AS volume_ma10, round(price_ma20, 4) AS price_ma20, round(volume_ma20, 4) AS volume_ma20,
       round(price_roc1, 6) AS price_roc1, round(price_roc3, 6) AS price_roc3, round(price_roc5, 6) AS price_roc5,
       hour_of_day, day_of_week, price_lag1, volume_lag1, price_lag2, volume_lag2, price_lag3, volume_lag3
FROM feats""")
def q_roc_lag(spark, sf):
    """WIN-04/05/18: MA, RoC, lags, hour and weekday per tick series."""
    return shape(_tick_features(spark, sf), FEATURE_DIGITS, micros=("ts_event",))


@register("mean_by_hour", f"""
WITH {SQL_TICKS}
SELECT CAST(hour(ts_event) AS INTEGER) AS hour_of_day, round(avg(acc_trade_volume_24h), 6) AS avg_volume,
       round(avg(acc_trade_price_24h), 6) AS avg_price
FROM ticks GROUP BY 1""")
def q_mean_by_hour(spark, sf):
    """AGG-01: mean volume and price per hour of day."""
    out = mean_by_hour(_ticks(spark, sf), "ts_event",
                       {"avg_volume": "acc_trade_volume_24h", "avg_price": "acc_trade_price_24h"})
    return shape(out, {"avg_volume": 6, "avg_price": 6})


@register("mean_by_weekday", "WITH " + SQL_TICK_FEATURES + """
SELECT day_of_week, round(avg(price_roc1), 6) AS avg_price_roc1,
       ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][day_of_week + 1] AS day_name
FROM feats WHERE price_roc1 IS NOT NULL GROUP BY day_of_week""")
def q_mean_by_weekday(spark, sf):
    """AGG-02: mean 1-period RoC per weekday (Mon = 0) with its name."""
    out = mean_by_weekday(_tick_features(spark, sf), "ts_event", "price_roc1", "avg_price_roc1")
    return shape(out, {"avg_price_roc1": 6})


def _describe_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM ticks""")
    return f"WITH {SQL_TICKS}\n" + "\nUNION ALL\n".join(parts)


@register("describe", _describe_sql(["acc_trade_price_24h", "acc_trade_volume_24h"]))
def q_describe(spark, sf):
    """AGG-03: count, mean, std, min, quartiles (interpolated), max."""
    out = describe(_ticks(spark, sf), ["acc_trade_price_24h", "acc_trade_volume_24h"])
    return shape(out, {"mean": 6, "std": 6, "p25": 6, "p50": 6, "p75": 6})


@register("describe_approx", f"""WITH {SQL_TICKS}
SELECT 'acc_trade_price_24h' AS "column", count(acc_trade_price_24h) AS count, round(avg(acc_trade_price_24h), 6) AS mean, round(stddev_samp(acc_trade_price_24h), 6) AS std,
  CAST(min(acc_trade_price_24h) AS DOUBLE) AS min, CAST(max(acc_trade_price_24h) AS DOUBLE) AS max, 3 AS quartiles_within FROM ticks""")
def q_describe_approx(spark, sf):
    """AGG-03 by sketch: the moments, and how many of the sketch's quartiles lie
    within one rank in a thousand of the exact ones."""
    ticks, col = _ticks(spark, sf), "acc_trade_price_24h"
    a = describe(ticks, [col], approx=True)
    around = [quantile_row(ticks, col, [max(p + s * 0.001, 0.0) for p in (0.25, 0.5, 0.75)]).withColumnRenamed("q", n) for s, n in ((-1, "low"), (1, "high"))]
    j = a.withColumn("_one", F.lit(1))
    for r in around:
        j = j.join(F.broadcast(r.withColumn("_one", F.lit(1))), "_one")
    within = sum(((F.col(p) >= F.col("low")[k]) & (F.col(p) <= F.col("high")[k])).cast("int") for k, p in enumerate(("p25", "p50", "p75")))
    return shape(j.select("column", "count", "mean", "std", "min", "max", within.alias("quartiles_within")), {"mean": 6, "std": 6})


NULL_COLS = ["acc_trade_price_24h", "acc_trade_volume_24h", "price_ma5", "volume_ma5", "price_ma10", "volume_ma10",
             "price_ma20", "volume_ma20", "price_roc1", "price_roc3", "price_roc5", "hour_of_day", "day_of_week",
             "price_lag1", "volume_lag1", "price_lag2", "volume_lag2", "price_lag3", "volume_lag3"]


@register("null_profile", "WITH " + SQL_TICK_FEATURES + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS nulls, count(*) AS rows FROM feats"""
    for c in NULL_COLS))
def q_null_profile(spark, sf):
    """AGG-04: NULL count per feature column in one pass."""
    return null_profile(_tick_features(spark, sf), NULL_COLS).drop("dtype")


CORR_COLS = marts.CORRELATION_COLUMNS


def _corr_sql() -> str:
    nn = " AND ".join(f"{c} IS NOT NULL" for c in CORR_COLS)
    rows = []
    for i, j in combinations_with_replacement(range(len(CORR_COLS)), 2):
        a, b = CORR_COLS[i], CORR_COLS[j]
        r = f"round(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})), 6)"
        rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r} AS r FROM clean")
        if i != j:
            rows.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {r} AS r FROM clean")
    return "WITH " + SQL_TICK_FEATURES + f",\nclean AS (SELECT * FROM feats WHERE {nn})\n" + "\nUNION ALL\n".join(rows)


@register("correlation_matrix", _corr_sql())
def q_correlation(spark, sf):
    """AGG-05: Pearson matrix after listwise NULL removal, long form."""
    return shape(correlation_matrix(_tick_features(spark, sf), CORR_COLS), {"r": 6})


# -- JSON, landing and contracts ----------------------------------------------

@register("market_stats_latest", """
SELECT symbol, acc_trade_price_24h, acc_trade_volume_24h, 'upbit' AS source,
       strftime(to_timestamp(epoch_us(ts) // 1000000), '%Y-%m-%d %H:%M:%S') AS ts_event
FROM (SELECT event_type AS symbol, value AS acc_trade_price_24h,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS acc_trade_volume_24h, ts,
             row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rk FROM events)
WHERE rk = 1""")
def q_market_stats_latest(spark, sf):
    """PIP-01: landing JSON -> typed fields -> newest per market."""
    lt = derived.ticker_landing(table(spark, sf, "events"))
    m = marts.build_market_stats_24h(lt).drop("created_at")
    m = m.withColumn("acc_trade_price_24h", F.col("acc_trade_price_24h").cast("double")) \
         .withColumn("acc_trade_volume_24h", F.col("acc_trade_volume_24h").cast("double"))
    return shape(m)


@register("json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS market,
       value AS acc_trade_price_24h, (epoch_us(ts) // 1000) AS ts_ms
FROM events""")
def q_json_extract(spark, sf):
    """PRJ-01/05: payload built with to_json and read back by path."""
    ev = table(spark, sf, "events")
    lt = ev.select("event_id", "props",
                   F.to_json(F.struct(F.col("event_type").alias("market"), F.col("value").alias("acc_trade_price_24h"),
                                      derived.epoch_millis("ts").alias("timestamp"))).alias("payload"))
    out = json_fields(lt, "props", {"k": ("$.k", "int")})
    out = json_fields(out, "payload", {"market": ("$.market", "string"),
                                       "acc_trade_price_24h": ("$.acc_trade_price_24h", "double"),
                                       "ts_ms": ("$.timestamp", "bigint")})
    return out.select("event_id", "k", "market", "acc_trade_price_24h", "ts_ms")


@register("candles_from_landing", f"""
WITH {SQL_CANDLES}
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume FROM candles""")
def q_candles_from_landing(spark, sf):
    """SRC-02/06/07 + DED-01: two overlapping ingests of the candle payloads,
    unioned, parsed and deduped to the newest ingest per (symbol, date)."""
    c = _candles(spark, sf)
    first = derived.candle_landing(c)
    again = derived.candle_landing(c, ingested_at=(F.col("date").cast("timestamp") + F.expr("INTERVAL 1 DAY")))
    lands = landing.union_history(first, again)
    typed = landing.candles_from_landing(lands)
    out = dedupe_latest(typed, ["symbol", "date"], ["ingested_at"]).drop("ingested_at")
    return shape(out.select("symbol", "date", "open", "high", "low", "close", "volume"))


@register("sentiment_from_landing", f"""
WITH {SQL_SENTIMENT}
SELECT strftime(date, '%Y-%m-%d') AS date, fng_value, fng_class FROM sentiment""")
def q_sentiment_from_landing(spark, sf):
    """SRC-03 + PRJ-10: sentiment payloads with epoch-second text times."""
    s = derived.sentiment(table(spark, sf, "lineitem"))
    payload = F.to_json(F.struct(F.col("fng_value").cast("string").alias("value"),
                                 F.col("fng_class").alias("value_classification"),
                                 F.unix_timestamp(F.col("date").cast("timestamp")).cast("string").alias("timestamp")))
    land = s.select(payload.alias("payload"))
    land = land.select("payload",
                       F.get_json_object("payload", "$.value_classification").alias("value_classification"),
                       epoch_s_to_ts(F.get_json_object("payload", "$.timestamp")).alias("timestamp"))
    return shape(landing.sentiment_from_landing(land))


SQL_MESSAGES = """
msgs AS (
  SELECT event_id, user_id, event_type, value, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'click' THEN 'trade' WHEN 'purchase' THEN 'trade' WHEN 'view' THEN 'ticker'
                         WHEN 'error' THEN 'orderbook' ELSE event_type END AS mtype
  FROM events)"""


SQL_REASON = """CASE WHEN k < 5 THEN 'malformed json'
            WHEN k < 10 THEN (CASE mtype WHEN 'orderbook' THEN 'total_bid_size' ELSE 'trade_price' END) || ': required'
            WHEN k < 15 THEN (CASE mtype WHEN 'trade' THEN 'side: invalid enum' WHEN 'ticker' THEN 'change: invalid enum'
                                         ELSE 'orderbook_units: invalid levels' END)
            ELSE 'symbol: invalid str' END"""


@register("contract_valid", f"""
WITH {SQL_MESSAGES}
SELECT event_id, mtype AS type, 'KRW-U' || CAST(user_id AS VARCHAR) AS symbol,
       value AS price, CAST(k AS DOUBLE) AS qty, (epoch_us(ts) // 1000) AS ts_ms
FROM msgs WHERE mtype IN ('trade', 'ticker', 'orderbook') AND k >= 20""")
def q_contract_valid(spark, sf):
    """PRJ-03/06/08: messages built from events (both naming styles, numeric
    text, ms and ISO times) validated per contract; valid rows."""
    valid, _ = messages.validate_all(messages.messages_from_events(table(spark, sf, "events")))
    return valid


@register("contract_rejected", f"""
WITH {SQL_MESSAGES}
SELECT event_id, CASE WHEN k < 5 THEN NULL ELSE mtype END AS type, {SQL_REASON} AS reason
FROM msgs WHERE (mtype IN ('trade', 'ticker', 'orderbook') AND k < 20) OR k < 5""")
def q_contract_rejected(spark, sf):
    """PRJ-06 / STR-08: dead-letter rows with their first reason."""
    _, rejected = messages.validate_all(messages.messages_from_events(table(spark, sf, "events")))
    return rejected


@register("orderbook_levels", f"""
WITH {SQL_MESSAGES}
SELECT event_id, 'KRW-U' || CAST(user_id AS VARCHAR) AS symbol, lvl AS level, value AS ask_price,
       round(value - 0.01 * lvl, 2) AS bid_price, CAST(k AS DOUBLE) AS ask_size, CAST(k + lvl AS DOUBLE) AS bid_size
FROM msgs, range(0, 3) AS r(lvl) WHERE mtype = 'orderbook' AND k >= 20""")
def q_orderbook_levels(spark, sf):
    """PRJ-07: typed order-book levels, one row per level."""
    ob = messages.valid_by_type(messages.messages_from_events(table(spark, sf, "events")), "orderbook")
    lv = C.orderbook_levels(ob, keep=("event_id", "symbol"))
    return shape(lv.withColumn("level", F.col("level").cast("bigint")), {"bid_price": 2})


# -- dedupe, history, top-n, paging, union, joins ------------------------------

LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus"]


@register("dedupe_latest", f"""
SELECT l_orderkey, l_linenumber, {", ".join(c for c in LINEITEM_ORDER if c != "l_shipdate")},
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {", ".join(c + " DESC" for c in LINEITEM_ORDER)}) AS rk FROM lineitem)
WHERE rk = 1""")
def q_dedupe_latest(spark, sf):
    """DED-01/02: newest row per (l_orderkey, l_linenumber), full tie-break."""
    li = table(spark, sf, "lineitem")
    out = dedupe_latest(li.select("l_orderkey", "l_linenumber", *LINEITEM_ORDER), ["l_orderkey", "l_linenumber"],
                        LINEITEM_ORDER)
    return shape(out)


@register("unique_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_unique_violations(spark, sf):
    """DED-02 report: keys that occur more than once."""
    return unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("min_history", """
SELECT event_id, user_id, value FROM events
WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) >= 70)""")
def q_min_history(spark, sf):
    """FLT-06: rows of keys with at least 70 rows."""
    return min_history(table(spark, sf, "events").select("event_id", "user_id", "value"), "user_id", 70)


@register("recent_n_per_key", """
SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, rk AS "rank"
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rk FROM events)
WHERE rk <= 100""")
def q_recent_n(spark, sf):
    """ORD-02 / SNK-05 batch form: newest 100 per key, exact tree top-n."""
    ev = table(spark, sf, "events").select("event_type", "event_id", "ts")
    out = newest_n_per_key(ev, "event_type", ["ts", "event_id"], 100, rank_name="rank")
    return shape(out.withColumn("rank", F.col("rank").cast("bigint")), micros=("ts",))


@register("page_two", """
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 100""")
def q_page_two(spark, sf):
    """ORD-05: page 2 of 100 rows plus the total count."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rows, total = paginate(o, ["-o_totalprice", "o_orderkey"], page=2, size=100)
    return with_total(rows, total)


@register("page_deep", """
WITH n AS (SELECT count(*) AS total FROM orders)
SELECT o_orderkey, o_totalprice, total FROM orders, n
QUALIFY row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) BETWEEN 100 * (total // 200) + 1 AND 100 * (total // 200) + 100""")
def q_page_deep(spark, sf):
    """ORD-05 by index: a page in the middle reads about one range of the order, the total comes with the index."""
    index = page_index(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "-o_totalprice", "o_orderkey")
    return index.page(index.total // 200 + 1, 100).withColumn("total", F.lit(index.total).cast("bigint"))


@register("latest_two", """
SELECT event_type, event_id, value, 3 - rk AS pos_from_old, rk AS pos
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rk FROM events WHERE value IS NOT NULL) WHERE rk <= 2""")
def q_latest_two(spark, sf):
    """WIN-16: last and previous complete row of each series."""
    two = latest_two(table(spark, sf, "events").select("event_type", "event_id", "ts", "value"), "event_type", ["ts", "event_id"], ["value"])
    return two.select("event_type", "event_id", "value", (3 - F.col("pos")).cast("bigint").alias("pos_from_old"), F.col("pos").cast("bigint").alias("pos"))


@register("strict_cast", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS day, l_returnflag FROM lineitem""")
def q_strict_cast(spark, sf):
    """PRJ-05 / PRJ-02: rows serialized to one JSON text and read back with casts that fail the query on a bad value."""
    src = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("l_quantity"),
                                              "l_extendedprice", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_returnflag")
    fields = {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "day": "date", "l_returnflag": "string"}
    back = json_fields(to_json_payload(src), "payload", {n: (f"$.{n}", t) for n, t in fields.items()}, keep=False, strict=True)
    return back.withColumn("day", F.col("day").cast("string"))


@register("history_union", """
SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""")
def q_history_union(spark, sf):
    """SRC-07 / SET-01: overlapping history and update pages, unioned and
    made unique again by key."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    hist = o.where(F.col("o_orderdate").isNull() | (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")))
    upd = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp"))
    u = landing.union_history(hist, upd)
    out = enforce_unique(u, ["o_orderkey"])
    return shape(out.withColumn("o_orderdate", F.to_date("o_orderdate")))


@register("call_event_join", """
SELECT o.o_orderkey AS call_id, strftime(o.o_orderdate, '%Y-%m-%d') AS received, count(*) AS n_events,
       round(sum(l.l_quantity), 2) AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""")
def q_call_event_join(spark, sf):
    """JON-02: many events per API call (orders as calls, lineitem as events)."""
    calls = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("received"))
    ev = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("call_id"), "l_quantity")
    j = join_calls_events(calls, ev, key="call_id", calls_key="o_orderkey")
    out = j.groupBy("call_id", "received").agg(F.count(F.lit(1)).alias("n_events"),
                                                F.sum("l_quantity").alias("quantity"))
    return shape(out, {"quantity": 2})


@register("orphan_events", """
SELECT count(*) AS orphans FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""")
def q_orphan_events(spark, sf):
    """JON-02 foreign-key check: events without a call (left anti join)."""
    calls = table(spark, sf, "orders")
    ev = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("call_id"))
    return orphan_events(calls, ev, key="call_id", calls_key="o_orderkey").agg(F.count(F.lit(1)).alias("orphans"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# -- streaming hot path (events through running file-source queries) ------------

# Days of a block in the block query, and the cap of the capped query (below most symbols' trades even at small scale).
DAYS = 10
SMALL_CAP = 22


def _hot(spark, sf, cap=10000):
    return replay.run_hot_path(spark, sf, cap)


SQL_STREAM_TRADES = f"""
{SQL_MESSAGES},
tr AS (SELECT 'KRW-U' || CAST(user_id AS VARCHAR) AS symbol, value AS price, (epoch_us(ts) // 1000) AS ts_ms,
              event_id
       FROM msgs WHERE mtype = 'trade' AND k >= 20)"""

# Every trade with its means, the means before it, its cross and its place from the newest.
SQL_CROSSES = f"""WITH {SQL_STREAM_TRADES},
b AS (SELECT *, floor(ts_ms / {DAYS * 86_400_000}.0) AS blk FROM tr),
m AS (SELECT *, {_roll('avg', 'price', 5, 'symbol', 'ts_ms, event_id')} AS ma_short,
             {_roll('avg', 'price', 20, 'symbol', 'ts_ms, event_id')} AS ma_long,
             lead(blk) OVER (PARTITION BY symbol ORDER BY ts_ms, event_id) AS next_blk,
             row_number() OVER (PARTITION BY symbol ORDER BY ts_ms DESC, event_id DESC) AS back FROM b),
l AS (SELECT *, lag(ma_short) OVER (PARTITION BY symbol ORDER BY ts_ms, event_id) AS ps,
                lag(ma_long) OVER (PARTITION BY symbol ORDER BY ts_ms, event_id) AS pl FROM m),
k AS (SELECT *, CASE WHEN ps <= pl AND ma_short > ma_long THEN 'golden'
                     WHEN ps >= pl AND ma_short < ma_long THEN 'dead' END AS kind FROM l),
c AS (SELECT symbol, kind, ts_ms AS event_time_ms, round(ma_short, 4) AS ma_short, round(ma_long, 4) AS ma_long, event_id, blk, next_blk, back,
             symbol || ' ' || kind || ' cross: MA5 ' || format('{{:,}}', CAST(round_even(k.ma_short, 0) AS BIGINT)) || ', MA20 '
             || format('{{:,}}', CAST(round_even(k.ma_long, 0) AS BIGINT)) || ' at '
             || regexp_replace(strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', '') AS message
      FROM k WHERE kind IS NOT NULL)"""


def _alerts(df, *extra):
    return shape(df.select("symbol", "kind", F.unix_millis("event_time").alias("event_time_ms"), "ma_short", "ma_long", *extra),
                 {"ma_short": 4, "ma_long": 4})


@register("stream_snapshot", f"""
WITH {SQL_MESSAGES},
tk AS (SELECT 'KRW-U' || CAST(user_id AS VARCHAR) AS symbol, value AS price, (epoch_us(ts) // 1000) AS ts_ms,
              event_id FROM msgs WHERE mtype = 'ticker' AND k >= 20)
SELECT symbol, price, ts_ms, event_id AS "offset"
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts_ms DESC, event_id DESC) AS rk FROM tk)
WHERE rk = 1""")
def q_stream_snapshot(spark, sf):
    """STR-02/03, SNK-06: latest ticker per symbol from the state after all
    events (event time, then offset, wins)."""
    s = _hot(spark, sf).latest(spark, "ticker")
    return s.select("symbol", "price", F.unix_millis("ts").alias("ts_ms"), "offset")


def _recent_sql(cap):
    return "WITH " + SQL_STREAM_TRADES + f"""
SELECT symbol, event_id AS "offset", price, ts_ms
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts_ms DESC, event_id DESC) AS rk FROM tr)
WHERE rk <= {cap}"""


def _recent(spark, sf, cap):
    return _hot(spark, sf, cap).trades(spark).select("symbol", "offset", "price", F.unix_millis("ts").alias("ts_ms"))


@register("stream_recent", _recent_sql(10000))
def q_stream_recent(spark, sf):
    """STR-04, SNK-05: newest 10,000 trades per symbol kept by the stream."""
    return _recent(spark, sf, 10000)


@register("stream_recent_capped", _recent_sql(SMALL_CAP))
def q_stream_recent_capped(spark, sf):
    """STR-04, SNK-05 with a cap that binds: trades are evicted on arrival."""
    return _recent(spark, sf, SMALL_CAP)


@register("stream_alerts_every", SQL_CROSSES + """
SELECT symbol, kind, event_time_ms, ma_short, ma_long, message, event_id AS "offset" FROM c""")
def q_stream_alerts_every(spark, sf):
    """STR-05: a cross alert with its message at every trade, however the
    trades are cut into micro-batches."""
    return _alerts(_hot(spark, sf).alerts(spark), "message", "offset")


@register("stream_alerts", SQL_CROSSES + """
SELECT symbol, kind, event_time_ms, ma_short, ma_long FROM c WHERE back = 1""")
def q_stream_alerts(spark, sf):
    """STR-05 on a schedule: MA(5)/MA(20) crosses at the newest stored trade of each symbol."""
    return _alerts(periodic_cross_check(spark, _hot(spark, sf).root, seconds=0))


@register("stream_alerts_blocks", SQL_CROSSES + """
SELECT symbol, kind, event_time_ms, ma_short, ma_long FROM c WHERE next_blk IS NULL OR next_blk <> blk""")
def q_stream_alerts_blocks(spark, sf):
    """STR-05: of all alerts those at a symbol's newest trade of a block of ten days."""
    hot = _hot(spark, sf)
    block = F.floor(F.unix_millis("ts") / F.lit(DAYS * 86_400_000.0))
    newest = hot.trades(spark).groupBy("symbol", block.alias("block")).agg(F.max("number"), F.max_by(F.struct("topic", "partition", "offset"), "number").alias("at"))
    return _alerts(hot.alerts(spark).join(newest.select("symbol", "at.*"), ["symbol", "topic", "partition", "offset"], "left_semi"))


@register("stream_rejected", f"""
WITH {SQL_MESSAGES}
SELECT event_id AS "offset", CASE WHEN k < 5 THEN NULL ELSE mtype END AS type, {SQL_REASON} AS reason
FROM msgs WHERE (mtype IN ('trade', 'ticker', 'orderbook') AND k < 20) OR k < 5""")
def q_stream_rejected(spark, sf):
    """STR-08: every invalid message lands in the dead-letter table with its reason."""
    return _hot(spark, sf).rejected(spark).select("offset", "type", "reason")


@register("stream_orderbook", f"""
WITH {SQL_MESSAGES},
ob AS (SELECT 'KRW-U' || CAST(user_id AS VARCHAR) AS symbol, CAST(k AS DOUBLE) AS total_ask_size, value AS total_bid_size,
              (epoch_us(ts) // 1000) AS ts_ms, event_id FROM msgs WHERE mtype = 'orderbook' AND k >= 20)
SELECT symbol, total_ask_size, total_bid_size, ts_ms, event_id AS "offset"
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts_ms DESC, event_id DESC) AS rk FROM ob)
WHERE rk = 1""")
def q_stream_orderbook(spark, sf):
    """SNK-06: latest order book per symbol, read back from the state."""
    s = _hot(spark, sf).latest(spark, "orderbook")
    return s.select("symbol", "total_ask_size", "total_bid_size", F.unix_millis("ts").alias("ts_ms"), "offset")


SQL_TOPICS = "CASE mtype " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOPICS.items()) + " END"


@register("stream_routed", f"""
WITH {SQL_MESSAGES},
v AS (SELECT *, 'KRW-U' || CAST(user_id AS VARCHAR) AS symbol, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso
      FROM msgs WHERE mtype IN ('trade', 'ticker', 'orderbook') AND k >= 20)
SELECT {SQL_TOPICS} AS topic, symbol AS key, mtype AS type, value AS price, CAST(k AS DOUBLE) AS qty, iso AS timestamp,
       CASE mtype WHEN 'trade' THEN '{{"type":"trade","symbol":"' || symbol || '","trade_price":' || CAST(value AS VARCHAR) || ',"trade_volume":'
         || CAST(CAST(k AS DOUBLE) AS VARCHAR) || ',"side":"' || CASE WHEN user_id % 2 = 0 THEN 'BID' ELSE 'ASK' END || '","timestamp":"' || iso || '"}}' END AS trade
FROM v""")
def q_stream_routed(spark, sf):
    """SNK-04 / SRC-05 / PRJ-05: three topics as one subscription into the routing
    sink; what the sink holds by topic and key, canonical names and JSON."""
    r = spark.read.schema("topic string, key string, value string").parquet(replay.run_routing(spark, sf))
    fields = {n: (f"$.{n}", t) for n, t in (("type", "string"), ("trade_price", "double"), ("total_bid_size", "double"), ("trade_volume", "double"),
                                            ("acc_trade_volume_24h", "double"), ("total_ask_size", "double"), ("timestamp", "string"))}
    t = json_fields(r, "value", fields)
    return t.select("topic", "key", "type", F.coalesce("trade_price", "total_bid_size").alias("price"),
                    F.coalesce("trade_volume", "acc_trade_volume_24h", "total_ask_size").alias("qty"), "timestamp",
                    F.when(F.col("type") == "trade", F.col("value")).alias("trade"))


# -- serving reads (PIP-09) and ingest (PIP-08) --------------------------------

def _stats_mart(spark, sf):
    lt = derived.ticker_landing(table(spark, sf, "events"))
    return marts.build_market_stats_24h(lt, created_at=F.lit(None).cast("timestamp"))


SQL_STATS = """
stats AS (SELECT symbol, CAST(acc_trade_price_24h AS DECIMAL(30,8)) AS acc_trade_price_24h,
                 CAST(acc_trade_volume_24h AS DECIMAL(30,8)) AS acc_trade_volume_24h, 'upbit' AS source,
                 strftime(to_timestamp(epoch_us(ts) // 1000000), '%Y-%m-%d %H:%M:%S') AS ts_event
          FROM (SELECT event_type AS symbol, value AS acc_trade_price_24h,
                       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS acc_trade_volume_24h, ts,
                       row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rk FROM events)
          WHERE rk = 1)"""


def _as_text(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])


@register("market_stats_list", f"""
WITH {SQL_STATS}
SELECT symbol, CAST(acc_trade_price_24h AS VARCHAR) AS acc_trade_price_24h,
       CAST(acc_trade_volume_24h AS VARCHAR) AS acc_trade_volume_24h, source, ts_event,
       (SELECT count(*) FROM stats) AS total
FROM stats ORDER BY symbol LIMIT 100""")
def q_market_stats_list(spark, sf):
    """PIP-09 list: ordered by symbol, first page of 100, decimals as text
    with 8 places (the published format), plus the total count."""
    rows, total = serving.market_stats_list(_stats_mart(spark, sf))
    out = shape(rows.drop("created_at"))
    return with_total(_as_text(out, {"acc_trade_price_24h", "acc_trade_volume_24h"}), total)


@register("market_stats_detail", f"""
WITH {SQL_STATS}
SELECT symbol, CAST(acc_trade_price_24h AS VARCHAR) AS acc_trade_price_24h,
       CAST(acc_trade_volume_24h AS VARCHAR) AS acc_trade_volume_24h, source, ts_event
FROM stats WHERE symbol = 'view'""")
def q_market_stats_detail(spark, sf):
    """PIP-09 detail: one symbol (FLT-08)."""
    out = shape(serving.market_stats_detail(_stats_mart(spark, sf), "view").drop("created_at"))
    return _as_text(out, {"acc_trade_price_24h", "acc_trade_volume_24h"})


@register("trend_list", SQL_TREND_ROWS + """
SELECT symbol, CAST(CAST(close_price AS DECIMAL(20,4)) AS VARCHAR) AS close_price,
       CAST(CAST(ma_5 AS DECIMAL(20,4)) AS VARCHAR) AS ma_5, CAST(CAST(ma_20 AS DECIMAL(20,4)) AS VARCHAR) AS ma_20,
       CAST(CAST(ma_60 AS DECIMAL(20,4)) AS VARCHAR) AS ma_60, CAST(CAST(rsi_14 AS DECIMAL(10,2)) AS VARCHAR) AS rsi_14,
       is_golden_cross, trend_score, row_number() OVER (ORDER BY trend_score DESC, symbol) AS pos
FROM report""")
def q_trend_list(spark, sf):
    """PIP-09 trend list: score order, decimals at the mart's scales (PRJ-13)."""
    rows, _ = serving.trend_list(_trend(spark, sf).withColumn("created_at", F.lit(None).cast("timestamp")))
    placed = rows.withColumn("pos", F.monotonically_increasing_id() + 1)     # the page is one ordered partition
    return _as_text(placed.drop("created_at"), {"close_price", "ma_5", "ma_20", "ma_60", "rsi_14"})


@register("realtime_price", f"""
WITH {SQL_MESSAGES},
tk AS (SELECT 'KRW-U' || CAST(user_id AS VARCHAR) AS symbol, value AS price, (epoch_us(ts) // 1000) AS ts_ms,
              event_id FROM msgs WHERE mtype = 'ticker' AND k >= 20 AND user_id = 1)
SELECT symbol, price, ts_ms FROM tk ORDER BY ts_ms DESC, event_id DESC LIMIT 1""")
def q_realtime_price(spark, sf):
    """PRJ-12: latest price of one market from the stream snapshot."""
    r = serving.realtime_price(_hot(spark, sf).latest(spark, "ticker"), "KRW-U1")
    return r.select("symbol", "price", F.unix_millis("timestamp").alias("ts_ms"))


@register("ingest_backfill", f"""
WITH {SQL_CANDLES}
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume FROM candles""")
def q_ingest_backfill(spark, sf):
    """PIP-08: candle API responses (one JSON array per symbol and month)
    dumped twice (a backfill and an overlapping re-poll), landed element by
    element, unioned, parsed and deduped to the newest ingest."""
    c = _candles(spark, sf)
    item = F.struct(F.col("symbol").alias("market"),
                    F.date_format("date", "yyyy-MM-dd'T'00:00:00").alias("candle_date_time_utc"),
                    F.col("open").alias("opening_price"), F.col("high").alias("high_price"),
                    F.col("low").alias("low_price"), F.col("close").alias("trade_price"),
                    F.col("volume").alias("candle_acc_trade_volume"))
    docs = c.groupBy("symbol", F.trunc("date", "month").alias("m")) \
            .agg(F.to_json(F.collect_list(item)).alias("value"))           # one response per symbol-month
    root = scratch_path(spark, "responses")
    docs.select("value").write.text(root + "/backfill")
    docs.select("value").write.text(root + "/repoll")
    first = landing.land_batch(spark.read.text(root + "/backfill"), landing.CANDLE_ENDPOINT,
                              ingested_at=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    again = landing.land_batch(spark.read.text(root + "/repoll"), landing.CANDLE_ENDPOINT,
                              ingested_at=F.lit("2024-01-02 00:00:00").cast("timestamp"))
    typed = landing.candles_from_landing(landing.union_history(first, again))
    out = dedupe_latest(typed, ["symbol", "date"], ["ingested_at"]).drop("ingested_at")
    return shape(out.select("symbol", "date", "open", "high", "low", "close", "volume"))


# -- many keys: one series per customer ----------------------------------------

@register("customer_series", f"""
WITH candles AS (
  SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_max(o_totalprice, o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, close,
       round({_roll('avg', 'close', 3)}, 4) AS ma_3,
       close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS diff_1,
       round((close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1) * 100, 6) AS roc_1
FROM candles""")
def q_customer_series(spark, sf):
    """Any number of keys: daily candles per customer (SURVEY 7.4 many-key
    variant), MA 3, first difference and 1-period RoC over every series."""
    c = derived.candles(table(spark, sf, "orders"), symbol="o_custkey")
    sp = Spec([{"ma_3": rolling_mean("close", 3), "diff_1": diff("close"), "roc_1": rate_of_change("close", 1)}], 2)
    out = apply_specs(c, "symbol", "date", sp)
    return shape(out.select("symbol", "date", "close", "ma_3", "diff_1", "roc_1"), {"ma_3": 4, "roc_1": 6})


# -- storage round trips, gaps, re-polls, alerts --------------------------------

def _landing_table(spark, sf, name: str) -> str:
    """Candle payloads appended to a landing table (SNK-01), polled at the end of their month."""
    path = scratch_path(spark, name)
    append_landing(derived.candle_landing(_candles(spark, sf), F.last_day("date").cast("timestamp")), path)
    return path


AS_OF, RECENT_DAYS, RECENT_SYMBOLS = "1998-08-02", 200, ["1-URGENT", "5-LOW"]
SQL_RECENT = SQL_TREND_ROWS.replace(
    "hist AS (SELECT * FROM candles WHERE symbol IN (SELECT symbol FROM candles GROUP BY symbol HAVING count(*) >= 60))",
    f"""rec AS (SELECT * FROM candles WHERE last_day(date) >= DATE '{AS_OF}' - INTERVAL {RECENT_DAYS} DAY AND symbol IN ('1-URGENT', '5-LOW')),
hist AS (SELECT * FROM rec WHERE symbol IN (SELECT symbol FROM rec GROUP BY symbol HAVING count(*) >= 60))""")
for _c in ("ma_5", "ma_20", "ma_60", "rsi_14"):
    SQL_RECENT = SQL_RECENT.replace(f"round({_c}, 4)", f"round({_c}, 2)")


@register("trend_report_recent", SQL_RECENT + "\nSELECT * FROM report")
def q_trend_report_recent(spark, sf):
    """PIP-03 as scheduled: landing table read from storage (SRC-01), 200-day
    lookback with partition pruning (FLT-03), symbol list (FLT-02), default rounding."""
    land = landing.read_landing(spark, _landing_table(spark, sf, "candles"), landing.CANDLE_ENDPOINT)
    out = marts.build_trend_report(landing.candles_from_landing(land), RECENT_SYMBOLS, RECENT_DAYS, AS_OF)
    return out.drop("created_at")


@register("candles_from_candle_landing", f"""
WITH {SQL_CANDLES}
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume FROM candles""")
def q_candles_from_candle_landing(spark, sf):
    """SRC-02: the candle landing as collected (market, payload, candle time; no
    ingest time), written by market and read back typed, re-polled days dropped."""
    path = scratch_path(spark, "candle-landing")
    one = derived.candle_landing(_candles(spark, sf)).select(
        F.get_json_object("payload", "$.market").alias("market"), "payload",
        F.to_timestamp(F.get_json_object("payload", "$.candle_date_time_utc")).alias("candle_date_time_utc"))
    for _ in range(2):                                      # the same poll twice
        append_landing(one, path, partition_by=("market",))
    typed = landing.read_candle_landing(spark, path)
    out = dedupe_latest(typed, ["symbol", "date"], ["open", "high", "low", "close", "volume"])
    return shape(out.select("symbol", "date", "open", "high", "low", "close", "volume"))


@register("feature_mart_repolled", SQL_FEATURES)
def q_feature_mart_repolled(spark, sf):
    """DED-01 before JON-01: older polls of candles and of the daily index, with
    other values, change nothing."""
    def polls(df, column):
        old = df.withColumn(column, F.col(column) * 2).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))
        return old.withColumn(column, F.col(column).cast(dict(df.dtypes)[column])).unionByName(
            df.withColumn("ingested_at", F.lit("2024-01-02").cast("timestamp")))
    fm = marts.build_feature_mart(polls(_candles(spark, sf), "close"), polls(derived.sentiment(table(spark, sf, "lineitem")), "fng_value"))
    return _features_shape(fm)


@register("ewm_with_gaps", f"""
WITH RECURSIVE {SQL_CANDLES},
j AS (SELECT symbol, date, CASE WHEN day(date) % 7 <> 0 THEN close END AS x,
             row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn FROM candles),
e AS (SELECT symbol, rn, x AS y, 1.0::DOUBLE AS o FROM j WHERE rn = 0
      UNION ALL
      SELECT j.symbol, j.rn,
             CASE WHEN j.x IS NULL THEN e.y WHEN e.y IS NULL THEN j.x ELSE (e.o * 0.5 * e.y + 0.5 * j.x) / (e.o * 0.5 + 0.5) END,
             CASE WHEN j.x IS NULL AND e.y IS NOT NULL THEN e.o * 0.5 ELSE 1.0 END
      FROM e JOIN j ON j.symbol = e.symbol AND j.rn = e.rn + 1)
SELECT j.symbol, strftime(j.date, '%Y-%m-%d') AS date, round(e.y, 4) AS ema_3 FROM j JOIN e ON j.symbol = e.symbol AND j.rn = e.rn""")
def q_ewm_with_gaps(spark, sf):
    """WIN-08 on NULLs: a gap keeps the mean and ages the older weights."""
    c = _candles(spark, sf).withColumn("x", F.when(F.dayofmonth("date") % 7 != 0, F.col("close")))
    out = ewm_mean(c, "symbol", "date", {"ema_3": ("x", 3)})
    return shape(out.select("symbol", "date", "ema_3"), {"ema_3": 4})


@register("ma_cross_alerts", f"""
WITH candles AS (
  SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date, arg_max(o_totalprice, o_orderkey) AS close
  FROM orders GROUP BY 1, 2),
m AS (SELECT symbol, date, {_roll('avg', 'close', 2)} AS ma_short, {_roll('avg', 'close', 4)} AS ma_long,
             row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back FROM candles),
l AS (SELECT *, lag(ma_short) OVER (PARTITION BY symbol ORDER BY date) AS ps,
                lag(ma_long) OVER (PARTITION BY symbol ORDER BY date) AS pl FROM m),
k AS (SELECT *, CASE WHEN ps <= pl AND ma_short > ma_long THEN 'golden'
                     WHEN ps >= pl AND ma_short < ma_long THEN 'dead' END AS kind FROM l WHERE back = 1)
SELECT symbol, kind, strftime(date, '%Y-%m-%d') AS event_time, round(ma_short, 4) AS ma_short, round(ma_long, 4) AS ma_long,
       symbol || ' ' || kind || ' cross: MA2 ' || format('{{:,}}', CAST(round_even(ma_short, 0) AS BIGINT)) || ', MA4 '
       || format('{{:,}}', CAST(round_even(ma_long, 0) AS BIGINT)) || ' at ' || strftime(date, '%Y-%m-%d') AS message
FROM k WHERE kind IS NOT NULL""")
def q_ma_cross_alerts(spark, sf):
    """PIP-05: alert and its text (SCL-08) at the newest day of every customer's series."""
    c = derived.candles(table(spark, sf, "orders"), symbol="o_custkey")
    return shape(marts.detect_ma_cross(c, "symbol", "date", "close", 2, 4), {"ma_short": 4, "ma_long": 4})


@register("market_stats_mart", f"""
WITH {SQL_STATS}
SELECT symbol, CAST(acc_trade_price_24h AS VARCHAR) AS acc_trade_price_24h,
       CAST(acc_trade_volume_24h AS VARCHAR) AS acc_trade_volume_24h, source, ts_event FROM stats""")
def q_market_stats_mart(spark, sf):
    """SNK-02/03, SRC-04: the refresh job writes the typed mart twice (old version
    replaced), and the current version is read back."""
    land, mart = scratch_path(spark, "ticker-landing"), scratch_path(spark, "stats-mart")
    append_landing(derived.ticker_landing(table(spark, sf, "events")), land)
    for version in ("one", "two"):
        jobs.refresh_market_stats(spark, land, mart, version)
    return _as_text(shape(read_mart(spark, mart).drop("created_at")), {"acc_trade_price_24h", "acc_trade_volume_24h"})


@register("market_stats_incremental", f"""
WITH {SQL_STATS}
SELECT symbol, CAST(acc_trade_price_24h AS VARCHAR) AS acc_trade_price_24h,
       CAST(acc_trade_volume_24h AS VARCHAR) AS acc_trade_volume_24h, source, ts_event FROM stats""")
def q_market_stats_incremental(spark, sf):
    """STR-07 / PIP-01: ticker polls land in three parts, each over the whole
    time (so most are late) and the first one again at the end; after each
    landing the mart is kept up from the landed files alone."""
    base = scratch_path(spark, "incremental")
    land, mart, checkpoint = (f"{base}/{n}" for n in ("landing", "mart", "checkpoint"))
    polls = derived.ticker_landing(table(spark, sf, "events"))
    part = F.pmod(F.xxhash64("payload"), F.lit(3))
    for n in (0, 1, 2, 0):
        append_landing(polls.where(part == n), land)
        jobs.stats_on_landing(spark, land, landing.LANDING_SCHEMA + ", ingest_date DATE", mart, checkpoint)
    return _as_text(shape(read_mart(spark, mart).drop("created_at")), {"acc_trade_price_24h", "acc_trade_volume_24h"})


def _daily(spark, sf, update, name):
    """The candles in five parts of time, the newest day of each again in the next, one job run each."""
    mart = f"{scratch_path(spark, name)}/mart"
    c = _candles(spark, sf).withColumn("ingested_at", F.col("date").cast("timestamp"))
    low, high = c.agg(F.min("date"), F.max("date")).first()
    step = (high - low) / 5
    for n in range(5):
        start, end = low + n * step, low + (n + 1) * step if n < 4 else high
        update(c.where((F.col("date") >= F.lit(start)) & (F.col("date") <= F.lit(end))), mart, f"run-{n}")
    return read_current(spark, mart)


@register("trend_report_daily", SQL_TREND_ROWS + """
SELECT symbol, CAST(CAST(close_price AS DECIMAL(20,4)) AS VARCHAR) AS close_price, is_golden_cross, trend_score FROM report""")
def q_trend_report_daily(spark, sf):
    """PIP-03 run after run from a stored tail of 61 days: equal to one run over the whole history."""
    t = _daily(spark, sf, jobs.update_trend_report, "trend-daily")
    return t.select("symbol", F.col("close_price").cast("string").alias("close_price"), "is_golden_cross", "trend_score")


@register("feature_mart_daily", ORACLE["feature_mart"])
def q_feature_mart_daily(spark, sf):
    """PIP-02 run after run from new days, a stored tail and the stored MACD state: equal to one run over the whole history."""
    mart = f"{scratch_path(spark, 'features-daily')}/mart"
    c, s = _candles(spark, sf), derived.sentiment(table(spark, sf, "lineitem"))
    low, high = c.agg(F.min("date"), F.max("date")).first()
    step = (high - low) / 4
    for n in range(4):
        start, end = low + n * step, low + (n + 1) * step if n < 3 else high
        jobs.update_feature_mart(c.where((F.col("date") >= F.lit(start)) & (F.col("date") <= F.lit(end))), s, mart, f"run-{n}")
    return _features_shape(read_runs(spark, mart))


@register("mart_guards", f"""
WITH {SQL_STATS}
SELECT 'after an empty write' AS step, symbol, CAST(acc_trade_price_24h AS VARCHAR) AS acc_trade_price_24h FROM stats
UNION ALL SELECT 'after a repeated key', symbol, CAST(acc_trade_price_24h AS VARCHAR) FROM stats
UNION ALL SELECT 'the same version again', symbol, CAST(acc_trade_price_24h AS VARCHAR) FROM stats WHERE symbol <> 'view'""")
def q_mart_guards(spark, sf):
    """SNK-02/03, FLT-09: a write without rows and a write with a repeated key
    leave the mart; the same version id written again replaces it."""
    mart = scratch_path(spark, "guarded-mart")
    stats = conform(_stats_mart(spark, sf), jobs.STATS_MART)
    kept = lambda step: read_current(spark, mart).select(F.lit(step).alias("step"), "symbol", F.col("acc_trade_price_24h").cast("string").alias("acc_trade_price_24h"))
    overwrite_mart(stats, mart, "day-1", unique=["symbol"])
    overwrite_mart(stats.where("symbol is null"), mart, "day-1", unique=["symbol"])
    out = [kept("after an empty write")]
    try:
        overwrite_mart(stats.unionByName(stats), mart, "day-2", unique=["symbol"])
    except ValueError:
        out.append(kept("after a repeated key"))
    overwrite_mart(stats.where("symbol <> 'view'"), mart, "day-1", unique=["symbol"])
    return reduce(DataFrame.unionByName, [*out, kept("the same version again")])


@register("typed_table", """
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, CAST(CAST(close AS DECIMAL(20,4)) AS VARCHAR) AS close FROM (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, arg_max(o_totalprice, o_orderkey) AS close FROM orders GROUP BY 1, 2)""")
def q_typed_table(spark, sf):
    """SNK-03: CREATE TABLE IF NOT EXISTS (twice) with typed columns, rows
    conformed to it and inserted, the table read back."""
    path = scratch_path(spark, "typed")
    name = "typed_" + path.rsplit("-", 1)[-1]
    schema = "symbol string, date date, close decimal(20,4)"
    for _ in range(2):
        ensure_table(spark, name, schema, path)
    conform(_candles(spark, sf), schema).write.insertInto(name)
    return spark.table(name).select("symbol", F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("close").cast("string").alias("close"))


@register("ingest_markets", """
SELECT CASE WHEN event_id % 3 = 0 THEN 'BTC-' ELSE 'KRW-' END || event_type AS market, count(*) AS items
FROM events WHERE event_id % 3 <> 0 GROUP BY 1""")
def q_ingest_markets(spark, sf):
    """PIP-08: dumped responses through ``ingest`` (array elements, KRW markets
    only, append), read back from the landing table."""
    root = scratch_path(spark, "dumps")
    item = F.struct(F.concat(F.when(F.col("event_id") % 3 == 0, "BTC-").otherwise("KRW-"), "event_type").alias("market"), F.col("value").alias("trade_price"))
    table(spark, sf, "events").groupBy("user_id").agg(F.to_json(F.collect_list(item)).alias("value")).select("value").write.text(root + "/in")
    ingest(spark, {landing.TICKER_ENDPOINT: root + "/in"}, root + "/landing", wholetext=False)
    land = landing.read_landing(spark, root + "/landing", landing.TICKER_ENDPOINT)
    return json_fields(land, "payload", {"market": ("$.market", "string")}).groupBy("market").agg(F.count(F.lit(1)).alias("items"))


@register("head_and_tail", """
SELECT * FROM (SELECT 'head' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 7)
UNION ALL SELECT * FROM (SELECT 'tail', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 7)""")
def q_head_and_tail(spark, sf):
    """ORD-06: first and last 7 rows of the whole order."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    side = lambda name, df: df.select(F.lit(name).alias("side"), "*")
    return side("head", head(o, 7, "o_totalprice", "o_orderkey")).unionByName(side("tail", tail(o, 7, "o_totalprice", "o_orderkey")))


@register("page_after", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 199)
ORDER BY o_orderkey LIMIT 100""")
def q_page_after(spark, sf):
    """ORD-05 by key: the page after the 200th key, however deep."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    last = order_by(o, "o_orderkey").limit(200).agg(F.max("o_orderkey").alias("k")).first()["k"]
    return after(o, "o_orderkey", last, 100)


@register("text_forms", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso, format('{:,}', CAST(floor(value * 1000) AS BIGINT)) AS amount FROM events""")
def q_text_forms(spark, sf):
    """SCL-08/09: thousands separators and ISO-8601 text."""
    return table(spark, sf, "events").select("event_id", iso_text("ts").alias("iso"), thousands(F.floor(F.col("value") * 1000)).alias("amount"))


def _explore_sql() -> str:
    feats, ticks = "feats WHERE symbol = 'view'", "ticks WHERE symbol = 'view'"
    parts = []
    for c in ("acc_trade_price_24h", "acc_trade_volume_24h"):
        for m, x in (("count", f"count({c})"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("p50", f"quantile_cont({c}, 0.5)"), ("max", f"max({c})")):
            parts.append(f"SELECT 'describe' AS part, '{c}' AS item, '{m}' AS measure, round(CAST({x} AS DOUBLE), 6) AS value FROM {ticks}")
    parts += [f"SELECT 'nulls', '{c}', 'nulls', CAST(count(*) - count({c}) AS DOUBLE) FROM {feats}" for c in NULL_COLS]
    parts.append(f"SELECT 'by_hour', CAST(hour(ts_event) AS VARCHAR), 'acc_trade_volume_24h', round(avg(acc_trade_volume_24h), 6) FROM {feats} GROUP BY 2")
    parts.append(f"SELECT 'by_weekday', CAST(day_of_week AS VARCHAR), 'price_roc1', round(avg(price_roc1), 6) FROM {feats} AND price_roc1 IS NOT NULL GROUP BY 2")
    return "WITH " + SQL_TICK_FEATURES + "\n" + "\nUNION ALL\n".join(parts)


@register("explore_whole", _explore_sql())
def q_explore_whole(spark, sf):
    """PIP-06: every part of the exploration of one symbol but its matrix, in long form."""
    x = marts.explore_symbol(_ticks(spark, sf), "view")
    told = lambda df, part, item, measures: [df.select(F.lit(part).alias("part"), item.cast("string").alias("item"), F.lit(m).alias("measure"),
                                                       F.col(c).cast("double").alias("value")) for m, c in measures]
    same = lambda *names: [(n, n) for n in names]
    nulls = x["nulls"].where(F.col("column").isin(NULL_COLS))
    parts = [*told(x["describe"], "describe", F.col("column"), same("count", "mean", "std", "p50", "max")), *told(nulls, "nulls", F.col("column"), same("nulls")),
             *told(x["by_hour"], "by_hour", F.col("hour_of_day"), [("acc_trade_volume_24h", "avg_acc_trade_volume_24h")]),
             *told(x["by_weekday"], "by_weekday", F.col("day_of_week"), [("price_roc1", "avg_price_roc1")])]
    return shape(reduce(DataFrame.unionByName, parts), {"value": 6})


@register("explore_one_symbol", _corr_sql().replace("FROM feats WHERE", "FROM feats WHERE symbol = 'view' AND"))
def q_explore_one_symbol(spark, sf):
    """PIP-06 as one pipeline: one symbol's features to its correlation matrix."""
    return shape(marts.explore_symbol(_ticks(spark, sf), "view")["correlation"], {"r": 6})
