"""Joins (JON-01..03).

No join here carries a broadcast hint. The planner broadcasts a side whose
file statistics lie below ``spark.sql.autoBroadcastJoinThreshold``, AQE one that
it has measured below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond
these limits the shuffle join stays, and skewed partitions are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_day(prices: DataFrame, sentiment: DataFrame, on: str = "date") -> DataFrame:
    """Inner equi-join on the day: only days present in both; duplicates
    multiply (JON-01)."""
    return prices.join(sentiment, on=on, how="inner")


def join_calls_events(calls: DataFrame, events: DataFrame, key: str = "call_id",
                      calls_key: str | None = None) -> DataFrame:
    """Many events to one API call (JON-02)."""
    ck = calls_key or key
    c = calls if ck == key else calls.withColumnRenamed(ck, key)
    return events.join(c, on=key, how="inner")


def orphan_events(calls: DataFrame, events: DataFrame, key: str = "call_id",
                  calls_key: str | None = None) -> DataFrame:
    """Events whose call does not exist (foreign-key check)."""
    ck = calls_key or key
    c = calls.select(F.col(ck).alias(key))
    return events.join(c, on=key, how="left_anti")


def detect_anomalies(ticks: DataFrame, baseline: DataFrame, key: str = "symbol",
                     volume: str = "volume", move: str | None = "range",
                     vol_mult: float = 5.0, atr_mult: float = 3.0) -> DataFrame:
    """Alarm rows: volume above ``vol_mult`` x the 30-day average volume, or a
    price move above ``atr_mult`` x ATR (JON-03).

    ``baseline`` has one row per symbol; it joins any batch or streaming
    frame of ticks on ``key``.
    """
    b = baseline.select(key, "avg_volume_30d", "atr_14d")
    j = ticks.join(b, on=key, how="inner")
    vol_ratio = F.try_divide(F.col(volume), F.col("avg_volume_30d"))
    vol_hit = F.coalesce(F.col(volume) > F.col("avg_volume_30d") * F.lit(vol_mult), F.lit(False))
    if move:
        move_ratio = F.try_divide(F.col(move), F.col("atr_14d"))
        move_hit = F.coalesce(F.col(move) > F.col("atr_14d") * F.lit(atr_mult), F.lit(False))
    else:
        move_ratio, move_hit = F.lit(None).cast("double"), F.lit(False)
    kind = F.when(vol_hit & move_hit, F.lit("volume+move")).when(vol_hit, F.lit("volume")).when(move_hit, F.lit("move"))
    return j.select("*", vol_ratio.alias("volume_ratio"), move_ratio.alias("move_ratio"), kind.alias("kind")) \
            .where(F.col("kind").isNotNull())
