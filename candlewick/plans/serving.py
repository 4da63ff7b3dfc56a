"""Serving reads over the marts and the snapshot (PIP-09, PRJ-12/13).

Each read is a small DataFrame plan; an empty result means "not found".
Lists are ordered as the original views order them and paged 100 rows at a
time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.filters import equals, search
from candlewick.operators.ordering import paginate, top_k

PAGE_SIZE = 100
STATS_FIELDS = ["symbol", "acc_trade_price_24h", "acc_trade_volume_24h", "source", "ts_event", "created_at"]
TREND_FIELDS = ["symbol", "close_price", "ma_5", "ma_20", "ma_60", "rsi_14", "is_golden_cross", "trend_score",
                "created_at"]


def market_stats_view(df: DataFrame) -> DataFrame:
    """The six published fields, amounts as decimal(30,8) (PRJ-13)."""
    return df.select(*[F.col(c).cast("decimal(30,8)").alias(c) if c.startswith("acc_") else F.col(c)
                       for c in STATS_FIELDS])


def trend_view(df: DataFrame) -> DataFrame:
    """All trend fields with the mart's decimal scales (PRJ-13)."""
    casts = {"close_price": "decimal(20,4)", "ma_5": "decimal(20,4)", "ma_20": "decimal(20,4)",
             "ma_60": "decimal(20,4)", "rsi_14": "decimal(10,2)"}
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in TREND_FIELDS])


def market_stats_list(stats: DataFrame, symbol: str | None = None, page: int = 1) -> tuple[DataFrame, DataFrame]:
    """Ordered by symbol (ORD-04), optional exact ``symbol`` filter (FLT-08),
    paged (ORD-05): (rows, count)."""
    src = equals(stats, "symbol", symbol) if symbol else stats
    return paginate(market_stats_view(src), ["symbol"], page, PAGE_SIZE)


def market_stats_detail(stats: DataFrame, symbol: str) -> DataFrame:
    return market_stats_view(equals(stats, "symbol", symbol))


def trend_list(trend: DataFrame, terms: str | None = None, page: int = 1) -> tuple[DataFrame, DataFrame]:
    """Score descending, symbol breaking ties (ORD-04), optional search (FLT-07)."""
    src = search(trend, "symbol", terms) if terms else trend
    return paginate(trend_view(src), ["-trend_score", "symbol"], page, PAGE_SIZE)


def trend_top_picks(trend: DataFrame, k: int = 3) -> DataFrame:
    return top_k(trend_view(trend), k, "-trend_score", "symbol")


def realtime_price(snapshot: DataFrame, symbol: str = "KRW-BTC") -> DataFrame:
    """``symbol, price, timestamp`` from the latest ticker snapshot (PRJ-12);
    the market parameter is honoured."""
    return snapshot.where(F.col("symbol") == symbol).select("symbol", "price", F.col("ts").alias("timestamp"))
