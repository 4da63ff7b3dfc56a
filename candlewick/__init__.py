"""candlewick: keyed market time series on Spark.

Landing JSON, contract validation, dedupe, technical indicators (rolling
means and deviations, RSI, EWM/MACD, Bollinger bands, true range/ATR, lags
and rates of change), marts, serving reads and a Structured Streaming hot
path, all written as DataFrame / SQL expressions that Catalyst plans.
"""

from candlewick.session import checkpoint_root, get_spark

__all__ = ["get_spark", "checkpoint_root"]
