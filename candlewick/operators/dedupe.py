"""Latest rows, dedupe and history filters (WIN-15/16, DED-01/02, FLT-06, ORD-02).

The newest rows per key are plain ranked windows: Spark limits each key's
rows in every task before the exchange (WindowGroupLimit) and again after it,
so of a key that holds a third of all rows only ``n`` rows per task travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list:
    return [xs] if isinstance(xs, (str, Column)) else list(xs)


def _newest(df: DataFrame, key: list, order: list, n: int, rank_name: str) -> DataFrame:
    desc = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    return df.withColumn(rank_name, F.row_number().over(Window.partitionBy(*key).orderBy(*desc))).where(F.col(rank_name) <= n)


def latest_per_key(df: DataFrame, key, order) -> DataFrame:
    """The row with the greatest ``order`` per key (``DISTINCT ON`` newest).

    ``order`` should end with a unique column so the pick is deterministic;
    NULL is smallest, NaN greatest.
    """
    key = _cols(key)
    return _newest(df, key, _cols(order), 1, "_rank").select(*key, *[c for c in df.columns if c not in key])


def dedupe_latest(df: DataFrame, keys, order) -> DataFrame:
    """Keep the newest ingest per composite key, e.g. (symbol, date) by
    ``ingested_at`` (DED-01)."""
    return latest_per_key(df, keys, order).select(*df.columns)


def enforce_unique(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per unique key (DED-02). With ``order`` the newest is kept,
    otherwise the smallest row by all columns (deterministic)."""
    keys = _cols(keys)
    if order is None:
        order = [c for c in df.columns if c not in keys]
    return dedupe_latest(df, keys, order)


def unique_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = _cols(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def min_history(df: DataFrame, key, n: int) -> DataFrame:
    """Keep only keys with at least ``n`` rows (FLT-06).

    Counts per key with a partial aggregate, then a semi join: no per-key
    window, so a hot key is never sorted in one task.
    """
    key = _cols(key)
    ok = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select(*key)
    return df.join(ok, on=key, how="left_semi")


def newest_n_per_key(df: DataFrame, key, order, n: int, rank_name: str | None = None) -> DataFrame:
    """The ``n`` newest rows per key by ``order`` desc (ORD-02 all keys, SNK-05);
    ``rank_name`` keeps the 1-based rank. The group limit before the exchange
    applies up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (see
    :mod:`candlewick.session`)."""
    out = _newest(df, _cols(key), _cols(order), n, rank_name or "_rank")
    return out if rank_name else out.drop("_rank")


def latest_two(df: DataFrame, key, order, require: Sequence[str] | None = None) -> DataFrame:
    """Last and previous row of each series (WIN-16); ``require`` columns must
    be non-NULL for a row to count. Adds ``pos`` (1 = last, 2 = previous)."""
    src = df.dropna(how="any", subset=list(require)) if require else df
    return newest_n_per_key(src, key, order, 2, rank_name="pos")


def newest_n(df: DataFrame, order, n: int, where: Column | None = None) -> DataFrame:
    """Newest ``n`` rows of one filtered series: ORDER BY order DESC LIMIT n
    (planned as TakeOrderedAndProject, a per-task top-n then a merge)."""
    src = df.where(where) if where is not None else df
    return src.orderBy(*[(F.col(o) if isinstance(o, str) else o).desc() for o in _cols(order)]).limit(n)
