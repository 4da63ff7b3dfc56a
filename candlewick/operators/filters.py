"""Filters and predicates (FLT-01..09)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def equals(df: DataFrame, col: str, value) -> DataFrame:
    """Exact match (FLT-01, FLT-08); pushed into the Parquet scan."""
    return df.where(F.col(col) == F.lit(value))


def in_list(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """IN list (FLT-02). Values in a DataFrame (any number) are a left-semi
    join; AQE broadcasts the value side when it is measured small."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(v, on=col, how="left_semi")
    return df.where(F.col(col).isin(list(values)))


def lookback(df: DataFrame, ts: str, days: int, as_of=None, day: str | None = "ingest_date") -> DataFrame:
    """``ts >= as_of - INTERVAL days`` (FLT-03). ``as_of`` defaults to now;
    pass a value so reruns are repeatable. Where the table has the partition
    column ``day``, whole days before the range are pruned."""
    ref = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    since = ref - F.make_interval(days=F.lit(days))
    out = df.where(F.col(ts).cast("timestamp") >= since)
    return out.where(F.col(day) >= F.to_date(since)) if day and day in df.columns else out


def prefix(df: DataFrame, col: str, pre: str) -> DataFrame:
    """Keys starting with ``pre`` (FLT-04), e.g. the KRW- markets."""
    return df.where(F.col(col).startswith(pre))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (FLT-05); NaN is not produced by this engine."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def search(df: DataFrame, col: str, terms: str | Sequence[str]) -> DataFrame:
    """Case-insensitive substring search; whitespace-separated terms are ANDed
    (FLT-07, with SCL-10 lower/contains)."""
    if isinstance(terms, str):
        terms = terms.split()
    cond: Column = F.lit(True)
    for t in terms:
        cond = cond & F.contains(F.lower(F.col(col)), F.lower(F.lit(t)))
    return df.where(cond)
