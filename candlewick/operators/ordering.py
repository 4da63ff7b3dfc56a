"""Sort, top-k and pagination (ORD-01..06)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sort(cols: Sequence) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, Column):
            out.append(c)
        elif c.startswith("-"):
            out.append(F.col(c[1:]).desc())
        else:
            out.append(F.col(c).asc())
    return out


def order_by(df: DataFrame, *cols) -> DataFrame:
    """``"-score"`` sorts descending, ``"symbol"`` ascending (ORD-01/04)."""
    return df.orderBy(*_sort(cols))


def top_k(df: DataFrame, k: int, *cols) -> DataFrame:
    """First ``k`` rows by ``cols`` (planned as TakeOrderedAndProject) (ORD-03)."""
    return df.orderBy(*_sort(cols)).limit(k)


def paginate(df: DataFrame, order: Sequence, page: int = 1, size: int = 100) -> tuple[DataFrame, DataFrame]:
    """Rows of 1-based ``page`` plus a one-row frame with the total count
    (ORD-05). ``order`` must be a total order for stable pages."""
    rows = df.orderBy(*_sort(order)).offset((page - 1) * size).limit(size)
    total = df.agg(F.count(F.lit(1)).alias("count"))
    return rows, total


def with_total(rows: DataFrame, total: DataFrame) -> DataFrame:
    """The page plus its total as a column, in one lazy plan: the one-row total
    joins on a constant."""
    one = total.select(F.col("count").cast("bigint").alias("total"), F.lit(1).alias("_one"))
    return rows.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")


def after(df: DataFrame, order: str, last, size: int = 100) -> DataFrame:
    """The page that follows the row whose (ascending, unique) ``order`` value
    is ``last``: a pushed-down filter and a top-n, however deep the page."""
    return df.where(F.col(order) > F.lit(last)).orderBy(order).limit(size)


@dataclass(frozen=True)
class PageIndex:
    """Consecutive blocks of an ordered frame: rows, and the least and greatest
    value of the first order column (None, None: its NULLs). No two blocks share a value."""
    df: DataFrame
    order: tuple[str, ...]
    blocks: tuple[tuple[int, object, object], ...]

    @property
    def total(self) -> int:
        return sum(n for n, _, _ in self.blocks)

    def page(self, number: int, size: int = 100) -> DataFrame:
        """Rows of the 1-based page: a filter for the blocks it lies in (pushed
        down to the scan), a top-n inside them. Any page reads about one block."""
        start, before, asked = (number - 1) * size, 0, []
        for n, low, high in self.blocks:
            if before < start + size and before + n > start:
                asked.append((before, low, high))
            before += n
        first = F.col(self.order[0].lstrip("-"))
        if not asked:
            return self.df.limit(0)
        spans = [(low, high) for _, low, high in asked if low is not None]
        cond = first.isNull() if len(spans) < len(asked) else None
        if spans:
            within = (first >= F.lit(min(x for x, _ in spans))) & (first <= F.lit(max(x for _, x in spans)))
            cond = within if cond is None else cond | within
        return self.df.where(cond).orderBy(*_sort(self.order)).offset(start - asked[0][0]).limit(size)


def page_index(df: DataFrame, *order: str, ranges: int = 256) -> PageIndex:
    """An index of the pages of ``df`` in a total ``order`` (ORD-05). Spark
    range-partitions the order columns and counts each range; ``ranges`` rows
    reach the driver. The counts give every page's place and the total; ranges that share a boundary value are one block."""
    name = order[0].lstrip("-")
    x = F.col(name)
    dealt = df.select(*dict.fromkeys(c.lstrip("-") for c in order)).repartitionByRange(ranges, *_sort(order))
    rows = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.count(F.lit(1)).alias("n"), F.count(x).alias("known"), F.min(x).alias("low"), F.max(x).alias("high")) \
                .orderBy("range").collect()
    blocks: list[list] = []
    for r in rows:
        if r["known"]:
            if blocks and blocks[-1][1] <= r["high"] and r["low"] <= blocks[-1][2]:
                last = blocks[-1]
                blocks[-1] = [last[0] + r["known"], min(last[1], r["low"]), max(last[2], r["high"])]
            else:
                blocks.append([r["known"], r["low"], r["high"]])
    absent = sum(r["n"] - r["known"] for r in rows)
    if absent:
        blocks.insert(len(blocks) if order[0].startswith("-") else 0, [absent, None, None])
    return PageIndex(df, tuple(order), tuple(map(tuple, blocks)))


def head(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*_sort(order)).limit(n)


def tail(df: DataFrame, n: int, *order) -> DataFrame:
    """Last ``n`` rows in ``order``: a top-n on the reversed order, returned
    in the original order."""
    rev = [c[1:] if c.startswith("-") else "-" + c for c in order]
    return df.orderBy(*_sort(rev)).limit(n).orderBy(*_sort(order))
