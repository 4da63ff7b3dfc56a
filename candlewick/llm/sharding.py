"""Sharding by a minimax contiguous partition of atomic groups.

Equal texts form a group, which is never split. Groups stand in the order of
their 64-bit key (XXH64 of the text), and shards are contiguous runs of them,
so a document finds its shard by comparing its own key with at most
``shards - 1`` cuts: no join, and no text is shuffled.

The smallest feasible shard capacity is found by binary search; a capacity is
checked greedily (fill a shard up to the last group that fits, go on with the
next). The driver never holds the group sizes: it holds the sums of ranges of
keys, which bound every greedy cut from below and above, and asks Spark to
split only those ranges in which a cut can still fall, until all cuts of the
capacity are exact. Capacity and cuts are those of the whole table of groups.

A group above the mean of what is left gets a shard of its own (no partition
does better), so the search is over the other groups and shards. Many
partitions keep the capacity; the cuts taken are the ones next to even shares
among those that keep it.

Defined results: a NULL text is an empty one (no bytes). NULL, repeated and
hot ids are rows like any other; extra columns pass through ``assign``. An
empty table has no cuts. Different texts that share a key count as one group.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh_name

LAW = "bytes"
#: Key ranges of the first look, and pieces a range is split into.
FIRST_BITS, SPLIT_BITS = 14, 6
#: Groups up to which the ranges asked for are fetched group by group.
FETCH_GROUPS = 100_000
KEYS = 1 << 64


def size_of(text: str = "text") -> Column:
    """Bytes of the text in UTF-8 (NULL: none) plus 1."""
    return F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 1


def key_of(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def group_sizes(rows: DataFrame, key: str = "key", size: str = "size") -> DataFrame:
    """(key, size) of every group. Sums start in the tasks that read the rows, so a group of a third of all rows is one row of each."""
    return rows.groupBy(F.col(key).alias("key")).agg(F.sum(size).alias("size"))


@dataclass(frozen=True)
class Plan:
    """Shard of a key: its own for a heavy group, else by the cuts (a shard ends before its cut's key)."""
    capacity: int
    cuts: tuple[int, ...]
    heavy: tuple[int, ...]

    def shard(self, key: Column) -> Column:
        """Heavy groups take the first shards, the runs of the others the rest."""
        light = F.lit(len(self.heavy))
        for c in self.cuts:
            light = light + (key >= F.lit(c)).cast("int")
        out = light
        for n, h in enumerate(self.heavy):
            out = F.when(key == F.lit(h), F.lit(n)).otherwise(out)
        return out.cast("int")


class Ranges:
    """Consecutive key ranges that hold groups: their first key, total size and number of groups."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        rows = sorted(rows)
        self.first, self.width = [r[0] for r in rows], [r[1] for r in rows]
        self.groups = [r[3] for r in rows]
        self.ends = list(accumulate(r[2] for r in rows))
        self.starts = [0, *self.ends[:-1]]
        self.total = self.ends[-1] if rows else 0

    def low(self, x: int) -> int:
        """A group boundary that is known, at most x."""
        n = bisect_right(self.ends, x)
        return self.ends[n - 1] if n else 0

    def high(self, x: int) -> int:
        """No group boundary lies between this and x, from below: x itself inside a range of several groups."""
        n = bisect_right(self.ends, x)
        return min(x, self.total) if n < len(self.ends) and self.groups[n] > 1 else self.low(x)

    def open(self, low: int, high: int) -> set[int]:
        """Ranges of several groups that hold an inner point of [low, high]."""
        n = bisect_right(self.ends, low)
        out = set()
        while n < len(self.ends) and self.starts[n] < high or n < len(self.ends) and self.starts[n] == low == high:
            if self.groups[n] > 1:
                out.add(n)
            n += 1
        return out


def greedy(step: Callable[[int], int], capacity: int, shards: int, total: int) -> list[int]:
    """Where the shards end if each takes as much as fits."""
    out, at = [], 0
    for _ in range(shards):
        at = total if at + capacity >= total else step(at + capacity)
        out.append(at)
    return out


def least_capacity(step: Callable[[int], int], low: int, total: int, shards: int) -> int:
    """Binary search for the smallest capacity whose greedy shards reach the end."""
    high = total
    while low < high:
        mid = (low + high) // 2
        if greedy(step, mid, shards, total)[-1] >= total:
            high = mid
        else:
            low = mid + 1
    return low


def even_cuts(ranges: Ranges, capacity: int, shards: int) -> tuple[list[int], set[int]]:
    """Ends of the shards next to even shares, of those that keep the
    capacity, and the ranges that would have to be split to know them."""
    total, ends, opened = ranges.total, ranges.ends, set()

    def before(x: int) -> int:                              # last boundary at or before x
        opened.update(ranges.open(x, x) if x not in known else ())
        return ranges.low(x)

    def after(x: int) -> int:                               # first boundary at or after x
        opened.update(ranges.open(x, x) if x not in known else ())
        n = bisect_left(ends, x)
        return 0 if x <= 0 else ends[n]
    known = {0, *ends}
    must = [total]                                           # from where on the shards that are left suffice
    for _ in range(shards - 1):
        must.append(after(max(must[-1] - capacity, 0)))
    must = must[::-1]
    out, at = [], 0
    for n in range(shards - 1):
        fair = total * (n + 1) // shards
        near = min(before(fair), after(fair), key=lambda b: abs(b - fair))
        at = max(min(near, before(min(at + capacity, total))), must[n], at)
        out.append(at)
    return [*out, total], opened


def plan(groups: DataFrame, shards: int = 16) -> Plan:
    """Capacity and cuts over ``groups`` (key, size), which is read a few times."""
    size, key = F.col("size"), F.col("key")
    total = groups.agg(F.sum(size)).first()[0] or 0
    # heavy groups: at most shards - 1 are above the mean of what is left, whatever their order
    heavy, left = [], total
    for r in groups.orderBy(size.desc(), key).limit(shards - 1).collect():
        if r["size"] * (shards - len(heavy)) <= left:
            break
        heavy.append((r["key"], r["size"]))
        left -= r["size"]
    light = groups.where(~key.isin([k for k, _ in heavy])) if heavy else groups
    n = shards - len(heavy)
    most = light.agg(F.max(size)).first()[0] or 0

    def start_of(bits: int) -> Column:
        # arithmetic shift: keys are signed, and ranges keep their order
        return F.shiftleft(F.shiftright(key, 64 - bits), 64 - bits) if bits < 64 else key

    def ranges_of(df: DataFrame, bits: int) -> list:
        return [(r["first"], KEYS >> bits, r["size"], r["n"]) for r in
                df.groupBy(start_of(bits).alias("first")).agg(F.sum(size).alias("size"), F.count("*").alias("n")).collect()]

    ranges = Ranges(ranges_of(light, FIRST_BITS))

    def split(opened: set[int]) -> Ranges:
        kept = [(ranges.first[i], ranges.width[i], ranges.ends[i] - ranges.starts[i], ranges.groups[i]) for i in range(len(ranges.ends)) if i not in opened]
        asked: dict[int, list[int]] = {}
        for i in opened:
            asked.setdefault(64 - (ranges.width[i].bit_length() - 1), []).append(ranges.first[i])
        inside = light.where(reduce(or_, [start_of(bits).isin(firsts) for bits, firsts in asked.items()]))
        few = sum(ranges.groups[i] for i in opened) <= FETCH_GROUPS
        return Ranges(kept + ranges_of(inside, 64 if few else min(64, min(asked) + SPLIT_BITS)))

    capacity = 0
    while ranges.total:
        floor = max(most, -(-ranges.total // n))
        low = least_capacity(ranges.high, floor, ranges.total, n)
        high = least_capacity(ranges.low, low, ranges.total, n)
        opened: set[int] = set()
        if low < high:
            at = list(zip([0, *greedy(ranges.low, low, n, ranges.total)], [0, *greedy(ranges.high, high, n, ranges.total)]))
            for a, b in at[:-1]:
                opened |= ranges.open(min(a + low, ranges.total), min(b + high, ranges.total))
        else:
            capacity = low
            ends, opened = even_cuts(ranges, capacity, n)
        if not opened:
            break
        ranges = split(opened)
    if not ranges.total:
        return Plan(max((s for _, s in heavy), default=0), (), tuple(k for k, _ in heavy))
    cuts = []
    for e in ends[:-1]:                                      # the key of the first group after the cut
        i = bisect_left(ranges.starts, e)
        cuts.append(ranges.first[i] if i < len(ranges.first) else None)
    return Plan(max([capacity, *(s for _, s in heavy)]), tuple(c for c in cuts if c is not None), tuple(k for k, _ in heavy))


def fit(docs: DataFrame, shards: int = 16, text: str = "text") -> Plan:
    """The plan for all rows of ``docs``."""
    rows = docs.select(key_of(text).alias("key"), size_of(text).alias("size"))
    return plan(cut(group_sizes(rows), "groups"), shards)


def assign(docs: DataFrame, made: Plan, text: str = "text", name: str = "shard") -> DataFrame:
    """All rows and columns of ``docs`` plus their shard (the name gets underscores in front if it is taken)."""
    return docs.withColumn(fresh_name(docs, name), made.shard(key_of(text)))


def number(rows: DataFrame, shard: str = "shard", name: str = "slot") -> DataFrame:
    """``rows`` with a gapless number from 0 within each shard.

    The rows are written once with the place where each was read; a place's
    rows of a shard are numbered there and shifted by the counts of earlier places, so no task gets a shard whole."""
    place, at, own, offset = (fresh_name(rows, n) for n in ("place", "at", "own", "offset"))
    placed = cut(rows.withColumn(at, F.monotonically_increasing_id()).withColumn(place, F.shiftright(F.col(at), 33)), "placed")
    counts = placed.groupBy(shard, place).agg(F.count("*").alias(own))
    earlier = Window.partitionBy(shard).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, place, F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias(offset))
    w = Window.partitionBy(shard, place).orderBy(at)
    out = placed.withColumn(own, F.row_number().over(w)).join(offsets, [shard, place])
    return out.withColumn(name, (F.col(offset) + F.col(own) - 1).cast("long")).select(*rows.columns, name)


def place_documents(docs: DataFrame, shards: int = 16, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL under this law) of every document."""
    rows = cut(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), size_of(text).alias("size"),
                           F.crc32(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
                           key_of(text).alias("key")), "sizes")
    made = plan(cut(group_sizes(rows), "groups"), shards)
    placed = number(rows.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), made.shard(F.col("key")).alias("shard")))
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def write(docs: DataFrame, made: Plan, path: str, text: str = "text") -> None:
    """``docs`` as Parquet, one folder for each shard."""
    out = assign(docs, made, text, "shard")
    column = out.columns[-1]
    out.hint("rebalance", column).write.partitionBy(column).parquet(path)
