"""Ordered keyed series: the one window layout every indicator runs on.

A "stage" is a dict ``{name: build(w) -> Column}``; ``build`` receives the
window spec to use (already partitioned and ordered) and returns a window
expression. Stages are evaluated in order, so a later stage may reference an
earlier one (e.g. ``lag`` of a rolling mean).

The layout is the same at every size: rows get a 0-based position ``_rn``
within their key (numbered per (key, bucket) in parallel plus bucket
offsets), are cut into chunks of ``chunk_rows`` positions, and the last
``lookback`` rows of each chunk are copied into the next one as a halo.
Windows run per (key, chunk), so a key that holds a third of all rows is spread
over many tasks, and only native rows are kept. ``lookback`` must cover every
frame and lag of all stages combined. Recurrences need no halo: each chunk
tells what it does to the state before it, these are composed in the order of a key's chunks (one
small row per chunk), and each chunk starts from the state that comes out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

Stage = dict[str, Callable[[WindowSpec], Column]]

DEFAULT_CHUNK_ROWS = 100_000


class Recurrence(Protocol):
    """Columns that depend on the whole past of a series through a state of a
    few numbers (``start`` before the first row). ``summary`` tells what the rows of a chunk do
    to a state, ``fold`` applies it, ``compute`` gives the outputs of a chunk
    from the state before it; inputs are numpy arrays in order."""

    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    start: tuple[float, ...]

    def summary(self, ins: dict) -> list[float]: ...

    def fold(self, state: Sequence[float], told: Sequence[float]) -> tuple[float, ...]: ...

    def compute(self, ins: dict, state: Sequence[float]) -> dict: ...


def _cols(xs: str | Sequence[str]) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def chunk_rows_for(df: DataFrame) -> int:
    """Positions per chunk (``spark.candlewick.chunkRows``)."""
    return int(df.sparkSession.conf.get("spark.candlewick.chunkRows", str(DEFAULT_CHUNK_ROWS)))


def default_bucket(df: DataFrame, order) -> Column:
    """A bucket that never falls along the first order column: minute of a
    timestamp, month of a date, ranges of a number, the first characters of a
    string; any other orderable value is a bucket of its own."""
    name = _cols(order)[0]
    x, t = F.col(name), df.schema[name].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("minute", x)
    if isinstance(t, T.DateType):
        return F.trunc(x, "month")
    if isinstance(t, (T.FloatType, T.DoubleType)):          # NaN sorts above all numbers
        return F.when(F.isnan(x), F.lit(float("inf"))).otherwise(F.rint(x / F.lit(4096.0)))
    if isinstance(t, T.NumericType):
        return F.floor(x / F.lit(4096))
    if isinstance(t, T.StringType):
        return F.substring(x, 1, 3)
    return x


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; the right side's keys are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in on])


def number_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: Column | None = None,
                name: str = "_rn", min_rows: int = 0) -> DataFrame:
    """Add the 0-based position of each row within its key, in ``order``.

    ``bucket`` must be non-decreasing along ``order`` (default: by the type of
    its first column). Rows are numbered per (key, bucket) in parallel and
    shifted by the running count of earlier buckets, so no task ever sorts a
    whole key. ``order`` must be a total order (end it with a unique column).
    NULL keys form a series, NULL order values come first. Keys with fewer
    than ``min_rows`` rows are left out: their count is the total of the bucket
    counts, so that costs no pass of its own.
    """
    key, order = _cols(key), _cols(order)
    b = df.withColumn("_bk", bucket if bucket is not None else default_bucket(df, order))
    counts = b.groupBy(*key, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*key).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*key, "_bk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
                            *([F.sum("_n").over(Window.partitionBy(*key)).alias("_total")] if min_rows else []))
    if min_rows:
        offsets = offsets.where(F.col("_total") >= min_rows).drop("_total")
    # offsets has one row per (key, bucket): AQE broadcasts it when it is
    # measured small, otherwise this stays a shuffle join.
    j = join_null_safe(b, offsets, [*key, "_bk"])
    w = Window.partitionBy(*key, "_bk").orderBy(*order)
    return j.withColumn(name, F.col("_off") + F.row_number().over(w) - 1).drop("_bk", "_off")


def _in_order(t, recurrence: Recurrence) -> dict:
    import pyarrow as pa
    return {c: t.column(c).cast(pa.float64()).fill_null(float("nan")).to_numpy() for c in recurrence.inputs}


def _told(n: int) -> str:
    return f"_told{n}"


def _states(chunked: DataFrame, key: list[str], recurrences: Sequence[Recurrence], seeds: DataFrame | None = None) -> DataFrame:
    """The state before each chunk, and after a key's last one (as the state
    before the chunk that would follow): one row per (key, chunk), an array for each
    recurrence. Chunks are summed up in parallel; a key's rows to fold are one per chunk.
    ``seeds`` (key, ``_seed0``, ...) are the states to start from; other keys start anew."""
    names = [_told(n) for n in range(len(recurrences))]
    fields = [chunked.schema[c] for c in (*key, "_chunk")]
    schema = T.StructType(fields + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in names])

    def summed(t):
        import pyarrow as pa
        import pyarrow.compute as pc
        t = t.filter(t.column("_native"))
        t = t.take(pc.sort_indices(t.column("_rn")))
        first = t.slice(0, 1)                                   # nothing where a chunk holds a halo only
        cols = [pa.array([r.summary(_in_order(t, r)) for _ in range(len(first))], pa.list_(pa.float64())) for r in recurrences]
        return pa.table([*(first.column(f.name) for f in fields), *cols], names=schema.names)

    seeded = seeds is not None

    def folded(t):
        import pyarrow as pa
        import pyarrow.compute as pc
        t = t.take(pc.sort_indices(t.column("_chunk")))
        t = pa.concat_tables([t, t.slice(len(t) - 1)])           # the last row again, for the state after it
        cols = []
        for k, (n, r) in enumerate(zip(names, recurrences)):
            given = t.column(f"_seed{k}")[0].as_py() if seeded else None
            states = [tuple(r.start if given is None else given)]
            for told in t.column(n).to_pylist()[:-1]:
                states.append(r.fold(states[-1], told))
            cols.append(pa.array([list(s) for s in states], pa.list_(pa.float64())))
        chunk = t.column("_chunk").to_pylist()
        chunk[-1] += 1
        keys = [pa.array(chunk, t.column("_chunk").type) if f.name == "_chunk" else t.column(f.name) for f in fields]
        return pa.table([*keys, *cols], names=schema.names)

    # whole rows, halo included: so the exchange by (key, chunk) is the one that the windows use
    told = chunked.groupBy(*key, "_chunk").applyInArrow(summed, schema)
    if seeded:
        told = join_null_safe(told, seeds, key, "left")
    return told.groupBy(*key).applyInArrow(folded, schema)


def _run_recurrences(df: DataFrame, states: DataFrame, key: list[str], recurrences: Sequence[Recurrence]) -> DataFrame:
    """Chunk by chunk (bounded rows) in Arrow: sort by position, append the outputs."""
    names = [o for r in recurrences for o in r.outputs]
    schema = T.StructType(list(df.schema.fields) + [T.StructField(n, T.DoubleType()) for n in names])

    def run(t):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        t = t.take(pc.sort_indices(t.column("_rn")))
        for n, r in enumerate(recurrences):
            state = t.column(_told(n))[0].as_py()
            for name, values in r.compute(_in_order(t, r), state).items():
                t = t.append_column(name, pa.array(np.asarray(values, dtype="float64"), from_pandas=True))
        return t.select(schema.names)

    return join_null_safe(df, states, [*key, "_chunk"]).groupBy(*key, "_chunk").applyInArrow(run, schema)


def _chunked(df: DataFrame, key: list[str], order: list[str], lookback: int, bucket: Column | None, chunk_rows: int, min_rows: int) -> DataFrame:
    """Rows with their chunk and position, and the halo copies (``_native`` false)."""
    numbered = number_rows(df, key, order, bucket, min_rows=min_rows)
    c = F.floor(F.col("_rn") / F.lit(chunk_rows))
    in_halo = (F.col("_rn") % F.lit(chunk_rows)) >= F.lit(chunk_rows - lookback)
    native = F.struct(c.alias("c"), F.lit(True).alias("nat"))
    halo = F.struct((c + 1).alias("c"), F.lit(False).alias("nat"))
    copies = F.when(in_halo, F.array(native, halo)).otherwise(F.array(native))
    return numbered.withColumn("_cp", F.explode(copies)).select("*", F.col("_cp.c").alias("_chunk"), F.col("_cp.nat").alias("_native")).drop("_cp")


def resume(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], recurrences: Sequence[Recurrence],
           seeds: DataFrame | None = None, bucket: Column | None = None, chunk_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``recurrences`` over the rows that follow ``seeds`` (key columns,
    ``_seed0``, ...: the states that an earlier call returned; keys without one start anew), and the
    states after them, of the keys that have rows."""
    key = _cols(key)
    chunked = _chunked(df, key, _cols(order), 0, bucket, chunk_rows or chunk_rows_for(df), 0)
    states = _states(chunked, key, recurrences, seeds)
    rows = _run_recurrences(chunked, states, key, recurrences).drop("_chunk", "_native", "_rn")
    after = states.groupBy(*key).agg(*[F.max_by(_told(n), "_chunk").alias(f"_seed{n}") for n in range(len(recurrences))])
    return rows, after


def ordered_stages(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                   stages: Sequence[Stage], lookback: int, bucket: Column | None = None,
                   chunk_rows: int | None = None, recurrences: Sequence[Recurrence] = (), min_rows: int = 0) -> DataFrame:
    """Evaluate window ``stages``, then ``recurrences``, over each key's ordered
    rows; keys with fewer than ``min_rows`` rows are left out (FLT-06)."""
    key, order = _cols(key), _cols(order)
    chunk_rows = max(chunk_rows or chunk_rows_for(df), lookback + 1)
    out = _chunked(df, key, order, lookback, bucket, chunk_rows, min_rows)
    chunked, w = out, Window.partitionBy(*key, "_chunk").orderBy("_rn")
    for st in stages:
        out = out.select("*", *[fn(w).alias(n) for n, fn in st.items()])
    out = out.where(F.col("_native"))
    if recurrences:
        out = _run_recurrences(out, _states(chunked, key, recurrences), key, recurrences)
    return out.drop("_chunk", "_native", "_rn")
