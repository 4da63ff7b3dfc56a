"""Profiling aggregates (AGG-01..06).

All of them are lazy plans of partial aggregates (map-side combine), so the
shuffle carries one small buffer per task and group, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.timestamps import weekday_name


def mean_by_hour(df: DataFrame, ts: str, x: str | dict[str, str], name: str | None = None) -> DataFrame:
    """Mean of ``x`` per hour of day 0-23; ``x`` may be ``{name: column}``
    for several means in the same aggregate."""
    cols = x if isinstance(x, dict) else {name or f"avg_{x}": x}
    return df.groupBy(F.hour(ts).alias("hour_of_day")).agg(*[F.avg(c).alias(n) for n, c in cols.items()])


def mean_by_weekday(df: DataFrame, ts: str, x: str, name: str | None = None) -> DataFrame:
    """Rows with NULL ``x`` dropped; mean per weekday (Mon = 0) with its name."""
    g = df.where(F.col(x).isNotNull()).groupBy(F.weekday(ts).alias("day_of_week")) \
          .agg(F.avg(x).alias(name or f"avg_{x}"))
    return g.withColumn("day_name", weekday_name("day_of_week"))


def _magnitude(x: Column) -> Column:
    """A bucket that never falls as x rises: steps of about 0.02 % of the
    magnitude, so a few million buckets hold every double there is."""
    return F.signum(x) * F.floor(F.log1p(F.abs(x)) * F.lit(4096.0))


def _profile(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row per column number ``i``: n, mean, std, least, most and ``q``, the
    exact quantiles (linear interpolation, the pandas / numpy default). NULL and NaN are left out.

    One lazy plan and one scan for any number of columns, the same at every
    size. Rows are counted per (column, value) by partial aggregates, so a value that fills a
    third of the table is one row per task. Values are totalled per magnitude bucket,
    with moments about the bucket's middle (no cancellation); running totals over a column's buckets
    say which bucket holds each rank asked for, and running counts inside those
    buckets pick the values. Nothing is sorted as a whole.
    """
    x, c, i, b, n = (F.col(k) for k in ("x", "c", "i", "b", "n"))
    cells = F.array(*[F.struct(F.lit(k).alias("i"), F.col(f"`{name}`").cast("double").alias("x")) for k, name in enumerate(cols)])
    long = df.select(F.explode(cells).alias("v")).select("v.*").where(x.isNotNull() & ~F.isnan(x))
    values = long.groupBy("i", "x").agg(F.count(F.lit(1)).alias("c")).withColumn("b", _magnitude(x))
    values = values.where(i.isNotNull() & b.isNotNull())      # as the join below tells: both uses share one exchange
    inside = Window.partitionBy("i", "b").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    placed = values.withColumn("run", F.sum("c").over(inside))
    middle = F.signum(b) * F.expm1(F.abs(b) / F.lit(4096.0))
    d = x - middle
    totals = placed.groupBy("i", "b").agg(F.sum("c").alias("t"), F.sum(c * d).alias("s"), F.sum(c * d * d).alias("ss"), F.min("x").alias("least"), F.max("x").alias("most"))
    of = Window.partitionBy("i")
    t = F.col("t")
    centre = middle + F.col("s") / t
    ranked = totals.select("*", (F.sum("t").over(of.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)) - t).alias("before"), F.sum("t").over(of).alias("n"),
                           (F.sum(t * centre).over(of) / F.sum("t").over(of)).alias("mean"))
    at = [F.lit(float(p)) * (n - 1) for p in probs]
    ranks = [r for a in at for r in (F.floor(a), F.ceil(a))]
    lo = F.col("before")
    per = ranked.groupBy("i").agg(
        F.max("n").alias("n"), F.max("mean").alias("mean"),
        F.sum(F.col("ss") - F.col("s") * F.col("s") / t + t * (centre - F.col("mean")) * (centre - F.col("mean"))).alias("spread"),
        F.min("least").alias("least"), F.max("most").alias("most"),
        F.array(*[F.max(F.when((lo <= r) & (r < lo + t), F.struct(b.alias("b"), (r - lo).alias("r")))) for r in ranks]).alias("asked"))
    # two ranks of each quantile and column: a few rows, broadcast, which carry the column's figures along
    figures = ("n", "mean", "spread", "least", "most")
    asked = per.select(i.alias("ai"), *[F.col(f).alias(f"p_{f}") for f in figures], F.posexplode("asked").alias("k", "w")) \
               .select("ai", *[f"p_{f}" for f in figures], "k", F.col("w.b").alias("ab"), F.col("w.r").alias("r"))
    run = F.col("run")
    hit = placed.join(F.broadcast(asked), (i == F.col("ai")) & (b == F.col("ab")) & (run - c <= F.col("r")) & (F.col("r") < run))
    row = hit.groupBy("i").agg(*[F.max(f"p_{f}").alias(f) for f in figures], *[F.max(F.when(F.col("k") == k, x)).alias(f"v{k}") for k in range(len(ranks))])
    q = [F.col(f"v{2 * k}") + (F.col(f"v{2 * k + 1}") - F.col(f"v{2 * k}")) * (a - F.floor(a)) for k, a in enumerate(at)]
    std = F.when(n > 1, F.sqrt(F.greatest(F.col("spread"), F.lit(0.0)) / (n - 1)))
    return row.select("i", "n", "mean", std.alias("std"), "least", "most", F.array(*q).alias("q"))


def quantile_row(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """One row with ``q``: exact quantiles of the numbers in ``col``, NULL without any."""
    one = df.sparkSession.range(1).select(F.lit(0).alias("z"))
    return one.join(_profile(df, [col], probs), F.col("z") == F.col("i"), "left").select("q")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """The quantiles of :func:`quantile_row` as numbers."""
    return list(quantile_row(df, col, probs).first()["q"] or [None] * len(probs))


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 % (linear interpolation), max, one
    row per column, as one lazy plan of one scan: see :func:`_profile`.
    ``approx=True`` uses moments and a fixed-size sketch in one aggregate instead."""
    probs, cols = [0.25, 0.5, 0.75], list(cols)
    names = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).alias("column")) for k, c in enumerate(cols)])
    every = df.sparkSession.range(1).select(F.explode(names).alias("e")).select("e.*")
    if approx:
        aggs = []
        for k, name in enumerate(cols):
            x = F.col(f"`{name}`").cast("double")
            x = F.when(~F.isnan(x), x)
            aggs.append(F.struct(F.lit(k).alias("i"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("least"), F.max(x).alias("most"),
                                 F.percentile_approx(x, probs, accuracy).cast("array<double>").alias("q")).alias(f"a{k}"))
        per = df.agg(*aggs).select(F.explode(F.array(*[F.col(f"a{k}") for k in range(len(cols))])).alias("a")).select("a.*")
    else:
        per = _profile(df, cols, probs)
    out = every.join(per, F.col("k") == F.col("i"), "left")
    return out.select("column", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"), "mean", "std", F.col("least").alias("min"),
                      *[F.col("q")[k].alias(p) for k, p in enumerate(("p25", "p50", "p75"))], F.col("most").alias("max"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column (one pass), long form: column, dtype, nulls, rows."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")] + \
           [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"_n{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                               F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(cols)])
    return row.select(F.explode(items).alias("p"), F.col("_rows").alias("rows")).select("p.*", "rows")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix after listwise removal of NULL and NaN, long form (col_a,
    col_b, r). One lazy aggregate of mergeable co-moments, a group for each
    column with its covariances to all, so each task sends one row per column, whatever the row
    count. A constant column, and a frame without rows, give NULL."""
    cols, k = list(cols), len(cols)
    names = [f"x{i}" for i in range(k)]
    clean = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols, names)])
    clean = clean.where(reduce(and_, [F.col(n).isNotNull() & ~F.isnan(n) for n in names]))
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.col(n).alias("a")) for i, n in enumerate(names)])
    long = clean.select(*names, F.explode(each).alias("e")).select(*names, "e.i", "e.a")
    found = long.groupBy("i").agg(*[F.covar_pop("a", n).alias(f"c{j}") for j, n in enumerate(names)])
    row = found.agg(F.map_from_entries(F.collect_list(F.struct("i", F.array(*[F.col(f"c{j}") for j in range(k)])))).alias("c"))      # one entry per column
    told = F.array(*[F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"), F.lit(min(i, j)).alias("i"), F.lit(max(i, j)).alias("j"))
                     for i in range(k) for j in range(k)])
    out = row.select("c", F.explode(told).alias("t")).select("c", "t.*")
    of = lambda i, j: F.get(F.try_element_at("c", F.col(i)), F.col(j))
    r = F.try_divide(of("i", "j"), F.sqrt(of("i", "i")) * F.sqrt(of("j", "j")))
    return out.select("col_a", "col_b", r.alias("r")).select("col_a", "col_b", F.when(~F.isnan("r"), F.col("r")).alias("r"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))
