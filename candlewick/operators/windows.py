"""Row-frame analytics over an ordered keyed series (WIN-01..05, WIN-18).

Every builder returns ``build(w) -> Column`` for a window spec ``w`` that is
already partitioned by key and ordered by time; :class:`Spec` bundles builders
into stages with the lookback they need, and :func:`apply_specs` runs any
number of specs over one shared sort (see :mod:`candlewick.operators.series`).

NULL conventions follow pandas: a rolling statistic over ``n`` rows is NULL
until the frame holds ``n`` non-NULL values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from candlewick.operators.series import Recurrence, Stage, ordered_stages

Builder = Callable[[WindowSpec], Column]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def rolling_mean(x, n: int) -> Builder:
    """WIN-01: mean of the last ``n`` rows; NULL until ``n`` non-NULL values."""
    def build(w):
        f = last_rows(w, n)
        return F.when(F.count(_c(x)).over(f) == n, F.avg(_c(x)).over(f))
    return build


def rolling_std(x, n: int) -> Builder:
    """WIN-02: sample standard deviation (n-1) of the last ``n`` rows, same NULL rule."""
    def build(w):
        f = last_rows(w, n)
        return F.when(F.count(_c(x)).over(f) == n, F.stddev_samp(_c(x)).over(f))
    return build


def lag(x, k: int = 1) -> Builder:
    """WIN-04: the value ``k`` rows earlier."""
    return lambda w: F.lag(_c(x), k).over(w)


def diff(x, k: int = 1) -> Builder:
    """WIN-03: x minus the value ``k`` rows earlier; first ``k`` rows NULL."""
    return lambda w: _c(x) - F.lag(_c(x), k).over(w)


def rate_of_change(x, p: int) -> Builder:
    """WIN-05: (x / x[-p] - 1) * 100; NULL on the first ``p`` rows and on a zero base."""
    return lambda w: (F.try_divide(_c(x), F.lag(_c(x), p).over(w)) - F.lit(1)) * F.lit(100)


def plain(expr) -> Builder:
    """A row-local expression inside a stage (ignores the window)."""
    return lambda w: _c(expr)


@dataclass
class Spec:
    """Stages of window builders plus the rows of history they look back."""
    stages: list[Stage]
    lookback: int
    temps: set[str] = field(default_factory=set)


def combine(*specs: Spec) -> Spec:
    """Merge independent specs stage by stage so they share one sort."""
    depth = max(len(s.stages) for s in specs)
    stages: list[Stage] = [dict() for _ in range(depth)]
    for s in specs:
        for i, st in enumerate(s.stages):
            stages[i].update(st)
    return Spec(stages, max(s.lookback for s in specs), set().union(*[s.temps for s in specs]))


def chain(*specs: Spec) -> Spec:
    """Run specs one after another, for specs that read earlier outputs
    (e.g. a cross flag over moving averages); lookbacks add up."""
    stages: list[Stage] = []
    for s in specs:
        stages.extend(s.stages)
    return Spec(stages, sum(s.lookback for s in specs), set().union(*[s.temps for s in specs]))


def apply_specs(df: DataFrame, key, order, *specs: Spec, bucket: Column | None = None, chunk_rows: int | None = None,
                recurrences: Sequence[Recurrence] = (), min_rows: int = 0) -> DataFrame:
    """Evaluate specs (and recurrences) over each key's ordered rows and drop
    helper columns; keys with fewer than ``min_rows`` rows are left out."""
    sp = combine(*specs)
    out = ordered_stages(df, key, order, sp.stages, sp.lookback, bucket, chunk_rows, recurrences, min_rows)
    return out.drop(*sorted(sp.temps)) if sp.temps else out


# The windows, periods and lags of the feature expansion.
FEATURE_MA, FEATURE_ROC, FEATURE_LAGS = (5, 10, 20), (1, 3, 5), (1, 2, 3)


# -- WIN-18: feature expansion ------------------------------------------------

def expand_features(price: str, volume: str | None, ts: str, ma: Sequence[int] = FEATURE_MA,
                    roc: Sequence[int] = FEATURE_ROC, lags: Sequence[int] = FEATURE_LAGS,
                    prefix_price: str = "price", prefix_volume: str = "volume") -> Spec:
    """MA and lags of price and volume, RoC of price, hour and weekday (Mon=0)."""
    st: Stage = {}
    for n in ma:
        st[f"{prefix_price}_ma{n}"] = rolling_mean(price, n)
        if volume:
            st[f"{prefix_volume}_ma{n}"] = rolling_mean(volume, n)
    for p in roc:
        st[f"{prefix_price}_roc{p}"] = rate_of_change(price, p)
    st["hour_of_day"] = plain(F.hour(ts))
    st["day_of_week"] = plain(F.weekday(ts))
    for k in lags:
        st[f"{prefix_price}_lag{k}"] = lag(price, k)
        if volume:
            st[f"{prefix_volume}_lag{k}"] = lag(volume, k)
    look = max([*(n - 1 for n in ma), *roc, *lags, 0])
    return Spec([st], look)
