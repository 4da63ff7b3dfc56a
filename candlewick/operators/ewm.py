"""Exponentially weighted means (WIN-08, WIN-09).

pandas ``ewm(span, adjust=False)``: alpha = 2/(span+1), d = 1-alpha,
y0 = x0 and y_t = d*y_{t-1} + alpha*x_t; a NULL x keeps the last mean and
still ages the older weights.

A recurrence has no built-in window form, so it runs chunk by chunk in Arrow
on the layout of :mod:`candlewick.operators.series`, as a blocked scan: what a
chunk does to the state before it is an affine map (``summary``), the maps of a key's chunks
are composed in order (``fold``), and each chunk starts from the state that
comes out (``compute``). There is no halo, any span and any run of NULLs give
what one pass over the whole series gives, whatever the chunk size. Fast mean, slow mean and signal
come from the same pass. NaN counts as NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import isnan, nan

from pyspark.sql import Column, DataFrame

from candlewick.operators.series import ordered_stages


def alpha_of_span(span: float) -> float:
    return 2.0 / (span + 1.0)


def _mean(x, span: float):
    import pandas as pd
    return pd.Series(x).ewm(span=span, adjust=False).mean().to_numpy()


def _from(start: float, x, span: float):
    """Means of x after a row whose mean is ``start``."""
    import numpy as np
    return _mean(np.concatenate([[start], x]), span)[1:]


def _first(x) -> int:
    """Position of the first value, or -1."""
    import numpy as np
    at = np.flatnonzero(~np.isnan(x))
    return int(at[0]) if len(at) else -1


def _join(mean: float, rows: float, value: float, span: float) -> float:
    """The mean that a value ``rows`` rows after the last one makes of ``mean``."""
    if isnan(mean):
        return value
    alpha = alpha_of_span(span)
    weight = (1.0 - alpha) ** rows
    return (weight * mean + alpha * value) / (weight + alpha)


def _means(x, span: float, mean: float, age: float):
    """Means of a chunk from the mean before it and the rows since that took its last value."""
    import numpy as np
    p = _first(x)
    if p < 0:
        return np.full(len(x), mean)
    start = _join(mean, age + p + 1, x[p], span)
    return np.concatenate([np.full(p, mean), [start], _from(start, x[p + 1:], span)])


def _lines(rest, span: float):
    """Means of ``rest`` as ``a * start + b``, both by row."""
    return _from(1.0, rest * 0.0, span), _from(0.0, rest, span)


def _last(x, default: float) -> float:
    return float(x[-1]) if len(x) else default


def _age(x) -> int:
    """Rows since the last value (x has one)."""
    import numpy as np
    return len(x) - 1 - int(np.flatnonzero(~np.isnan(x))[-1])


@dataclass(frozen=True)
class Ewm:
    """EWM of ``x`` with ``span`` as column ``out``. State: mean, rows since its last value."""
    out: str
    x: str
    span: float
    start = (nan, 0.0)

    @property
    def inputs(self):
        return (self.x,)

    @property
    def outputs(self):
        return (self.out,)

    def summary(self, ins: dict) -> list[float]:
        x = ins[self.x]
        p = _first(x)
        if p < 0:
            return [len(x), p, nan, 1.0, 0.0, 0.0]
        a, b = _lines(x[p + 1:], self.span)
        return [len(x), p, float(x[p]), _last(a, 1.0), _last(b, 0.0), _age(x)]

    def fold(self, state: Sequence[float], told: Sequence[float]) -> tuple[float, ...]:
        (mean, age), (n, p, value, a, b, left) = state, told
        return (mean, age + n) if p < 0 else (a * _join(mean, age + p + 1, value, self.span) + b, left)

    def compute(self, ins: dict, state: Sequence[float]) -> dict:
        return {self.out: _means(ins[self.x], self.span, *state)}


@dataclass(frozen=True)
class Macd:
    """EWM(fast) - EWM(slow) of ``x``, and its EWM(signal). State: fast mean, slow mean, signal, rows since the last value."""
    x: str
    fast: float = 12
    slow: float = 26
    signal: float = 9
    names: tuple[str, str] = ("macd", "macd_signal")
    start = (nan, nan, nan, 0.0)

    @property
    def inputs(self):
        return (self.x,)

    @property
    def outputs(self):
        return self.names

    def summary(self, ins: dict) -> list[float]:
        x = ins[self.x]
        p = _first(x)
        if p < 0:
            return [len(x), p, nan, 1.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0]
        rest = x[p + 1:]
        (fa, fb), (sa, sb) = _lines(rest, self.fast), _lines(rest, self.slow)
        into = [_last(_from(0.0, u, self.signal), 0.0) for u in (fa, sa, fb - sb)]     # what each part leaves in the signal
        kept = (1.0 - alpha_of_span(self.signal)) ** len(rest)
        return [len(x), p, float(x[p]), _last(fa, 1.0), _last(fb, 0.0), _last(sa, 1.0), _last(sb, 0.0), kept, *into, _age(x)]

    def fold(self, state: Sequence[float], told: Sequence[float]) -> tuple[float, ...]:
        fast, slow, signal, age = state
        n, p, value, fa, fb, sa, sb, kept, into_f, into_s, into_b, left = told
        alpha = alpha_of_span(self.signal)
        held = (1.0 - alpha) ** (n if p < 0 else p)               # rows without a value: the difference stays as it is
        signal = held * signal + (1.0 - held) * (fast - slow)
        if p < 0:
            return fast, slow, signal, age + n
        f, s = _join(fast, age + p + 1, value, self.fast), _join(slow, age + p + 1, value, self.slow)
        signal = f - s if isnan(signal) else (1.0 - alpha) * signal + alpha * (f - s)
        return fa * f + fb, sa * s + sb, kept * signal + into_f * f - into_s * s + into_b, left

    def compute(self, ins: dict, state: Sequence[float]) -> dict:
        fast, slow, signal, age = state
        m = _means(ins[self.x], self.fast, fast, age) - _means(ins[self.x], self.slow, slow, age)
        return {self.names[0]: m, self.names[1]: _mean(m, self.signal) if isnan(signal) else _from(signal, m, self.signal)}


def ewm_mean(df: DataFrame, key, order, columns: Mapping[str, tuple[str, float]],
             bucket: Column | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Add ``{out: (x, span)}`` EWM columns."""
    return ordered_stages(df, key, order, [], 0, bucket, chunk_rows, [Ewm(o, x, s) for o, (x, s) in columns.items()])


def macd(df: DataFrame, key, order, x: str, fast: int = 12, slow: int = 26, signal: int = 9,
         names=("macd", "macd_signal"), bucket: Column | None = None, chunk_rows: int | None = None) -> DataFrame:
    """EWM(fast) - EWM(slow) and its EWM(signal)."""
    return ordered_stages(df, key, order, [], 0, bucket, chunk_rows, [Macd(x, fast, slow, signal, tuple(names))])
