"""Technical indicators as window specs (WIN-06/07, WIN-10..14, WIN-17).

RSI uses *simple* rolling means of gains and losses. The first row's missing
difference counts as zero gain and zero loss, so the first RSI value appears on
row ``n`` (1-based), as in the pandas original.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators.windows import Spec, diff, lag, plain, rolling_mean, rolling_std


def rsi(x: str, n: int = 14, mode: str = "strict", name: str | None = None) -> Spec:
    """Relative strength index (WIN-06 ``strict``, WIN-07 ``neutral``).

    ``strict``: average loss 0 gives 100 when there was a gain and NULL when
    the window is flat; NULL during warm-up.
    ``neutral``: average loss 0 or warm-up gives 50.
    """
    name = name or f"rsi_{n}"
    d, g, l, ag, al = (f"_{name}_{s}" for s in ("d", "g", "l", "ag", "al"))
    s1 = {d: diff(x)}
    s2 = {g: plain(F.when(F.col(d) > 0, F.col(d)).otherwise(F.lit(0.0))),
          l: plain(F.when(F.col(d) < 0, -F.col(d)).otherwise(F.lit(0.0)))}
    s3 = {ag: rolling_mean(g, n), al: rolling_mean(l, n)}
    G, L = F.col(ag), F.col(al)
    if mode == "strict":
        val = F.when(L == 0, F.when(G > 0, F.lit(100.0))) \
               .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + G / L))
    elif mode == "neutral":
        rs = F.try_divide(G, F.nullif(L, F.lit(0.0)))
        val = F.coalesce(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs), F.lit(50.0))
    else:
        raise ValueError(f"unknown rsi mode {mode!r}")
    return Spec([s1, s2, s3, {name: plain(val)}], n, {d, g, l, ag, al})


def bollinger(x: str, n: int = 20, k: float = 2.0, upper: str = "bb_upper", lower: str = "bb_lower",
              mid: str | None = None) -> Spec:
    """WIN-10: rolling mean plus/minus ``k`` sample standard deviations."""
    m, s = f"_{upper}_m", f"_{upper}_s"
    last = {upper: plain(F.col(m) + F.col(s) * F.lit(k)), lower: plain(F.col(m) - F.col(s) * F.lit(k))}
    temps = {m, s}
    if mid:
        last[mid] = plain(F.col(m))
    return Spec([{m: rolling_mean(x, n), s: rolling_std(x, n)}, last], n - 1, temps)


def true_range(high: str, low: str, close: str, name: str = "tr") -> Spec:
    """WIN-11: max(high-low, |high-prev close|, |low-prev close|), NULLs skipped."""
    pc = f"_{name}_pc"
    tr = F.greatest(F.col(high) - F.col(low), F.abs(F.col(high) - F.col(pc)), F.abs(F.col(low) - F.col(pc)))
    return Spec([{pc: lag(close, 1)}, {name: plain(tr)}], 1, {pc})


def atr(high: str, low: str, close: str, n: int = 14, name: str = "atr", tr_name: str = "tr",
        keep_tr: bool = True) -> Spec:
    """WIN-12: simple rolling mean of the true range."""
    t = true_range(high, low, close, tr_name)
    sp = Spec([*t.stages, {name: rolling_mean(tr_name, n)}], 1 + (n - 1), set(t.temps))
    if not keep_tr:
        sp.temps.add(tr_name)
    return sp


def moving_averages(x: str, windows=(5, 20, 60), prefix: str = "ma_") -> Spec:
    return Spec([{f"{prefix}{n}": rolling_mean(x, n) for n in windows}], max(windows) - 1)


def ma_cross(x: str, short: int = 5, long: int = 20, name: str = "cross",
             short_name: str | None = None, long_name: str | None = None) -> Spec:
    """WIN-14: per row 'golden', 'dead' or NULL from the two rolling means.

    golden: previous short <= previous long and now short > long;
    dead: previous short >= previous long and now short < long. A NULL
    comparison is no cross.
    """
    s = short_name or f"_{name}_s"
    lg = long_name or f"_{name}_l"
    ps, pl = f"_{name}_ps", f"_{name}_pl"
    st1 = {s: rolling_mean(x, short), lg: rolling_mean(x, long)}
    st2 = {ps: lag(s, 1), pl: lag(lg, 1)}
    S, Lc, PS, PL = F.col(s), F.col(lg), F.col(ps), F.col(pl)
    golden = F.coalesce((PS <= PL) & (S > Lc), F.lit(False))
    dead = F.coalesce((PS >= PL) & (S < Lc), F.lit(False))
    val = F.when(golden, F.lit("golden")).when(dead, F.lit("dead"))
    temps = {ps, pl}
    if not short_name:
        temps.add(s)
    if not long_name:
        temps.add(lg)
    return Spec([st1, st2, {name: plain(val)}], long, temps)


def golden_cross_flag(short_col: str, long_col: str, name: str = "is_golden_cross") -> Spec:
    """Golden cross of two existing columns against the previous row."""
    ps, pl = f"_{name}_ps", f"_{name}_pl"
    flag = F.coalesce((F.col(ps) <= F.col(pl)) & (F.col(short_col) > F.col(long_col)), F.lit(False))
    return Spec([{ps: lag(short_col, 1), pl: lag(long_col, 1)}, {name: plain(flag)}], 1, {ps, pl})


# Points of the trend score (short over middle, middle over long, RSI above half, golden cross).
SCORE_POINTS, SCORE_RSI = (30, 30, 20, 20), 50


def trend_score(ma5="ma_5", ma20="ma_20", ma60="ma_60", rsi_col="rsi_14", golden="is_golden_cross"):
    """WIN-17: +30 ma5>ma20, +30 ma20>ma60, +20 rsi>50, +20 golden cross; NULL adds 0."""
    def pts(cond, p):
        return F.when(F.coalesce(cond, F.lit(False)), F.lit(p)).otherwise(F.lit(0))
    short, middle, strong, cross = SCORE_POINTS
    return (pts(F.col(ma5) > F.col(ma20), short) + pts(F.col(ma20) > F.col(ma60), middle)
            + pts(F.col(rsi_col) > SCORE_RSI, strong) + pts(F.col(golden), cross)).cast("int")
