"""Indicators: hand-computed goldens, pandas parity, one or many chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators.ewm import ewm_mean, macd
from candlewick.operators.indicators import atr, bollinger, ma_cross, moving_averages, rsi
from candlewick.operators.windows import Spec, apply_specs, diff, rate_of_change, rolling_mean, rolling_std


def series(spark, rows):
    return spark.createDataFrame(rows, "symbol string, t long, close double, high double, low double")


def walk(spark, keys=3, n=300, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(keys):
        x = 100 + np.cumsum(rng.normal(0, 1, n))
        for i, v in enumerate(x):
            rows.append((f"S{k}", i, float(round(v, 2)), float(round(v + 1.5, 2)), float(round(v - 1.25, 2))))
    return series(spark, rows), pd.DataFrame(rows, columns=["symbol", "t", "close", "high", "low"])


def collect(df, cols):
    return df.orderBy("symbol", "t").select(*cols).toPandas()


def test_constant_series_rsi(spark):
    df = series(spark, [("A", i, 10.0, 10.0, 10.0) for i in range(20)])
    out = collect(apply_specs(df, "symbol", "t", rsi("close", 14, "strict"),
                              rsi("close", 14, "neutral", name="rsi_n")), ["rsi_14", "rsi_n"])
    assert out.rsi_14.isna().all()            # flat window: undefined in strict mode
    assert (out.rsi_n == 50).all()            # neutral mode


def test_all_gain_series_and_warmup(spark):
    df = series(spark, [("A", i, float(i), float(i), float(i)) for i in range(20)])
    out = collect(apply_specs(df, "symbol", "t", rsi("close", 14, "strict"),
                              rsi("close", 14, "neutral", name="rsi_n")), ["rsi_14", "rsi_n"])
    # the first missing diff counts as zero: first value on row 14 (index 13)
    assert out.rsi_14[:13].isna().all() and out.rsi_14[13] == 100
    assert (out.rsi_14[13:] == 100).all()
    assert (out.rsi_n == 50).all()            # loss mean 0 -> neutral 50


def test_true_range_first_row(spark):
    df = series(spark, [("A", 0, 10.0, 12.0, 9.0), ("A", 1, 11.0, 11.5, 10.5), ("A", 2, 8.0, 9.0, 7.0)])
    out = collect(apply_specs(df, "symbol", "t", atr("high", "low", "close", 2)), ["tr", "atr"])
    # row 1 = high-low; then the largest of high-low, |high-prev close|, |low-prev close|
    assert out.tr.tolist() == [3.0, 1.5, 4.0]
    assert np.isnan(out.atr[0]) and out.atr[1] == 2.25 and out.atr[2] == 2.75


@pytest.mark.parametrize("chunk_rows", [None, 64])
def test_pandas_parity(spark, chunk_rows):
    df, pdf = walk(spark)
    out = apply_specs(df, "symbol", "t", moving_averages("close", (5, 20, 60)), rsi("close", 14, "strict"),
                      rsi("close", 14, "neutral", name="rsi_n"), bollinger("close", 20, 2.0, mid="bb_mid"),
                      atr("high", "low", "close", 14),
                      Spec([{"std_20": rolling_std("close", 20), "d1": diff("close"),
                             "roc3": rate_of_change("close", 3), "ma7": rolling_mean("close", 7)}], 19),
                      chunk_rows=chunk_rows)
    got = collect(out, ["ma_5", "ma_20", "ma_60", "rsi_14", "rsi_n", "bb_upper", "bb_lower", "bb_mid", "tr",
                        "atr", "std_20", "d1", "roc3", "ma7"])
    exp = []
    for _, g in pdf.groupby("symbol"):
        c = g.close
        d = c.diff()
        gain = d.where(d > 0, 0).rolling(14).mean()
        loss = (-d.where(d < 0, 0)).rolling(14).mean()
        pc = c.shift(1)
        tr = pd.concat([g.high - g.low, (g.high - pc).abs(), (g.low - pc).abs()], axis=1).max(axis=1)
        m, s = c.rolling(20).mean(), c.rolling(20).std()
        exp.append(pd.DataFrame({
            "ma_5": c.rolling(5).mean(), "ma_20": m, "ma_60": c.rolling(60).mean(),
            "rsi_14": 100 - 100 / (1 + gain / loss),
            "rsi_n": (100 - 100 / (1 + gain / loss.replace(0, np.nan))).fillna(50),
            "bb_upper": m + 2 * s, "bb_lower": m - 2 * s, "bb_mid": m, "tr": tr, "atr": tr.rolling(14).mean(),
            "std_20": s, "d1": d, "roc3": c.pct_change(3) * 100, "ma7": c.rolling(7).mean()}))
    exp = pd.concat(exp).reset_index(drop=True)
    for col in exp.columns:
        a, b = got[col].to_numpy(float), exp[col].to_numpy(float)
        assert np.array_equal(np.isnan(a), np.isnan(b)), col
        assert np.nanmax(np.abs(a - b) / np.maximum(1, np.abs(b))) < 1e-9, col
    ok = got.dropna()
    assert ((ok.bb_lower <= ok.bb_mid + 1e-9) & (ok.bb_mid <= ok.bb_upper + 1e-9)).all()
    assert ((ok.rsi_14 >= 0) & (ok.rsi_14 <= 100)).all()
    assert (got.tr >= (pdf.sort_values(["symbol", "t"]).high - pdf.sort_values(["symbol", "t"]).low).to_numpy() - 1e-9).all()


@pytest.mark.parametrize("span", [2, 9, 12, 26, 200])
def test_ewm_matches_pandas(spark, span):
    df, pdf = walk(spark, keys=2, n=1500, seed=span)
    out = collect(ewm_mean(df, "symbol", "t", {"e": ("close", span)}), ["e"])
    exp = pd.concat([g.close.ewm(span=span, adjust=False).mean() for _, g in pdf.groupby("symbol")])
    assert np.max(np.abs(out.e.to_numpy() - exp.to_numpy()) / np.abs(exp.to_numpy())) < 1e-12


def test_ewm_chunked_layout_and_macd(spark):
    df, pdf = walk(spark, keys=2, n=900, seed=3)
    a = collect(macd(df, "symbol", "t", "close"), ["macd", "macd_signal"])
    b = collect(macd(df, "symbol", "t", "close", chunk_rows=64), ["macd", "macd_signal"])
    exp = []
    for _, g in pdf.groupby("symbol"):
        m = g.close.ewm(span=12, adjust=False).mean() - g.close.ewm(span=26, adjust=False).mean()
        exp.append(pd.DataFrame({"macd": m, "macd_signal": m.ewm(span=9, adjust=False).mean()}))
    exp = pd.concat(exp).reset_index(drop=True)
    for got in (a, b):
        assert np.max(np.abs(got.macd - exp.macd)) < 1e-8
        assert np.max(np.abs(got.macd_signal - exp.macd_signal)) < 1e-8


def test_ma_cross_kinds(spark):
    prices = [10.0] * 20 + [20.0, 20.0, 1.0, 1.0, 1.0, 1.0]
    df = series(spark, [("A", i, p, p, p) for i, p in enumerate(prices)])
    out = collect(apply_specs(df, "symbol", "t", ma_cross("close", 2, 4)), ["t", "cross"])
    kinds = dict(zip(out.t, out.cross))
    assert kinds[20] == "golden"              # short rises above long
    assert kinds[22] == "dead" or kinds[23] == "dead"
    assert out.cross.isna().sum() == len(prices) - 2


def test_result_independent_of_input_order(spark):
    df, _ = walk(spark, keys=2, n=120)
    a = collect(apply_specs(df, "symbol", "t", rsi("close")), ["rsi_14"])
    b = collect(apply_specs(df.orderBy(F.rand(1)).repartition(5), "symbol", "t", rsi("close")),
                ["rsi_14"])
    assert np.allclose(a.rsi_14.fillna(-1), b.rsi_14.fillna(-1))


def test_ewm_over_many_chunks_and_gaps(spark):
    df, pdf = walk(spark, keys=2, n=6000, seed=11)
    gaps = df.withColumn("close", F.when(F.col("t") % 5 != 3, F.col("close")))
    out = collect(ewm_mean(gaps, "symbol", "t", {"e": ("close", 3)}, chunk_rows=1077), ["e"])
    pdf = pdf.assign(close=pdf.close.where(pdf.t % 5 != 3))
    exp = pd.concat([g.close.ewm(span=3, adjust=False).mean() for _, g in pdf.groupby("symbol")])
    assert np.max(np.abs(out.e.to_numpy() - exp.to_numpy())) < 1e-9
    small = collect(ewm_mean(spark.createDataFrame([("A", 0, 1.0), ("A", 1, None), ("A", 2, 3.0)], "symbol string, t long, close double"),
                             "symbol", "t", {"e": ("close", 3)}), ["e"])
    assert np.allclose(small.e, [1.0, 1.0, 7 / 3])


@pytest.mark.parametrize("chunk_rows", [7, 400, 1200, 100_000])
def test_ewm_and_macd_do_not_depend_on_the_chunks(spark, chunk_rows):
    """Leading NULLs, gaps longer than several chunks, a span longer than the series, a NULL key, a key of NULLs only."""
    n, rng = 3000, np.random.default_rng(5)
    x = np.round(100 + np.cumsum(rng.normal(0, 1, n)), 2)
    gap = x.copy()
    gap[1:2999] = np.nan
    some = x.copy()
    some[:20], some[100:1400], some[1500:1507] = np.nan, np.nan, np.nan
    told = {"gap": gap, "some": some, None: x, "none": np.full(50, np.nan)}
    if chunk_rows == 7:
        told = {k: v[:120] for k, v in told.items()}
    df = spark.createDataFrame([(k, i, None if np.isnan(v) else float(v)) for k, xs in told.items() for i, v in enumerate(xs)], "symbol string, t long, close double")
    ewm = ewm_mean(df, "symbol", "t", {"e3": ("close", 3), "e5000": ("close", 5000)}, chunk_rows=chunk_rows).toPandas()
    both = macd(df, "symbol", "t", "close", chunk_rows=chunk_rows).toPandas()
    for k, xs in told.items():
        s = pd.Series(xs)
        line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
        want = {"e3": s.ewm(span=3, adjust=False).mean(), "e5000": s.ewm(span=5000, adjust=False).mean(), "macd": line, "macd_signal": line.ewm(span=9, adjust=False).mean()}
        for c, w in want.items():
            d = ewm if c[0] == "e" else both
            got = d[d.symbol.isna() if k is None else d.symbol == k].sort_values("t")[c].to_numpy(dtype=float)
            assert np.allclose(got, w.to_numpy(), rtol=1e-9, atol=1e-9, equal_nan=True), (k, c)


def test_recurrences_beside_windows_keep_halo_only_chunks_out(spark):
    df, pdf = walk(spark, keys=1, n=20, seed=2)
    from candlewick.operators.ewm import Ewm
    out = collect(apply_specs(df, "symbol", "t", Spec([{"m": rolling_mean("close", 4)}], 3), chunk_rows=5, recurrences=[Ewm("e", "close", 4)]), ["m", "e"])
    assert np.allclose(out.m, pdf.close.rolling(4).mean(), equal_nan=True) and np.allclose(out.e, pdf.close.ewm(span=4, adjust=False).mean())


@pytest.mark.parametrize("kind", ["string", "double", "decimal(20,4)", "date", "timestamp", "binary", "int"])
def test_every_orderable_type_has_a_bucket(spark, kind):
    """One key holds a third of the rows; positions equal the plain rank for any order type, NULL first."""
    from candlewick.operators.series import number_rows
    base = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', cast(id % 40 as string)) as k", "id", "(id * 7919) % 900 as v")
    text = {"date": "cast(date_add(date'2020-01-01', cast(v as int)) as date)", "timestamp": "timestamp_seconds(v * 37)", "binary": "cast(lpad(v, 5, '0') as binary)",
            "string": "lpad(v, 5, '0')"}.get(kind, f"cast(v * 31.5 - 9000 as {kind})")
    df = base.selectExpr("nullif(k, '7') as k", "id", f"if(v % 50 = 0, null, {text}) as o")
    from pyspark.sql import Window
    want = df.withColumn("_rn", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")) - 1)
    got = number_rows(df, ["k"], ["o", "id"])
    assert sorted(map(tuple, got.select("id", "_rn").collect())) == sorted(map(tuple, want.select("id", "_rn").collect()))
