"""The keyed state's work: a few state calls for a bucket, not for each of its symbols, and a log cut as it outgrows the cap."""

import datetime as dt

import pandas as pd

from candlewick.streaming import replay
from candlewick.streaming.keyed_state import INPUT, SEGMENT, SymbolState


class Handle:
    """State variables in memory that count their calls."""

    def __init__(self):
        self.value, self.map, self.calls = None, {}, 0

    def getValueState(self, *names):
        return self

    getMapState = getValueState

    def _count(self, x=None):
        self.calls += 1
        return x

    def get(self):
        return self._count(self.value)

    def update(self, v):
        self.value = self._count(v)

    def getValue(self, k):
        return self._count(self.map.get(k))

    def updateValue(self, k, v):
        self.map[k] = self._count(v)

    def removeKey(self, k):
        self._count(self.map.pop(k, None))


def frame(offsets, symbols):
    t = dt.datetime(2024, 1, 1)
    rows = [(0, f"S{o % symbols}", "trade", t, t, "x", 0, o, float(o % 7), 1.0, "BID", None, None, None, t) for o in offsets]
    df = pd.DataFrame(rows, columns=INPUT)
    return df.assign(ts=pd.to_datetime(df["ts"]), arrived=pd.to_datetime(df["arrived"]))


def test_calls_do_not_grow_with_the_symbols():
    h, s = Handle(), SymbolState()
    s.init(h)
    list(s.handleInputRows((0,), iter([frame(range(SEGMENT), SEGMENT)]), None))
    assert len(h.value[0]) == SEGMENT and h.calls <= 6


def test_log_is_cut_and_holds_the_newest():
    h, s, symbols, cap = Handle(), SymbolState(cap=30), 3, 30
    s.init(h)
    for at in range(0, 3000, 100):
        list(s.handleInputRows((0,), iter([frame(range(at, at + 100), symbols)]), None))
        first = {r[0]: r[3][1] for r in h.value[0]}
        log = [r for v in h.map.values() for r in v[0]]
        kept = sorted(r[5] for r in log if r[1] >= first[r[0]])
        assert kept == sorted(o for k in range(symbols) for o in [*range(k, at + 100, symbols)][-cap:])
        assert len(log) == h.value[3] <= 2 * symbols * cap + SEGMENT


def test_files_of_a_span_grow_with_the_events(spark):
    small, large = (replay.files_of(spark.range(n)) for n in (1000, 12 * 20_000 * 5))
    assert (small, large) == (replay.FILES, 5)


def test_a_symbol_is_a_few_values_in_the_state():
    """Spark turns every value of a state row over in Python at each micro-batch."""
    h, s, symbols = Handle(), SymbolState(), 50
    s.init(h)
    for at in range(0, 30 * symbols, symbols):
        list(s.handleInputRows((0,), iter([frame(range(at, at + symbols), symbols)]), None))
    values = lambda x: sum(map(values, x)) if isinstance(x, (tuple, list)) else 1
    assert values(h.value[0]) <= 6 * symbols


def test_windows_of_symbols_do_not_mix():
    """Crosses of symbols that share a bucket, new and known, cut into batches anyhow, are those of each alone."""
    prices = {f"S{n}": [float((i * i + n) % 17) for i in range(2, 4 + 9 * n)] for n in range(6)}
    rows = sorted((i + 7 * (n % 3), n, f"S{n}", p) for n in range(6) for i, p in enumerate(prices[f"S{n}"]))
    t = dt.datetime(2024, 1, 1)
    df = pd.DataFrame([(0, s, "trade", t, t, "x", 0, o, p, 1.0, "BID", None, None, None, t) for o, (_, _, s, p) in enumerate(rows)], columns=INPUT)
    df = df.assign(**{c: pd.to_datetime(df[c]) for c in ("ts", "arrived", "last_updated")})
    mean = lambda x, k, n: sum(x[k - n + 1:k + 1]) / n
    want = []
    for s, x in prices.items():
        for k in range(20, len(x)):
            a, b, c, d = (mean(x, j, n) for j in (k - 1, k) for n in (5, 20))
            want += [(s, "golden" if a <= b and c > d else "dead", round(c, 9), round(d, 9))] if (a <= b and c > d) or (a >= b and c < d) else []
    for step in (3, 40, len(df)):
        h, state = Handle(), SymbolState()
        state.init(h)
        got = [r for at in range(0, len(df), step) for out in state.handleInputRows((0,), iter([df[at:at + step].reset_index(drop=True)]), None) for r in out.itertuples()]
        assert sorted((r.symbol, r.kind, round(r.ma_short, 9), round(r.ma_long, 9)) for r in got) == sorted(want) and want


def test_latest_values_that_are_no_numbers_are_read_back(spark):
    from pyspark.sql import functions as F

    from candlewick.streaming.keyed_state import LATEST
    df = frame(range(3), 3).assign(kind="ticker", price=[float("nan"), float("-inf"), 0.1], data='{"a":"\u00e9\\"x"}')
    h, s = Handle(), SymbolState()
    s.init(h)
    list(s.handleInputRows((0,), iter([df]), None))
    read = spark.createDataFrame([(r[1],) for r in sorted(h.value[0])], "v string").select(F.from_json("v", f"struct<{LATEST['ticker']}>").alias("v")).select("v.*").collect()
    assert [str(r["price"]) for r in read] == ["nan", "-inf", "0.1"] and read[0]["data"] == '{"a":"\u00e9\\"x"}'
    assert [r["offset"] for r in read] == [0, 1, 2] and read[0]["ts"] == 1_704_067_200_000_000


def test_rows_are_one_text_in_the_store(spark):
    """What a state call carries does not grow in values with the bucket's symbols or trades, and Spark reads it back whole."""
    from candlewick.streaming.keyed_state import SYMBOL, TRADE, PackedSymbolState, unpacked
    plain, packed, symbols = Handle(), Handle(), 40
    for h, s in ((plain, SymbolState(cap=30)), (packed, PackedSymbolState(cap=30))):
        s.init(h)
        for at in range(0, 100 * symbols, 25 * symbols):
            df = frame(range(at, at + 25 * symbols), symbols)
            df = df.assign(topic=[None if o % 3 else "a\u00e9\U0001f600\"" for o in df["offset"]], price=[float("nan") if o % 11 == 0 else o / 7 for o in df["offset"]])
            list(s.handleInputRows((0,), iter([df]), None))
        tick = frame(range(4000, 4000 + symbols // 2), symbols).assign(kind="ticker", data='{"a":1}')
        list(s.handleInputRows((0,), iter([tick]), None))
    assert len(packed.value) == 4 and isinstance(packed.value[0], str) and all(len(v) == 1 and isinstance(v[0], str) for v in packed.map.values())
    assert packed.value[1:] == plain.value[1:] and packed.calls == plain.calls
    read = lambda texts, columns: sorted(map(str, map(tuple, unpacked(spark.createDataFrame([(t,) for t in texts], "t string"), "t", columns).collect())))
    assert read([v[0] for v in packed.map.values()], TRADE) == sorted(str(tuple(r)) for v in plain.map.values() for r in v[0])
    assert read([packed.value[0]], SYMBOL) == sorted(str((r[0], r[1], r[2], *r[3])) for r in plain.value[0])
