"""Per-symbol state of the hot path in Spark's own state store.

One ``transformWithState`` operator on the RocksDB provider. Symbols meet in
``BUCKETS`` hash buckets, which are its keys: a micro-batch costs a few state
calls for each bucket, not for each symbol. Two state variables hold a bucket:

* ``symbols``, a value: of each symbol, as JSON texts that cross into the state store as they are, the latest ticker and order book by (event time, topic,
  partition, offset), so an older event never overwrites a newer one (SNK-06, STR-03), and ``cross``:
  the last ``long`` prices with the last two means, a window that
  slides over every trade, so a cross is found at every trade and not only at
  a batch's newest one (STR-05), with the newest offset taken from each source partition, so a
  redelivered message changes nothing, and the number of its oldest kept trade;
* ``trades``, a map of segments: the log of the bucket's trades by arrival. A micro-batch appends
  to the last segment; trades beyond a symbol's newest ``cap`` are passed over by readers at once
  and cut when the log holds twice as many as are kept, segment by segment,
  so the work is that of the new trades, not of the cap (SNK-05, STR-04).

The running query keeps a bucket's rows, and a segment's, packed as one JSON text each (:class:`PackedSymbolState`).

Arrival order of a symbol's messages is (source timestamp, topic, partition,
offset); what is kept does not depend on how the messages are cut into
batches. Memory of a task is one bucket's rows of one micro-batch, which the
source's trigger limits bound, its symbols' latest values and at most two segments.

State is read back with Spark's state data source (:func:`read_state`), alerts
come out of the operator as rows for an append sink.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state provider that transformWithState needs; a commit writes the batch's changes, whole snapshots follow in the background.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}

#: Trades of a segment of the history.
SEGMENT = 256

#: Hash buckets of symbols; a checkpoint keeps the number it was started with.
BUCKETS = 512

#: Stands for a missing offset inside the state: below every offset.
NO_OFFSET = -1

_AT = "ts:bigint,topic:string,partition:int,offset:bigint"
#: What the JSON texts inside the state hold, by column; times are microseconds.
LATEST = {"ticker": f"{_AT},price:double,data:string,last_updated:bigint",
          "orderbook": f"{_AT},total_ask_size:double,total_bid_size:double,data:string,last_updated:bigint"}
WINDOW = "prices:array<double>,ma_short:double,ma_long:double,seen:array<struct<topic:string,partition:int,offset:bigint>>"
SYMBOLS = ("rows array<struct<symbol:string,ticker:string,orderbook:string,cross:struct<taken:bigint,first:bigint,window:string>>>, "
           "low long, high long, held long")        # the log's first and last segment and its rows
TRADE = f"symbol:string,number:bigint,{_AT},price:double,volume:double,side:string"
SEGMENT_ROWS = f"rows array<struct<{TRADE}>>"
#: The same rows as the running query keeps them: one JSON text, an array for each column.
SYMBOL = "symbol:string,ticker:string,orderbook:string,taken:bigint,first:bigint,window:string"
PACKED_SYMBOLS, PACKED_SEGMENT = "rows string, low long, high long, held long", "rows string"
#: Rows of the operator's input: the typed fields of all three message types, by bucket; times are microseconds, a missing ``arrived`` is LAST.
INPUT = ["bucket", "symbol", "kind", "ts", "arrived", "topic", "partition", "offset", "price", "volume", "side", "total_ask_size", "total_bid_size", "data", "last_updated"]
LAST = 2 ** 63 - 1
ALERTS = "symbol string, kind string, event_time timestamp, topic string, partition int, offset long, ma_short double, ma_long double"


def sliding_means(prices: list[float], n: int) -> list[float | None]:
    """Mean of each price and the n - 1 before it, summed in their order; None for the first n - 1."""
    import numpy as np
    x = np.asarray(prices, dtype=float)
    if len(x) < n:
        return [None] * len(x)
    total = np.zeros(len(x) - n + 1)
    for k in range(n):
        total += x[k:len(x) - n + 1 + k]
    return [None] * (n - 1) + (total / n).tolist()


def bucket_of(symbol: Column) -> Column:
    """The operator's key: the hash bucket of a symbol."""
    return F.pmod(F.xxhash64(symbol), F.lit(BUCKETS))


def _micros(times) -> list[int]:
    """A column of times, as numbers or as timestamps, in microseconds."""
    if times.dtype.kind != "M":
        return times.tolist()
    return times.to_numpy().astype("datetime64[us]").astype("int64").tolist()


class SymbolState(StatefulProcessor):
    """State and alerts of a bucket's symbols."""

    VALUES = {"ticker": ["price"], "orderbook": ["total_ask_size", "total_bid_size"]}

    def __init__(self, cap: int = 10_000, short: int = 5, long: int = 20):
        if cap < 1 or not 0 < short < long:
            raise ValueError("cap must be positive and short below long")
        self.cap, self.short, self.long = cap, short, long

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.symbols = handle.getValueState("symbols", SYMBOLS)
        self.trades = handle.getMapState("trades", "segment long", SEGMENT_ROWS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd
        frames = list(rows)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        col = {c: _micros(batch[c]) if c in ("ts", "arrived", "last_updated") else batch[c].tolist() for c in INPUT[1:]}
        at = [(t is None, t or "", p, o) for t, p, o in zip(col["topic"], col["partition"], col["offset"])]
        newest: dict[str, dict[str, int]] = {kind: {} for kind in self.VALUES}
        mine = []
        for i, (symbol, kind) in enumerate(zip(col["symbol"], col["kind"])):
            if kind == "trade":
                mine.append(i)
            elif kind in newest:
                of = newest[kind]
                if symbol not in of or (col["ts"][of[symbol]], at[of[symbol]]) <= (col["ts"][i], at[i]):
                    of[symbol] = i
        mine.sort(key=lambda i: (col["arrived"][i], at[i]))
        trades: dict[str, list[int]] = {}
        for i in mine:
            trades.setdefault(col["symbol"][i], []).append(i)
        stored, low, high, held = self.symbols.get() or ([], 0, 0, 0)
        known = {r[0]: [r[1], r[2], r[3] and tuple(r[3])] for r in stored}
        for n, (kind, of) in enumerate(newest.items()):
            for symbol, i in of.items():
                values = known.setdefault(symbol, [None, None, None])
                values[n] = self._newer(values[n], kind, col, i)
        kept, out = self._take(known, trades, col)
        if kept:
            low, high, held = self._append(kept, {s: v[2] for s, v in known.items() if v[2]}, low, high, held)
        self.symbols.update(([(s, *v) for s, v in known.items()], low, high, held))
        if out:
            told = pd.DataFrame(out, columns=["symbol", "kind", "event_time", "topic", "partition", "offset", "ma_short", "ma_long"])
            yield told.assign(event_time=pd.Series(np.array(told["event_time"], "datetime64[us]")).dt.tz_localize("UTC"))

    @classmethod
    def _newer(cls, old: str | None, kind: str, col: dict[str, list], i: int) -> str:
        """The later of a stored row and row i of the batch, by event time and source place."""
        new = {"ts": col["ts"][i], "topic": col["topic"][i], "partition": int(col["partition"][i]), "offset": int(col["offset"][i])}
        if old is not None and cls._place(json.loads(old)) > cls._place(new):
            return old
        return json.dumps(new | {v: float(col[v][i]) for v in cls.VALUES[kind]} | {"data": col["data"][i], "last_updated": col["last_updated"][i]})

    @staticmethod
    def _place(r: dict) -> tuple:
        return r["ts"], r["topic"] is None, r["topic"] or "", r["partition"], r["offset"]

    def _take(self, known: dict[str, list], trades: dict[str, list[int]], col: dict[str, list]) -> tuple[list[tuple], list[tuple]]:
        """Take each symbol's trades (rows of the batch in order of arrival)
        into its ``cross``; returns the trades to keep and the alerts. The windows
        of all symbols are summed as one series, in which each symbol's last prices come before its new ones."""
        import numpy as np
        taking, series, kept, out = [], [], [], []
        for symbol in sorted(trades):
            values = known.setdefault(symbol, [None, None, None])
            taken, first, window = values[2] or (0, 0, None)
            window = json.loads(window) if window else {"prices": [], "ma_short": None, "ma_long": None, "seen": []}
            seen = {(s["topic"], s["partition"]): s["offset"] for s in window["seen"]}
            fresh = []
            for i in trades[symbol]:
                place, offset = (col["topic"][i], int(col["partition"][i])), int(col["offset"][i])
                if offset > seen.get(place, NO_OFFSET):                   # else delivered before
                    seen[place] = offset
                    fresh.append(i)
            if not fresh:
                continue
            count = taken + len(fresh)
            first = max(first, count - self.cap)
            kept += [(symbol, taken + n, col["ts"][i], col["topic"][i], int(col["partition"][i]), int(col["offset"][i]), float(col["price"][i]), float(col["volume"][i]), col["side"][i])
                     for n, i in enumerate(fresh) if taken + n >= first]
            last = window["prices"][-(self.long - 1):]
            taking.append((symbol, window, seen, fresh, taken, first, len(series) + len(last)))
            series += last
            series += [float(col["price"][i]) for i in fresh]
        if not taking:
            return [], []
        # a window of n prices is whole from a symbol's n-th trade on; before, its mean takes part in no cross
        means = [np.array(m, dtype=float) for m in (sliding_means(series, self.short), sliding_means(series, self.long))]
        before = [np.roll(m, 1) for m in means]
        for _, window, _, fresh, taken, _, start in taking:
            for m, b, n, name in zip(means, before, (self.short, self.long), ("ma_short", "ma_long")):
                part = start + min(len(fresh), max(0, n - 1 - taken))
                m[start:part] = np.nan
                b[start] = np.nan if window[name] is None else window[name]
                b[start + 1:min(part + 1, start + len(fresh))] = np.nan
        (s, l), (ps, pl) = means, before
        golden, dead = (ps <= pl) & (s > l), (ps >= pl) & (s < l)
        crossed = golden | dead
        for symbol, window, seen, fresh, taken, first, start in taking:
            end = start + len(fresh)
            for n in np.flatnonzero(crossed[start:end]).tolist():
                i, k = fresh[n], start + n
                out.append((symbol, "golden" if golden[k] else "dead", col["ts"][i], col["topic"][i], int(col["partition"][i]), int(col["offset"][i]), float(s[k]), float(l[k])))
            count = taken + len(fresh)
            told = [float(m[end - 1]) if count >= n else None for m, n in zip(means, (self.short, self.long))]
            prices = series[max(start - len(window["prices"][-(self.long - 1):]), end - self.long + 1):end]
            known[symbol][2] = (count, first, json.dumps({"prices": prices, "ma_short": told[0], "ma_long": told[1],
                                                          "seen": [{"topic": t, "partition": p, "offset": o} for (t, p), o in seen.items()]}))
        return kept, out

    def _segment(self, number: int) -> list[tuple]:
        value = self.trades.getValue((number,))
        return [tuple(r) for r in value[0]] if value else []

    def _write(self, rows: list[tuple], number: int) -> int:
        """Write rows as segments from ``number`` on; returns the last one's number."""
        for at in range(0, len(rows), SEGMENT):
            self.trades.updateValue((number + at // SEGMENT,), (rows[at:at + SEGMENT],))
        return number + max(0, len(rows) - 1) // SEGMENT

    def _append(self, fresh: list[tuple], cross: dict, low: int, high: int, held: int) -> tuple[int, int, int]:
        """Add trades to the log, and write it anew once most of it is beyond the cap. Returns its first and last segment and its rows."""
        if len(fresh) < SEGMENT:
            high = self._write(self._segment(high) + fresh, high)
        else:                                        # segments of their own: the last one need not be read and written again
            high = self._write(fresh, high + 1)
        held += len(fresh)
        live = sum(c[0] - c[1] for c in cross.values())
        if held <= 2 * live + SEGMENT:
            return low, high, held
        start = at = high + 1
        rest: list[tuple] = []
        for number in range(low, high + 1):
            rest += [r for r in self._segment(number) if r[1] >= cross[r[0]][1]]
            self.trades.removeKey((number,))
            if len(rest) >= SEGMENT:
                self._write(rest[:SEGMENT], at)
                rest, at = rest[SEGMENT:], at + 1
        return start, self._write(rest, at), live

    def close(self) -> None:
        pass


def _names(columns: str) -> list[str]:
    return [c.split(":")[0] for c in columns.split(",")]


def pack(rows: list[tuple], columns: str) -> str:
    """Rows as one JSON text, an array for each column."""
    names = _names(columns)
    return json.dumps(dict(zip(names, zip(*rows) if rows else [[] for _ in names])), separators=(",", ":"))


def unpack(text: str) -> list[tuple]:
    return list(zip(*json.loads(text).values()))


def unpacked(df: DataFrame, text: str, columns: str) -> DataFrame:
    """The rows of all packed texts of a column; each text is parsed once."""
    arrays = ",".join("{}:array<{}>".format(*c.split(":")) for c in columns.split(","))
    packed = df.select(F.from_json(text, f"struct<{arrays}>").alias("p"))
    return packed.select(F.inline(F.arrays_zip(*[F.col("p")[c].alias(c) for c in _names(columns)])))


class PackedSymbols:
    """The state value ``symbols`` over its packed form."""

    def __init__(self, state):
        self.state = state

    def get(self):
        value = self.state.get()
        if not value:
            return None
        rows = [(s, t, o, None if taken is None else (taken, first, window)) for s, t, o, taken, first, window in unpack(value[0])]
        return rows, value[1], value[2], value[3]

    def update(self, value) -> None:
        rows, *log = value
        self.state.update((pack([(s, t, o, *(cross or (None, None, None))) for s, t, o, cross in rows], SYMBOL), *log))


class PackedTrades:
    """The state map ``trades`` over its packed form."""

    def __init__(self, state):
        self.state, self.removeKey = state, state.removeKey

    def getValue(self, key):
        value = self.state.getValue(key)
        return (unpack(value[0]),) if value else None

    def updateValue(self, key, value) -> None:
        self.state.updateValue(key, (pack(value[0], TRADE),))


class PackedSymbolState(SymbolState):
    """``SymbolState`` with a bucket's rows, and a segment's, as one text each: Spark
    turns every value of a state row over between the JVM and Python, of a text only one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.symbols = PackedSymbols(handle.getValueState("symbols", PACKED_SYMBOLS))
        self.trades = PackedTrades(handle.getMapState("trades", "segment long", PACKED_SEGMENT))


def read_state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """The state of the operator's newest committed batch: one row per
    symbol (ticker, orderbook, cross) or per kept trade (trades)."""
    def load(variable: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()
    rows = unpacked(load("symbols"), "value.rows", SYMBOL)
    if name == "trades":
        first = rows.where("taken IS NOT NULL").select("symbol", "first")
        log = unpacked(load("trades"), "user_map_value.rows", TRADE).withColumn("ts", F.timestamp_micros("ts"))
        return log.join(first, "symbol").where("number >= first").drop("first")
    if name == "cross":
        return rows.where("taken IS NOT NULL").select("symbol", "taken", "first", F.from_json("window", f"struct<{WINDOW}>").alias("w")).select("symbol", "taken", "first", "w.*")
    out = rows.where(F.col(name).isNotNull()).select("symbol", F.from_json(name, f"struct<{LATEST[name]}>").alias("v")).select("symbol", "v.*")
    return out.withColumns({t: F.timestamp_micros(t) for t in ("ts", "last_updated")} | {"offset": F.nullif(F.col("offset"), F.lit(NO_OFFSET))})
