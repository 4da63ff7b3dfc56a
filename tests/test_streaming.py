"""Hot path on Spark's keyed state: redelivery, event-time snapshot, batching independence, cap, crosses, restart."""

import json
import os

import pytest
from pyspark.sql import functions as F

from candlewick.streaming.hot_path import HotPath, read_message_files, run_available

SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
#: Rows of a symbol above one segment, so that segments are added and cut.
MANY = 700


@pytest.fixture(scope="module", autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def trade(sym, ms, price, off, arrived=None):
    return (sym, json.dumps({"type": "trade", "code": sym, "trade_price": price, "trade_volume": 1.0, "ask_bid": "BID",
                             "trade_timestamp": ms}), "upbit-trades", 0, off, arrived)


def ticker(sym, ms, price, off):
    return (sym, json.dumps({"type": "ticker", "code": sym, "opening_price": price, "high_price": price,
                             "low_price": price, "trade_price": price, "change": "EVEN", "change_price": 0,
                             "signed_change_rate": 0, "acc_trade_volume_24h": 1, "timestamp": ms}),
            "upbit-tickers", 0, off, None)


class Run:
    """A watched folder and the hot path over it; each delivery is taken as micro-batches of one file."""

    def __init__(self, spark, tmp_dir, name="a", **options):
        self.spark, self.options = spark, options
        self.src, self.root = (os.path.join(tmp_dir, name, n) for n in ("src", "hot"))

    def take(self, *batches):
        for rows in batches:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(self.src)
        self.hot = run_available(read_message_files(self.spark, self.src, 1), self.root, **self.options)
        return self

    def snapshot(self):
        return {r["symbol"]: (r["price"], r["offset"]) for r in self.hot.latest(self.spark, "ticker").collect()}

    def trades(self):
        return sorted((r["symbol"], r["number"], r["offset"]) for r in self.hot.trades(self.spark).collect())

    def alerts(self):
        return sorted((r["symbol"], r["kind"], r["offset"], r["ma_short"], r["ma_long"], r["message"]) for r in self.hot.alerts(self.spark).collect())


def test_snapshot_cap_and_restart(spark, tmp_dir):
    run = Run(spark, tmp_dir, cap=3, short=1, long=2)
    run.take([trade("A", 1000 + i, 10.0 + i, i) for i in range(5)] + [ticker("A", 1000, 5.0, 10)])
    assert run.trades() == [("A", 2, 2), ("A", 3, 3), ("A", 4, 4)]                 # capped at the 3 newest
    run.take([trade("A", 2000, 99.0, 20), ticker("A", 500, 1.0, 21)])               # a restart from the checkpoint
    assert run.snapshot() == {"A": (5.0, 10)}                                       # an older event does not overwrite a newer one
    assert run.trades() == [("A", 3, 3), ("A", 4, 4), ("A", 5, 20)]


def test_redelivered_messages_change_nothing(spark, tmp_dir):
    rows = [trade("A", 1000 + i, float(i % 7), i) for i in range(60)]
    once, twice = Run(spark, tmp_dir, "once", cap=25).take(rows), Run(spark, tmp_dir, "twice", cap=25).take(rows[:40], rows[20:], rows[30:])
    assert once.trades() == twice.trades() and len(once.trades()) == 25
    assert once.alerts() == twice.alerts() and once.alerts()


def test_result_does_not_depend_on_the_batches(spark, tmp_dir):
    rows = [trade(f"S{i % 3}", 1000 + i, float((i * i) % 17), i) for i in range(90)] + [ticker(f"S{i % 3}", 1000 + i, float(i), 100 + i) for i in range(9)]
    one = Run(spark, tmp_dir, "one", cap=21).take(rows)
    many = Run(spark, tmp_dir, "many", cap=21).take(*[rows[i:i + 13] for i in range(0, len(rows), 13)])
    assert one.snapshot() == many.snapshot() and one.trades() == many.trades() and one.alerts() == many.alerts()
    # every cross, as a plain window over each symbol's trades in order tells it
    want = []
    for s in range(3):
        prices = [(i, float((i * i) % 17)) for i in range(s, 90, 3)]
        mean = lambda k, n: sum(p for _, p in prices[k - n + 1:k + 1]) / n
        for k in range(20, len(prices)):
            a, b, c, d = mean(k - 1, 5), mean(k - 1, 20), mean(k, 5), mean(k, 20)
            kind = "golden" if a <= b and c > d else "dead" if a >= b and c < d else None
            if kind:
                want.append((f"S{s}", kind, prices[k][0], c, d))
    assert [a[:5] for a in one.alerts()] == sorted(want) and want
    assert one.alerts()[0][5].startswith(f"{want[0][0]} {one.alerts()[0][1]} cross: MA5 ")


def test_segments_are_added_and_cut(spark, tmp_dir):
    rows = [trade("A", 1000 + i, 1.0, i) for i in range(MANY)]
    run = Run(spark, tmp_dir, cap=300).take(rows[:290], rows[290:310], rows[310:])
    assert [t[1] for t in run.trades()] == list(range(MANY - 300, MANY))
    small = Run(spark, tmp_dir, "s", cap=30).take(rows[:10], rows[10:MANY])             # a batch above the cap
    assert [t[1] for t in small.trades()] == list(range(MANY - 30, MANY))


def test_files_are_taken_once_and_rejected_rows_kept(spark, tmp_dir):
    run = Run(spark, tmp_dir, cap=100)
    for part in range(2):
        run.take([trade("B", 100 * part + i, float(i), 100 * part + i) for i in range(5)] + [("B", "{bad json", "upbit-trades", 0, 999 + part, None)])
    assert len(run.trades()) == 10
    assert run.hot.rejected(spark).where(F.col("reason") == "malformed json").count() == 2


def test_poison_message_is_rejected_and_the_rest_goes_on(spark, tmp_dir):
    run = Run(spark, tmp_dir).take([trade("A", 9223372036854775807, 1.0, 1), trade("A", 1000, 2.0, 2)])
    assert [(r["offset"], r["reason"]) for r in run.hot.rejected(spark).collect()] == [(1, "timestamp: invalid ts")]
    assert [t[2] for t in run.trades()] == [2]


def test_same_offsets_of_two_partitions(spark, tmp_dir):
    a, b = trade("A", 1000, 1.0, 7), ("A", trade("A", 1000, 2.0, 3)[1], "upbit-trades", 1, 3, None)
    run = Run(spark, tmp_dir).take([a, b], [a])
    assert sorted((r["partition"], r["offset"]) for r in run.hot.trades(spark).collect()) == [(0, 7), (1, 3)]


def test_nothing_delivered(spark, tmp_dir):
    run = Run(spark, tmp_dir).take([("A", json.dumps({"type": "news"}), "upbit-news", 0, 1, None)])
    assert run.trades() == [] and run.snapshot() == {} and run.alerts() == [] and run.hot.rejected(spark).count() == 0


def test_parameters_are_checked():
    from candlewick.streaming.keyed_state import SymbolState
    for bad in ({"cap": 0}, {"short": 20, "long": 20}):
        with pytest.raises(ValueError):
            SymbolState(**bad)


def test_anomaly_stream_static_join(spark, tmp_dir):
    from candlewick.operators.joins import detect_anomalies
    base = spark.createDataFrame([("KRW-BTC", 10.0, 2.0), ("KRW-ETH", 100.0, 5.0)],
                                 "symbol string, avg_volume_30d double, atr_14d double")
    src = os.path.join(tmp_dir, "ticks")
    spark.createDataFrame([("KRW-BTC", 60.0, 1.0), ("KRW-BTC", 5.0, 9.0), ("KRW-ETH", 50.0, 1.0), ("KRW-XRP", 1e9, 1e9)],
                          "symbol string, volume double, range double").write.json(src)
    ticks = spark.readStream.schema("symbol string, volume double, range double").json(src)
    got = []
    q = detect_anomalies(ticks, base, vol_mult=5.0, atr_mult=3.0).writeStream \
        .foreachBatch(lambda df, i: got.extend((r["symbol"], r["kind"]) for r in df.collect())) \
        .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(got) == [("KRW-BTC", "move"), ("KRW-BTC", "volume")]   # unknown symbol: no baseline


def test_topics_as_one_subscription_and_routing(spark, tmp_dir):
    from candlewick.streaming.hot_path import TOPICS, read_topic_files, route_stream
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    def deliver(kind, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(os.path.join(src, TOPICS[kind]))
    def routed():
        route_stream(read_topic_files(spark, src, max_files=1), ck, "json", {"availableNow": True}, path=out).awaitTermination()
        return {r["topic"]: r["count"] for r in spark.read.json(out).groupBy("topic").count().collect()}
    deliver("trade", [trade("X", 1000 + i, 10.0, i) for i in range(22)])
    deliver("ticker", [ticker("X", 999, 7.0, 99)])
    deliver("orderbook", [("X", "{bad", "upbit-orderbooks", 0, 1, None)])
    assert routed() == {"upbit-trades": 22, "upbit-tickers": 1}
    deliver("ticker", [ticker("X", 1999, 8.0, 100)])                                     # a restart reads only what is new
    assert routed() == {"upbit-trades": 22, "upbit-tickers": 2}


def test_periodic_check(spark, tmp_dir):
    from candlewick.streaming.hot_path import periodic_cross_check
    run = Run(spark, tmp_dir).take([trade("X", 1000 + i, 10.0 if i < 21 else 30.0, i) for i in range(22)])
    alerts = periodic_cross_check(spark, run.root, seconds=0).collect()
    assert [(a["symbol"], a["kind"]) for a in alerts] == [("X", "golden")] and alerts[0]["message"].startswith("X golden cross: MA5 14, MA20 11")
    assert periodic_cross_check(spark, run.root, seconds=600).count() == 0
