"""Structured Streaming hot path (PIP-07: STR-01..08, SNK-04..06).

Source -> micro-batch -> one VARIANT parse -> contract check, then two running
queries over the same source, each with its own checkpoint (STR-06):

* the symbol query: valid messages into the keyed state of
  :mod:`candlewick.streaming.keyed_state` (latest ticker and order book per
  symbol, the newest ``cap`` trades, the sliding cross window); its output rows are the alerts of every
  moving-average cross, appended to Parquet by Spark's exactly-once file sink;
* the dead-letter query: rejected messages with their reasons, to Parquet (STR-08).

A restart goes on from the checkpoints: offsets, state and sink logs are
committed batch by batch. No event-time window or watermark is used: the count
cap bounds the state.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import contract as C
from candlewick.plans.marts import cross_message, detect_ma_cross
from candlewick.streaming.keyed_state import ALERTS, INPUT, LAST, NO_OFFSET, STATE_CONF, PackedSymbolState, bucket_of, read_state

# Kafka source columns (the file source in tests carries the same fields).
KAFKA_SCHEMA = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
KEEP = ("topic", "partition", "offset")
CARRIED = (*KEEP, "timestamp")

# Topic per message type.
TOPICS = {"trade": "upbit-trades", "ticker": "upbit-tickers", "orderbook": "upbit-orderbooks"}

REJECT_SCHEMA = "topic string, partition int, offset bigint, type string, reason string, raw string"


def read_topics(spark: SparkSession, bootstrap: str, topics=tuple(TOPICS.values()),
                starting: str = "earliest") -> DataFrame:
    """Subscribe to the topics (SRC-05); needs the Kafka connector on the
    classpath. ``startingOffsets`` applies on the first start only; after
    that the checkpoint decides (STR-06)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", ",".join(topics)).option("startingOffsets", starting).load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition",
                    "offset", "timestamp"))


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """File source with the Kafka column layout (JSON lines)."""
    r = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def read_topic_files(spark: SparkSession, root: str, topics=tuple(TOPICS.values()), max_files: int | None = None) -> DataFrame:
    """One subscription to several topics laid out as folders of JSON lines
    (SRC-05 without the connector): a union of file sources, each with its own
    offsets in the query's one checkpoint, from the earliest file on."""
    return reduce(DataFrame.unionByName, [read_message_files(spark, os.path.join(root, t), max_files) for t in topics])


def parse_stream(raw: DataFrame) -> DataFrame:
    """STR-01: decode, dispatch on ``type``, validate; bad messages survive
    as rows with ``errors``. A source without the message time goes without it."""
    carried = tuple(c for c in CARRIED if c in raw.columns)
    return C.check_messages(C.parse_messages(raw, "value", carried), carried)


def route_by_type(checked: DataFrame) -> DataFrame:
    """SNK-04: valid messages as (topic, key, value) with canonical names,
    ready for the Kafka sink's ``topic`` column."""
    t = F.col("_type")
    topic = F.element_at(F.create_map(*[F.lit(x) for kv in TOPICS.items() for x in kv]), t)
    body = F.when(t == "trade", F.to_json("trade")).when(t == "ticker", F.to_json("ticker")) \
            .when(t == "orderbook", F.to_json("orderbook"))
    sym = F.coalesce(F.col("trade.symbol"), F.col("ticker.symbol"), F.col("orderbook.symbol"))
    return checked.where(t.isin(*TOPICS) & (F.size("errors") == 0)) \
                  .select(topic.alias("topic"), sym.alias("key"), body.alias("value"))


def symbol_rows(checked: DataFrame) -> DataFrame:
    """Valid messages of the three types as rows of the keyed state's input."""
    t = F.col("_type")
    body = lambda field, *kinds: F.coalesce(*[F.col(f"{k}.{field}") for k in kinds])
    every = tuple(TOPICS)
    return checked.where(t.isin(*TOPICS) & (F.size("errors") == 0)).select(
        bucket_of(body("symbol", *every)).alias("bucket"), body("symbol", *every).alias("symbol"), t.alias("kind"), F.unix_micros(body("timestamp", *every)).alias("ts"),
        F.coalesce(F.unix_micros("timestamp"), F.lit(LAST)).alias("arrived"), "topic", "partition",
        F.coalesce("offset", F.lit(NO_OFFSET)).alias("offset"),
        body("trade_price", "trade", "ticker").alias("price"), F.col("trade.trade_volume").alias("volume"), F.col("trade.side").alias("side"),
        F.col("orderbook.total_ask_size").alias("total_ask_size"), F.col("orderbook.total_bid_size").alias("total_bid_size"),
        F.when(t == "ticker", F.to_json("ticker")).when(t == "orderbook", F.to_json("orderbook")).alias("data"),
        F.unix_micros(F.current_timestamp()).alias("last_updated")).select(*INPUT)


def rejected_rows(checked: DataFrame) -> DataFrame:
    reason = F.col("errors")[0]
    return checked.where(F.size("errors") > 0).select(*KEEP, F.when(~reason.startswith("malformed"), F.col("_type")).alias("type"),
                                                      reason.alias("reason"), F.col("_text").alias("raw"))


@dataclass(frozen=True)
class HotPath:
    """Where a hot path keeps its tables and checkpoints."""
    root: str

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def latest(self, spark: SparkSession, kind: str) -> DataFrame:
        """The snapshot: newest ticker or order book of each symbol (STR-03)."""
        return read_state(spark, self.path("checkpoint", "symbols"), kind)

    def trades(self, spark: SparkSession) -> DataFrame:
        """The newest ``cap`` trades of each symbol, ``number`` counting from its first trade (STR-04)."""
        return read_state(spark, self.path("checkpoint", "symbols"), "trades")

    def alerts(self, spark: SparkSession) -> DataFrame:
        """Every cross, once, with its message (STR-05)."""
        return spark.read.schema(ALERTS + ", message string").parquet(self.path("alerts"))

    def rejected(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(REJECT_SCHEMA).parquet(self.path("rejected"))


def start_hot_path(raw: DataFrame, root: str, cap: int = 10000, trigger: dict | None = None, short: int = 5, long: int = 20) -> list:
    """STR-02: the two running queries over one subscription, with their
    tables and checkpoints under ``root``. The number of state partitions is
    ``spark.sql.shuffle.partitions`` of the first start."""
    hot, spark = HotPath(root), raw.sparkSession
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    checked = parse_stream(raw)
    alerts = symbol_rows(checked).groupBy("bucket").transformWithStateInPandas(PackedSymbolState(cap, short, long), ALERTS, "Append", "None")
    message = cross_message("symbol", "kind", "ma_short", "ma_long", "event_time", short, long)
    out = []
    for name, df, where in (("symbols", alerts.withColumn("message", message), "alerts"), ("rejected", rejected_rows(checked), "rejected")):
        w = df.writeStream.format("parquet").outputMode("append").option("path", hot.path(where)) \
              .option("checkpointLocation", hot.path("checkpoint", name))
        out.append((w.trigger(**trigger) if trigger else w).start())
    return out


def run_available(raw: DataFrame, root: str, **options) -> HotPath:
    """Take what the source holds now, then stop."""
    for q in start_hot_path(raw, root, trigger={"availableNow": True}, **options):
        q.awaitTermination()
    return HotPath(root)


def refresh_on_landing(spark: SparkSession, landing_path: str, schema: str, refresh, checkpoint: str):
    """STR-07: run ``refresh(batch_df, batch_id)`` for newly landed files,
    processing what is there and stopping (``availableNow``)."""
    q = (spark.readStream.schema(schema).parquet(landing_path).writeStream
         .foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def route_stream(raw: DataFrame, checkpoint: str, sink: str = "kafka", trigger: dict | None = None, **options):
    """SNK-04 as a running query: valid messages to the topic of their type
    (``kafka.bootstrap.servers`` etc. as options; any sink with the columns
    topic, key, value will do)."""
    w = route_by_type(parse_stream(raw)).writeStream.format(sink).options(**options).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def periodic_cross_check(spark: SparkSession, root: str, seconds: int = 600, short: int = 5, long: int = 20) -> DataFrame:
    """STR-05 on a schedule: crosses at the newest trade of every stored
    series, one row per symbol with its message; ``seconds`` is the age of the newest trade from
    which a series counts as stale and is left out (0: none)."""
    alerts = detect_ma_cross(HotPath(root).trades(spark), "symbol", "number", "price", short, long, time="ts")
    return alerts.where(F.col("event_time") >= F.current_timestamp() - F.make_interval(secs=F.lit(seconds))) if seconds else alerts
