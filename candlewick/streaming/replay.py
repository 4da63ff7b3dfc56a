"""The driver ``events`` as topics of stream messages.

``events`` is written once as files of the Kafka column layout (offset =
event id), ``BLOCKS`` spans of time one after the other, in each span a
symbol's messages in one file: the way a keyed topic holds them. Events are
dealt by user first and become messages where they are written; a span has as many files as its share of the events asks for.
The hot path then reads the files as one running subscription, a span's files per trigger, so
it takes many micro-batches. Files, tables and checkpoints lie under the shared
checkpoint root that the session names.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import scratch_path
from candlewick.sources.messages import messages_from_events
from candlewick.sources.tables import table
from candlewick.streaming.hot_path import TOPICS, HotPath, read_message_files, read_topic_files, route_stream, run_available

#: Spans of time, the least files of each span, and the events of a file.
BLOCKS, FILES, FILE_EVENTS = 12, 2, 20_000
#: Fixed value: what the names of topics begin with.
TOPIC_PREFIX = os.path.commonprefix(list(TOPICS.values()))

_DONE: dict[tuple, object] = {}


def kafka_records(events: DataFrame) -> DataFrame:
    """key, value, topic, partition, offset, timestamp."""
    m = messages_from_events(events)
    topic = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in TOPICS.items() for x in kv]),
                                    F.col("mtype")), F.concat(F.lit(TOPIC_PREFIX), F.col("mtype")))
    return m.select(F.concat(F.lit("KRW-U"), F.col("user_id").cast("string")).alias("key"), "value",
                    topic.alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                    F.col("ts").cast("timestamp").alias("timestamp"))


def blocks_of(records: DataFrame, blocks: int = BLOCKS, time: str = "timestamp"):
    """Conditions that cut the records into equal spans of time; rows without a time are in the last."""
    low, high = records.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    if low is None:
        return [F.lit(True)]
    width = max((high - low) // blocks + 1, 1)
    number = F.coalesce(F.floor((F.unix_micros(time) - F.lit(low)) / F.lit(width)), F.lit(blocks - 1))
    return [number == n for n in range(blocks)]


def files_of(events: DataFrame) -> int:
    """Files of each span: about ``FILE_EVENTS`` events in one, ``FILES`` at least."""
    return max(FILES, -(-events.count() // (BLOCKS * FILE_EVENTS)))


def deliver(events: DataFrame, path: str, files: int, by_topic: bool = False) -> None:
    """Append the events' records to the watched folder, span after span, in each span a key's messages in one file."""
    events = events.withColumn("at", F.col("ts").cast("timestamp"))
    for block in blocks_of(events, time="at"):
        out = kafka_records(events.where(block).drop("at").repartition(files, "user_id")).sortWithinPartitions("timestamp", "offset")
        if by_topic:
            out = out.where(F.col("topic").isin(*TOPICS.values()))
            out.withColumn("folder", F.col("topic")).write.mode("append").partitionBy("folder").json(path)
        else:
            out.write.mode("append").json(path)


def _once(spark: SparkSession, key: tuple, make):
    key = (spark.sparkContext.applicationId, *key)
    if key not in _DONE:
        _DONE[key] = make()
    return _DONE[key]


def run_hot_path(spark: SparkSession, sf_dir: str, cap: int = 10000) -> HotPath:
    """Stream all events through the hot path, once per application, table folder and cap."""
    def stage():
        path, events = scratch_path(spark, "topics"), table(spark, sf_dir, "events")
        files = files_of(events)
        deliver(events, path, files)
        return path, files

    def make():
        src, files = _once(spark, ("staged", sf_dir), stage)
        return run_available(read_message_files(spark, src, files), scratch_path(spark, "hotpath"), cap=cap).root
    return HotPath(_once(spark, ("run", sf_dir, cap), make))


def run_routing(spark: SparkSession, sf_dir: str) -> str:
    """All events through a subscription to three topics into the routing sink; returns the sink's folder."""
    def make():
        base = scratch_path(spark, "routing")
        src, out = os.path.join(base, "topics"), os.path.join(base, "routed")
        events = table(spark, sf_dir, "events")
        files = files_of(events)
        deliver(events, src, files, by_topic=True)
        folders = [f"folder={t}" for t in TOPICS.values()]
        route_stream(read_topic_files(spark, src, folders, files), os.path.join(base, "checkpoint"), "parquet", {"availableNow": True}, path=out).awaitTermination()
        return out
    return _once(spark, ("routed", sf_dir), make)
