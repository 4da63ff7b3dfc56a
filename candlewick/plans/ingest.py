"""Daily ingest and backfill (PIP-08).

API responses arrive as dumped JSON documents (one file per call); each
array element becomes a landing row, pages and daily updates are unioned,
and the landing table is appended. Readers dedupe on read (DED-01), so a
re-poll of the same days never double counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.filters import prefix
from candlewick.sources.landing import MARKET_PREFIX, land_batch, union_history
from candlewick.sources.sinks import append_landing


def read_responses(spark: SparkSession, path: str, wholetext: bool = True) -> DataFrame:
    """One row per response document: a file each, or a line each (``wholetext=False``)."""
    return spark.read.text(path, wholetext=wholetext)


def land_responses(spark: SparkSession, paths: dict[str, str], items_path: dict[str, str] | None = None,
                   ingested_at=None, wholetext: bool = True) -> DataFrame:
    """``{endpoint: folder}`` of dumped responses to landing rows, all
    endpoints and pages unioned (SRC-06, SRC-07)."""
    items_path = items_path or {}
    frames = [land_batch(read_responses(spark, p, wholetext), ep, "value", items_path.get(ep, "$"), ingested_at)
              for ep, p in paths.items()]
    return union_history(*frames)


def krw_markets(landing: DataFrame, market_path: str = "$.market") -> DataFrame:
    """Only KRW- markets (FLT-04), and items that name no market."""
    m = F.try_variant_get(F.try_parse_json("payload"), market_path, "string")
    return prefix(landing.withColumn("_market", F.coalesce(m, F.lit(MARKET_PREFIX))), "_market", MARKET_PREFIX).drop("_market")


def ingest(spark: SparkSession, paths: dict[str, str], landing_path: str, items_path=None, ingested_at=None,
           wholetext: bool = True) -> None:
    """Land the KRW markets of every dumped response (FLT-04) and append to the
    landing table (SNK-01). Items without a market (e.g. the daily index) stay."""
    append_landing(krw_markets(land_responses(spark, paths, items_path, ingested_at, wholetext)), landing_path)
