"""Reading the driver tables (Parquet, one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of ``{sf_dir}/{name}.parquet``; columns and
    filters chosen later are pushed into the scan by Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
