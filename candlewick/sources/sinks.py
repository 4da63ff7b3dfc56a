"""Sinks (SNK-01..03) and the mart read (SRC-04).

Marts are overwritten without the empty-table gap of TRUNCATE + INSERT: each
write goes to a folder of its own, and only then a new numbered pointer file
names that folder. Folders and pointers are added, never rewritten, so a reader
always finds a whole version. Rows and repeated keys are counted while the
folder is written (``DataFrame.observe``, one scan); the pointer moves only if both are
right. Writing a version id again (a replayed batch) points to the new folder.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTERS = "_pointers"

#: Versions that stay readable after a newer one was written.
KEEP_VERSIONS = 3


def append_landing(df: DataFrame, path: str, partition_by=("endpoint", "ingest_date")) -> None:
    """Plain append, partitioned by endpoint and ingest day (SNK-01). Rows are
    rebalanced by partition first: few files per day, and a day with most of
    the rows is split over tasks."""
    out = df
    if "ingest_date" in partition_by and "ingest_date" not in df.columns:
        out = out.withColumn("ingest_date", F.to_date("ingested_at"))
    out.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(number, version, folder) of each pointer, oldest first: names of a short folder."""
    fs, p, _ = _fs(spark, os.path.join(path, POINTERS))
    if not fs.exists(p):
        return []
    found = (re.fullmatch(r"(\d+)~(.*)~(\w+)", st.getPath().getName()) for st in fs.listStatus(p))
    return sorted((int(m[1]), m[2], m[3]) for m in found if m)


def _folder(path: str, name: str) -> str:
    return os.path.join(path, f"v={name}")


def _point(spark: SparkSession, path: str, version: str, folder: str, keep: int) -> None:
    """Add the next pointer (creating an empty file is atomic), then drop
    pointers and folders beyond the ``keep`` newest."""
    old = _pointers(spark, path)
    number = old[-1][0] + 1 if old else 0
    fs, p, jvm = _fs(spark, os.path.join(path, POINTERS, f"{number:012d}~{version}~{folder}"))
    fs.create(p, False).close()
    for n, v, f in [*old, (number, version, folder)][:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(os.path.join(path, POINTERS, f"{n:012d}~{v}~{f}")), False)
        fs.delete(jvm.org.apache.hadoop.fs.Path(_folder(path, f)), True)


def overwrite_mart(df: DataFrame, path: str, version: str | int | None = None, require_rows: bool = True,
                   keep: int = KEEP_VERSIONS, unique: Sequence[str] = ()) -> str | None:
    """Write a new version of the mart and point to it (SNK-02). The plan runs once.

    With ``require_rows`` a write without rows changes nothing (FLT-09) and
    returns None. ``unique`` names the key columns: a write in which a key
    (NULLs alike) is repeated changes nothing and raises ``ValueError``. Returns the version written.
    """
    if keep < 1:
        raise ValueError("keep at least the version that is written")
    spark, folder = df.sparkSession, uuid.uuid4().hex[:16]
    v = re.sub(r"[^\w.:+-]", "_", str(version if version is not None else folder))
    out, seen = _folder(path, folder), Observation()
    if unique:
        again = "_again"
        while again in df.columns:
            again = "_" + again
        keys = [F.col(f"`{c}`") for c in unique]
        nth = df.withColumn(again, F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
        counted = nth.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum((F.col(again) == 2).cast("long")).alias("repeated")).drop(again)
    else:
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.parquet(out)
    told = seen.get
    rows, repeated = told.get("rows") or 0, told.get("repeated") or 0
    if repeated or (require_rows and not rows):
        fs, p, _ = _fs(spark, out)
        fs.delete(p, True)
        if repeated:
            raise ValueError(f"{repeated} values of {', '.join(unique)} are repeated; the mart stays as it was")
        return None
    _point(spark, path, v, folder, keep)
    return v


def current_version(spark: SparkSession, path: str) -> str | None:
    found = _pointers(spark, path)
    return found[-1][1] if found else None


def read_current(spark: SparkSession, path: str) -> DataFrame:
    found = _pointers(spark, path)
    if not found:
        raise FileNotFoundError(f"no mart version under {path}")
    return spark.read.parquet(_folder(path, found[-1][2]))


def append_run(df: DataFrame, path: str, version: str | int, unique: Sequence[str] = ()) -> str | None:
    """Add the rows of a run to a mart that grows (:func:`read_runs`): as
    ``overwrite_mart``, but earlier runs stay. A run written again under its version id takes the place of the first."""
    return overwrite_mart(df, path, version, unique=unique, keep=1 << 62)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs of a growing mart."""
    folders = {v: f for _, v, f in _pointers(spark, path)}
    if not folders:
        raise FileNotFoundError(f"no mart version under {path}")
    return spark.read.parquet(*[_folder(path, f) for f in folders.values()])


def read_mart(spark: SparkSession, path: str, order: str = "ts_event") -> DataFrame:
    """Full read of the mart's current version, newest first (SRC-04)."""
    return read_current(spark, path).orderBy(F.col(order).desc())


def ensure_table(spark: SparkSession, name: str, schema: StructType | str, path: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with typed columns (SNK-03)."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{loc}")


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Cast and order columns to a mart schema before writing."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
