"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import scratch_path

#: Rows per Arrow batch: whole long texts travel in a batch, so few of them.
BATCH_ROWS = 256

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in rows, as one row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a short
    lineage that survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text.

    Every byte of a code point from U+0080 on is at least 0x80, so the code
    point class and the byte class cut the same words; only A-Z is folded.
    """
    return text.translate(_FOLD).split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, A-Z lower-cased."""
    return text.lower().split() if text else []


def text_bytes(df: DataFrame, text: str = "text"):
    """The text column as UTF-8 bytes (Arrow binary), NULL kept."""
    return F.col(f"`{text}`").cast("string").cast("binary")


def map_rows(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def annotate(df: DataFrame, text: str, make: Callable[[], Callable], outputs: list[tuple[str, T.DataType]], together: bool = False) -> DataFrame:
    """All rows and columns of ``df`` plus ``outputs`` computed from the text.

    ``make()`` runs once in each task and returns the function of one text
    (UTF-8 bytes or None) that gives the output values, or, if ``together``,
    of the texts of a batch. The rows stay where they are: no shuffle. An output
    whose name ``df`` already has gets underscores in front (see ``fresh_name``);
    the columns of ``df`` stay as they are.
    """
    outputs = [(fresh_name(df, n), t) for n, t in outputs]
    raw = fresh_name(df, "utf8")
    arrow = {T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64(), T.LongType(): pa.int64(), T.StringType(): pa.string(),
             T.BinaryType(): pa.binary()}
    types = [arrow[t] for _, t in outputs]
    schema = T.StructType(list(df.schema.fields) + [T.StructField(n, t) for n, t in outputs])

    def run(batches):
        fn = make()
        for b in batches:
            texts = b.column(raw).to_pylist()
            rows = fn(texts) if together else [fn(x) for x in texts]
            keep = [i for i, n in enumerate(b.schema.names) if n != raw]
            cols = [b.column(i) for i in keep]
            cols += [pa.array([r[j] for r in rows], type=t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(cols, names=[b.schema.names[i] for i in keep] + [n for n, _ in outputs])

    return map_rows(df.withColumn(raw, text_bytes(df, text)), run, schema)
