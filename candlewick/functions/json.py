"""JSON text extraction (PRJ-01, SCL-01).

The payload is parsed once into a VARIANT and fields are pulled with
``try_variant_get``: a missing field or an impossible cast gives NULL, and
numeric strings are accepted for numeric targets (like ``payload->>'f'::T``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c)


def field(variant, path: str, dtype: str) -> Column:
    v = F.col(variant) if isinstance(variant, str) else variant
    if not path.startswith("$"):
        path = "$." + path
    return F.try_variant_get(v, path, dtype)


def json_fields(df: DataFrame, col: str, fields: Mapping[str, tuple[str, str]],
                keep: bool = True, strict: bool = False) -> DataFrame:
    """Add ``{name: (path, type)}`` columns pulled from JSON text ``col``.

    PRJ-02: ``strict=True`` uses ``variant_get``: a value that cannot be cast
    fails the query (the ``::NUMERIC`` behaviour); otherwise it becomes NULL.
    """
    v = "_v_" + col
    out = df.withColumn(v, parse(col))
    get = F.variant_get if strict else F.try_variant_get
    cols = [get(F.col(v), p if p.startswith("$") else "$." + p, t).alias(n) for n, (p, t) in fields.items()]
    base = [c for c in df.columns] if keep else []
    return out.select(*base, *cols)
