"""Shaping results for exact comparison with an SQL oracle.

Dates and timestamps become ISO text and computed doubles are rounded to a
stated number of places in both the Spark query and its SQL twin, so the
comparison is exact and independent of engine-specific float printing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE_FMT = "yyyy-MM-dd"
TS_FMT = "yyyy-MM-dd HH:mm:ss"
TS_US_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def shape(df: DataFrame, digits: Mapping[str, int] | None = None, micros: tuple[str, ...] = ()) -> DataFrame:
    """Dates/timestamps to text; ``digits`` columns rounded."""
    digits = dict(digits or {})
    types = dict(df.dtypes)
    cols = []
    for c in df.columns:
        t = types[c]
        x = F.col(c)
        if t == "date":
            x = F.date_format(x, DATE_FMT)
        elif t.startswith("timestamp"):
            x = F.date_format(x, TS_US_FMT if c in micros else TS_FMT)
        elif c in digits:
            x = F.round(x.cast("double"), digits[c])
        cols.append(x.alias(c))
    return df.select(*cols)
