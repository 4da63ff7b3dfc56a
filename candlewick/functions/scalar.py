"""Scalar helpers (SCL-04..08, PRJ-04/05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, digits: int = 2) -> Column:
    """SCL-05: ``round`` (half up). The pandas original rounds half to even; the two
    differ only on exact ties."""
    return F.round(_c(x), digits)


def safe_ratio(a, b) -> Column:
    """a / b, NULL on a zero or NULL divisor (ANSI mode raises otherwise)."""
    return F.try_divide(_c(a), _c(b))


def fill(x, value) -> Column:
    """SCL-06: ``fillna(value)``."""
    return F.coalesce(_c(x), F.lit(value))


def null_if(x, value) -> Column:
    """SCL-06: ``replace(value, NaN)``."""
    return F.nullif(_c(x), F.lit(value))


def keep_where(cond, x, other=0.0) -> Column:
    """SCL-07: ``x.where(cond, other)`` -- ``x`` where ``cond`` holds, else
    ``other`` (a NULL condition also gives ``other``, as in pandas)."""
    return F.when(cond, _c(x)).otherwise(F.lit(other))


def thousands(x, digits: int = 0) -> Column:
    """SCL-08: ``1,234,567`` style text."""
    return F.format_number(_c(x), digits)


def audit_columns(df: DataFrame, source: str | None = None, created_at: str | None = "created_at",
                  at: Column | None = None) -> DataFrame:
    """Literal source tag and a wall-clock audit column (PRJ-04)."""
    out = df
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    if created_at:
        out = out.withColumn(created_at, at if at is not None else F.current_timestamp())
    return out


def to_json_payload(df: DataFrame, name: str = "payload") -> DataFrame:
    """Serialize each row to one JSON text column (PRJ-05)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
