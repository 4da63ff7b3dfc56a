"""Time conversions (PRJ-08..11, SCL-02/03/09). All return Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Monday = 0.
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


# Fixed value: the last millisecond of the year 9999.
MAX_EPOCH_MS = 253_402_300_799_999


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def smart_timestamp(x) -> Column:
    """Digits (number or digit string) are epoch milliseconds; anything else is
    ISO-8601 (``Z`` or an offset accepted) converted to UTC. Milliseconds are
    kept. Unparseable input gives NULL, as do milliseconds beyond the year 9999."""
    s = _c(x).cast("string")
    digits = s.rlike("^[0-9]+$")
    iso = F.regexp_replace(s, "Z$", "+00:00")
    ms = s.try_cast("bigint")
    in_range = F.when(ms <= F.lit(MAX_EPOCH_MS), ms)          # more would overflow microseconds and end the job
    return F.when(digits, F.timestamp_millis(in_range)).otherwise(F.try_to_timestamp(iso))


def epoch_ms_to_ts_seconds(x) -> Column:
    """PRJ-09: epoch ms to a timestamp truncated to whole seconds (integer division)."""
    ms = _c(x).cast("bigint")
    return F.timestamp_seconds((ms - F.pmod(ms, F.lit(1000))) / F.lit(1000))


def epoch_s_to_ts(x) -> Column:
    """Epoch-second text to a UTC timestamp; missing gives epoch 0."""
    return F.timestamp_seconds(F.coalesce(_c(x).cast("bigint"), F.lit(0)))


def to_day(x) -> Column:
    """ISO datetime text or a timestamp to DATE."""
    return F.to_date(_c(x))


def hour_of_day(x) -> Column:
    """SCL-02: hour 0-23."""
    return F.hour(_c(x))


def weekday(x) -> Column:
    """SCL-02: Monday = 0 ... Sunday = 6 (not ``dayofweek``)."""
    return F.weekday(_c(x))


def weekday_name(day_number) -> Column:
    """SCL-03: weekday number to its short name."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.element_at(names, _c(day_number) + 1)


def iso_text(x) -> Column:
    """SCL-09: timestamp to ISO-8601 text with a ``Z`` zone (UTC session)."""
    return F.date_format(_c(x), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
