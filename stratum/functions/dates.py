"""Date and time helpers.

Timestamps in the refined layer are ``timestamp_ntz``: the sources carry
wall-clock times without a zone, and the session zone is pinned to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c, source_type: DataType | None = None) -> Column:
    """Typed timestamp from text or any date/time type; bad text is null.

    ``source_type`` is the column's current type, read from the schema, so
    already-typed columns are converted without a text round trip."""
    col = _col(c)
    if isinstance(source_type, TimestampNTZType):
        return col
    if isinstance(source_type, (TimestampType, DateType)):
        return col.cast("timestamp_ntz")
    if source_type is None or isinstance(source_type, StringType):
        return F.try_to_timestamp(col.cast("string")).cast("timestamp_ntz")
    return col.try_cast("timestamp_ntz")


def to_day(c) -> Column:
    return F.to_date(_col(c))


def day_of_week(c) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(c))


def day_diff(end, start) -> Column:
    """Number of calendar-day boundaries from ``start`` to ``end``."""
    return F.datediff(_col(end), _col(start))


def is_later(a, b) -> Column:
    """``a`` strictly after ``b``; null when either side is null."""
    return _col(a) > _col(b)


def plus_days(c, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(days), _col(c))
