"""Lenient casts: a value that does not convert becomes null instead of
failing the job (ANSI mode raises on a plain ``cast``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c) -> Column:
    """Whole number; decimals are cut off (``'5.0'`` and ``'5.9'`` give 5)."""
    return F.coalesce(_col(c).try_cast("int"), _col(c).try_cast("decimal(38,18)").try_cast("int"))


def as_double_value(c) -> Column:
    return _col(c).try_cast("double")


def coalesce_first(*cols) -> Column:
    """First non-null of the given columns."""
    return F.coalesce(*[_col(c) for c in cols])
