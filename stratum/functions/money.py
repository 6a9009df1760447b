"""Money and other measures: held as the source's doubles, added up exactly.

A refined value keeps the precision it came with, so filters see the unrounded
number. Sums go through decimals that hold each double's shortest text, so a
sum doesn't depend on partitioning or summation order, and become a double
once. Values such a decimal can't hold are summed as doubles instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Holds doubles below 1e20 to 18 places.
EXACT = DecimalType(38, 18)
# Intermediate precision used before rounding a double to two places.
_ROUNDING = DecimalType(24, 8)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Parse or convert an amount; text that is not a number becomes null."""
    return _col(c).try_cast("double")


def as_double(c) -> Column:
    return _col(c).cast("double")


def ratio(num, den) -> Column:
    """``num / den`` as double; null when the divisor is zero or null."""
    return F.try_divide(as_double(num), as_double(den))


def pct(num, den) -> Column:
    """Percentage ``num / den * 100`` (null for a zero divisor)."""
    return ratio(num, den) * F.lit(100.0)


def round2(c) -> Column:
    """Round to two decimals, half away from zero, returned as double.

    Going through a decimal avoids the binary-fraction surprises of rounding a
    double directly (``round(1.005, 2)``); numbers too large for it have no
    decimals to round."""
    col = as_double(c)
    return F.coalesce(F.round(col.try_cast(_ROUNDING), 2).cast("double"), F.round(col, 2))


def total(c) -> Column:
    """Sum of the non-null doubles, independent of their order."""
    col = _col(c)
    exact = col.try_cast(EXACT)
    return F.coalesce(F.when(F.count(exact) == F.count(col), F.try_sum(exact)).cast("double"),
                      F.sum(col.cast("double")))


def total_mean(c) -> Column:
    """Average of the non-null doubles: :func:`total` divided once by the count."""
    return F.try_divide(total(c), F.count(_col(c)))


def mean(c) -> Column:
    """Average of the non-null whole numbers: their sum divided once by the count."""
    col = _col(c)
    return F.try_divide(F.sum(col).cast("double"), F.count(col))
