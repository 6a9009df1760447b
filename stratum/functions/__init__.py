"""Scalar and aggregate building blocks shared by every layer.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from stratum.functions.money import (  # noqa: F401
    as_double,
    mean,
    money,
    pct,
    ratio,
    round2,
    total,
    total_mean,
)
from stratum.functions.dates import (  # noqa: F401
    as_timestamp,
    day_diff,
    day_of_week,
    is_later,
    plus_days,
    to_day,
)
from stratum.functions.casts import as_int, as_double_value, coalesce_first  # noqa: F401
from stratum.functions.checksum import checksum  # noqa: F401
