"""A checksum of a table's rows that doesn't depend on their order.

Each row becomes one text (columns by name, strings with their length, nulls marked),
and the characters of 32 bits of each text's md5 are added up by place: a partial
aggregate per task, one number in the end. It can be observed during a write, so that
nothing is read again for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

#: doubles below a bound are multiplied by a power of ten and cut, which keeps about
#: 16 digits of each; the product is the same in every engine, a double's text is not
SCALES = ((1.0, 1e17), (1e2, 1e15), (1e4, 1e13), (1e6, 1e11), (1e8, 1e9), (1e12, 1e5), (1e18, 1.0))


def _text(name: str, kind) -> Column:
    c = F.col("`" + name.replace("`", "``") + "`")
    text = c.cast("string")
    if isinstance(kind, (DoubleType, FloatType)):
        c = c.cast("double")
        places = reduce(lambda tail, s: F.when(F.abs(c) < s[0], F.concat(F.floor(c * s[1] + 0.5).cast("string"), F.lit(f"/{int(s[1])}")))
                        .otherwise(tail), reversed(SCALES), F.lit(None).cast("string"))
        text = F.coalesce(places, text)
    elif isinstance(kind, StringType):  # no other type's text holds a separator
        text = F.concat(F.length(c).cast("string"), F.lit(":"), c)
    return F.coalesce(text, F.lit("~"))


def row_text(df: DataFrame) -> Column:
    kinds = {f.name: f.dataType for f in df.schema.fields if not f.name.startswith("__")}
    return F.concat_ws("|", *[_text(c, kinds[c]) for c in sorted(kinds)])


#: what four characters of a digest are worth, and that a second four follow them
PLACES, HALF = (1 << 21, 1 << 14, 1 << 7, 1), 1 << 28


def row_halves(df: DataFrame) -> tuple[Column, Column]:
    """Two numbers below HALF for each row."""
    digest = F.md5(row_text(df))

    def half(at: int) -> Column:
        return sum((F.ascii(F.substring(digest, at + i, 1)) * p for i, p in enumerate(PLACES)), F.lit(0)).cast("bigint")
    return half(1), half(5)


def checksum(df: DataFrame) -> Column:
    """Aggregate over the rows of ``df``: decimal text, '0' for no rows. Columns
    must be scalars; those whose names start with ``__`` are left out."""
    high, low = (F.sum(h.cast("decimal(20,0)")) for h in row_halves(df))
    return F.coalesce((high * HALF + low).cast("decimal(38,0)").cast("string"), F.lit("0"))
