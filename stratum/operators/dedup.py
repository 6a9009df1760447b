"""Deterministic key deduplication.

``dropDuplicates`` keeps an arbitrary row per key, so two runs over the same
input can publish different rows. Here the surviving row is the greatest
under a total order: the ``newest_first`` columns (ingestion date and time),
then every remaining column in schema order, nulls lowest.

The plan is one ``groupBy(keys)`` with ``max(struct(...))``: a partial
aggregate runs before the shuffle, so a key that holds a large share of the
rows reaches the exchange as at most one row per map task, never as one
unbounded group in a single task (a ``row_number`` window would do that).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WINNER = "__winner"


def dedup_latest(df: DataFrame, keys: Sequence[str],
                 newest_first: Sequence[str] = ()) -> DataFrame:
    """One row per distinct ``keys`` value (null keys form one group)."""
    keys = list(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"dedup keys not in frame: {missing}")
    order = [c for c in newest_first if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    if not fields:
        return df.select(*keys).distinct()
    winner = F.max(F.struct(*[F.col(f"`{c}`") for c in fields])).alias(_WINNER)
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(winner)
    return out.select(*[
        F.col(f"`{c}`") if c in keys else F.col(_WINNER).getField(c).alias(c)
        for c in df.columns
    ])
