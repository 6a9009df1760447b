"""Data-quality expectations evaluated as fused Spark aggregates.

All value expectations of one table are folded into a single ``agg`` (one
scan, partial aggregation before the exchange of a single row). Each
uniqueness check adds one keyed aggregate over that column only. Results
come back as a small DataFrame, one row per expectation:

``table_name, expectation, column_name, arguments, element_count,
unexpected_count, unexpected_pct, success``

Null rules: value checks (unique, in-set, between) look at non-null values
only and use the non-null count as denominator; not-null uses all rows.
``success`` holds when ``(element_count - unexpected_count) / element_count
>= mostly``; an empty denominator passes. Range checks on a text column read
its numbers; text that is no number counts as unexpected. Column checks look
at the schema only: no rows are read and ``element_count`` is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

RESULT_COLUMNS = ("table_name", "expectation", "column_name", "arguments",
                  "element_count", "unexpected_count", "unexpected_pct", "success")
RESULT_SCHEMA = ("table_name string, expectation string, column_name string, "
                 "arguments string, element_count bigint, unexpected_count bigint, "
                 "unexpected_pct double, success boolean")


class QualityGateError(ValueError):
    """Raised by :func:`gate` when any expectation of a suite fails."""


def _fmt(v) -> str:
    if v is None:
        return "None"
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return str(v)


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = ()
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
            "row_count": "expect_table_row_count_to_be_between",
            "in_set": "expect_column_values_to_be_in_set",
            "between": "expect_column_values_to_be_between",
            "exists": "expect_column_to_exist",
            "absent": "expect_columns_to_be_absent",
        }[self.kind]

    @property
    def arguments(self) -> str:
        parts = []
        if self.kind in ("row_count", "between"):
            parts += [f"min_value={_fmt(self.min_value)}", f"max_value={_fmt(self.max_value)}"]
        if self.kind == "in_set":
            parts.append("value_set=[" + ", ".join(map(str, self.values)) + "]")
        if self.kind == "absent":
            parts.append("columns=[" + ", ".join(map(str, self.values)) + "]")
        if self.mostly != 1.0:
            parts.append(f"mostly={self.mostly}")
        return ", ".join(parts)


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("not_null", column, mostly=mostly)


def unique(column: str) -> Expectation:
    return Expectation("unique", column)


def row_count_between(min_value: int | None, max_value: int | None) -> Expectation:
    return Expectation("row_count", None, min_value, max_value)


def in_set(column: str, values: Iterable) -> Expectation:
    return Expectation("in_set", column, values=tuple(values))


def between(column: str, min_value: float | None, max_value: float | None,
            mostly: float = 1.0) -> Expectation:
    return Expectation("between", column, min_value, max_value, mostly=mostly)


def column_exists(column: str) -> Expectation:
    return Expectation("exists", column)


def columns_absent(columns: Sequence[str]) -> Expectation:
    return Expectation("absent", None, values=tuple(columns))


# --- SQL text of the aggregates -------------------------------------------------
# Each table's checks are one ``selectExpr`` (a global aggregate) and one
# ``inline`` of result structs: a handful of driver-to-JVM calls per table
# instead of several per expression, which matters for suites with many checks.

def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lit(v) -> str:
    """SQL literal with the type ``F.lit`` would give (int, double, string)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"{v!r}D" if math.isfinite(v) else f"CAST({_text(v)} AS DOUBLE)"
    return _text(v)


def _range_sql(c: str, lo, hi) -> str:
    parts = []
    if lo is not None:
        parts.append(f"{c} >= {_lit(lo)}")
    if hi is not None:
        parts.append(f"{c} <= {_lit(hi)}")
    return " AND ".join(parts) or "TRUE"


def _counts(e: Expectation, texts: Sequence[str]) -> tuple[str, str]:
    """(element_count, unexpected_count) aggregate expressions, as SQL; ``texts``
    names the text columns."""
    rows = "count(1)"
    if e.kind == "row_count":
        return rows, "CAST(NULL AS BIGINT)"
    c = _ident(e.column)
    if e.kind == "not_null":
        return rows, f"count_if({c} IS NULL)"
    if e.kind == "in_set":
        if not e.values:
            return f"count({c})", f"count({c})"
        values = ", ".join(_lit(v) for v in e.values)
        return f"count({c})", f"count_if({c} IS NOT NULL AND NOT {c} IN ({values}))"
    if e.kind == "between":
        value = f"try_cast({c} AS DOUBLE)" if e.column in texts else c
        fits = f"coalesce({_range_sql(value, e.min_value, e.max_value)}, FALSE)"
        return f"count({c})", f"count_if({c} IS NOT NULL AND NOT {fits})"
    raise ValueError(e.kind)


def _row(table: str, e: Expectation, n: str, u: str) -> str:
    column = "CAST(NULL AS STRING)" if e.column is None else _text(e.column)
    return (
        f"named_struct('table_name', {_text(table)}, 'expectation', {_text(e.name)}, "
        f"'column_name', {column}, 'arguments', {_text(e.arguments)}, "
        f"'element_count', CAST({n} AS BIGINT), 'unexpected_count', CAST({u} AS BIGINT), "
        f"'mostly', {_lit(float(e.mostly))}, 'kind', {_text(e.kind)}, "
        f"'lo', CAST({_lit(e.min_value)} AS DOUBLE), 'hi', CAST({_lit(e.max_value)} AS DOUBLE))")


_FINISH = (
    "table_name", "expectation", "column_name", "arguments", "element_count",
    "unexpected_count",
    "try_divide(CAST(unexpected_count AS DOUBLE) * 100.0D, CAST(element_count AS DOUBLE))"
    " AS unexpected_pct",
    "CASE WHEN kind = 'row_count' THEN (lo IS NULL OR element_count >= lo)"
    " AND (hi IS NULL OR element_count <= hi)"
    " WHEN kind IN ('exists', 'absent') THEN unexpected_count = 0"
    " ELSE element_count = 0 OR try_divide(CAST(element_count - unexpected_count AS DOUBLE),"
    " CAST(element_count AS DOUBLE)) >= mostly END AS success",
)


def _finish(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(*_FINISH)


def _raw(df: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """Unfinished result rows of one table (counts and the rule's inputs)."""
    metadata = [e for e in expectations if e.kind in ("exists", "absent")]
    fused = [e for e in expectations if e.kind not in ("unique", "exists", "absent")]
    parts: list[DataFrame] = []
    if metadata:
        names = set(df.columns)
        wrong = [str(int(e.column not in names) if e.kind == "exists" else sum(c in names for c in e.values))
                 for e in metadata]
        structs = ", ".join(_row(table, e, "NULL", u) for e, u in zip(metadata, wrong))
        parts.append(df.sparkSession.range(1, numPartitions=1).selectExpr(f"inline(array({structs}))"))
    if fused:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        aggs, structs = [], []
        for i, e in enumerate(fused):
            n, u = _counts(e, texts)
            aggs += [f"{n} AS n{i}", f"{u} AS u{i}"]
            structs.append(_row(table, e, f"n{i}", f"u{i}"))
        one = df.selectExpr(*aggs)
        parts.append(one.selectExpr(f"inline(array({', '.join(structs)}))"))
    for e in expectations:
        if e.kind != "unique":
            continue
        c = _ident(e.column)
        per_value = df.where(f"{c} IS NOT NULL").groupBy(F.col(c)).agg(
            F.count(F.lit(1)).alias("__rows"))
        summary = per_value.selectExpr(
            "coalesce(sum(__rows), 0) AS n",
            "coalesce(sum(CASE WHEN __rows > 1 THEN __rows END), 0) AS u")
        parts.append(summary.selectExpr(f"inline(array({_row(table, e, 'n', 'u')}))"))
    return reduce(DataFrame.union, parts)


def evaluate(df: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """All expectations of one table: one fused scan + one aggregate per
    uniqueness check. Returns one result row per expectation (in order)."""
    return _finish(_raw(df, table, expectations))


def evaluate_suites(tables: dict[str, DataFrame],
                    suites: dict[str, Sequence[Expectation]]) -> DataFrame:
    """Results for several tables, as one frame. A suite whose table is missing
    is an error: nothing would have been checked."""
    missing = [name for name, exps in suites.items() if exps and name not in tables]
    if missing:
        raise QualityGateError("no table for the suites of: " + ", ".join(missing))
    frames = [_raw(tables[name], name, exps) for name, exps in suites.items() if exps]
    if not frames:  # nothing to check: no result rows, so a gate passes
        spark = SparkSession.getActiveSession() or next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], RESULT_SCHEMA)
    return _finish(reduce(DataFrame.union, frames))


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))


def gate(results: DataFrame, label: str = "") -> DataFrame:
    """Raise :class:`QualityGateError` listing every failed expectation.

    The result frame is small (one row per expectation), so it is collected;
    it is returned unchanged when everything passes."""
    rows = results.collect()
    failed = [r for r in rows if not r["success"]]
    if failed:
        lines = "\n".join(
            f"  {r['table_name']}: {r['expectation']}({r['column_name']}; {r['arguments']})"
            f" unexpected={r['unexpected_count']} of {r['element_count']}" for r in failed)
        raise QualityGateError(
            f"Quality gate failed{(' for ' + label) if label else ''}: "
            f"{len(failed)}/{len(rows)} expectations failed:\n{lines}")
    return results
