"""DuckDB statements for expectation results (same contract as
:mod:`stratum.operators.quality`)."""

from __future__ import annotations

from collections.abc import Sequence

from stratum.operators.quality import Expectation


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _range(col: str, lo, hi) -> str:
    parts = []
    if lo is not None:
        parts.append(f"{col} >= {lo}")
    if hi is not None:
        parts.append(f"{col} <= {hi}")
    return " AND ".join(parts) or "TRUE"


def expectation_sql(table: str, rel: str, e: Expectation, columns: Sequence[str]) -> str:
    meta = (f"{_lit(table)} AS table_name, {_lit(e.name)} AS expectation, "
            f"CAST({_lit(e.column)} AS VARCHAR) AS column_name, {_lit(e.arguments)} AS arguments")
    c = e.column
    if e.kind == "unique":
        src = f"(SELECT {c}, COUNT(*) AS k FROM {rel} WHERE {c} IS NOT NULL GROUP BY {c})"
        n, u = "COALESCE(SUM(k), 0)", "COALESCE(SUM(CASE WHEN k > 1 THEN k END), 0)"
    else:
        src = rel
        if e.kind == "not_null":
            n, u = "COUNT(*)", f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        elif e.kind == "in_set":
            vals = ", ".join(_lit(v) for v in e.values)
            n, u = f"COUNT({c})", f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals}))"
        elif e.kind == "between":
            n = f"COUNT({c})"
            number = f"TRY_CAST({c} AS DOUBLE)"
            u = (f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT "
                 f"COALESCE({_range(number, e.min_value, e.max_value)}, FALSE))")
        elif e.kind == "row_count":
            n, u = "COUNT(*)", "NULL"
        elif e.kind == "exists":
            n, u, src = "NULL", "0" if c in columns else "1", "(SELECT 1) one"
        elif e.kind == "absent":
            n, u, src = "NULL", str(sum(1 for x in e.values if x in columns)), "(SELECT 1) one"
        else:
            raise ValueError(e.kind)
    inner = (f"SELECT {meta}, CAST({n} AS BIGINT) AS element_count, "
             f"CAST({u} AS BIGINT) AS unexpected_count FROM {src}")
    if e.kind == "row_count":
        success = _range("element_count", e.min_value, e.max_value)
    elif e.kind in ("exists", "absent"):
        success = "unexpected_count = 0"
    else:
        success = (f"(element_count = 0 OR CAST(element_count - unexpected_count AS DOUBLE) "
                   f"/ CAST(element_count AS DOUBLE) >= {e.mostly!r})")
    return (
        "SELECT table_name, expectation, column_name, arguments, element_count, "
        "unexpected_count, CAST(unexpected_count AS DOUBLE) * CAST(100 AS DOUBLE) / "
        "NULLIF(CAST(element_count AS DOUBLE), 0) AS unexpected_pct, "
        f"COALESCE({success}, FALSE) AS success FROM ({inner}) x")


def suites_sql(relations: dict[str, str], columns: dict[str, Sequence[str]],
               suites: dict[str, Sequence[Expectation]]) -> str:
    parts = [expectation_sql(t, relations[t], e, columns.get(t, ()))
             for t, exps in suites.items() if t in relations for e in exps]
    return "\nUNION ALL\n".join(parts)
