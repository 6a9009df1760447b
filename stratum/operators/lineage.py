"""Bronze lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_lineage(df: DataFrame, source_file: str, run_ts: str,
                run_date: str | None = None) -> DataFrame:
    """Ingest stamp (ISO text), source file name and ingest date.

    Both stamps come from one run timestamp passed in by the caller (no
    ``current_date``), so a rerun of the same run lands identical values."""
    return df.withColumns({
        "_ingested_at": F.lit(run_ts),
        "_source_file": F.lit(source_file),
        "_ingestion_date": F.lit(run_date or run_ts[:10]).cast("date"),
    })
