"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from stratum.session import new_path
from stratum.sources.files import remove_on_exit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared scratch folder (``spark.checkpoint.dir``)
    and read it back: cuts the lineage, survives lost executors, and lets several
    later steps use the rows without computing them again. The folder is deleted
    when the application ends."""
    spark = df.sparkSession
    path = new_path(spark, purpose)
    df.write.parquet(path, compression=compression)
    remove_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    while name in df.columns:
        name += "_"
    return name


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text)`` with null texts as empty ones; other columns are left out,
    so names that clash with an operator's results can't disturb it."""
    return df.select(F.col(id_col).alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_texts(df: DataFrame, setup: Callable[[], Callable[[list[str]], list[list]]],
              fields: list[StructField], id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per text: its id (any type, passed through untouched) and
    ``fields``. ``setup`` runs once in each task and returns the function that
    turns a batch of texts into one list per field. Narrow: no shuffle."""
    return map_values(texts_of(df, id_col, text_col), setup, fields)


def map_values(source: DataFrame, setup: Callable[[], Callable[[list], list[list]]],
               fields: list[StructField]) -> DataFrame:
    """The same for the second column of ``source``, whatever its type."""
    schema = StructType([source.schema.fields[0], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = setup()
        for batch in batches:
            columns = score(batch.column(1).to_pylist())
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), *arrays],
                                             schema=arrow)

    return source.mapInArrow(run, schema)


def explode_texts(df: DataFrame, setup: Callable[[], Callable[[str], list[tuple]]],
                  fields: list[StructField], id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Any number of rows per text: its id and ``fields``."""
    source = texts_of(df, id_col, text_col)
    schema = StructType([source.schema["doc_id"], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = setup()
        for batch in batches:
            at: list[int] = []
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                new = rows_of(text)
                rows += new
                at += [i] * len(new)
            ids = batch.column(0).cast(arrow.field(0).type).take(pa.array(at, pa.int64()))
            columns = list(zip(*rows)) if rows else [[] for _ in fields]
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([ids, *arrays], schema=arrow)

    return source.mapInArrow(run, schema)


def text_groups(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of texts of at most ``most`` characters together; a longer text
    stands alone."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if len(texts) > at:
        yield at, len(texts)
