"""Scans: CSV landing files, date-partitioned bronze Parquet, layer tables.

Every reader takes an explicit schema or relies on the file format's own
schema; nothing infers types from the data (inference is an extra pass and
turns codes such as ``01037`` into numbers).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from stratum.sources.versions import COMMITS, DATA, HIDDEN, commit_of, names, read_commit, versions

# Text form of wall-clock timestamps in landing files.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"

# Options for text files with a header: quoted fields may contain the
# delimiter, doubled quotes and, with multi_line, line breaks.
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "timestampNTZFormat": TIMESTAMP_TEXT,
    "timestampFormat": TIMESTAMP_TEXT,
}


def string_schema(columns: Sequence[str]) -> StructType:
    """All-text schema: the raw landing form, typed later with ``try_cast``."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def _first_line(spark: SparkSession, file: str, whole_quotes: bool) -> str:
    """First line of a file that isn't empty, unpacked if need be; with
    ``whole_quotes`` as many lines as its quoted names span."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(file)
    stream = jpath.getFileSystem(conf).open(jpath)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(jpath)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        while whole_quotes and line is not None and line.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            line += "\n" + more
        return line or ""
    finally:
        stream.close()


def _as_pattern(file: str) -> str:
    """A file's own name, where a reader takes patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", file)


def files_by_header(spark: SparkSession, path: str, multi_line: bool = False) -> dict[str, list[str]]:
    """The files of a landing file, folder or pattern by their header lines; files
    without any line have none and are left out. Only first lines are read, several
    files at a time."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    files = []
    for found in fs.globStatus(jpath) or ():
        inside = fs.listStatus(found.getPath()) if found.isDirectory() else [found]
        files += [f.getPath().toString() for f in inside
                  if not f.isDirectory() and not f.getPath().getName().startswith(("_", "."))]
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(files, pool.map(lambda f: _first_line(spark, f, multi_line), files)):
            if line:
                groups.setdefault(line, []).append(file)
    return groups


def read_csv(spark: SparkSession, path: str, schema: StructType,
             multi_line: bool = False, malformed: str | None = None) -> DataFrame:
    """CSV with header under an explicit schema, whose columns are found by their
    names in the header, in any order there. The files of a folder may have different
    headers: files with the same header line are read together, and the groups are
    united. ``malformed`` names a further column
    that holds the text of lines with too many or too few fields, or with a value
    that its type can't hold (null for all others).

    ``multi_line`` is needed only for sources whose quoted fields contain line
    breaks; such files cannot be split, so it is off by default to keep one
    task per file split."""
    groups = files_by_header(spark, path, multi_line)
    if not groups:
        raise ValueError(f"{path}: no file with a header")
    parts = [_read_group(spark, [path] if len(groups) == 1 else [_as_pattern(f) for f in files], schema, multi_line, malformed)
             for _, files in sorted(groups.items())]
    return reduce(DataFrame.unionByName, parts)


def _read_group(spark: SparkSession, paths: list[str], schema: StructType, multi_line: bool,
                malformed: str | None) -> DataFrame:
    """Files of one header."""
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower())
    header = reader.csv(paths[:1]).columns  # reads the first line
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"{paths[0]}: the header lacks {', '.join(missing)}")
    # every column of the header, in its order; then those asked for
    types = {f.name: f for f in schema.fields}
    full = StructType([types.get(c, StructField(c, StringType())) for c in header])
    if malformed:
        # a line's fields can be counted only if none is pruned
        reader = reader.option("columnPruning", "false").option("columnNameOfCorruptRecord", malformed)
        full = full.add(malformed, StringType())
    return reader.schema(full).csv(paths).select(*[f"`{c}`" for c in schema.names], *([malformed] if malformed else []))


#: lines of a packed landing file, which one task reads
FILE_LINES = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    """Landing-file writer (header, ISO wall-clock timestamps). Files are packed with
    gzip; since a packed file isn't split when it is read, none has more than FILE_LINES lines."""
    (df.write.mode("overwrite").options(**CSV_OPTIONS).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_LINES).csv(path))


#: a column's type may grow from one date to a later one
WIDENED = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
           ("int", "bigint"), ("int", "double"), ("float", "double"), ("void", "string")}


def united_schema(schemas: Sequence[tuple[str, StructType]]) -> StructType:
    """All columns of several schemas, by first appearance, each with the widest of
    its types. Names tell where a type can't be widened to the others."""
    found: dict[str, tuple[str, StructField]] = {}
    for name, schema in schemas:
        for f in schema.fields:
            if f.name not in found:
                found[f.name] = (name, StructField(f.name, f.dataType, True))
                continue
            other, held = found[f.name]
            pair = (held.dataType.simpleString(), f.dataType.simpleString())
            if pair in WIDENED:
                found[f.name] = (name, StructField(f.name, f.dataType, True))
            elif pair[0] != pair[1] and pair[::-1] not in WIDENED:
                raise ValueError(f"column {f.name} is {pair[0]} in {other} but {pair[1]} in {name}")
    return StructType([f for _, f in found.values()])


def read_bronze(spark: SparkSession, path: str, dates: Sequence[str] | None = None,
                since: str | None = None) -> DataFrame:
    """Bronze table partitioned by ``_ingestion_date``; ``dates`` restricts
    the scan to those partitions, ``since`` to that date and later ones (partition pruning, no file is opened for
    other dates).

    The columns are those of all dates asked for, each date's taken from the footer
    of one of its files (a date is landed by one job): a column that a date lacks is
    null there, a type that grew is read as the wider one, types that don't go
    together raise. Columns whose names start with ``__`` are left out."""
    folders = [n for n in names(spark, path) if n.startswith("_ingestion_date=")]
    chosen = [n for n in folders if (not dates or n.split("=")[1] in dates) and (not since or n.split("=")[1] >= since)]
    reader = spark.read.option("basePath", path)
    if folders:
        with ThreadPoolExecutor(16) as pool:  # opening a folder is a small job
            seen = list(pool.map(lambda n: (n, spark.read.parquet(f"{path}/{n}").schema), chosen or folders[-1:]))
        schema = united_schema(seen).add("_ingestion_date", DateType())
        reader = reader.schema(schema)
    df = reader.parquet(path)
    df = df.drop(*[c for c in df.columns if c.startswith(HIDDEN)])
    if dates:
        df = df.where(F.col("_ingestion_date").isin(
            *[F.lit(d).cast("date") for d in dates]))
    if since:
        df = df.where(F.col("_ingestion_date") >= F.lit(since).cast("date"))
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A refined or mart table in any data-source format (parquet, orc,
    delta when the session has it): its last version, or the files as they are
    where others wrote them."""
    commit = None if fmt == "delta" else commit_of(spark, path)
    return read_commit(spark, path, commit, fmt) if commit else spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when ``path`` holds a table of format ``fmt``. A folder that holds
    nothing but what a first write left before its commit is none; any other
    folder without a commit counts, whatever is in it."""
    if fmt == "delta":
        try:
            from delta.tables import DeltaTable  # optional dependency
        except ImportError:
            return False
        return DeltaTable.isDeltaTable(spark, path)
    return path_exists(spark, path) and (bool(versions(spark, path)) or names(spark, path) not in ([DATA], [COMMITS, DATA]))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence of a file-system path through the session's Hadoop
    configuration (works for any Hadoop URI: hdfs, s3a, abfs, file)."""
    sc = spark.sparkContext
    jvm = sc._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(sc._jsc.hadoopConfiguration()).exists(jpath))


def remove_on_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the application's file system is closed (end of
    the application): for staged tables that a returned DataFrame still
    reads lazily, so they cannot be deleted right away."""
    sc = spark.sparkContext
    jvm = sc._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(jpath)
