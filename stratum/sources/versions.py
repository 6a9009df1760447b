"""Tables kept as folders of data files and a commit that lists them.

``<table>/_data/[<partition or bucket folder>/]__v=<version>/`` holds files that
are never written again; ``<table>/_commits/<version>`` names the folders that make
up the table from that version on, its schema and its layout. A version therefore
counts from its commit on: a write that fails, or is not yet published, changes
nothing for readers, and a version that replaces a few folders names the others of
the version before. Single-writer.

Columns whose names start with ``__`` are kept beside the published ones (the
bucket number, what a merge compares) and left out when a table is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS, DATA = "_commits", "_data"
HIDDEN, VERSION, BUCKET = "__", "__v", "__bucket"
#: up to so many buckets, each task writes a file in each: rows aren't shuffled for it
FEW_BUCKETS = 8


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, jpath = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(jpath)) if fs.exists(jpath) else []


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder (recursively) through the session's Hadoop
    configuration; True when something was deleted. Used for staged copies
    in the shared scratch folder once they are no longer needed."""
    fs, jpath = _fs(spark, path)
    return bool(fs.delete(jpath, True))


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, or nothing where there is no such folder:
    what stood there goes in both cases. A rename, which object stores do by copying;
    not atomic, so a run that ends in between is run again."""
    fs, from_ = _fs(spark, source)
    _, to = _fs(spark, target)
    fs.delete(to, True)
    if fs.exists(from_):
        fs.mkdirs(to.getParent())
        if not fs.rename(from_, to):
            raise RuntimeError(f"{source} could not be moved to {target}")


@dataclass(frozen=True)
class Commit:
    version: str
    #: published and hidden columns, partition columns among them
    schema: StructType
    partition_by: tuple[str, ...]
    #: key columns and number of hash buckets; 0: none
    bucket_keys: tuple[str, ...]
    buckets: int
    folders: tuple[str, ...]

    @property
    def layout(self) -> tuple[str, ...]:
        return (BUCKET,) if self.buckets else self.partition_by

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_keys), F.lit(self.buckets)).cast("int")

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "partition_by": self.partition_by, "buckets": self.buckets,
                           "bucket_keys": self.bucket_keys, "folders": self.folders})


def versions(spark: SparkSession, path: str) -> list[str]:
    """Committed versions of a table, oldest first."""
    return [n for n in names(spark, f"{path}/{COMMITS}") if not n.startswith(".")]


def commit_of(spark: SparkSession, path: str, version: str | None = None) -> Commit | None:
    """A version's commit (default: the last one); None where there is none."""
    done = versions(spark, path)
    if not done:
        return None
    fs, jpath = _fs(spark, f"{path}/{COMMITS}/{version or done[-1]}")
    stream = fs.open(jpath)
    try:
        held = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Commit(version or done[-1], StructType.fromJson(held["schema"]), tuple(held["partition_by"]),
                  tuple(held["bucket_keys"]), held["buckets"], tuple(held["folders"]))


def read_commit(spark: SparkSession, path: str, commit: Commit, fmt: str = "parquet",
                folders: Sequence[str] | None = None, hidden: bool = False) -> DataFrame:
    """The rows of a commit, or of some of its folders: no other folder is listed.
    The schema is the commit's, so nothing is opened to find it."""
    shown = [c for c in commit.schema.names if hidden or not c.startswith(HIDDEN)]
    folders = commit.folders if folders is None else folders
    if not folders:
        return spark.createDataFrame([], commit.schema).select(*shown)
    reader = spark.read.schema(commit.schema).format(fmt).option("basePath", f"{path}/{DATA}")
    return reader.load([f"{path}/{DATA}/{f}" for f in folders]).select(*[f"`{c}`" for c in shown])


def write_folders(df: DataFrame, path: str, commit: Commit, fmt: str = "parquet", more: bool = False) -> None:
    """Write rows as the folders of ``commit.version``, in its layout; with ``more`` beside
    those written for it before.

    Rows are grouped by folder first, so that a folder gets a few well-sized files;
    AQE's rebalance splits a folder that holds a large share of the rows across
    tasks and merges small ones, so a hot one is not one task. With FEW_BUCKETS or
    fewer, rows stay in their tasks: all tasks hold rows of all buckets, and a file is no
    smaller than that part of a task's rows."""
    layout = list(commit.layout)
    packed = {"compression": "zstd"} if fmt == "parquet" else {}
    if not layout:
        df.write.format(fmt).options(**packed).mode("append" if more else "errorifexists").save(f"{path}/{DATA}/{VERSION}={commit.version}")
        return
    if commit.buckets:
        df = df.withColumn(BUCKET, commit.bucket())
    if not 0 < commit.buckets <= FEW_BUCKETS:
        df = df.hint("rebalance", *layout)
    (df.withColumn(VERSION, F.lit(commit.version))
     .write.format(fmt).options(**packed).mode("append").partitionBy(*layout, VERSION).save(f"{path}/{DATA}"))


def written_folders(spark: SparkSession, path: str, commit: Commit) -> tuple[str, ...]:
    """The folders of a version that were written, found by their names."""
    fs, data = _fs(spark, f"{path}/{DATA}")
    if not fs.exists(data):
        return ()
    _, pattern = _fs(spark, f"{path}/{DATA}" + "/*" * len(commit.layout) + f"/{VERSION}={commit.version}")
    depth = len(commit.layout) + 1
    return tuple(sorted("/".join(f.getPath().toString().split("/")[-depth:]) for f in fs.globStatus(pattern) or ()))


def new_version(spark: SparkSession, path: str) -> str:
    done = versions(spark, path)
    return f"{int(done[-1].split('-')[0]) + 1 if done else 1:012d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, path: str, commit: Commit, keep: int = 2) -> None:
    """Make a written version the current one. Of those before, ``keep`` - 1 stay
    readable; the folders that only older ones name are deleted."""
    fs, jpath = _fs(spark, f"{path}/{COMMITS}/{commit.version}")
    _, half = _fs(spark, f"{path}/{COMMITS}/.{commit.version}")
    out = fs.create(half, True)
    out.write(commit.text().encode())
    out.close()
    if not fs.rename(half, jpath):
        raise RuntimeError(f"{path}: version {commit.version} could not be committed")
    done = versions(spark, path)
    old = [commit_of(spark, path, v) for v in done[:-keep]]
    needed = {f for v in done[-keep:] for f in commit_of(spark, path, v).folders} if old else set()
    for c in old:
        for folder in set(c.folders) - needed:
            remove_path(spark, f"{path}/{DATA}/{folder}")
        remove_path(spark, f"{path}/{COMMITS}/{c.version}")
