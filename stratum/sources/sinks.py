"""Sinks: partition replacement, full overwrite, keyed upsert.

Row counts are taken with ``DataFrame.observe`` during the write itself,
so a table is computed once instead of once for ``count`` and again for the
write.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.functions.checksum import HALF, row_halves
from stratum.session import new_path
from stratum.sources.files import read_table, remove_on_exit, table_exists
from stratum.sources.versions import (
    BUCKET,
    DATA,
    Commit,
    commit_of,
    new_version,
    publish,
    read_commit,
    remove_path,
    write_folders,
    written_folders,
)


class DuplicateKeyError(ValueError):
    """A source holds several rows for one key."""


def observed_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on ``df`` and return the number of rows it wrote."""
    return summed_write(df, write, False)[0]


def summed_write(df: DataFrame, write: Callable[[DataFrame], None], summed: bool) -> tuple[int, str | None]:
    """The same, with the checksum of the written rows where ``summed``: both are
    taken by the write itself."""
    obs = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if summed:
        # columns, so that generated code makes them and the observer only adds
        df = df.withColumns(dict(zip(("__high", "__low"), row_halves(df))))
        measures += [F.sum("__high").alias("high"), F.sum("__low").alias("low")]
    df = df.observe(obs, *measures)
    write(df.drop("__high", "__low") if summed else df)
    got = obs.get if obs._jo.getRow().length() else {"rows": 0}
    return got["rows"], str((got.get("high") or 0) * HALF + (got.get("low") or 0)) if summed else None


def observed(df: DataFrame, measure: Column) -> tuple[Callable[[], int], DataFrame]:
    """``df`` with an aggregate that is taken when it is first written, and the
    function that gives its value from then on (0 for a null, and for a plan that the
    optimizer found to be empty, of which nothing is observed)."""
    obs = Observation()

    def value() -> int:
        return int(obs.get["measure"] or 0) if obs._jo.getRow().length() else 0
    return value, df.observe(obs, measure.alias("measure"))


def write_partitioned(df: DataFrame, path: str,
                      partition_by: str | Sequence[str] = "_ingestion_date",
                      fmt: str = "parquet") -> int:
    """Replace only the partitions present in ``df`` (dynamic overwrite);
    partitions of other dates are left as they are."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)

    def write(d: DataFrame) -> None:
        (d.write.format(fmt).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*cols).save(path))
    return observed_write(df, write)


@dataclass
class Pending:
    """A written version that no reader sees yet. ``frame`` reads the table as it
    would then be, for an audit; ``publish`` makes it current, ``discard`` drops it."""
    spark: SparkSession
    path: str
    fmt: str
    #: none where a merge had nothing to change
    commit: Commit | None
    action: str
    rows: int
    #: of the whole table's published columns, where it was asked for and written whole
    checksum: str | None = None

    def frame(self) -> DataFrame:
        if not self.commit:
            return read_table(self.spark, self.path, self.fmt)
        return read_commit(self.spark, self.path, self.commit, self.fmt)

    def publish(self) -> tuple[str, int]:
        if self.commit:
            publish(self.spark, self.path, self.commit)
        return self.action, self.rows

    def discard(self) -> None:
        if not self.commit:
            return
        for folder in written_folders(self.spark, self.path, self.commit):
            remove_path(self.spark, f"{self.path}/{DATA}/{folder}")


def _written(df: DataFrame, path: str, fmt: str, commit: Commit, action: str,
             others: Sequence[str] = (), summed: bool = False) -> Pending:
    """Write ``df`` as a version that also keeps the folders ``others``."""
    spark = df.sparkSession
    rows, total = summed_write(df, lambda d: write_folders(d, path, commit, fmt), summed and not others)
    folders = (*others, *written_folders(spark, path, commit))
    return Pending(spark, path, fmt, replace(commit, folders=folders), action, rows, total)


def _with_rows(made: Pending, df: DataFrame, summed: bool) -> Pending:
    """A written version with further rows beside those it has."""
    commit = replace(made.commit, folders=())
    rows, total = summed_write(df, lambda d: write_folders(d, made.path, commit, made.fmt, more=True), summed)
    folders = (*dict.fromkeys((*made.commit.folders, *written_folders(made.spark, made.path, commit))),)
    return replace(made, commit=replace(commit, folders=folders), rows=made.rows + rows,
                   checksum=str(int(made.checksum) + int(total)) if summed else None)


def _layout(df: DataFrame, path: str, partition_by: Sequence[str], keys: Sequence[str], buckets: int) -> Commit:
    if partition_by and buckets:
        raise ValueError("a table is laid out by partition columns or by hash buckets, not both")
    schema = StructType([f for f in df.schema.fields if f.name != BUCKET])
    return Commit(new_version(df.sparkSession, path), schema, tuple(partition_by), tuple(keys) if buckets else (), buckets, ())


def prepare_overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                      summed: bool = False) -> Pending:
    """Full rewrite of a table, written once as a version to be published."""
    return _written(df, path, fmt, _layout(df, path, partition_by, (), 0), "overwritten", summed=summed)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """Full rewrite of a table (laid out by ``partition_by`` when given), written
    once as a new version: until it is complete, readers and a failed run keep
    the version before it."""
    if fmt == "delta":
        return observed_write(df, lambda d: d.write.format(fmt).mode("overwrite").save(path))
    return prepare_overwrite(df, path, fmt, partition_by).publish()[1]


def _null_safe_match(target: DataFrame, source: DataFrame, keys: Sequence[str]):
    return reduce(lambda a, b: a & b,
                  [target[k].eqNullSafe(source[k]) for k in keys])


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 newest_by: str | None = None, gone: DataFrame | None = None) -> DataFrame:
    """Update-all / insert-all / no delete, as a relational plan: target rows
    whose key has no match in the source, plus every source row. Keys match
    null-safely, so a rerun with a null key replaces instead of duplicating.
    Both sides must have the same columns: a source without one would null it in
    every matched row. The anti join shuffles on the keys; a small daily source is broadcast by
    the planner when its measured size allows.

    ``newest_by``: a source row gives way to a target row of its key with a greater
    value there (a null is the smallest). Only that column and the keys of the target
    are looked at for it. ``gone``: keys whose target rows go, whatever the source has."""
    if newest_by:
        t, s = target.select(*keys, newest_by), source.select(*keys, newest_by)
        newer = s[newest_by].isNull() & t[newest_by].isNotNull() | (t[newest_by] > s[newest_by])
        # written, so that its size is known: it is small as a rule, and the rows of
        # the source then meet it without a shuffle
        spark, path = target.sparkSession, new_path(target.sparkSession, "ahead")
        found = t.join(s, _null_safe_match(t, s, keys) & newer, "left_semi").select(*keys)
        found.write.parquet(path)
        remove_on_exit(spark, path)
        ahead = spark.read.schema(found.schema).parquet(path)
        source = source.join(ahead, _null_safe_match(source, ahead, keys), "left_anti")
    replaced = source.select(*keys).unionByName(gone.select(*keys)) if gone is not None else source
    kept = target.join(replaced, _null_safe_match(target, replaced, keys), "left_anti")
    return kept.unionByName(source)


def one_row_a_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Callable[[], int]]:
    """``df`` grouped by its keys, and a check to be called once it was written: it
    raises where a key had several rows, else gives the most rows of a key (0 or 1).
    The rows of a key are counted by the same
    job, with a partial aggregate before the shuffle; rows that come grouped by the
    keys already, as refined ones do, are not shuffled for it."""
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row") if rest else F.first(F.lit(1)).alias("__row")
    grouped = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(row, F.count(F.lit(1)).alias("__n"))
    most, grouped = observed(grouped, F.max("__n"))
    single = grouped.select(*[F.col(f"`{c}`") if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns])

    def check() -> int:
        if most() > 1:
            raise DuplicateKeyError(f"the source has up to {most()} rows for one key ({', '.join(keys)})")
        return most()
    return single, check


def _same_columns(source: DataFrame, target: StructType, path: str) -> None:
    ours, theirs = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (source.schema, target))
    if differing := set(ours) ^ set(theirs):
        raise ValueError(f"source and {path} differ in columns: {', '.join(sorted(differing))}")
    if changed := [f"{c} ({ours[c]}, not {theirs[c]})" for c in ours if ours[c] != theirs[c]]:
        raise ValueError(f"source and {path} differ in types: {', '.join(sorted(changed))}")


def _prefix(layout: Sequence[str]) -> Column:
    """Folder of a row, by its layout columns, as Spark names it."""
    def name(c: str) -> Column:
        value = F.col(f"`{c}`").cast("string")
        return F.concat(F.lit(f"{c}="), F.coalesce(F.when(value != "", value), F.lit("__HIVE_DEFAULT_PARTITION__")))
    return F.concat_ws("\0", *map(name, layout))


def touched_folders(spark: SparkSession, frames: Sequence[DataFrame], commit: Commit) -> set[str]:
    """Folders of the rows of ``frames``: one row each, bounded by the number of
    folders the driver lists anyway."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    rows = reduce(DataFrame.unionByName, [f.select(_prefix(commit.layout).alias("folder")) for f in frames])
    return {"/".join("=".join(map(escape, part.split("=", 1))) for part in r.folder.split("\0"))
            for r in rows.distinct().collect()}


def prepare_upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                   fmt: str = "parquet", partition_by: Sequence[str] = (), buckets: int = 0,
                   newest_by: str | None = None, gone: DataFrame | None = None, summed: bool = False) -> Pending:
    """:func:`upsert` up to the written version, to be published after an audit."""
    keys = list(keys)
    single, check = one_row_a_key(source, keys)
    if not table_exists(spark, path, fmt):
        made = _written(single, path, fmt, _layout(source, path, partition_by, keys, buckets), "created", summed=summed)
        try:
            check()
        except DuplicateKeyError:
            made.discard()
            raise
        return made
    held = commit_of(spark, path)
    if held:
        target_schema = held.schema
    else:
        try:
            target_schema = read_table(spark, path, fmt).schema
        except AnalysisException as e:
            raise RuntimeError(f"{path} exists but holds no readable table; it is not taken for a first load") from e
    _same_columns(source, target_schema, path)
    # One snapshot of the source serves the check of its keys, the list of touched
    # folders and the merge: were it evaluated twice and its input changed in between,
    # a folder missing from the list would lose its unread target rows. It is written as
    # folders of the table's next version already, which it may simply become.
    layout = replace(held, version=new_version(spark, path), folders=()) if held and held.layout else \
        _layout(spark.createDataFrame([], target_schema), path, partition_by, keys, buckets)
    staged = None
    try:
        staged = _written(single.select(*[f"`{c}`" for c in layout.schema.names]), path, fmt, layout, "merged", summed=summed)
        if not check() and gone is None:
            return Pending(spark, path, fmt, None, "merged", 0)
        source = read_commit(spark, path, staged.commit, fmt, hidden=True)
        touched, others = [], []
        if not held or not held.layout:
            target = read_commit(spark, path, held, fmt, hidden=True) if held else read_table(spark, path, fmt)
        else:
            if held.buckets:
                looked = [f.select(*keys).withColumn(BUCKET, held.bucket()) for f in (source, gone) if f is not None]
            else:
                index = read_commit(spark, path, held, fmt, hidden=True).select(*dict.fromkeys([*keys, *held.layout]))
                looked = [source, *[index.join(f, _null_safe_match(index, f, keys), "left_semi")
                                    for f in (source, gone) if f is not None]]
            folders = touched_folders(spark, looked, held)
            touched = [f for f in held.folders if f.rsplit("/", 1)[0] in folders]
            others = [f for f in held.folders if f not in set(touched)]
            target = read_commit(spark, path, held, fmt, touched, hidden=True)
        held_rows = target.count() if gone is None else 0
        if gone is None and 2 * staged.rows >= held_rows:
            newer, stays, stay = _unmatched(target, source, keys, newest_by)
            if not newer:
                made = staged
                if stays:
                    # found by the fewer keys: those that stay, or those that are replaced
                    few, how = (stay, "left_semi") if 2 * stays <= held_rows else (source.select(*keys), "left_anti")
                    kept = target.join(few, _null_safe_match(target, few, keys), how)
                    made = _with_rows(made, kept.select(*[f"`{c}`" for c in source.columns]), summed)
                staged = None
                return replace(made, commit=replace(made.commit, folders=(*others, *made.commit.folders)),
                               checksum=None if others else made.checksum)
        return _written(merge_frames(target, source, keys, newest_by, gone), path, fmt,
                        replace(layout, version=new_version(spark, path)), "merged", others, summed)
    finally:
        if staged:
            staged.discard()


def _unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str],
               newest_by: str | None) -> tuple[int, int, DataFrame]:
    """Of a source about as large as the target: how many of its rows give way to a newer
    one, of how many target rows it doesn't have the key, and these keys.
    The keys alone are shuffled; they are written, so that their size is known to the
    planner when the rows are looked up."""
    spark, path = target.sparkSession, new_path(target.sparkSession, "unmatched")
    columns = [*keys, newest_by] if newest_by else list(keys)
    t, s = target.select(*columns), source.select(*columns).withColumn("__held", F.lit(True))
    newer = F.lit(False)
    if newest_by:
        newer = F.coalesce(s[newest_by].isNull() & t[newest_by].isNotNull() | (t[newest_by] > s[newest_by]), F.lit(False))
    found = (t.join(s, _null_safe_match(t, s, keys), "left")
             .select(*[t[k] for k in keys], s["__held"].isNull().alias("__stays"), newer.alias("__newer"))
             .where(F.col("__stays") | F.col("__newer")))
    stays, found = observed(found, F.count_if("__stays"))
    ahead, found = observed(found, F.count_if(F.col("__newer") & ~F.col("__stays")))
    found.write.parquet(path)
    remove_on_exit(spark, path)
    return ahead(), stays(), spark.read.schema(found.schema).parquet(path).where("__stays").select(*keys)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
           fmt: str = "parquet", partition_by: Sequence[str] = (), buckets: int = 0,
           newest_by: str | None = None, gone: DataFrame | None = None) -> tuple[str, int]:
    """Keyed upsert of ``source`` into the table at ``path``.

    Returns ``(action, rows_written)``; action is ``created`` on first load.
    With Delta available and ``fmt="delta"`` this is a ``MERGE``. For plain
    file formats the merged rows are written once, as a new version of the table
    that counts from its commit on: a failure midway leaves the table as it was, and
    a first load that failed is simply run again. Single-writer. A target that exists
    but can't be read is an error, never a first load.

    A source with several rows for one key raises :class:`DuplicateKeyError`, also on
    first load (``MERGE`` raises where they match); columns and types must be the
    target's.

    Which files are read and rewritten follows from the table's layout, given at its
    first load. ``partition_by``: folders by those columns; only the folders that hold
    the source's keys, before or after the merge, are merged. Which folders held a
    key that moves is found by a scan of the target's key and partition columns alone.
    ``buckets``: that many folders by a hash of the keys, so a key's folder follows
    from the key, nothing is scanned for it, and only the source's buckets are merged.
    Neither: the whole table is. ``rows_written`` counts the rewritten folders only.

    ``newest_by``: a column by which a source row that is older than the target's row
    of its key gives way to it, in whatever order the days are merged. ``gone``: keys
    whose rows are taken out first. A source without rows changes nothing.
    """
    if fmt == "delta" and table_exists(spark, path, fmt):
        if gone is not None:
            raise ValueError("rows can't be taken out of a delta table here")
        from delta.tables import DeltaTable  # optional dependency
        cond = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
        newer = f"NOT coalesce(t.`{newest_by}` > s.`{newest_by}`, false)" if newest_by else None
        (DeltaTable.forPath(spark, path).alias("t").merge(source.alias("s"), cond)
         .whenMatchedUpdateAll(newer).whenNotMatchedInsertAll().execute())
        return "merged", read_table(spark, path, fmt).count()
    if fmt == "delta":
        return "created", overwrite(source, path, fmt)
    return prepare_upsert(spark, source, path, keys, fmt, partition_by, buckets, newest_by, gone).publish()
