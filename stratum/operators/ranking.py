"""Rank within a group, without sending a whole group to one task.

``rank() OVER (PARTITION BY g ORDER BY v DESC)`` hash-partitions on ``g``;
when one group holds a large share of the rows (one product category can),
that group is sorted by a single task. :func:`rank_desc_within` computes the
same result (rank with gaps, ties share a rank) from a global order:

1. one range-partitioned sort on ``(g, v DESC, tiebreak)``: the range
   partitioner splits a large group across many tasks;
2. the sorted rows are written, with the number of their part, to a new folder
   under the shared checkpoint folder, so that a part stays the same when a task
   or an executor is lost and it is read again;
3. rows are ranked within their part and group; no part holds a whole hot group;
4. a carry table with one row per part and group gives what earlier parts add: how
   many rows of the group they hold, and where a tie that goes on began. It is
   joined on part and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import new_path
from stratum.sources.files import remove_on_exit


def rank_window(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Plain window rank (all rows of a group in one task)."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc())
    return df.withColumn(name, F.rank().over(w))


def rank_desc_within(df: DataFrame, group: str, value: str, name: str,
                     tiebreak: Sequence[str]) -> DataFrame:
    """Rank of ``value`` descending within ``group`` (ties share a rank,
    gaps after ties). ``tiebreak`` columns must make the order total (for
    example the row key); they do not affect the result."""
    spark = df.sparkSession
    base = new_path(spark, "rank")
    # The range exchange samples its input in a separate job; both that job
    # and the sort read the input's last shuffle output, so the work above
    # it is not repeated.
    ordered = df.orderBy(F.col(group).asc_nulls_first(), F.col(value).desc_nulls_last(),
                         *[F.col(c).asc_nulls_first() for c in tiebreak])
    ordered.withColumn("__part", F.spark_partition_id()).write.parquet(f"{base}/sorted")
    remove_on_exit(spark, base)  # read lazily by the result, so kept until the end
    inside = Window.partitionBy("__part", group).orderBy(F.col(value).desc_nulls_last())
    local = spark.read.parquet(f"{base}/sorted").withColumn("__rank", F.rank().over(inside))

    v = F.col(value)
    parts = local.groupBy("__part", group).agg(
        F.count(F.lit(1)).alias("__n"), F.max(v).alias("__first"),
        F.when(F.count(v) == F.count(F.lit(1)), F.min(v)).alias("__last"),
        (F.max("__rank") - 1).alias("__above_last"))
    along = Window.partitionBy(group).orderBy("__part")
    earlier = F.coalesce(F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = (parts.withColumn("__before", earlier)
             .withColumn("__tie", F.min(F.col("__before") + F.col("__above_last"))
                         .over(Window.partitionBy(group, "__last")))
             .withColumns({"__goes_on": F.lag(F.lit(True)).over(along)
                           & F.lag("__last").over(along).eqNullSafe(F.col("__first")),
                           "__tie": F.lag("__tie").over(along)}))
    r, c = local.alias("r"), carry.alias("c")
    joined = r.join(c, (F.col("r.__part") == F.col("c.__part"))
                    & F.col(f"r.{group}").eqNullSafe(F.col(f"c.{group}")))
    rank = (F.when(F.col("c.__goes_on") & F.col(f"r.{value}").eqNullSafe(F.col("c.__first")),
                   F.col("c.__tie") + 1)
            .otherwise(F.col("c.__before") + F.col("r.__rank")).cast("int"))
    return joined.select(*[F.col(f"r.{x}") for x in df.columns], rank.alias(name))
