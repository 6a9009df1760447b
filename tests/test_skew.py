"""One key holding a third of all rows: results stay exact and the plans
reduce the hot key before the shuffle instead of sending it to one task."""

import re

import pytest
from pyspark.sql import functions as F

from stratum.operators import quality as q
from stratum.operators.dedup import dedup_latest
from stratum.operators.ranking import rank_desc_within

N = 3000


@pytest.fixture()
def hot(spark):
    # key 0 holds a third of the rows, spread over every input partition
    return (spark.range(0, N, numPartitions=6)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                    (F.col("id") * 7 % 101).alias("v"),
                    F.concat(F.lit("s"), (F.col("id") % 13).cast("string")).alias("s")))


def _partial_before_exchange(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchange = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln)
    return any(re.search(r"partial_", ln) for ln in lines[exchange + 1:])


def test_dedup_hot_key_exact_and_partial(spark, hot):
    out = dedup_latest(hot, ["k"])
    rows = {r.k: (r.v, r.s) for r in out.collect()}
    brute = {}
    for r in hot.collect():
        brute[r.k] = max(brute.get(r.k, (r.v, r.s)), (r.v, r.s))
    assert rows == brute
    assert _partial_before_exchange(out)


def test_unique_check_hot_key(spark, hot):
    res = q.evaluate(hot, "t", [q.unique("k")]).collect()[0]
    assert (res.element_count, res.unexpected_count, res.success) == (N, N // 3, False)
    per_value = hot.where("k IS NOT NULL").groupBy("k").count()
    assert _partial_before_exchange(per_value)


def test_rank_hot_group(spark):
    # group "hot" holds a third of the rows; values tie often
    df = (spark.range(0, N, numPartitions=6)
          .select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                  .otherwise(F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("g"),
                  (F.col("id") * 7 % 101).alias("v"), "id"))
    rows = df.collect()
    got = {r.id: r.r for r in rank_desc_within(df, "g", "v", "r", ["id"]).collect()}
    for r in rows:
        assert got[r.id] == 1 + sum(1 for o in rows if o.g == r.g and o.v > r.v)
