"""Every registered query stays JVM-side and pairs rows only by keys: no
Python UDF operators, no Cartesian or nested-loop joins in its plan, nor in the
plan of any table that it writes on the way."""

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
from stratum.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def plans(spark):
    """The returned frame's plan and those of all frames the query writes."""
    out, written = {}, []

    def watched(method):
        def write(self, *args, **options):
            written.append(self._df._jdf.queryExecution().executedPlan().toString())
            return method(self, *args, **options)
        return write

    with pytest.MonkeyPatch.context() as patch:
        for name in ("save", "parquet", "csv"):
            patch.setattr(DataFrameWriter, name, watched(getattr(DataFrameWriter, name)))
        for name in REGISTRY:
            written.clear()
            df = entry.queries()[name](spark, SF)
            out[name] = [*written, df._jdf.queryExecution().executedPlan().toString()]
    return out


def test_no_python_udfs_or_cross_joins(plans):
    bad = {name: [op for op in FORBIDDEN for plan in found if op in plan] for name, found in plans.items()}
    assert {name: ops for name, ops in bad.items() if ops} == {}


def test_every_query_has_a_plan(plans):
    assert len(plans) == len(REGISTRY) and all(all(found) for found in plans.values())
    # the writes of layered runs are among them: nine landing files and tables, eight refined, four marts
    assert len(plans["pipeline_end_to_end"]) > 30
    assert sum("LeftAnti" in plan for plan in plans["upsert_merge_bucketed"]) >= 2
