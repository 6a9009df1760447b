import pytest
from pyspark.sql import functions as F

from stratum.plans.concurrent import run_all
from stratum.session import new_path
from stratum.sources.files import read_table
from stratum.sources.sinks import overwrite


def test_results_in_input_order(spark):
    jobs = {f"t{i}": (lambda i=i: spark.range(1000 * (i + 1)).count()) for i in range(5)}
    out = run_all(spark, jobs)
    assert list(out) == ["t0", "t1", "t2", "t3", "t4"]
    assert list(out.values()) == [1000, 2000, 3000, 4000, 5000]


def test_every_job_finishes_before_first_failure_is_raised(spark):
    path = new_path(spark, "concurrent")

    def fail_first():
        raise ValueError("first")

    def fail_second():
        raise KeyError("second")

    jobs = {
        "bad1": fail_first,
        "ok": lambda: overwrite(spark.range(10).withColumn("x", F.col("id") * 2), path),
        "bad2": fail_second,
    }
    with pytest.raises(ValueError, match="first"):
        run_all(spark, jobs)
    assert read_table(spark, path).count() == 10


def test_empty_and_single(spark):
    assert run_all(spark, {}) == {}
    assert run_all(spark, {"one": lambda: 1}) == {"one": 1}
