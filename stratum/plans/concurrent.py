"""Run independent per-table Spark jobs at the same time.

A layer of the pipeline is a set of jobs with no data dependency between
them (land nine sources, refine eight tables, build four marts). Submitted
one after another, a small table's job leaves most of the cluster idle while
it runs; submitted together from driver threads, the scheduler fills the
free executor slots with tasks of the other jobs. Each job stays a normal
Spark job (its own stages, retries and speculation), so losing an executor
only re-runs the lost tasks of the jobs that used it.

Results are returned in input order. When jobs fail, the first failure in
input order is raised after every submitted job has finished, so no write
is abandoned half way; every sink used with this helper is an idempotent
overwrite, so a rerun after a failure is safe.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

from stratum.session import scratch_dir

T = TypeVar("T")

# Upper bound on jobs in flight from one layer; the executors' task slots,
# not this number, bound the work running at once.
MAX_CONCURRENT_JOBS = 8


def run_all(spark: SparkSession, jobs: Mapping[str, Callable[[], T]],
            max_jobs: int = MAX_CONCURRENT_JOBS) -> dict[str, T]:
    """Run every callable in ``jobs`` (each submits its own Spark jobs) and
    return ``{name: result}`` in the order given."""
    if not jobs:
        return {}
    # Resolve the shared checkpoint folder once, before threads race to set
    # it. Without one on a cluster, only jobs that stage data need it, and
    # they raise on their own.
    try:
        scratch_dir(spark)
    except RuntimeError:
        pass
    if len(jobs) == 1 or max_jobs <= 1:
        return {name: fn() for name, fn in jobs.items()}
    sc = spark.sparkContext
    parent = sc.getLocalProperty("spark.job.description")

    def labelled(name: str, fn: Callable[[], T]) -> Callable[[], T]:
        def job() -> T:
            # thread-local: names the Spark jobs of this table in the event log;
            # under spark.scheduler.mode=FAIR each table also gets its own pool,
            # so a large table cannot hold every slot (ignored under FIFO)
            sc.setJobDescription(f"{parent}: {name}" if parent else name)
            sc.setLocalProperty("spark.scheduler.pool", name)
            try:
                return fn()
            finally:
                sc.setJobDescription(None)
                sc.setLocalProperty("spark.scheduler.pool", None)
        return job

    with ThreadPoolExecutor(max_workers=min(max_jobs, len(jobs)),
                            thread_name_prefix="stratum-job") as pool:
        futures = {name: pool.submit(labelled(name, fn)) for name, fn in jobs.items()}
        errors = [f.exception() for f in futures.values()]
    first = next((e for e in errors if e is not None), None)
    if first is not None:
        raise first
    return {name: f.result() for name, f in futures.items()}
