"""Expectations: each one fails on a frame built to break it."""

import pytest

from stratum.operators import quality as q


@pytest.fixture()
def df(spark):
    rows = [(1, "a", 5.0), (2, "b", 7.0), (2, None, None), (None, "z", 11.0)]
    return spark.createDataFrame(rows, "id long, s string, v double")


def run(df, *exps):
    return {(r.expectation, r.column_name, r.arguments): r
            for r in q.evaluate(df, "t", list(exps)).collect()}


def one(df, e):
    return next(iter(run(df, e).values()))


def test_not_null_and_mostly(df):
    r = one(df, q.not_null("id"))
    assert (r.element_count, r.unexpected_count, r.success) == (4, 1, False)
    assert r.unexpected_pct == 25.0
    assert one(df, q.not_null("id", mostly=0.75)).success is True


def test_unique_counts_all_duplicated_rows(df):
    r = one(df, q.unique("id"))
    assert (r.element_count, r.unexpected_count, r.success) == (3, 2, False)
    assert one(df, q.unique("s")).success is True     # nulls are skipped


def test_between_skips_nulls_and_open_bounds(df):
    r = one(df, q.between("v", 5, 10))
    assert (r.element_count, r.unexpected_count, r.success) == (3, 1, False)
    assert one(df, q.between("v", 5, None)).success is True
    assert one(df, q.between("v", None, 4)).unexpected_count == 3


def test_in_set(df):
    r = one(df, q.in_set("s", ["a", "b"]))
    assert (r.element_count, r.unexpected_count, r.success) == (3, 1, False)


def test_row_count(df):
    assert one(df, q.row_count_between(1, 3)).success is False
    assert one(df, q.row_count_between(4, None)).success is True


def test_metadata_checks(df):
    assert one(df, q.column_exists("nope")).success is False
    assert one(df, q.column_exists("s")).success is True
    assert one(df, q.columns_absent(["s", "x"])).unexpected_count == 1


def test_empty_denominator_passes(spark):
    empty = spark.createDataFrame([], "id long")
    assert one(empty, q.between("id", 1, 2)).success is True


def test_gate_raises_listing_failures(df):
    res = q.evaluate(df, "t", [q.not_null("id"), q.unique("s")])
    with pytest.raises(q.QualityGateError, match="1/2 expectations failed"):
        q.gate(res, "t")


def test_suite_fused_single_scan_plan(df):
    res = q.evaluate(df, "t", [q.not_null("id"), q.between("v", 0, 1), q.in_set("s", ["a"])])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 1


def test_ranges_on_text_and_missing_tables(spark):
    import pytest

    from stratum.operators.quality import QualityGateError, between, column_exists, columns_absent, evaluate, evaluate_suites

    df = spark.createDataFrame([("13.29",), ("abc",), (None,), ("-1",)], "price string")
    row = evaluate(df, "t", [between("price", 0, 10_000)]).collect()[0]
    assert (row.element_count, row.unexpected_count) == (3, 2)
    with pytest.raises(QualityGateError, match="missing"):
        evaluate_suites({"t": df}, {"t": [column_exists("price")], "missing": [column_exists("x")]})
    schema_only = evaluate(df, "t", [column_exists("price"), columns_absent(["price"])])
    assert [(r.element_count, r.success) for r in schema_only.collect()] == [(None, True), (None, False)]
    plan = schema_only._jdf.queryExecution().executedPlan().toString()
    assert "Scan" not in plan.replace("OneRowRelation", "")


def test_validate_one_layer(spark):
    import pytest

    from stratum.operators.quality import QualityGateError, not_null
    from stratum.plans.pipeline import Layout, validate
    from stratum.session import new_path
    from stratum.sources.sinks import overwrite

    lake = Layout(new_path(spark, "lake"))
    overwrite(spark.range(3), lake.gold("a"))
    assert validate(spark, lake, "gold", suite={"a": [not_null("id")]}).count() == 1
    with pytest.raises(QualityGateError):
        validate(spark, lake, "gold", suite={"a": [not_null("id")], "b": [not_null("id")]})
