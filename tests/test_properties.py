"""Property tests (hypothesis): dedup, segments, rank, rates."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators.dedup import dedup_latest
from stratum.operators.ranking import rank_desc_within, rank_window

SETTINGS = dict(max_examples=10, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

rows = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)),
                          st.sampled_from(["a", "b", None])), max_size=25)


@settings(**SETTINGS)
@given(data=rows)
def test_dedup_idempotent_and_one_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, v int, s string")
    once = dedup_latest(df, ["k"])
    twice = dedup_latest(once, ["k"])
    a = sorted(map(tuple, once.collect()), key=repr)
    assert a == sorted(map(tuple, twice.collect()), key=repr)
    assert len(a) == len({k for k, _, _ in data})
    # the survivor is a real input row
    assert set(a) <= set(data)


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.sampled_from(["x", "y", None]),
                               st.one_of(st.none(), st.integers(0, 5))),
                     min_size=1, max_size=30))
def test_rank_starts_at_one_and_matches_window(spark, data):
    df = spark.createDataFrame(
        [(i, g, None if v is None else Decimal(v)) for i, (g, v) in enumerate(data)],
        "k int, g string, v decimal(18,2)")
    fast = {r.k: r.r for r in rank_desc_within(df, "g", "v", "r", ["k"]).collect()}
    slow = {r.k: r.r for r in rank_window(df, "g", "v", "r").collect()}
    assert fast == slow
    for g in {g for g, _ in data}:
        assert min(fast[i] for i, (gg, _) in enumerate(data) if gg == g) == 1


def test_late_rate_within_bounds_on_test_tables(spark):
    import __spark_entry__ as entry
    df = entry.queries()["seller_performance"](spark, "/root/testdata/sf0.001")
    bad = df.where((F.col("late_rate") < 0) | (F.col("late_rate") > 100)).count()
    assert bad == 0
    seg = entry.queries()["rfm_segments"](spark, "/root/testdata/sf0.001")
    assert seg.count() == seg.select("customer_id").distinct().count()


# keys 0..7; a key's partition is fixed (None for key 7), values vary by day
def _day(rows):
    return [(k, None if k == 7 else k % 3, v) for k, v in rows]


day_rows = st.lists(st.tuples(st.integers(0, 7), st.sampled_from(["a", "b", "c"])),
                    max_size=8, unique_by=lambda r: r[0])


@settings(**SETTINGS)
@given(first=day_rows, second=day_rows)
def test_partitioned_upsert_equals_plain_merge(spark, first, second):
    from stratum.session import new_path
    from stratum.sources.files import read_table
    from stratum.sources.sinks import upsert

    schema = "k int, p int, v string"
    flat, parted = new_path(spark, "flat"), new_path(spark, "parted")
    for rows in (first, second):
        src = spark.createDataFrame(_day(rows), schema)
        upsert(spark, src, flat, ["k"])
        upsert(spark, src, parted, ["k"], partition_by=["p"])
    got = sorted(map(tuple, read_table(spark, parted).select("k", "p", "v").collect()), key=repr)
    want = sorted(map(tuple, read_table(spark, flat).select("k", "p", "v").collect()),
                  key=repr)
    assert got == want
    expected = {k: (p, v) for k, p, v in _day(first)}
    expected.update({k: (p, v) for k, p, v in _day(second)})
    assert got == sorted(((k, p, v) for k, (p, v) in expected.items()), key=repr)


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),
                               st.one_of(st.none(), st.sampled_from(["a", "b", "c'q"]))),
                     max_size=25),
       lo=st.one_of(st.none(), st.integers(0, 2)), hi=st.one_of(st.none(), st.integers(2, 4)),
       mostly=st.sampled_from([1.0, 0.5]))
def test_expectations_match_brute_force(spark, data, lo, hi, mostly):
    from stratum.operators import quality as q

    df = spark.createDataFrame(data, "n int, s string")
    exps = [q.not_null("n", mostly=mostly), q.between("n", lo, hi, mostly=mostly),
            q.in_set("s", ["a", "c'q"]), q.unique("n"), q.row_count_between(1, 10)]
    got = {r.expectation: r for r in q.evaluate(df, "t", exps).collect()}
    ns = [n for n, _ in data if n is not None]
    ss = [s for _, s in data if s is not None]

    def ok(total, bad):
        return total == 0 or (total - bad) / total >= mostly

    nn = got["expect_column_values_to_not_be_null"]
    bad = sum(1 for n, _ in data if n is None)
    assert (nn.element_count, nn.unexpected_count, nn.success) == (
        len(data), bad, ok(len(data), bad))
    bw = got["expect_column_values_to_be_between"]
    bad = sum(1 for n in ns if (lo is not None and n < lo) or (hi is not None and n > hi))
    assert (bw.element_count, bw.unexpected_count, bw.success) == (len(ns), bad, ok(len(ns), bad))
    st_ = got["expect_column_values_to_be_in_set"]
    bad = sum(1 for s in ss if s not in ("a", "c'q"))
    assert (st_.element_count, st_.unexpected_count) == (len(ss), bad)
    un = got["expect_column_values_to_be_unique"]
    dup = sum(c for c in (ns.count(v) for v in set(ns)) if c > 1)
    assert (un.element_count, un.unexpected_count, un.success) == (len(ns), dup, dup == 0)
    rc = got["expect_table_row_count_to_be_between"]
    assert rc.success == (1 <= len(data) <= 10)


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(1, 3)),
                               st.one_of(st.none(), st.sampled_from(["06:00", "18:00"])),
                               st.one_of(st.none(), st.integers(0, 9))), max_size=25))
def test_dedup_keeps_newest_then_greatest(spark, data):
    df = spark.createDataFrame(data, "k int, d int, t string, v int")
    got = {r.k: (r.d, r.t, r.v) for r in dedup_latest(df, ["k"], ["d", "t"]).collect()}

    def order(row):  # nulls lowest, as in the struct ordering
        return tuple((0,) if x is None else (1, x) for x in row)

    want = {}
    for k, *rest in data:
        if k not in want or order(rest) > order(want[k]):
            want[k] = tuple(rest)
    assert got == want
