"""The layered run: gate modes and a second daily run that merges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators import marts
from stratum.operators.lineage import add_lineage
from stratum.operators.quality import QualityGateError, row_count_between
from stratum.plans import suites
from stratum.plans.layers import MART_BUILDERS, SILVER_TABLES, refine_table
from stratum.plans.pipeline import (
    Layout,
    bronze_tables,
    gold_tables,
    prepare_sales,
    prepare_silver_table,
    run_pipeline,
    silver_tables,
)
from stratum.plans.queries import _role_frames, all_marts, export_landing
from stratum.session import new_path
from stratum.sources.files import read_bronze, read_table
from stratum.sources.sinks import write_partitioned
from stratum.sources.versions import commit_of, names, versions

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_raise_and_stop_at_the_failing_bronze_gate(spark):
    base = new_path(spark, "lake")
    sources = export_landing(spark, SF, base)
    # the source volume bounds (90k-120k orders) fail on this small table
    with pytest.raises(QualityGateError, match="bronze"):
        run_pipeline(spark, sources, base, "2026-01-01T06:00:00")
    report = run_pipeline(spark, sources, base, "2026-01-01T06:00:00", on_failure="stop")
    assert {layer for layer, *_ in report.tables} == {"bronze"}
    assert [g[0] for g in report.gates] == ["bronze"] and report.gates[0][2] > 0


def test_second_day_merges_and_marts_match_a_fresh_build(spark):
    base = new_path(spark, "lake")
    sources = export_landing(spark, SF, base)
    relaxed = {"bronze": suites.bronze_suite(order_rows=(1, None)),
               "silver": {}, "gold": suites.gold_suite()}
    day1 = run_pipeline(spark, sources, base, "2026-01-01T06:00:00", suites=relaxed,
                        on_failure="continue")
    day2 = run_pipeline(spark, sources, base, "2026-01-02T06:00:00", suites=relaxed,
                        on_failure="continue")
    silver1 = {t: a for layer, t, _, a in day1.tables if layer == "silver"}
    silver2 = {t: a for layer, t, _, a in day2.tables if layer == "silver"}
    assert set(silver1.values()) == {"created"} and set(silver2.values()) == {"merged"}
    layout = Layout(base)
    # the same extract landed twice: the refined tables hold each key once
    orders = silver_tables(spark, layout)["orders"]
    assert orders.count() == orders.select("order_id").distinct().count()
    # marts rebuilt from the merged tables equal marts built from scratch
    fresh = all_marts(spark, SF)
    published = gold_tables(spark, layout, list(fresh))
    for name, df in fresh.items():
        assert _rows(published[name].select(*df.columns)) == _rows(df), name


def _three(spark, base, orders, ts):
    """The sources of the sales mart, with these orders."""
    frames = _role_frames(spark, SF)
    layout = Layout(base, buckets={"order_items": 4})
    for name, df in (("orders", orders), ("order_items", frames["order_items"]), ("order_payments", frames["order_payments"])):
        write_partitioned(add_lineage(df, f"{name}.csv", ts), layout.bronze(name))
    return layout


def test_a_failed_gate_before_publishing_leaves_every_table(spark):
    base = new_path(spark, "lake")
    sources = export_landing(spark, SF, base)
    none = {"bronze": {}, "silver": {}, "gold": {}}
    run_pipeline(spark, sources, base, "2026-01-01T06:00:00", suites=none)
    layout = Layout(base)
    before = {n: _rows(df) for n, df in gold_tables(spark, layout, list(MART_BUILDERS)).items()}
    silver = {n: versions(spark, layout.silver(n)) for n in SILVER_TABLES}
    never = [row_count_between(10 ** 9, None)]
    # at bronze: the date isn't landed; at silver: no version is committed; at gold: the same
    for layer, table in (("bronze", "orders"), ("silver", "order_items"), ("gold", "gold_seller_performance")):
        with pytest.raises(QualityGateError, match=layer):
            run_pipeline(spark, sources, base, "2026-01-02T06:00:00", suites=none | {layer: {table: never}},
                         gate_before_publish=True)
        dates = [n for n in names(spark, layout.bronze("orders")) if n.startswith("_ingestion_date")]
        assert len(dates) == (1 if layer == "bronze" else 2)
        if layer != "gold":
            assert {n: versions(spark, layout.silver(n)) for n in SILVER_TABLES} == silver
        assert {n: _rows(df) for n, df in gold_tables(spark, layout, list(MART_BUILDERS)).items()} == before
        assert all(len(versions(spark, layout.gold(n))) == 1 for n in MART_BUILDERS)
    # a run that is told to go on publishes and reports
    report = run_pipeline(spark, sources, base, "2026-01-02T06:00:00", suites=none | {"gold": {"gold_seller_performance": never}},
                          gate_before_publish=True, on_failure="continue")
    assert {t[0] for t in report.tables} == {"bronze", "silver", "gold"} and [g[2] for g in report.gates] == [0, 0, 1]
    assert len(versions(spark, layout.gold("gold_seller_performance"))) == 2


def test_sales_of_changed_days_alone(spark):
    orders = _role_frames(spark, SF)["orders"]
    layout = _three(spark, new_path(spark, "lake"), orders, "2026-01-01T06:00:00")
    tables = ["orders", "order_items", "order_payments"]

    def run(date, before):
        bronze = bronze_tables(spark, layout, tables, [date])
        for name in tables:
            prepare_silver_table(spark, layout, name, bronze, [date]).publish()
        return prepare_sales(spark, layout, date, before).publish()

    path = layout.gold("gold_sales_summary")
    run("2026-01-01", None)
    first = commit_of(spark, path).folders
    # one order moves to another day, one is canceled, one is new
    ids = [r.order_id for r in orders.where("order_status = 'delivered'").orderBy("order_id").limit(2).collect()]
    changed = orders.where(F.col("order_id").isin(ids)).withColumns({
        "order_purchase_timestamp": F.when(F.col("order_id") == ids[0], F.lit("1999-05-05 10:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("order_purchase_timestamp")),
        "order_status": F.when(F.col("order_id") == ids[1], "canceled").otherwise("delivered")})
    new = changed.where(F.col("order_id") == ids[0]).withColumn("order_id", F.lit(10 ** 9).cast("long"))
    write_partitioned(add_lineage(changed.unionByName(new), "orders.csv", "2026-01-02T06:00:00"), layout.bronze("orders"))
    for name in tables[1:]:
        write_partitioned(add_lineage(read_bronze(spark, layout.bronze(name)).drop("_ingested_at", "_source_file", "_ingestion_date")
                                      .limit(0), f"{name}.csv", "2026-01-02T06:00:00"), layout.bronze(name))
    run("2026-01-02", commit_of(spark, layout.silver("orders")))
    silver = {n: read_table(spark, layout.silver(n)) for n in tables}
    full = marts.sales_summary(silver["orders"], silver["order_payments"], silver["order_items"])
    got = read_table(spark, path)
    assert _rows(got.select(*full.columns)) == _rows(full)
    assert got.where("order_date = DATE '1999-05-05'").count() == 1
    after = commit_of(spark, path).folders
    assert 0 < len(set(after) - set(first)) <= 3 and len(set(after) & set(first)) > len(after) // 2


def test_a_rerun_reads_one_bronze_date(spark):
    orders = _role_frames(spark, SF)["orders"]
    layout = _three(spark, new_path(spark, "lake"), orders, "2026-01-01T06:00:00")
    write_partitioned(add_lineage(orders, "orders.csv", "2026-01-02T06:00:00"), layout.bronze("orders"))
    bronze = bronze_tables(spark, layout, ["orders"], ["2026-01-01"])
    assert {f.split("_ingestion_date=")[1][:10] for f in refine_table("orders", bronze).inputFiles()} <= {"2026-01-01", "2026-01-02"}
    plan = refine_table("orders", bronze)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan and "2026-01-01" in plan


def test_names_reach_products_of_earlier_days(spark):
    layout = Layout(new_path(spark, "lake"))
    schema = "product_id string, product_category_name string"
    names_schema = "product_category_name string, product_category_name_english string"

    def run(day, products, translated):
        ts = f"2026-01-0{day}T06:00:00"
        for name, rows, s in (("products", products, schema), ("category_translation", translated, names_schema)):
            write_partitioned(add_lineage(spark.createDataFrame(rows, s), "f.csv", ts), layout.bronze(name))
        date = ts[:10]
        bronze = bronze_tables(spark, layout, ["products"], [date]) | bronze_tables(spark, layout, ["category_translation"])
        made = prepare_silver_table(spark, layout, "products", bronze, [date])
        return made.publish(), {r.product_id: r.category for r in read_table(spark, layout.silver("products")).collect()}

    assert run(1, [("p", "brinq"), ("q", "livro"), ("r", None), ("s", "cama")], [("brinq", "toy"), ("cama", "toy")])[1] == {
        "p": "toy", "q": "livro", "r": None, "s": "toy"}
    # two categories of one name part, another gets its first name, a product changes its category the same day
    got = run(2, [("s", "livro")], [("brinq", "toys"), ("livro", "book")])
    assert got[1] == {"p": "toys", "q": "book", "r": None, "s": "book"}
    # nothing called otherwise: nothing is written
    assert run(3, [], [("brinq", "toys")])[0] == ("merged", 0)
    # an older day again: its product rows give way, today's names stay
    assert run(1, [("s", "cama"), ("t", "brinq")], [("brinq", "toy"), ("cama", "toy")])[1] == {
        "p": "toys", "q": "book", "r": None, "s": "book", "t": "toys"}


def test_two_days_with_every_switch_on(spark):
    """Gates before publishing, quarantine, buckets and incremental sales together give
    the marts of a fresh build."""
    base = new_path(spark, "lake")
    suites_ = {"bronze": suites.bronze_suite(order_rows=(1, None)), "silver": {}, "gold": suites.gold_suite()}
    suites_["bronze"].pop("order_items")  # their prices go beyond the source's bounds
    suites_["bronze"].pop("geolocation")
    switches = {"suites": suites_, "on_failure": "continue", "gate_before_publish": True, "quarantine": True,
                "buckets": {"order_items": 4, "order_payments": 4, "customers": 2}, "incremental_sales": True, "summed": True}
    older = _role_frames(spark, SF)["orders"].withColumn("order_status", F.when(F.col("order_id") % 2 == 0, "shipped").otherwise("delivered"))
    day1 = run_pipeline(spark, export_landing(spark, SF, f"{base}/1", {"orders": older}), base, "2026-01-01T06:00:00", **switches)
    day2 = run_pipeline(spark, export_landing(spark, SF, f"{base}/2"), base, "2026-01-02T06:00:00", **switches)
    layout = Layout(base)
    actions = {(layer, t): a for layer, t, _, a in day2.tables}
    assert actions[("gold", "gold_sales_summary")] == "merged" and actions[("silver", "order_items")] == "merged"
    assert set(day1.malformed.values()) == {0} and all(day1.checksums.values())
    fresh = all_marts(spark, SF)
    published = gold_tables(spark, layout, list(fresh))
    for name, df in fresh.items():
        assert _rows(published[name].select(*df.columns)) == _rows(df), name


def test_landed_sources_are_taken_as_they_are(spark, tmp_path):
    """A later day writes the files that differ alone; the sources of the others stay those of the first day."""
    first = export_landing(spark, SF, f"{tmp_path}/1")
    kept = {name: source for name, source in first.items() if name != "orders"}
    second = export_landing(spark, SF, f"{tmp_path}/2", landed=kept)
    assert [p.name for p in (tmp_path / "2" / "landing").iterdir()] == ["orders"]
    assert set(second) == set(first) and {n: second[n] for n in kept} == kept
    assert second["orders"].path == f"{tmp_path}/2/landing/orders"


def test_marts_share_what_they_read_by_order(spark, monkeypatch):
    """Each big table is read once for all marts, and they are those of the tables alone."""
    from pyspark.sql import DataFrameWriter
    from stratum.plans.pipeline import prepare_gold
    from stratum.sources.sinks import overwrite

    t0 = dt.datetime(2018, 1, 1)
    late = [(f"o{i}", f"c{i % 3}", "delivered" if i % 4 else "shipped", t0 + dt.timedelta(days=i % 5), 2018, 1, i % 6, [True, False, None][i % 3])
            for i in range(12)]
    frames = {
        "orders": spark.createDataFrame(late, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
                                              "order_year int, order_month int, delivery_days int, is_late boolean"),
        # an order with a product twice, lines without a product or a seller, an order without lines
        "order_items": spark.createDataFrame([(f"o{i}", n, [f"p{n % 2}", None][i == 5], [f"s{i % 2}", None][i == 7], 10.0 + i + n / 3, 1.5 * n)
                                              for i in range(11) for n in range(1, 4)],
                                             "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"),
        "order_payments": spark.createDataFrame([(f"o{i}", n, 0.1 * i + n) for i in range(10) for n in range(2)],
                                                "order_id string, payment_sequential int, payment_value double"),
        "order_reviews": spark.createDataFrame([(f"r{i}", f"o{i // 2}", i % 5 + 1) for i in range(9)], "review_id string, order_id string, review_score int"),
        "customers": spark.createDataFrame([("c0", "SP", "x"), ("c1", None, "y")], "customer_id string, customer_state string, customer_city string"),
        "products": spark.createDataFrame([("p0", "toys"), ("p9", "toys")], "product_id string, category string"),
        "sellers": spark.createDataFrame([("s0", "SP")], "seller_id string, seller_state string"),
        "geolocation": spark.createDataFrame([(1,)], "geolocation_zip_code_prefix int")}
    layout = Layout(new_path(spark, "lake"))
    for name, frame in frames.items():
        overwrite(frame, layout.silver(name))
    read = []
    for method in ("save", "parquet"):
        def watched(self, *args, write=getattr(DataFrameWriter, method), **options):
            read.append(self._df.inputFiles())
            return write(self, *args, **options)
        monkeypatch.setattr(DataFrameWriter, method, watched)
    made = prepare_gold(spark, layout)
    for name in ("order_items", "order_payments", "order_reviews"):
        assert sum(any(f"/silver/{name}/" in f for f in files) for files in read) == 1, name
    for name, build in MART_BUILDERS.items():
        assert _rows(made[name].frame()) == _rows(build(frames)), name


def test_run_settings_leave_the_clusters_own(spark):
    """Shuffle files go with their statement; a value that isn't Spark's default stays."""
    from stratum.session import large_run_settings

    cleanup, split = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.files.maxPartitionBytes"
    assert (spark.conf.get(cleanup), spark.conf.get(split)) == ("true", "32m")
    try:
        spark.conf.set(split, "16m")
        large_run_settings(spark, False)
        assert (spark.conf.get(cleanup), spark.conf.get(split)) == ("false", "16m")
    finally:
        spark.conf.unset(split)
        large_run_settings(spark)
    assert (spark.conf.get(cleanup), spark.conf.get(split)) == ("true", "32m")
    counts = spark.range(1000).groupBy(F.col("id") % 10).count()
    assert len(counts.collect()) == len(counts.collect()) == 10
