"""Registry of queries: key -> Spark callable ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the role views) or data
Spark derived from them, so its work grows with the tables. The matching
DuckDB statements live in :mod:`stratum.plans.oracle_queries`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import (
    as_double_value,
    as_int,
    as_timestamp,
    coalesce_first,
    day_diff,
    money,
    pct,
    ratio,
    round2,
    to_day,
    total,
    total_mean,
)
from stratum.operators import marts
from stratum.operators.dedup import dedup_latest
from stratum.operators.lineage import add_lineage
from stratum.operators.quality import evaluate_suites, gate, row_count_between
from stratum.operators.refine import (
    LANDED,
    MERGE_KEYS,
    PARTITION_COLUMNS,
    SPECS,
    derive_order_items,
    drop_lineage,
    refine_orders,
    refine_products,
    type_columns,
)
from stratum.plans import suites
from stratum.plans.concurrent import run_all
from stratum.plans.layers import MART_BUILDERS, bronze_views, build_marts, silver_views
from stratum.plans.pipeline import (
    REPORT_SCHEMA,
    Layout,
    Source,
    bronze_tables,
    contents,
    gold_tables,
    ingest_bronze,
    prepare_sales,
    prepare_silver_table,
    read_quarantine,
    run_gold,
    run_pipeline,
    run_silver,
    silver_tables,
    stage_bronze,
)
from stratum.plans.roles import (
    ROLE_BUILDERS,
    SOURCE_FILES,
    category_translation_role,
    read_tables,
)
from stratum.session import new_path
from stratum.sources.files import CSV_OPTIONS, read_bronze, read_csv, read_table, remove_on_exit, string_schema, write_csv
from stratum.sources.sinks import DuplicateKeyError, overwrite, upsert, write_partitioned
from stratum.sources.versions import commit_of

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def _silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return silver_views(spark, sf_dir)


def _silver_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _silver(spark, sf_dir)[table]
    run.__name__ = f"silver_{table}"
    return run


for _t in ("orders", "order_items", "order_payments", "customers", "products",
           "sellers", "order_reviews", "geolocation"):
    REGISTRY[f"silver_{_t}"] = _silver_query(_t)


@query("dedup_latest")
def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic dedup on the raw line table: one row per (order, line number),
    the greatest by all remaining columns."""
    lines = read_tables(spark, sf_dir)["lineitem"]
    return dedup_latest(lines, ["l_orderkey", "l_linenumber"])


@query("sales_summary")
def sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return marts.sales_summary(s["orders"], s["order_payments"], s["order_items"])


@query("product_performance")
def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return marts.product_performance(s["order_items"], s["products"], s["orders"],
                                     s["order_reviews"])


@query("rfm_segments")
def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return marts.customer_segments(s["orders"], s["order_payments"], s["customers"])


@query("seller_performance")
def seller_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return marts.seller_performance(s["order_items"], s["orders"], s["sellers"],
                                    s["order_reviews"])


#: refined tables that more than one mart reads
SHARED = ("orders", "order_items", "order_payments", "order_reviews")


def _silver_once(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The refined tables, those that several marts read written once for all of them."""
    silver = _silver(spark, sf_dir)

    def write(name: str):
        def job() -> DataFrame:
            path = new_path(spark, f"silver-{name}")
            silver[name].write.parquet(path)
            remove_on_exit(spark, path)
            return spark.read.schema(silver[name].schema).parquet(path)
        return job
    return silver | run_all(spark, {name: write(name) for name in SHARED})


def all_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build_marts(_silver_once(spark, sf_dir))


# --- projections and filters ---------------------------------------

def _bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return bronze_views(spark, sf_dir)


@query("bronze_lineage")
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir)["orders"]


@query("project_derived")
def project_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _bronze(spark, sf_dir)["order_items"]
    return drop_lineage(derive_order_items(type_columns(items, SPECS["order_items"])))


@query("drop_metadata")
def drop_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both join sides carry lineage columns; one drop removes all of them."""
    b = _bronze(spark, sf_dir)
    joined = b["products"].join(b["category_translation"], "product_category_name", "left")
    return drop_lineage(joined)


@query("project_select")
def project_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)["orders"].select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp")


@query("filter_status")
def filter_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.delivered_orders(_silver(spark, sf_dir)["orders"])


@query("filter_positive")
def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)["order_items"].where(F.col("freight_value") > 0)


@query("filter_not_null")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)["orders"].dropna(subset=["order_delivered_customer_date"])


# --- joins -----------------------------------------------------------

@query("join_left_preagg")
def join_left_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    per_order = s["order_payments"].groupBy("order_id").agg(
        total("payment_value").alias("total_payment"),
        F.count_distinct("payment_type").alias("payment_methods_used"))
    return (
        marts.delivered_orders(s["orders"])
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(per_order, "order_id", "left")
    )


@query("join_left_dim")
def join_left_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return s["order_items"].join(s["products"].select("product_id", "category"),
                                 "product_id", "left")


@query("join_semi_delivered")
def join_semi_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    delivered = marts.delivered_orders(s["orders"]).select("order_id")
    return s["order_items"].join(delivered, "order_id", "left_semi")


@query("join_inner_filtered")
def join_inner_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    return s["order_items"].join(marts.delivered_orders(s["orders"]), "order_id", "inner")


# --- aggregations ------------------------------------------------------

@query("agg_by_key")
def agg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pays = _silver(spark, sf_dir)["order_payments"]
    return pays.groupBy("order_id").agg(
        total("payment_value").alias("total_payment"),
        F.count("payment_type").alias("payment_count"),
    )


@query("agg_expr_key")
def agg_expr_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _silver(spark, sf_dir)["orders"]
    return orders.groupBy(
        "order_year", "order_month", to_day("order_purchase_timestamp").alias("order_date"),
    ).agg(F.count("order_id").alias("total_orders"))


@query("agg_distinct")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _silver(spark, sf_dir)["order_items"]
    return items.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("unique_orders"),
        F.count_distinct("seller_id").alias("unique_sellers"),
    )


@query("agg_avg")
def agg_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _silver(spark, sf_dir)["order_items"]
    return items.groupBy("seller_id").agg(
        total_mean("price").alias("avg_item_price"),
        total_mean("freight_value").alias("avg_freight"),
    )


@query("agg_two_stage")
def agg_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews averaged per order first, then over the seller's items."""
    s = _silver(spark, sf_dir)
    return (
        s["order_items"]
        .join(marts.reviews_per_order(s["order_reviews"], "avg_score"), "order_id", "left")
        .groupBy("seller_id")
        .agg(total_mean("avg_score").alias("avg_review_score"))
    )


@query("agg_conditional")
def agg_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = marts.delivered_orders(_silver(spark, sf_dir)["orders"])
    return orders.groupBy(to_day("order_purchase_timestamp").alias("order_date")).agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("is_late")).alias("late_deliveries"),
    )


@query("agg_max")
def agg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _silver(spark, sf_dir)["orders"]
    latest = orders.select(F.max("order_purchase_timestamp")).scalar()
    return orders.groupBy("customer_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase"),
        latest.alias("as_of"),
    )


@query("scalar_asof")
def scalar_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _silver(spark, sf_dir)["orders"]
    as_of = orders.select(F.max("order_purchase_timestamp")).scalar()
    return marts.delivered_orders(orders).groupBy("customer_id").agg(
        F.datediff(as_of, F.max("order_purchase_timestamp")).alias("recency_days"))


# --- window and sorts -----------------------------------------------------

@query("window_rank")
def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _silver(spark, sf_dir)
    per_product = (
        s["order_items"].join(s["products"].select("product_id", "category"),
                              "product_id", "left")
        .groupBy("product_id", "category").agg(total("price").alias("revenue"))
    )
    ranked = marts.rank_desc_within(per_product, "category", "revenue", "revenue_rank")
    return ranked.select("product_id", "category",
                         F.col("revenue").alias("total_revenue"), "revenue_rank")


@query("sort_asc")
def sort_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sort_for_report(sales_summary(spark, sf_dir), "order_date")


@query("sort_desc")
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sort_for_report(product_performance(spark, sf_dir), "total_revenue",
                                 descending=True)


# --- scalar functions -----------------------------------------------------

@query("fn_to_timestamp")
def fn_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_tables(spark, sf_dir)["orders"]
    text = F.col("o_orderdate").cast("string")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        text.alias("purchase_text"),
        as_timestamp(text).alias("purchase_ts"),
        as_timestamp(F.col("o_orderpriority")).alias("priority_ts"),
    )


@query("fn_date_parts")
def fn_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)["orders"].select(
        "order_id", to_day("order_purchase_timestamp").alias("order_date"),
        "order_year", "order_month", "order_dow")


@query("fn_datediff")
def fn_datediff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)["orders"].select(
        "order_id", "delivery_days",
        day_diff("order_delivered_carrier_date", "order_purchase_timestamp")
        .alias("carrier_days"))


@query("fn_try_cast")
def fn_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to int / double / money; text that is not a number becomes null."""
    li = read_tables(spark, sf_dir)["lineitem"]
    price_text = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return li.select(
        "l_orderkey", "l_linenumber",
        as_int(F.col("l_linenumber").cast("string")).alias("line_int"),
        as_double_value(price_text).alias("price_double"),
        money(price_text).alias("price_money"),
        as_int(F.concat(F.col("l_linenumber").cast("string"), F.lit(".0"))).alias("line_decimal_text"),
        as_int(F.col("l_returnflag")).alias("flag_int"),
    )


@query("fn_ratio")
def fn_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _silver(spark, sf_dir)["order_items"]
    return items.select(
        "order_id", "order_item_id",
        pct("freight_value", "price").alias("freight_pct"),
        ratio("price", "freight_value").alias("price_per_freight"),
    )


@query("fn_round")
def fn_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _silver(spark, sf_dir)["order_items"]
    return items.select(
        "order_id", "order_item_id",
        round2(pct("freight_value", "price")).alias("freight_pct"),
        round2(ratio("price", "order_item_id")).alias("price_per_line"),
    )


@query("fn_coalesce")
def fn_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    joined = b["products"].join(
        b["category_translation"].select("product_category_name",
                                         "product_category_name_english"),
        "product_category_name", "left")
    return joined.select(
        "product_id",
        coalesce_first("product_category_name_english", "product_category_name")
        .alias("category"))


@query("fn_is_late")
def fn_is_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)["orders"].select(
        "order_id", "order_delivered_customer_date", "order_estimated_delivery_date",
        "is_late")


# --- data quality -------------------------------------------------------

def _only(suite: dict, *kinds: str) -> dict:
    return {t: [e for e in exps if e.kind in kinds] for t, exps in suite.items()
            if any(e.kind in kinds for e in exps)}


def _dq(layer: str, *kinds: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if layer == "bronze":
            tables, suite = _bronze(spark, sf_dir), suites.bronze_suite()
        elif layer == "silver":
            tables, suite = _silver(spark, sf_dir), suites.silver_suite()
        else:
            tables, suite = all_marts(spark, sf_dir), suites.gold_suite()
        return evaluate_suites(tables, _only(suite, *kinds) if kinds else suite)
    return run


DQ_QUERIES = {
    "dq_not_null": ("bronze", ("not_null",)),
    "dq_unique": ("bronze", ("unique",)),
    "dq_row_count": ("bronze", ("row_count",)),
    "dq_in_set": ("bronze", ("in_set",)),
    "dq_between": ("bronze", ("between",)),
    "dq_column_exists": ("silver", ("exists",)),
    "dq_no_lineage": ("silver", ("absent",)),
    "dq_suite_bronze": ("bronze", ()),
    "dq_suite_silver": ("silver", ()),
    "dq_suite_gold": ("gold", ()),
}
for _name, (_layer, _kinds) in DQ_QUERIES.items():
    REGISTRY[_name] = _dq(_layer, *_kinds)


@query("dq_gate")
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate over the marts: raises QualityGateError on any failure, else
    returns the (small) result rows."""
    results = _dq("gold")(spark, sf_dir)
    gate(results, "gold")
    return results


# --- scans, sinks and layered runs -----------

DAY1_TS, DAY2_TS = "2026-01-01T06:00:00", "2026-01-02T06:00:00"
DAY1, DAY2 = DAY1_TS[:10], DAY2_TS[:10]


def _role_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = read_tables(spark, sf_dir)
    frames = {name: build(t) for name, build in ROLE_BUILDERS.items()}
    frames["category_translation"] = category_translation_role(spark)
    return frames


def export_landing(spark: SparkSession, sf_dir: str, base: str, changed: dict[str, DataFrame] | None = None,
                   landed: dict[str, Source] | None = None) -> dict[str, Source]:
    """Write the role tables (or those ``changed`` in their place) as CSV landing
    files, a Spark job per table, and return the source registry pointing at them.
    ``landed``: sources that were written already and are taken as they are."""
    frames = {name: df for name, df in (_role_frames(spark, sf_dir) | (changed or {})).items() if name not in (landed or {})}

    def export(name: str, df: DataFrame):
        return lambda: write_csv(df, f"{base}/landing/{name}")

    run_all(spark, {name: export(name, df) for name, df in frames.items()})
    return {name: Source(f"{base}/landing/{name}", df.schema, SOURCE_FILES[name])
            for name, df in frames.items()} | (landed or {})


@query("csv_scan")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw landing scan: header, explicit all-text schema, no inference; the file
    has its columns in another order than the schema."""
    items = _role_frames(spark, sf_dir)["order_items"]
    path = new_path(spark, "landing-items")
    write_csv(items.select(*reversed(items.columns)), path)
    return read_csv(spark, path, string_schema(items.columns))


@query("csv_scan_mixed_headers")
def csv_scan_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder whose files have their columns in different orders, some of
    them with a column more: each is read by its own header."""
    items = _role_frames(spark, sf_dir)["order_items"]
    path, third = new_path(spark, "landing-items"), F.col("order_id") % 3
    parts = (items.where(third == 0), items.where(third == 1).select(*reversed(items.columns)),
             items.where(third == 2).withColumn("note", F.lit('a "quoted", note')).select("note", *sorted(items.columns)))
    for part in parts:
        part.write.mode("append").options(**CSV_OPTIONS).csv(path)
    return read_csv(spark, path, string_schema(items.columns))


LINE_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id"]


@query("bronze_quarantine")
def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item lines of which some have a field too many or too few: the others land in
    bronze, these as raw text in the quarantine table, by one pass; both as lines, and
    the counts that the landing reports."""
    items = _role_frames(spark, sf_dir)["order_items"]
    nth = F.col("order_item_id")
    line = (F.when(nth % 5 == 0, F.concat_ws(",", *LINE_COLUMNS, F.lit("more")))
            .when(nth % 7 == 0, F.concat_ws(",", *LINE_COLUMNS[:3])).otherwise(F.concat_ws(",", *LINE_COLUMNS)))
    base = new_path(spark, "lake")
    # no text holds this separator, so lines and header are written as they are
    (items.select(line.alias(",".join(LINE_COLUMNS))).write.options(header="true", sep="\x01", quote="")
     .csv(f"{base}/landing"))
    layout, source = Layout(base), Source(f"{base}/landing", string_schema(LINE_COLUMNS), "order_items.csv")
    _, _, good, _, bad = ingest_bronze(spark, {"order_items": source}, layout, DAY1_TS, quarantine=True)[0]
    landed = read_bronze(spark, layout.bronze("order_items"), [DAY1]).select(
        F.lit("bronze").alias("kind"), F.concat_ws(",", *LINE_COLUMNS).alias("line"))
    kept = read_quarantine(spark, layout, "order_items", [DAY1]).select(F.lit("quarantine"), "line")
    counts = spark.createDataFrame([("bronze rows", str(good)), ("quarantine rows", str(bad))], "kind string, line string")
    return landed.union(kept).union(counts)


@query("bronze_ingest_report")
def bronze_ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all nine sources (CSV -> lineage -> date partition) with row
    counts, malformed lines and a checksum observed during the writes, and a grand
    total."""
    base = new_path(spark, "ingest")
    landed = stage_bronze(spark, export_landing(spark, sf_dir, base), Layout(base), DAY1_TS, summed=True)
    report = [(name, x.publish()[1], x.malformed, x.checksum) for name, x in landed.items()]
    report.append(("TOTAL", sum(r[1] for r in report), sum(r[2] for r in report), None))
    return spark.createDataFrame(report, "table_name string, row_count bigint, malformed_rows bigint, checksum string")


def _held(found: DataFrame) -> dict[str, tuple[int, str]]:
    """Row count and checksum by table (one row each)."""
    return {r["table_name"]: (r["row_count"], r["checksum"]) for r in found.collect()}


def _with_checksums(spark: SparkSession, report: list[tuple], tables: dict[str, DataFrame]) -> DataFrame:
    """Report rows of written tables, each with the checksum of what it now holds."""
    held = _held(contents(tables))
    return spark.createDataFrame([(*row, held[row[1]][1]) for row in report], f"{REPORT_SCHEMA}, checksum string")


@query("dq_bronze_text")
def dq_bronze_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze item checks over an all-text landing in which the prices of every
    third line are no numbers."""
    items = _role_frames(spark, sf_dir)["order_items"]
    bad = F.when(F.col("order_item_id") % 3 == 0, "n/a").otherwise(F.col("price").cast("string"))
    path = new_path(spark, "landing-items")
    write_csv(items.withColumn("price", bad), path)
    landed = read_csv(spark, path, string_schema(items.columns))
    return evaluate_suites({"order_items": landed}, {"order_items": suites.bronze_suite()["order_items"]})


def _land_two_days(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    orders = _role_frames(spark, sf_dir)["orders"]
    write_partitioned(add_lineage(orders, "orders.csv", DAY1_TS), path)
    write_partitioned(add_lineage(orders, "orders.csv", DAY2_TS), path)
    return orders


@query("bronze_partition_overwrite")
def bronze_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land two dates, then land day 1 again with only delivered orders:
    dynamic overwrite replaces that one partition and keeps day 2."""
    path = new_path(spark, "bronze-orders")
    orders = _land_two_days(spark, sf_dir, path)
    rerun = orders.where(F.col("order_status") == "delivered")
    write_partitioned(add_lineage(rerun, "orders.csv", DAY1_TS), path)
    return read_bronze(spark, path)


@query("parquet_scan_pruned")
def parquet_scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read one landed date of a two-date bronze table (partition pruning)."""
    path = new_path(spark, "bronze-orders")
    _land_two_days(spark, sf_dir, path)
    return read_bronze(spark, path, [DAY2])


@query("parquet_scan_evolved")
def parquet_scan_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed dates with different columns: the first lacks one, and has another as
    a smaller type; both are read under the united schema."""
    items = _role_frames(spark, sf_dir)["order_items"].withColumn("freight_value", F.col("freight_value").cast("double"))
    path = new_path(spark, "bronze-items")
    older = items.drop("freight_value").withColumn("order_item_id", F.col("order_item_id").cast("int"))
    newer = items.withColumns({"order_item_id": F.col("order_item_id").cast("bigint"), "gift": F.col("order_id") % 2 == 0})
    write_partitioned(add_lineage(older, "order_items.csv", DAY1_TS), path)
    write_partitioned(add_lineage(newer, "order_items.csv", DAY2_TS), path)
    return read_bronze(spark, path)


@query("table_scan")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "silver-orders")
    overwrite(_silver(spark, sf_dir)["orders"], path, "parquet")
    return read_table(spark, path, "parquet")


@query("gold_overwrite")
def gold_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a mart, overwrite it with a newer build, read it back."""
    s = _silver(spark, sf_dir)
    path = new_path(spark, "gold-sales")
    overwrite(marts.sales_summary(s["orders"], s["order_payments"], s["order_items"],
                                  status="shipped"), path)
    overwrite(marts.sales_summary(s["orders"], s["order_payments"], s["order_items"]), path)
    return read_table(spark, path)


@query("upsert_first_load")
def upsert_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "silver-orders")
    upsert(spark, _silver(spark, sf_dir)["orders"], path, MERGE_KEYS["orders"])
    return read_table(spark, path)


def upsert_days(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two daily extracts of the orders source: day 1 holds orders placed
    before 1998 as still processing and undelivered; day 2 holds orders
    placed from 1997 on in their current state (overlap = updates)."""
    purchase = F.col("order_purchase_timestamp")
    day1 = (orders.where(purchase < F.lit("1998-01-01").cast("timestamp_ntz"))
            .withColumns({"order_status": F.lit("processing"),
                          "order_delivered_customer_date":
                          F.lit(None).cast("timestamp_ntz")}))
    day2 = orders.where(purchase >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return (add_lineage(day1, "orders.csv", DAY1_TS), add_lineage(day2, "orders.csv", DAY2_TS))


@query("upsert_merge")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update matched keys, insert new keys, keep keys absent from the source."""
    day1, day2 = upsert_days(_role_frames(spark, sf_dir)["orders"])
    path = new_path(spark, "silver-orders")
    upsert(spark, refine_orders(day1), path, MERGE_KEYS["orders"])
    upsert(spark, refine_orders(day2), path, MERGE_KEYS["orders"])
    return read_table(spark, path)


@query("upsert_merge_partitioned")
def upsert_merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two merges into a table laid out by purchase year and month:
    day 2 reads and rewrites only the months it touches (1997 on); earlier
    months are left as day 1 wrote them. Same result as ``upsert_merge``."""
    day1, day2 = upsert_days(_role_frames(spark, sf_dir)["orders"])
    path = new_path(spark, "silver-orders")
    upsert(spark, refine_orders(day1), path, MERGE_KEYS["orders"],
           partition_by=PARTITION_COLUMNS["orders"])
    upsert(spark, refine_orders(day2), path, MERGE_KEYS["orders"],
           partition_by=PARTITION_COLUMNS["orders"])
    return read_table(spark, path)


@query("upsert_after_failed_write")
def upsert_after_failed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rewrite that fails in its tasks between the two merges changes nothing:
    same result as ``upsert_merge``."""
    day1, day2 = upsert_days(_role_frames(spark, sf_dir)["orders"])
    path = new_path(spark, "silver-orders")
    upsert(spark, refine_orders(day1), path, MERGE_KEYS["orders"])
    broken = read_table(spark, path).withColumn("order_status", F.raise_error(F.lit("lost")).cast("string"))
    try:
        overwrite(broken, path)
    except Exception as e:  # noqa: BLE001 the failure is the point
        if "lost" not in str(e):
            raise
    upsert(spark, refine_orders(day2), path, MERGE_KEYS["orders"])
    return read_table(spark, path)


@query("upsert_moved_partition")
def upsert_moved_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that land without a purchase time and get it the next day move to
    another partition folder; each stays one row."""
    orders = _role_frames(spark, sf_dir)["orders"]
    late = F.col("customer_id") % 7 == 0
    purchase = F.col("order_purchase_timestamp")
    day1 = orders.withColumn("order_purchase_timestamp", F.when(~late, purchase))
    path = new_path(spark, "silver-orders")
    for frame, ts in ((day1, DAY1_TS), (orders.where(late), DAY2_TS)):
        upsert(spark, refine_orders(add_lineage(frame, "orders.csv", ts)), path, MERGE_KEYS["orders"],
               partition_by=PARTITION_COLUMNS["orders"])
    return read_table(spark, path)


@query("upsert_merge_bucketed")
def upsert_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two merges into a table laid out in hash buckets of its key, and then
    a third that touches few of them. Same result as ``upsert_merge``."""
    day1, day2 = upsert_days(_role_frames(spark, sf_dir)["orders"])
    path = new_path(spark, "silver-orders")
    upsert(spark, refine_orders(day1), path, MERGE_KEYS["orders"], buckets=16)
    few = F.col("order_id") < 5
    for part in (day2.where(~few), day2.where(few)):
        upsert(spark, refine_orders(part), path, MERGE_KEYS["orders"])
    return read_table(spark, path)


@query("upsert_retry_first_load")
def upsert_retry_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load that fails in its tasks is simply run again: it creates the table.
    The rows, and which action each run took."""
    orders = _silver(spark, sf_dir)["orders"]
    path = new_path(spark, "silver-orders")
    broken = orders.withColumn("order_status", F.raise_error(F.lit("lost")).cast("string"))
    try:
        upsert(spark, broken, path, MERGE_KEYS["orders"], partition_by=PARTITION_COLUMNS["orders"])
    except Exception as e:  # noqa: BLE001 the failure is the point
        if "lost" not in str(e):
            raise
    action, _ = upsert(spark, orders, path, MERGE_KEYS["orders"], partition_by=PARTITION_COLUMNS["orders"])
    return read_table(spark, path).withColumn("action", F.lit(action))


@query("upsert_duplicate_keys")
def upsert_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with several rows for a key raises and leaves the table as it was;
    with one row each it merges."""
    day1, day2 = upsert_days(_role_frames(spark, sf_dir)["orders"])
    path = new_path(spark, "silver-orders")
    upsert(spark, refine_orders(day1), path, MERGE_KEYS["orders"], buckets=8)
    clean = refine_orders(day2)
    raised = False
    try:
        upsert(spark, clean.unionByName(clean.where(F.col("customer_id") % 3 == 0)), path, MERGE_KEYS["orders"])
    except DuplicateKeyError:
        raised = True
    before = read_table(spark, path).select(F.lit("before").alias("state"), F.lit(raised).alias("raised"), "*")
    upsert(spark, clean, path, MERGE_KEYS["orders"])
    return before.union(read_table(spark, path).select(F.lit("after"), F.lit(raised), "*"))


@query("upsert_backfill")
def upsert_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed dates, the later refined first, then the earlier again: newer
    rows stay. Each run reads its own date alone; the merge compares landing dates."""
    orders = _role_frames(spark, sf_dir)["orders"]
    bronze, path = new_path(spark, "bronze-orders"), new_path(spark, "silver-orders")
    older = orders.withColumn("order_status", F.lit("processing"))
    write_partitioned(add_lineage(older, "orders.csv", DAY1_TS), bronze)
    write_partitioned(add_lineage(orders.where(F.col("customer_id") % 4 != 0), "orders.csv", DAY2_TS), bronze)
    for day in (DAY2, DAY1):
        upsert(spark, refine_orders(read_bronze(spark, bronze, [day]), hidden=True), path, MERGE_KEYS["orders"],
               newest_by=LANDED)
    return read_table(spark, path)


@query("silver_names_changed")
def silver_names_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products land on the first day, under old names of their categories; on the
    second day only names land, and a few products. All products get the new names."""
    frames = _role_frames(spark, sf_dir)
    names, products = frames["category_translation"], frames["products"]
    older = names.withColumn("product_category_name_english", F.concat(F.lit("zz_"), "product_category_name_english"))
    layout = Layout(new_path(spark, "lake"), buckets={"products": 4})
    few = products.where(F.col("product_id") % 10 == 0)
    for day, landed in ((DAY1_TS, {"products": products, "category_translation": older}),
                        (DAY2_TS, {"products": few, "category_translation": names})):
        for name, frame in landed.items():
            write_partitioned(add_lineage(frame, SOURCE_FILES[name], day), layout.bronze(name))
        bronze = bronze_tables(spark, layout, ["products"], [day[:10]]) | bronze_tables(spark, layout, ["category_translation"])
        prepare_silver_table(spark, layout, "products", bronze, [day[:10]]).publish()
    return read_table(spark, layout.silver("products"))


@query("silver_products_all_dates")
def silver_products_all_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products and category names landed on two dates, names changed in between:
    one row per product, with the newer name."""
    frames = _role_frames(spark, sf_dir)
    names = frames["category_translation"]
    older = names.withColumn("product_category_name_english", F.concat(F.lit("zz_"), "product_category_name_english"))
    base = Layout(new_path(spark, "lake"))
    for frame, ts in ((older, DAY1_TS), (names, DAY2_TS)):
        write_partitioned(add_lineage(frames["products"], "products.csv", ts), base.bronze("products"))
        write_partitioned(add_lineage(frame, "names.csv", ts), base.bronze("category_translation"))
    return refine_products(read_bronze(spark, base.bronze("products")),
                           read_bronze(spark, base.bronze("category_translation")))


@query("rfm_by_person")
def rfm_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with all customer ids of a person together; in the role view a
    person is a customer's place of residence and business."""
    s = _silver(spark, sf_dir)
    person = s["customers"].withColumn("customer_unique_id", F.concat_ws("/", "customer_state", "customer_city"))
    return marts.customer_segments(s["orders"], s["order_payments"], person, customer_key="customer_unique_id")


@query("silver_row_counts")
def silver_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in _silver(spark, sf_dir).items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _landed_bronze(spark: SparkSession, sf_dir: str, base: str):
    layout = Layout(base)

    def land(name: str, df: DataFrame):
        return lambda: write_partitioned(add_lineage(df, SOURCE_FILES[name], DAY1_TS),
                                         layout.bronze(name))

    run_all(spark, {name: land(name, df) for name, df in _role_frames(spark, sf_dir).items()})
    return layout


@query("silver_pipeline")
def silver_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze landed -> eight refined tables upserted; report per table."""
    layout = _landed_bronze(spark, sf_dir, new_path(spark, "lake"))
    report = run_silver(spark, layout, DAY1)
    return _with_checksums(spark, report, silver_tables(spark, layout))


@query("gold_pipeline")
def gold_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined tables written -> four marts overwritten; report per mart."""
    layout = Layout(new_path(spark, "lake"))

    def publish(name: str, df: DataFrame):
        return lambda: overwrite(df, layout.silver(name))

    run_all(spark, {name: publish(name, df) for name, df in _silver(spark, sf_dir).items()})
    report = run_gold(spark, layout)
    return _with_checksums(spark, report, gold_tables(spark, layout, [r[1] for r in report]))


@query("pipeline_end_to_end")
def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV landing -> bronze -> gate -> silver -> gate -> gold -> gate, with
    the source pipeline's suites. Gates run in ``continue`` mode so the
    report lists every layer; the gate outcome of each layer is joined onto
    its table rows. Checksums are of what each write wrote."""
    base = new_path(spark, "lake")
    report = run_pipeline(spark, export_landing(spark, sf_dir, base), base, DAY1_TS,
                          on_failure="continue", summed=True)
    gates = {layer: (checks, failed) for layer, checks, failed in report.gates}
    rows = [(layer, name, n, action, *gates.get(layer, (0, 0)), report.checksums[f"{layer}.{name}"])
            for layer, name, n, action in report.tables]
    return spark.createDataFrame(
        rows, "layer string, table_name string, row_count bigint, action string, "
              "layer_checks bigint, layer_failed_checks bigint, checksum string")


def _stored(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """All tables of a finished run, by layer and name."""
    layers = {"bronze": bronze_tables(spark, layout, list(SOURCE_FILES)), "silver": silver_tables(spark, layout),
              "gold": gold_tables(spark, layout, list(MART_BUILDERS))}
    return {f"{layer}.{name}": df for layer, tables in layers.items() for name, df in tables.items()}


@query("pipeline_two_days")
def pipeline_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs without gates: the first day has the orders before 1998, as
    processing and undelivered, the second all orders as they are now. What every
    table then holds: bronze both days, the layers above the state of the second."""
    base = new_path(spark, "lake")
    older = upsert_days(_role_frames(spark, sf_dir)["orders"])[0]
    no_gates = {"bronze": {}, "silver": {}, "gold": {}}
    landed: dict[str, Source] = {}  # the second day's files differ in the orders alone
    for ts, changed in ((DAY1_TS, {"orders": drop_lineage(older)}), (DAY2_TS, {})):
        sources = export_landing(spark, sf_dir, f"{base}/{ts[:10]}", changed, landed)
        landed = {name: source for name, source in sources.items() if name != "orders"}
        run_pipeline(spark, sources, base, ts, suites=no_gates, buckets={"order_items": 8, "order_payments": 8})
    return contents(_stored(spark, Layout(base)))


@query("pipeline_gate_blocks_publish")
def pipeline_gate_blocks_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run, then one whose orders are all canceled: its gold gate, before
    publishing, finds no sales, and readers keep every mart of the first run."""
    base = new_path(spark, "lake")
    no_gates = {"bronze": {}, "silver": {}, "gold": {}}
    run_pipeline(spark, export_landing(spark, sf_dir, f"{base}/1"), base, DAY1_TS, suites=no_gates)
    canceled = _role_frames(spark, sf_dir)["orders"].withColumn("order_status", F.lit("canceled"))
    write_csv(canceled, f"{base}/2/orders")
    report = run_pipeline(
        spark, {"orders": Source(f"{base}/2/orders", canceled.schema, SOURCE_FILES["orders"])}, base, DAY2_TS,
        suites=no_gates | {"gold": {"gold_sales_summary": [row_count_between(1, None)]}},
        on_failure="stop", gate_before_publish=True)
    published = {layer for layer, *_ in report.tables}
    held = contents(gold_tables(spark, Layout(base), list(MART_BUILDERS)))
    return held.withColumns({"failed": F.lit(",".join(f"{layer}:{table}" for layer, table, *_ in report.failures)),
                             "gold_published": F.lit("gold" in published), "silver_published": F.lit("silver" in published)})


@query("sales_summary_incremental")
def sales_summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales built in full on the first day, when the latest orders were not yet
    delivered and some stood under another day; the second day lands these orders alone
    and only the days they touch are computed again. Same result as ``sales_summary``."""
    layout = Layout(new_path(spark, "lake"), buckets={"order_items": 8, "order_payments": 8})
    frames = {n: f for n, f in _role_frames(spark, sf_dir).items() if n in ("orders", "order_items", "order_payments")}
    purchase = F.col("order_purchase_timestamp")
    late = purchase >= F.lit("2001-06-01").cast("timestamp_ntz")
    moved = F.when(F.col("customer_id") % 3 == 0, purchase - F.expr("INTERVAL 700 DAYS")).otherwise(purchase)
    first = frames["orders"].withColumns({
        "order_purchase_timestamp": F.when(late, moved).otherwise(purchase),
        "order_status": F.when(late & (F.col("customer_id") % 2 == 0), "processing").otherwise(F.col("order_status"))})
    second = {"orders": frames["orders"].where(late)}
    second |= {n: frames[n].limit(0) for n in ("order_items", "order_payments")}
    for day, landed in ((DAY1_TS, frames | {"orders": first}), (DAY2_TS, second)):
        for name, frame in landed.items():
            write_partitioned(add_lineage(frame, SOURCE_FILES[name], day), layout.bronze(name))
        before = commit_of(spark, layout.silver("orders"))
        bronze = bronze_tables(spark, layout, list(frames), [day[:10]])
        for name in frames:
            prepare_silver_table(spark, layout, name, bronze, [day[:10]]).publish()
        prepare_sales(spark, layout, day[:10], before).publish()
    return read_table(spark, layout.gold("gold_sales_summary"))
