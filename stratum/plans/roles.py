"""Role views: present the driver's TPC-H-like tables as the commerce source
tables the pipeline expects (orders, order_items, order_payments, customers,
products, sellers, order_reviews, geolocation, category_translation).

A role view is a plain projection / join over the given tables, so all work
scales with them. Mapping (also in README):

* orders: o_orderkey, o_custkey, status letter -> status word, o_orderdate as
  purchase and approval time, first / last l_shipdate as carrier and customer
  delivery (customer delivery only for fulfilled orders), estimate = purchase
  + 60 days;
* order_items / order_payments: one row per lineitem row; (l_orderkey,
  l_linenumber) repeats, so the refined layer's dedup is exercised; money is
  computed exactly in decimal (freight = price x tax, payment = price x
  (1 - discount));
* customers / sellers: nation name as state; geolocation: one row per
  customer, zip prefix = nation key (many rows per prefix);
* products: p_type is the category; the translation table covers four of the
  six types so that the fallback to the source name is exercised;
* order_reviews: one review per accepted or returned line (flag A or R),
  score 1..5 from the quantity band, so orders have 0..n reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import plus_days
from stratum.plans.concurrent import run_all
from stratum.operators.lineage import add_lineage

# Status words of the commerce source, keyed by the test
# tables' status letter (F = fulfilled).
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
# Payment type per return flag.
PAYMENT_TYPE_BY_FLAG = {"A": "credit_card", "N": "boleto", "R": "voucher"}
# Category translation (four of the six part types).
CATEGORY_TRANSLATION = {
    "ECONOMY": "economy_goods",
    "LARGE": "large_goods",
    "MEDIUM": "medium_goods",
    "SMALL": "small_goods",
}
REVIEWED_FLAGS = ("A", "R")
ESTIMATE_DAYS = 60

# Run identity used for lineage columns when a role is landed as bronze.
RUN_DATE = "2026-01-01"
RUN_TS = "2026-01-01T06:00:00"

SOURCE_FILES = {
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "order_payments": "order_payments.csv",
    "customers": "customers.csv",
    "products": "products.csv",
    "sellers": "sellers.csv",
    "order_reviews": "order_reviews.csv",
    "geolocation": "geolocation.csv",
    "category_translation": "category_translation.csv",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    # opening a Parquet file reads its footer; open the tables together
    return run_all(spark, {t: (lambda t=t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
                           for t in TABLES})


def _map(col: str, mapping: dict[str, str]):
    expr = None
    for code, word in mapping.items():
        expr = (F.when(F.col(col) == code, word) if expr is None
                else expr.when(F.col(col) == code, word))
    return expr.otherwise(F.col(col))


def _cents(c: str):
    return F.col(c).cast("decimal(18,2)")


def orders_role(t: dict[str, DataFrame]) -> DataFrame:
    ships = t["lineitem"].groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    o = t["orders"]
    return (
        o.join(ships, o.o_orderkey == ships.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            _map("o_orderstatus", STATUS_BY_CODE).alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.col("o_orderdate").alias("order_approved_at"),
            F.col("first_ship").alias("order_delivered_carrier_date"),
            F.when(F.col("o_orderstatus") == "F", F.col("last_ship"))
            .alias("order_delivered_customer_date"),
            plus_days("o_orderdate", ESTIMATE_DAYS).alias("order_estimated_delivery_date"),
        )
    )


def order_items_role(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _cents("l_extendedprice").alias("price"),
        (_cents("l_extendedprice") * _cents("l_tax")).alias("freight_value"),
    )


def order_payments_role(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _map("l_returnflag", PAYMENT_TYPE_BY_FLAG).alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        (_cents("l_extendedprice") * (F.lit(1) - _cents("l_discount"))).alias("payment_value"),
    )


def customers_role(t: dict[str, DataFrame]) -> DataFrame:
    c, n = t["customer"], t["nation"]
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def products_role(t: dict[str, DataFrame]) -> DataFrame:
    return t["part"].select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        F.col("p_size").alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
    )


def category_translation_role(spark: SparkSession) -> DataFrame:
    """The fixed translation rows as an inline table (a one-row range plus a
    generator), so the planner knows it is tiny and broadcasts it."""
    rows = [F.struct(F.lit(k).alias("product_category_name"),
                     F.lit(v).alias("product_category_name_english"))
            for k, v in sorted(CATEGORY_TRANSLATION.items())]
    return spark.range(1).select(F.inline(F.array(*rows)))


def sellers_role(t: dict[str, DataFrame]) -> DataFrame:
    s, n = t["supplier"], t["nation"]
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def order_reviews_role(t: dict[str, DataFrame]) -> DataFrame:
    li = t["lineitem"].where(F.col("l_returnflag").isin(*REVIEWED_FLAGS))
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("review_score"),
        F.col("l_shipdate").alias("review_creation_date"),
        plus_days("l_shipdate", 2).alias("review_answer_timestamp"),
    )


def geolocation_role(t: dict[str, DataFrame]) -> DataFrame:
    bal = F.col("c_acctbal") / 1000
    return t["customer"].select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        (F.lit(-30.0) + bal).alias("geolocation_lat"),
        (F.lit(-50.0) - bal).alias("geolocation_lng"),
        F.col("c_name").alias("geolocation_city"),
        F.col("c_mktsegment").alias("geolocation_state"),
    )


ROLE_BUILDERS = {
    "orders": orders_role,
    "order_items": order_items_role,
    "order_payments": order_payments_role,
    "customers": customers_role,
    "products": products_role,
    "sellers": sellers_role,
    "order_reviews": order_reviews_role,
    "geolocation": geolocation_role,
}


def bronze_roles(spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS,
                 run_date: str = RUN_DATE) -> dict[str, DataFrame]:
    """All nine source roles with lineage columns, as bronze would hold them."""
    t = read_tables(spark, sf_dir)

    def role(name: str, build):
        return lambda: add_lineage(build(t), SOURCE_FILES[name], run_ts, run_date)

    # plan building is driver work (analysis per step); build the roles together
    out = run_all(spark, {name: role(name, build) for name, build in ROLE_BUILDERS.items()})
    out["category_translation"] = add_lineage(
        category_translation_role(spark), SOURCE_FILES["category_translation"],
        run_ts, run_date)
    return out
