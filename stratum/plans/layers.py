"""Layer views over the driver's tables: bronze roles -> refined -> marts.

These build lazy plans only; nothing is executed or written here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.operators import marts
from stratum.operators.refine import REFINERS
from stratum.plans.concurrent import run_all
from stratum.plans.roles import RUN_DATE, RUN_TS, bronze_roles

SILVER_TABLES = ("orders", "order_items", "order_payments", "customers", "products",
                 "sellers", "order_reviews", "geolocation")


def refine_table(name: str, bronze: dict[str, DataFrame], hidden: bool = False) -> DataFrame:
    if name == "products":
        return REFINERS[name](bronze["products"], bronze["category_translation"], hidden)
    return REFINERS[name](bronze[name], hidden)


def bronze_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return bronze_roles(spark, sf_dir, RUN_TS, RUN_DATE)


def silver_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    bronze = bronze_views(spark, sf_dir)
    return run_all(spark, {n: (lambda n=n: refine_table(n, bronze)) for n in SILVER_TABLES})


# "totals" and "lines" are there where the marts share them (share_by_order)
MART_BUILDERS = {
    "gold_sales_summary": lambda s: marts.sales_summary(
        s["orders"], s["order_payments"], s["order_items"], totals=s.get("totals")),
    "gold_product_performance": lambda s: marts.product_performance(
        s["order_items"], s["products"], s["orders"], s["order_reviews"], lines=s.get("lines")),
    "gold_customer_segments": lambda s: marts.customer_segments(
        s["orders"], s["order_payments"], s["customers"], totals=s.get("totals")),
    "gold_seller_performance": lambda s: marts.seller_performance(
        s["order_items"], s["orders"], s["sellers"], s["order_reviews"], lines=s.get("lines")),
}


def share_by_order(silver: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The refined tables with what the marts need of the delivered orders, written once
    under ``folder`` for all of them: lines, and totals by order. Payments, items and
    reviews are shuffled by order once, not for each mart; the lines lie by order, so
    that what was shipped is added up before the shuffle."""
    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    lines = written(marts.order_lines(silver["order_items"], silver["orders"], silver["order_reviews"]).select(*marts.LINES), "lines")
    totals = marts.order_totals(silver["orders"], silver["order_payments"], lines).select(*marts.TOTALS)
    return silver | {"lines": lines, "totals": written(totals, "totals")}


def build_marts(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four marts from refined frames. Plans are lazy except the
    in-category rank, which materialises its sorted input when built."""
    return {name: build(s) for name, build in MART_BUILDERS.items()}
