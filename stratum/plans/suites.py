"""Declarative quality suites of the three layers (values of the source
pipeline's gates)."""

from __future__ import annotations

from stratum.operators.quality import (
    Expectation,
    between,
    column_exists,
    columns_absent,
    in_set,
    not_null,
    row_count_between,
    unique,
)
from stratum.operators.refine import LINEAGE

# Accepted order statuses, payment types and customer segments.
ORDER_STATUSES = ("delivered", "shipped", "canceled", "unavailable",
                  "invoiced", "processing", "created", "approved")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
CUSTOMER_SEGMENTS = ("Champion", "Loyal", "New Customer", "At Risk", "Lost")
ORDERS_DERIVED = ("is_late", "delivery_days", "order_year", "order_month", "order_dow")

# Expected order volume of the source data set; the area that coordinates lie in;
# the range of scores; and, in the suites below, every bound and share of a check.
ORDER_ROWS = (90_000, 120_000)
LATITUDES, LONGITUDES = (-34, 6), (-74, -34)
SCORES = (1, 5)

Suite = dict[str, list[Expectation]]


def bronze_suite(order_rows: tuple[int | None, int | None] = ORDER_ROWS) -> Suite:
    return {
        "orders": [
            not_null("order_id"), unique("order_id"),
            row_count_between(*order_rows),
            in_set("order_status", ORDER_STATUSES),
            not_null("order_purchase_timestamp"),
        ],
        "order_items": [
            not_null("order_id"), not_null("product_id"),
            between("price", 0, 10_000), between("freight_value", 0, 1_000),
        ],
        "order_payments": [
            not_null("order_id"), in_set("payment_type", PAYMENT_TYPES),
            between("payment_value", 0, 100_000),
        ],
        "customers": [not_null("customer_id"), unique("customer_id"),
                      not_null("customer_state")],
        "products": [not_null("product_id"), unique("product_id")],
        "sellers": [not_null("seller_id"), unique("seller_id")],
        "order_reviews": [
            not_null("review_id", mostly=0.999),
            between("review_score", *SCORES, mostly=0.97),
            not_null("order_id", mostly=0.97),
        ],
        "geolocation": [
            not_null("geolocation_zip_code_prefix"),
            between("geolocation_lat", *LATITUDES), between("geolocation_lng", *LONGITUDES),
        ],
    }


def silver_suite() -> Suite:
    no_lineage = columns_absent(LINEAGE)
    return {
        "orders": [
            no_lineage, not_null("order_id"), unique("order_id"),
            *[column_exists(c) for c in ORDERS_DERIVED],
            between("order_year", 2016, 2018),
        ],
        "order_items": [no_lineage, column_exists("total_item_value"),
                        between("price", 0.01, 10_000)],
        "order_payments": [no_lineage, between("payment_value", 0.01, 100_000)],
        "customers": [no_lineage, not_null("customer_id"), unique("customer_id")],
        "products": [no_lineage, not_null("product_id"), column_exists("category")],
        "sellers": [no_lineage, not_null("seller_id")],
        "order_reviews": [no_lineage, between("review_score", *SCORES)],
        "geolocation": [
            no_lineage, not_null("geolocation_zip_code_prefix"),
            between("geolocation_lat", *LATITUDES), between("geolocation_lng", *LONGITUDES),
        ],
    }


def gold_suite() -> Suite:
    return {
        "gold_sales_summary": [
            not_null("order_date"), between("total_orders", 1, None),
            between("total_revenue", 0.01, None), between("late_delivery_rate", 0, 100),
        ],
        "gold_product_performance": [
            between("revenue_rank", 1, None), between("freight_ratio", 0, None),
            between("total_revenue", 0.01, None),
        ],
        "gold_customer_segments": [not_null("customer_id"),
                                   in_set("segment", CUSTOMER_SEGMENTS)],
        "gold_seller_performance": [
            between("total_orders", 1, None), between("late_rate", 0, 100),
            between("avg_review_score", *SCORES),
        ],
    }
