"""Refined ("silver") layer: type, deduplicate, derive, drop lineage, filter.

Each table is described by a :class:`RefineSpec`; :func:`refine` applies it as
one narrow projection, one deterministic dedup (the only shuffle), and the
filters. Semantics kept from the source pipeline:

* bad text in a typed column becomes null (``try_cast`` / ``try_to_timestamp``);
* dedup runs *before* value filters, so a key whose surviving row fails a
  value filter (``price > 0``) disappears entirely;
* filters on key columns commute with dedup and are pushed below it by
  Catalyst; value filters are not.

Changed on purpose: the surviving duplicate is the newest ingestion, then a
total order over all columns (:mod:`stratum.operators.dedup`), instead of an
arbitrary row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import (
    as_double_value,
    as_int,
    as_timestamp,
    day_diff,
    day_of_week,
    is_later,
    money,
)
from stratum.operators.dedup import dedup_latest

# Bronze lineage columns, in the order bronze adds them.
LINEAGE = ("_ingested_at", "_source_file", "_ingestion_date")
# Dedup prefers the newest landing: date first, then the run stamp.
NEWEST_FIRST = ("_ingestion_date", "_ingested_at")


@dataclass(frozen=True)
class RefineSpec:
    name: str
    keys: tuple[str, ...]
    money: tuple[str, ...] = ()
    ints: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    derive: Callable[[DataFrame], DataFrame] | None = None
    drop: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    keep_if: Callable[[], Column] | None = field(default=None, compare=False)
    # Storage layout of the refined table: partition folders that never change
    # for a key, so a daily upsert reads and rewrites only the touched ones.
    partition_by: tuple[str, ...] = ()
    # Columns kept beside the published ones: what a later merge compares or looks up.
    hidden: tuple[tuple[str, str], ...] = (("__landed", "_ingestion_date"),)


#: hidden column with the landing date of a refined row
LANDED = "__landed"


def type_columns(df: DataFrame, spec: RefineSpec) -> DataFrame:
    """One projection that converts every typed column present in ``df``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    conv: dict[str, Column] = {}
    for c in spec.money:
        if c in types:
            conv[c] = money(c)
    for c in spec.ints:
        if c in types:
            conv[c] = as_int(c)
    for c in spec.doubles:
        if c in types:
            conv[c] = as_double_value(c)
    for c in spec.timestamps:
        if c in types:
            conv[c] = as_timestamp(c, types[c])
    return df.withColumns(conv) if conv else df


def drop_lineage(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Drop lineage (and ``extra``) columns; same-named columns from both
    sides of a join are all removed."""
    return df.drop(*LINEAGE, *extra)


def refine(df: DataFrame, spec: RefineSpec, hidden: bool = False) -> DataFrame:
    """``hidden`` adds the columns that a table keeps beside the published ones."""
    # the file's name would be the last to tell two rows of a key apart, and isn't published
    typed = type_columns(df, spec).drop("_source_file")
    deduped = dedup_latest(typed, spec.keys, NEWEST_FIRST)
    derived = spec.derive(deduped) if spec.derive else deduped
    if hidden:
        derived = derived.withColumns({name: F.col(of) for name, of in spec.hidden})
    out = drop_lineage(derived, spec.drop)
    if spec.required:
        out = out.dropna(subset=list(spec.required))
    if spec.keep_if is not None:
        out = out.where(spec.keep_if())
    return out


# --- the eight source tables --------------------------------------------------

ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def derive_orders(df: DataFrame) -> DataFrame:
    purchase = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    return df.withColumns({
        "order_year": F.year(purchase),
        "order_month": F.month(purchase),
        "order_dow": day_of_week(purchase),
        "delivery_days": day_diff(delivered, purchase),
        "is_late": is_later(delivered, F.col("order_estimated_delivery_date")),
    })


def derive_order_items(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "total_item_value", F.col("price") + F.col("freight_value"))


def derive_products(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "category",
        F.coalesce(F.col("product_category_name_english"), F.col("product_category_name")))


SPECS: dict[str, RefineSpec] = {
    "orders": RefineSpec(
        "orders", ("order_id",), timestamps=ORDER_TIMESTAMPS,
        derive=derive_orders, required=("order_id",),
        partition_by=("order_year", "order_month")),
    "order_items": RefineSpec(
        "order_items", ("order_id", "order_item_id"),
        money=("price", "freight_value"), ints=("order_item_id",),
        timestamps=("shipping_limit_date",), derive=derive_order_items,
        required=("order_id",), keep_if=lambda: F.col("price") > 0),
    "order_payments": RefineSpec(
        "order_payments", ("order_id", "payment_sequential"),
        money=("payment_value",), ints=("payment_installments", "payment_sequential"),
        required=("order_id",), keep_if=lambda: F.col("payment_value") > 0),
    "customers": RefineSpec("customers", ("customer_id",), required=("customer_id",)),
    "products": RefineSpec(
        "products", ("product_id",),
        ints=("product_name_lenght", "product_description_lenght", "product_photos_qty"),
        doubles=("product_weight_g", "product_length_cm", "product_height_cm",
                 "product_width_cm"),
        derive=derive_products,
        drop=("product_category_name", "product_category_name_english"),
        required=("product_id",),
        hidden=((LANDED, "_ingestion_date"), ("__category", "product_category_name"))),
    "sellers": RefineSpec("sellers", ("seller_id",), required=("seller_id",)),
    "order_reviews": RefineSpec(
        "order_reviews", ("review_id",), ints=("review_score",),
        timestamps=("review_creation_date", "review_answer_timestamp"),
        required=("order_id", "review_score")),
    "geolocation": RefineSpec(
        "geolocation", ("geolocation_zip_code_prefix",),
        doubles=("geolocation_lat", "geolocation_lng"),
        required=("geolocation_zip_code_prefix",)),
}

# Merge keys and partition folders of the refined tables (used by the upsert sink).
MERGE_KEYS = {name: spec.keys for name, spec in SPECS.items()}
PARTITION_COLUMNS = {name: spec.partition_by for name, spec in SPECS.items()}


def refine_orders(df: DataFrame, hidden: bool = False) -> DataFrame:
    return refine(df, SPECS["orders"], hidden)


def refine_order_items(df: DataFrame, hidden: bool = False) -> DataFrame:
    return refine(df, SPECS["order_items"], hidden)


def refine_order_payments(df: DataFrame, hidden: bool = False) -> DataFrame:
    return refine(df, SPECS["order_payments"], hidden)


def refine_customers(df: DataFrame, hidden: bool = False) -> DataFrame:
    return refine(df, SPECS["customers"], hidden)


def newest_names(translation: DataFrame) -> DataFrame:
    """One English name per category: of a category landed more than once the newest."""
    newest = dedup_latest(translation, ["product_category_name"],
                          [c for c in NEWEST_FIRST if c in translation.columns])
    return newest.select("product_category_name", "product_category_name_english")


def refine_products(products: DataFrame, translation: DataFrame, hidden: bool = False) -> DataFrame:
    """Products with an English category where a translation exists, else the
    source name; of a category landed more than once the newest counts. The translation is a small dimension; the planner broadcasts
    it when its measured size is under the broadcast threshold."""
    joined = products.join(newest_names(translation), on="product_category_name", how="left")
    return refine(joined, SPECS["products"], hidden)


def renamed_products(silver: DataFrame, names: DataFrame) -> DataFrame:
    """Stored products (hidden columns among them) whose category is called something
    else in ``names``, under its new name. Of the products only the source category and
    the name are compared; all their columns are read for the affected ones."""
    called = names.select(F.col("product_category_name").alias("__name"),
                          F.coalesce("product_category_name_english", "product_category_name").alias("__called"))
    # a null category has no name to look up, so equality will do
    found = silver.join(called, F.col("__category") == F.col("__name")).where(~F.col("category").eqNullSafe(F.col("__called")))
    return found.withColumn("category", F.col("__called")).select(*silver.columns)


def refine_sellers(df: DataFrame, hidden: bool = False) -> DataFrame:
    return refine(df, SPECS["sellers"], hidden)


def refine_order_reviews(df: DataFrame, hidden: bool = False) -> DataFrame:
    return refine(df, SPECS["order_reviews"], hidden)


def refine_geolocation(df: DataFrame, hidden: bool = False) -> DataFrame:
    return refine(df, SPECS["geolocation"], hidden)


REFINERS: dict[str, Callable[..., DataFrame]] = {
    "orders": refine_orders,
    "order_items": refine_order_items,
    "order_payments": refine_order_payments,
    "customers": refine_customers,
    "products": refine_products,
    "sellers": refine_sellers,
    "order_reviews": refine_order_reviews,
    "geolocation": refine_geolocation,
}
