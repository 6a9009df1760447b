"""Independent SQL statements of every registered query, for DuckDB.

They run on the driver's pre-registered views (orders, lineitem, ...), so
the role views, refined tables and marts are restated here in plain SQL.
Numeric rules shared with the Spark side:

* amounts are doubles; a sum adds the decimals of their shortest texts and
  becomes DOUBLE once; an average is such a sum divided by the count;
* rounding to two places goes through DECIMAL(24,8);
* day of week is 1 = Sunday (DuckDB's dayofweek + 1);
* every integer output is cast to the type Spark produces.
"""

from __future__ import annotations

from stratum.plans.roles import (
    CATEGORY_TRANSLATION,
    ESTIMATE_DAYS,
    PAYMENT_TYPE_BY_FLAG,
    REVIEWED_FLAGS,
    RUN_DATE,
    RUN_TS,
    SOURCE_FILES,
    STATUS_BY_CODE,
)


def case_map(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {col} END"


def lineage(table: str, run_ts: str = RUN_TS, run_date: str = RUN_DATE) -> str:
    return (f"'{run_ts}' AS _ingested_at, '{SOURCE_FILES[table]}' AS _source_file, "
            f"DATE '{run_date}' AS _ingestion_date")


def round2(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(24,8)), 2) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def pct(num: str, den: str) -> str:
    return f"({ratio(num, den)} * 100.0)"


def mean(expr: str) -> str:
    return f"(CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0))"


def total(expr: str) -> str:
    return f"CAST(SUM(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE)"


#: as in :mod:`stratum.functions.checksum`
_SCALE = ("CASE WHEN abs({x}) < 1.0 THEN 1e17 WHEN abs({x}) < 1e2 THEN 1e15 WHEN abs({x}) < 1e4 THEN 1e13 "
          "WHEN abs({x}) < 1e6 THEN 1e11 WHEN abs({x}) < 1e8 THEN 1e9 WHEN abs({x}) < 1e12 THEN 1e5 "
          "WHEN abs({x}) < 1e18 THEN 1e0 END")


def checksum(columns: list[str]) -> str:
    """Sum over rows of the first characters of the md5 of each row's text."""
    def text(c: str) -> str:
        number = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
        scale = _SCALE.format(x=number)
        places = (f"CAST(TRY_CAST(floor({number} * ({scale}) + 0.5) AS BIGINT) AS VARCHAR) || '/' || "
                  f"CAST(CAST({scale} AS BIGINT) AS VARCHAR)")
        plain = f"CAST({c} AS VARCHAR)"
        return (f"COALESCE(CASE typeof({c}) WHEN 'DOUBLE' THEN {places} "
                f"WHEN 'VARCHAR' THEN CAST(length({plain}) AS VARCHAR) || ':' || {plain} END, {plain}, '~')")
    row = f"concat_ws('|', {', '.join(text(c) for c in sorted(columns))})"
    high, low = ("SUM(CAST(" + " + ".join(f"ascii(substr(md5({row}), {at + i}, 1)) * {1 << 21 - 7 * i}" for i in range(4))
                 + " AS BIGINT))" for at in (1, 5))
    return f"COALESCE(CAST({high} * {1 << 28} + {low} AS VARCHAR), '0')"


def total_mean(expr: str) -> str:
    return f"({total(expr)} / NULLIF(COUNT({expr}), 0))"


def dedup(src: str, keys: list[str], order: list[str]) -> str:
    """Greatest row per key under the total order (nulls lowest)."""
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT * FROM {src} QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {by}) = 1")


NEWEST = ["_ingestion_date", "_ingested_at"]

# --- bronze role views -----------------------------------------------------------

ROLE_SQL = {
    "orders": f"""
SELECT o.o_orderkey AS order_id,
       o.o_custkey AS customer_id,
       {case_map('o.o_orderstatus', STATUS_BY_CODE)} AS order_status,
       o.o_orderdate AS order_purchase_timestamp,
       o.o_orderdate AS order_approved_at,
       s.first_ship AS order_delivered_carrier_date,
       CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS order_delivered_customer_date,
       o.o_orderdate + INTERVAL {ESTIMATE_DAYS} DAY AS order_estimated_delivery_date
FROM orders o
LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
           FROM lineitem GROUP BY l_orderkey) s
  ON o.o_orderkey = s.l_orderkey""",
    "order_items": """
SELECT l_orderkey AS order_id,
       l_linenumber AS order_item_id,
       l_partkey AS product_id,
       l_suppkey AS seller_id,
       l_shipdate AS shipping_limit_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS freight_value
FROM lineitem""",
    "order_payments": f"""
SELECT l_orderkey AS order_id,
       l_linenumber AS payment_sequential,
       {case_map('l_returnflag', PAYMENT_TYPE_BY_FLAG)} AS payment_type,
       CAST(l_quantity AS INTEGER) AS payment_installments,
       CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS payment_value
FROM lineitem""",
    "customers": """
SELECT c.c_custkey AS customer_id,
       c.c_name AS customer_unique_id,
       c.c_nationkey AS customer_zip_code_prefix,
       c.c_mktsegment AS customer_city,
       n.n_name AS customer_state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "products": """
SELECT p_partkey AS product_id,
       p_type AS product_category_name,
       CAST(length(p_name) AS INTEGER) AS product_name_lenght,
       CAST(length(p_brand) AS INTEGER) AS product_description_lenght,
       p_size AS product_photos_qty,
       p_retailprice AS product_weight_g
FROM part""",
    "sellers": """
SELECT s.s_suppkey AS seller_id,
       s.s_nationkey AS seller_zip_code_prefix,
       s.s_name AS seller_city,
       n.n_name AS seller_state
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "order_reviews": f"""
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS review_id,
       l_orderkey AS order_id,
       CAST(CEIL(l_quantity / 10) AS INTEGER) AS review_score,
       l_shipdate AS review_creation_date,
       l_shipdate + INTERVAL 2 DAY AS review_answer_timestamp
FROM lineitem
WHERE l_returnflag IN ({', '.join(f"'{f}'" for f in REVIEWED_FLAGS)})""",
    "geolocation": """
SELECT c_nationkey AS geolocation_zip_code_prefix,
       -30.0 + c_acctbal / 1000 AS geolocation_lat,
       -50.0 - c_acctbal / 1000 AS geolocation_lng,
       c_name AS geolocation_city,
       c_mktsegment AS geolocation_state
FROM customer""",
    "category_translation": "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', '{v}')" for k, v in sorted(CATEGORY_TRANSLATION.items()))
    + ") AS t(product_category_name, product_category_name_english)",
}

# Column order of each bronze role (Spark frame order; dedup order follows it).
ROLE_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type",
                       "payment_installments", "payment_value"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "products": ["product_id", "product_category_name", "product_name_lenght",
                 "product_description_lenght", "product_photos_qty", "product_weight_g"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_creation_date",
                      "review_answer_timestamp"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}

LINEAGE_COLS = ["_ingested_at", "_source_file", "_ingestion_date"]


def bronze_sql(table: str) -> str:
    return f"SELECT r.*, {lineage(table)} FROM ({ROLE_SQL[table]}) r"


# --- refined layer -------------------------------------------------------------

# Typed projections (same column order as the bronze role + lineage).
TYPED = {
    "orders": None,  # all typed already
    "order_items": {
        "order_item_id": "TRY_CAST(order_item_id AS INTEGER)",
        "price": "TRY_CAST(price AS DOUBLE)",
        "freight_value": "TRY_CAST(freight_value AS DOUBLE)",
    },
    "order_payments": {
        "payment_sequential": "TRY_CAST(payment_sequential AS INTEGER)",
        "payment_installments": "TRY_CAST(payment_installments AS INTEGER)",
        "payment_value": "TRY_CAST(payment_value AS DOUBLE)",
    },
    "customers": None,
    "products": {
        "product_name_lenght": "TRY_CAST(product_name_lenght AS INTEGER)",
        "product_description_lenght": "TRY_CAST(product_description_lenght AS INTEGER)",
        "product_photos_qty": "TRY_CAST(product_photos_qty AS INTEGER)",
        "product_weight_g": "TRY_CAST(product_weight_g AS DOUBLE)",
    },
    "sellers": None,
    "order_reviews": {"review_score": "TRY_CAST(review_score AS INTEGER)"},
    "geolocation": {
        "geolocation_lat": "TRY_CAST(geolocation_lat AS DOUBLE)",
        "geolocation_lng": "TRY_CAST(geolocation_lng AS DOUBLE)",
    },
}

KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "order_reviews": ["review_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
}


def frame_columns(table: str) -> list[str]:
    """Columns of the frame the Spark side deduplicates, in its order."""
    if table == "products":
        # USING join: key first, then product columns, then the translation.
        rest = [c for c in ROLE_COLUMNS["products"] if c != "product_category_name"]
        return ["product_category_name", *rest, *LINEAGE_COLS,
                "product_category_name_english"]
    return [*ROLE_COLUMNS[table], *LINEAGE_COLS]


def dedup_order(table: str) -> list[str]:
    cols = frame_columns(table)
    keys = KEYS[table]
    return [*NEWEST, *[c for c in cols if c not in keys and c not in NEWEST]]


def typed_sql(table: str, src: str) -> str:
    conv = TYPED[table] or {}
    cols = [f"{conv[c]} AS {c}" if c in conv else c for c in frame_columns(table)]
    return f"SELECT {', '.join(cols)} FROM {src}"


DERIVED = {
    "orders": """,
       CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
       CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
       CAST(dayofweek(order_purchase_timestamp) + 1 AS INTEGER) AS order_dow,
       CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                      CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_days,
       order_delivered_customer_date > order_estimated_delivery_date AS is_late""",
    "order_items": ",\n       price + freight_value AS total_item_value",
    "products": ",\n       COALESCE(product_category_name_english, product_category_name) AS category",
}

FILTERS = {
    "orders": "order_id IS NOT NULL",
    "order_items": "order_id IS NOT NULL AND price > 0",
    "order_payments": "order_id IS NOT NULL AND payment_value > 0",
    "customers": "customer_id IS NOT NULL",
    "products": "product_id IS NOT NULL",
    "sellers": "seller_id IS NOT NULL",
    "order_reviews": "order_id IS NOT NULL AND review_score IS NOT NULL",
    "geolocation": "geolocation_zip_code_prefix IS NOT NULL",
}

DROPPED = {"products": ["product_category_name", "product_category_name_english"]}


def silver_output_columns(table: str) -> list[str]:
    drop = set(LINEAGE_COLS) | set(DROPPED.get(table, []))
    return [c for c in frame_columns(table) if c not in drop]


def silver_from(table: str, bronze: str, translation: str | None = None) -> str:
    """Refined table ``table`` from a bronze relation (a CTE or view name)."""
    if table == "products":
        tr = translation or "b_category_translation"
        rest = ", ".join(f"p.{c}" for c in frame_columns("products")[1:-1])
        src = (f"(SELECT p.product_category_name, {rest}, t.product_category_name_english "
               f"FROM {bronze} p LEFT JOIN (SELECT product_category_name, "
               f"product_category_name_english FROM {tr}) t "
               f"ON p.product_category_name = t.product_category_name)")
    else:
        src = bronze
    typed = f"({typed_sql(table, src)})"
    deduped = f"({dedup(typed, KEYS[table], dedup_order(table))})"
    cols = ", ".join(silver_output_columns(table))
    return (f"SELECT {cols}{DERIVED.get(table, '')}\nFROM {deduped} d\n"
            f"WHERE {FILTERS[table]}")


SILVER_TABLES = list(KEYS)


def with_ctes(ctes: dict[str, str], body: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


def layer_ctes(*silver: str, bronze: tuple[str, ...] = ()) -> dict[str, str]:
    """CTEs ``b_<t>`` (bronze role + lineage) and ``s_<t>`` (refined)."""
    out: dict[str, str] = {}
    need_b = set(bronze) | set(silver)
    if "products" in silver:
        need_b.add("category_translation")
    for t in ROLE_SQL:
        if t in need_b:
            out[f"b_{t}"] = bronze_sql(t)
    for t in SILVER_TABLES:
        if t in silver:
            out[f"s_{t}"] = silver_from(t, f"b_{t}")
    return out


# --- marts -----------------------------------------------------------------------

SALES_SUMMARY_BODY = f"""
, pay AS (SELECT order_id, {total('payment_value')} AS total_payment
          FROM s_order_payments GROUP BY order_id)
, itm AS (SELECT order_id, {total('freight_value')} AS freight_revenue,
                 COUNT(order_item_id) AS items_count
          FROM s_order_items GROUP BY order_id)
, daily AS (
  SELECT o.order_year, o.order_month, CAST(o.order_purchase_timestamp AS DATE) AS order_date,
         COUNT(o.order_id) AS total_orders,
         {total('p.total_payment')} AS revenue,
         {total_mean('p.total_payment')} AS avg_order_value,
         CAST(SUM(i.items_count) AS BIGINT) AS total_items_sold,
         {total('i.freight_revenue')} AS freight,
         {mean('o.delivery_days')} AS avg_delivery_days,
         CAST(SUM(CASE WHEN o.is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_deliveries
  FROM s_orders o
  LEFT JOIN pay p ON o.order_id = p.order_id
  LEFT JOIN itm i ON o.order_id = i.order_id
  WHERE o.order_status = 'delivered'
  GROUP BY 1, 2, 3)
SELECT order_year, order_month, order_date, total_orders,
       CAST(revenue AS DOUBLE) AS total_revenue, avg_order_value, total_items_sold,
       CAST(freight AS DOUBLE) AS total_freight, avg_delivery_days, late_deliveries,
       {round2(pct('late_deliveries', 'total_orders'))} AS late_delivery_rate,
       {round2(ratio('revenue', 'total_items_sold'))} AS revenue_per_item
FROM daily"""


def _mart(ctes: dict[str, str], tail: str) -> str:
    """CTE list followed by further CTEs / the final SELECT in ``tail``."""
    return "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in ctes.items()) + tail


def sales_summary_sql() -> str:
    return _mart(layer_ctes("orders", "order_payments", "order_items"), SALES_SUMMARY_BODY)


PRODUCT_PERF_TAIL = f"""
, rv AS (SELECT order_id, {mean('review_score')} AS avg_review_score
         FROM s_order_reviews GROUP BY order_id)
, pp AS (
  SELECT i.product_id, p.category,
         COUNT(i.order_id) AS total_orders,
         {total('i.price')} AS revenue,
         {total_mean('i.price')} AS avg_price,
         {total('i.freight_value')} AS freight,
         {total_mean('r.avg_review_score')} AS avg_rating,
         COUNT(DISTINCT i.order_id) AS unique_orders
  FROM s_order_items i
  LEFT JOIN s_products p ON i.product_id = p.product_id
  LEFT JOIN rv r ON i.order_id = r.order_id
  WHERE i.order_id IN (SELECT order_id FROM s_orders WHERE order_status = 'delivered')
  GROUP BY i.product_id, p.category)
SELECT product_id, category, total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
       avg_price, CAST(freight AS DOUBLE) AS total_freight, avg_rating, unique_orders,
       CAST(RANK() OVER (PARTITION BY category ORDER BY revenue DESC NULLS LAST) AS INTEGER)
         AS revenue_rank,
       {round2(pct('freight', 'revenue'))} AS freight_ratio
FROM pp"""


def product_performance_sql() -> str:
    return _mart(layer_ctes("order_items", "products", "orders", "order_reviews"),
                 PRODUCT_PERF_TAIL)


RFM_TAIL = f"""
, ov AS (SELECT order_id, {total('payment_value')} AS order_value
         FROM s_order_payments GROUP BY order_id)
, rfm AS (
  SELECT o.customer_id,
         CAST(date_diff('day', CAST(MAX(o.order_purchase_timestamp) AS DATE),
              CAST((SELECT MAX(order_purchase_timestamp) FROM s_orders) AS DATE)) AS INTEGER)
           AS recency_days,
         COUNT(o.order_id) AS frequency,
         {total('v.order_value')} AS monetary
  FROM s_orders o LEFT JOIN ov v ON o.order_id = v.order_id
  WHERE o.order_status = 'delivered'
  GROUP BY o.customer_id)
SELECT r.customer_id, c.customer_state, c.customer_city, r.recency_days, r.frequency,
       {round2('r.monetary')} AS monetary,
       CASE WHEN r.recency_days <= 90 AND r.frequency >= 2 AND r.monetary >= 500 THEN 'Champion'
            WHEN r.recency_days <= 180 AND r.frequency >= 2 THEN 'Loyal'
            WHEN r.recency_days <= 90 AND r.frequency = 1 THEN 'New Customer'
            WHEN r.recency_days > 365 THEN 'Lost'
            ELSE 'At Risk' END AS segment
FROM rfm r LEFT JOIN s_customers c ON r.customer_id = c.customer_id"""


def rfm_by_person_sql() -> str:
    """RFM_TAIL with orders and customers under their person's key."""
    tail = RFM_TAIL.replace("FROM s_orders o LEFT JOIN ov", "FROM people_orders o LEFT JOIN ov").replace(
        "s_customers c", "people c").replace("r.customer_id", "r.customer_id AS customer_unique_id", 1)
    key = "concat_ws('/', customer_state, customer_city)"
    people = f"""
, ids AS (SELECT customer_id, {key} AS person, customer_state, customer_city FROM s_customers)
, people_orders AS (SELECT o.* REPLACE (i.person AS customer_id) FROM s_orders o
                    LEFT JOIN ids i ON o.customer_id = i.customer_id)
, people AS (SELECT person AS customer_id, arg_max(customer_state, customer_id) AS customer_state,
                    arg_max(customer_city, customer_id) AS customer_city FROM ids GROUP BY person)"""
    return _mart(layer_ctes("orders", "order_payments", "customers"), people + tail)


def rfm_segments_sql() -> str:
    return _mart(layer_ctes("orders", "order_payments", "customers"), RFM_TAIL)


SELLER_TAIL = f"""
, rv AS (SELECT order_id, {mean('review_score')} AS avg_score
         FROM s_order_reviews GROUP BY order_id)
, ps AS (
  SELECT i.seller_id,
         COUNT(i.order_id) AS total_orders,
         {total('i.price')} AS revenue,
         {total_mean('i.price')} AS avg_item_price,
         {mean('o.delivery_days')} AS avg_delivery_days,
         {total_mean('r.avg_score')} AS score,
         CAST(SUM(CASE WHEN o.is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_orders,
         COUNT(DISTINCT i.product_id) AS unique_products
  FROM s_order_items i
  JOIN s_orders o ON i.order_id = o.order_id AND o.order_status = 'delivered'
  LEFT JOIN rv r ON i.order_id = r.order_id
  GROUP BY i.seller_id)
SELECT ps.seller_id, ps.total_orders, {round2('ps.revenue')} AS total_revenue,
       ps.avg_item_price, ps.avg_delivery_days,
       {round2('ps.score')} AS avg_review_score,
       ps.late_orders, ps.unique_products,
       s.seller_zip_code_prefix, s.seller_city, s.seller_state,
       {round2(pct('ps.late_orders', 'ps.total_orders'))} AS late_rate
FROM ps LEFT JOIN s_sellers s ON ps.seller_id = s.seller_id"""


def seller_performance_sql() -> str:
    return _mart(layer_ctes("order_items", "orders", "sellers", "order_reviews"), SELLER_TAIL)


DERIVED_NAMES = {
    "orders": ["order_year", "order_month", "order_dow", "delivery_days", "is_late"],
    "order_items": ["total_item_value"],
    "products": ["category"],
}


MART_COLUMNS = {
    "gold_sales_summary": [
        "order_year", "order_month", "order_date", "total_orders", "total_revenue", "avg_order_value",
        "total_items_sold", "total_freight", "avg_delivery_days", "late_deliveries", "late_delivery_rate",
        "revenue_per_item"],
    "gold_product_performance": [
        "product_id", "category", "total_orders", "total_revenue", "avg_price", "total_freight", "avg_rating",
        "unique_orders", "revenue_rank", "freight_ratio"],
    "gold_customer_segments": [
        "customer_id", "customer_state", "customer_city", "recency_days", "frequency", "monetary", "segment"],
    "gold_seller_performance": [
        "seller_id", "total_orders", "total_revenue", "avg_item_price", "avg_delivery_days", "avg_review_score",
        "late_orders", "unique_products", "seller_zip_code_prefix", "seller_city", "seller_state", "late_rate"],
}


def silver_columns(table: str) -> list[str]:
    return [*silver_output_columns(table), *DERIVED_NAMES.get(table, [])]
