"""DuckDB statements for the registered queries (see :mod:`.queries`)."""

from __future__ import annotations

from stratum.plans import oracle as o

SQL: dict[str, str] = {}

for _t in o.SILVER_TABLES:
    SQL[f"silver_{_t}"] = o.with_ctes(o.layer_ctes(_t), f"SELECT * FROM s_{_t}")

SQL["dedup_latest"] = o.dedup(
    "lineitem", ["l_orderkey", "l_linenumber"],
    ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
     "l_returnflag", "l_linestatus", "l_shipdate"])

SQL["sales_summary"] = o.sales_summary_sql()
SQL["product_performance"] = o.product_performance_sql()
SQL["rfm_segments"] = o.rfm_segments_sql()
SQL["seller_performance"] = o.seller_performance_sql()


def _q(body: str, *silver: str, bronze: tuple[str, ...] = ()) -> str:
    return o.with_ctes(o.layer_ctes(*silver, bronze=bronze), body)


_PROD_COLS = ", ".join(f"p.{c}" for c in o.ROLE_COLUMNS["products"]
                       if c != "product_category_name")

SQL.update({
    "bronze_lineage": _q("SELECT * FROM b_orders", bronze=("orders",)),
    "project_derived": _q(
        "SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
        "price, freight_value, price + freight_value AS total_item_value "
        f"FROM ({o.typed_sql('order_items', 'b_order_items')}) t",
        bronze=("order_items",)),
    "drop_metadata": _q(
        f"SELECT p.product_category_name, {_PROD_COLS}, t.product_category_name_english "
        "FROM b_products p LEFT JOIN b_category_translation t "
        "ON p.product_category_name = t.product_category_name",
        bronze=("products", "category_translation")),
    "project_select": _q(
        "SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM s_orders",
        "orders"),
    "filter_status": _q("SELECT * FROM s_orders WHERE order_status = 'delivered'", "orders"),
    "filter_positive": _q("SELECT * FROM s_order_items WHERE freight_value > 0",
                          "order_items"),
    "filter_not_null": _q(
        "SELECT * FROM s_orders WHERE order_delivered_customer_date IS NOT NULL", "orders"),
    # joins
    "join_left_preagg": _q(
        "SELECT o.order_id, o.customer_id, o.order_purchase_timestamp, "
        "p.total_payment, p.payment_methods_used "
        f"FROM s_orders o LEFT JOIN (SELECT order_id, {o.total('payment_value')} AS total_payment, "
        "COUNT(DISTINCT payment_type) AS payment_methods_used FROM s_order_payments "
        "GROUP BY order_id) p ON o.order_id = p.order_id "
        "WHERE o.order_status = 'delivered'",
        "orders", "order_payments"),
    "join_left_dim": _q(
        "SELECT i.*, p.category FROM s_order_items i "
        "LEFT JOIN s_products p ON i.product_id = p.product_id",
        "order_items", "products"),
    "join_semi_delivered": _q(
        "SELECT * FROM s_order_items WHERE order_id IN "
        "(SELECT order_id FROM s_orders WHERE order_status = 'delivered')",
        "order_items", "orders"),
    "join_inner_filtered": _q(
        "SELECT i.*, o.* EXCLUDE (order_id) FROM s_order_items i "
        "JOIN s_orders o ON i.order_id = o.order_id WHERE o.order_status = 'delivered'",
        "order_items", "orders"),
    # aggregations
    "agg_by_key": _q(
        f"SELECT order_id, {o.total('payment_value')} AS total_payment, "
        "COUNT(payment_type) AS payment_count FROM s_order_payments GROUP BY order_id",
        "order_payments"),
    "agg_expr_key": _q(
        "SELECT order_year, order_month, CAST(order_purchase_timestamp AS DATE) AS order_date, "
        "COUNT(order_id) AS total_orders FROM s_orders GROUP BY 1, 2, 3", "orders"),
    "agg_distinct": _q(
        "SELECT product_id, COUNT(DISTINCT order_id) AS unique_orders, "
        "COUNT(DISTINCT seller_id) AS unique_sellers FROM s_order_items GROUP BY product_id",
        "order_items"),
    "agg_avg": _q(
        f"SELECT seller_id, {o.total_mean('price')} AS avg_item_price, "
        f"{o.total_mean('freight_value')} AS avg_freight FROM s_order_items GROUP BY seller_id",
        "order_items"),
    "agg_two_stage": _q(
        f"SELECT i.seller_id, {o.total_mean('r.avg_score')} AS avg_review_score "
        "FROM s_order_items i LEFT JOIN (SELECT order_id, "
        f"{o.mean('review_score')} AS avg_score FROM s_order_reviews GROUP BY order_id) r "
        "ON i.order_id = r.order_id GROUP BY i.seller_id",
        "order_items", "order_reviews"),
    "agg_conditional": _q(
        "SELECT CAST(order_purchase_timestamp AS DATE) AS order_date, "
        "COUNT(order_id) AS total_orders, "
        "CAST(SUM(CASE WHEN is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_deliveries "
        "FROM s_orders WHERE order_status = 'delivered' GROUP BY 1", "orders"),
    "agg_max": _q(
        "SELECT customer_id, MAX(order_purchase_timestamp) AS last_purchase, "
        "(SELECT MAX(order_purchase_timestamp) FROM s_orders) AS as_of "
        "FROM s_orders GROUP BY customer_id", "orders"),
    "scalar_asof": _q(
        "SELECT customer_id, CAST(date_diff('day', CAST(MAX(order_purchase_timestamp) AS DATE), "
        "CAST((SELECT MAX(order_purchase_timestamp) FROM s_orders) AS DATE)) AS INTEGER) "
        "AS recency_days FROM s_orders WHERE order_status = 'delivered' GROUP BY customer_id",
        "orders"),
    # window and sorts
    "window_rank": _q(
        "SELECT product_id, category, CAST(revenue AS DOUBLE) AS total_revenue, "
        "CAST(RANK() OVER (PARTITION BY category ORDER BY revenue DESC NULLS LAST) AS INTEGER) "
        f"AS revenue_rank FROM (SELECT i.product_id, p.category, {o.total('i.price')} AS revenue "
        "FROM s_order_items i LEFT JOIN s_products p ON i.product_id = p.product_id "
        "GROUP BY i.product_id, p.category) t",
        "order_items", "products"),
    "sort_asc": SQL["sales_summary"] + "\nORDER BY order_date",
    "sort_desc": SQL["product_performance"] + "\nORDER BY total_revenue DESC",
    # scalar functions
    "fn_to_timestamp": (
        "SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS purchase_text, "
        "TRY_CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS purchase_ts, "
        "TRY_CAST(o_orderpriority AS TIMESTAMP) AS priority_ts FROM orders"),
    "fn_date_parts": _q(
        "SELECT order_id, CAST(order_purchase_timestamp AS DATE) AS order_date, order_year, "
        "order_month, order_dow FROM s_orders", "orders"),
    "fn_datediff": _q(
        "SELECT order_id, delivery_days, CAST(date_diff('day', "
        "CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_carrier_date AS DATE)) "
        "AS INTEGER) AS carrier_days FROM s_orders", "orders"),
    "fn_try_cast": (
        "SELECT l_orderkey, l_linenumber, "
        "TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS line_int, "
        "TRY_CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) AS price_double, "
        "TRY_CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) AS price_money, "
        "CAST(l_linenumber AS INTEGER) AS line_decimal_text, "
        "TRY_CAST(l_returnflag AS INTEGER) AS flag_int FROM lineitem"),
    "fn_ratio": _q(
        f"SELECT order_id, order_item_id, {o.pct('freight_value', 'price')} AS freight_pct, "
        f"{o.ratio('price', 'freight_value')} AS price_per_freight FROM s_order_items",
        "order_items"),
    "fn_round": _q(
        f"SELECT order_id, order_item_id, {o.round2(o.pct('freight_value', 'price'))} "
        f"AS freight_pct, {o.round2(o.ratio('price', 'order_item_id'))} AS price_per_line "
        "FROM s_order_items", "order_items"),
    "fn_coalesce": _q(
        "SELECT p.product_id, COALESCE(t.product_category_name_english, "
        "p.product_category_name) AS category FROM b_products p "
        "LEFT JOIN b_category_translation t ON p.product_category_name = t.product_category_name",
        bronze=("products", "category_translation")),
    "fn_is_late": _q(
        "SELECT order_id, order_delivered_customer_date, order_estimated_delivery_date, "
        "is_late FROM s_orders", "orders"),
})


# --- data quality ----------------------------------------------------------------------

def _dq_sql(layer: str, *kinds: str) -> str:
    from stratum.plans import suites
    from stratum.plans.oracle_quality import suites_sql
    if layer == "bronze":
        suite = suites.bronze_suite()
        rels = {t: f"({o.bronze_sql(t)})" for t in suite}
        cols = {t: [*o.ROLE_COLUMNS[t], *o.LINEAGE_COLS] for t in suite}
    elif layer == "silver":
        suite = suites.silver_suite()
        rels = {t: "(" + o.with_ctes(o.layer_ctes(t), f"SELECT * FROM s_{t}") + ")"
                for t in suite}
        cols = {t: o.silver_columns(t) for t in suite}
    else:
        suite = suites.gold_suite()
        rels = {"gold_sales_summary": f"({SQL['sales_summary']})",
                "gold_product_performance": f"({SQL['product_performance']})",
                "gold_customer_segments": f"({SQL['rfm_segments']})",
                "gold_seller_performance": f"({SQL['seller_performance']})"}
        cols = {}
    if kinds:
        suite = {t: [e for e in exps if e.kind in kinds] for t, exps in suite.items()}
        suite = {t: exps for t, exps in suite.items() if exps}
    return suites_sql(rels, cols, suite)


def _dq_text_sql() -> str:
    from stratum.plans import suites
    from stratum.plans.oracle_quality import suites_sql
    return suites_sql({"order_items": _BAD_PRICES}, {}, {"order_items": suites.bronze_suite()["order_items"]})


_DQ = {
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
    "dq_gate": ("gold", ()),
}
for _k, (_layer, _kinds) in _DQ.items():
    SQL[_k] = _dq_sql(_layer, *_kinds)


# --- scans, sinks, layered runs ----------------------------------------------------------

_D1 = ("2026-01-01T06:00:00", "2026-01-01")
_D2 = ("2026-01-02T06:00:00", "2026-01-02")
_ORDERS = f"({o.ROLE_SQL['orders']})"


def _with_lineage(rel: str, table: str, day: tuple[str, str], where: str = "") -> str:
    return f"SELECT r.*, {o.lineage(table, *day)} FROM {rel} r {where}"


def _counts(rels: dict[str, str], columns: dict[str, list[str]] | None = None) -> str:
    """Row count of each relation and, with its ``columns``, its checksum."""
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count"
        + (f", {o.checksum(columns[t])} AS checksum" if columns else "") + f" FROM {rel}"
        for t, rel in rels.items())


_ITEM_TEXT = ", ".join(
    f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" if c == "shipping_limit_date"
    else f"CAST({c} AS VARCHAR) AS {c}" for c in o.ROLE_COLUMNS["order_items"])

_S1 = o.silver_from("orders", "day1_b")
_S2 = o.silver_from("orders", "day2_b")
_DAY1_COLS = ", ".join(
    "'processing' AS order_status" if c == "order_status"
    else "CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date"
    if c == "order_delivered_customer_date" else c
    for c in o.ROLE_COLUMNS["orders"])

_ROLE_RELS = {t: f"({o.ROLE_SQL[t]})" for t in o.ROLE_SQL}
_MARTS = {"gold_sales_summary": "sales_summary", "gold_product_performance": "product_performance",
          "gold_customer_segments": "rfm_segments", "gold_seller_performance": "seller_performance"}
_BRONZE_COLS = {t: [*o.ROLE_COLUMNS[t], *o.LINEAGE_COLS] for t in o.ROLE_SQL}
_BRONZE_HELD = _counts({t: "(" + _with_lineage(rel, t, _D1) + ")" for t, rel in _ROLE_RELS.items()}, _BRONZE_COLS)
_SILVER_HELD = o.with_ctes(o.layer_ctes(*o.SILVER_TABLES), _counts(
    {t: f"s_{t}" for t in o.SILVER_TABLES}, {t: o.silver_columns(t) for t in o.SILVER_TABLES}))
_GOLD_HELD = _counts({t: f"({SQL[q]})" for t, q in _MARTS.items()}, o.MART_COLUMNS)
_BAD_PRICES = ("(SELECT * REPLACE (CASE WHEN order_item_id % 3 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END "
               f"AS price) FROM ({o.ROLE_SQL['order_items']}) r)")

SQL.update({
    "csv_scan": f"SELECT {_ITEM_TEXT} FROM ({o.ROLE_SQL['order_items']}) r",
    "bronze_ingest_report": (
        f"SELECT table_name, row_count, CAST(0 AS BIGINT) AS malformed_rows, checksum FROM ({_BRONZE_HELD}) c\n"
        "UNION ALL\nSELECT 'TOTAL' AS table_name, CAST(SUM(row_count) AS BIGINT), CAST(0 AS BIGINT), NULL "
        f"FROM ({_counts(_ROLE_RELS)}) t"),
    "bronze_partition_overwrite": (
        _with_lineage(_ORDERS, "orders", _D1, "WHERE order_status = 'delivered'")
        + "\nUNION ALL\n" + _with_lineage(_ORDERS, "orders", _D2)),
    "parquet_scan_pruned": _with_lineage(_ORDERS, "orders", _D2),
    "table_scan": SQL["silver_orders"],
    "upsert_first_load": SQL["silver_orders"],
    "gold_overwrite": SQL["sales_summary"],
    "upsert_merge": (
        f"WITH day1_b AS (SELECT {_DAY1_COLS}, {o.lineage('orders', *_D1)} FROM {_ORDERS} r "
        "WHERE order_purchase_timestamp < TIMESTAMP '1998-01-01'),\n"
        f"day2_b AS ({_with_lineage(_ORDERS, 'orders', _D2)} "
        "WHERE order_purchase_timestamp >= TIMESTAMP '1997-01-01'),\n"
        f"s1 AS ({_S1}),\ns2 AS ({_S2})\n"
        "SELECT * FROM s1 WHERE NOT EXISTS (SELECT 1 FROM s2 "
        "WHERE s2.order_id IS NOT DISTINCT FROM s1.order_id)\nUNION ALL\nSELECT * FROM s2"),
    "silver_row_counts": o.with_ctes(
        o.layer_ctes(*o.SILVER_TABLES), _counts({t: f"s_{t}" for t in o.SILVER_TABLES})),
    "silver_pipeline": "SELECT 'silver' AS layer, table_name, row_count, 'created' AS action, checksum "
    f"FROM ({_SILVER_HELD}) c",
    "gold_pipeline": "SELECT 'gold' AS layer, table_name, row_count, 'overwritten' AS action, checksum "
    f"FROM ({_GOLD_HELD}) c",
})
SQL["upsert_after_failed_write"] = SQL["upsert_merge"]
# Whatever way they came in, the refined rows are the same in the end.
SQL["upsert_moved_partition"] = SQL["upsert_backfill"] = SQL["silver_orders"]
SQL["silver_products_all_dates"] = SQL["silver_products"]
SQL["rfm_by_person"] = o.rfm_by_person_sql()


def _layered_report() -> str:
    """Every table of a first run, with each layer's gate."""
    def layer(name: str, action: str, held: str, gate: str) -> str:
        return (f"SELECT '{name}' AS layer, c.table_name, c.row_count, '{action}' AS action, "
                f"g.n AS layer_checks, g.bad AS layer_failed_checks, c.checksum FROM ({held}) c, "
                f"(SELECT COUNT(*) AS n, CAST(COUNT(*) FILTER (WHERE NOT success) AS BIGINT) AS bad FROM ({gate}) r) g")
    return "\nUNION ALL\n".join((
        layer("bronze", "partition_replaced", _BRONZE_HELD, SQL["dq_suite_bronze"]),
        layer("silver", "created", _SILVER_HELD, SQL["dq_suite_silver"]),
        layer("gold", "overwritten", _GOLD_HELD, SQL["dq_suite_gold"])))


def _two_days() -> str:
    """What all tables hold after two runs, the first with older orders."""
    def landed(table: str) -> str:
        first = (f"SELECT {_DAY1_COLS}, {o.lineage(table, *_D1)} FROM {_ORDERS} r "
                 "WHERE order_purchase_timestamp < TIMESTAMP '1998-01-01'"
                 if table == "orders" else _with_lineage(_ROLE_RELS[table], table, _D1))
        return f"({first} UNION ALL {_with_lineage(_ROLE_RELS[table], table, _D2)})"
    bronze = _counts({t: landed(t) for t in _ROLE_RELS}, _BRONZE_COLS)
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}.' || table_name AS table_name, row_count, checksum FROM ({held}) c"
        for layer, held in (("bronze", bronze), ("silver", _SILVER_HELD), ("gold", _GOLD_HELD)))


SQL["pipeline_two_days"] = _two_days()
SQL["dq_bronze_text"] = _dq_text_sql()
SQL["pipeline_end_to_end"] = _layered_report()
# A merge scoped to partition folders must give the same table.
SQL["upsert_merge_partitioned"] = SQL["upsert_merge"]

# Bucket folders, failures on the way and duplicate sources don't change what a merge gives.
SQL["upsert_merge_bucketed"] = SQL["upsert_merge"]
SQL["upsert_retry_first_load"] = f"SELECT *, 'created' AS action FROM ({SQL['silver_orders']}) s"
_DAY1_SILVER = (f"WITH day1_b AS (SELECT {_DAY1_COLS}, {o.lineage('orders', *_D1)} FROM {_ORDERS} r "
                f"WHERE order_purchase_timestamp < TIMESTAMP '1998-01-01') {_S1}")
SQL["upsert_duplicate_keys"] = (f"SELECT 'before' AS state, true AS raised, b.* FROM ({_DAY1_SILVER}) b\nUNION ALL\n"
                                f"SELECT 'after', true, a.* FROM ({SQL['upsert_merge']}) a")
# Of the orders landed on both days the newer row stays, the others have the first day's.
_BACKFILLED = ", ".join("CASE WHEN customer_id % 4 = 0 THEN 'processing' ELSE order_status END AS order_status"
                        if c == "order_status" else c for c in o.ROLE_COLUMNS["orders"])
SQL["upsert_backfill"] = (f"WITH day2_b AS (SELECT {_BACKFILLED}, {o.lineage('orders', *_D2)} FROM {_ORDERS} r) {_S2}")
SQL["csv_scan_mixed_headers"] = SQL["csv_scan"]
_LINE = "order_id || ',' || order_item_id || ',' || product_id"
SQL["bronze_quarantine"] = f"""
WITH lines AS (
  SELECT CASE WHEN order_item_id % 5 = 0 OR order_item_id % 7 = 0 THEN 'quarantine' ELSE 'bronze' END AS kind,
         CASE WHEN order_item_id % 5 = 0 THEN {_LINE} || ',' || seller_id || ',more'
              WHEN order_item_id % 7 = 0 THEN {_LINE} ELSE {_LINE} || ',' || seller_id END AS line
  FROM ({o.ROLE_SQL['order_items']}) r)
SELECT kind, line FROM lines
UNION ALL
SELECT k.kind || ' rows', CAST((SELECT COUNT(*) FROM lines l WHERE l.kind = k.kind) AS VARCHAR)
FROM (VALUES ('bronze'), ('quarantine')) k(kind)"""
_ITEM_COLS = [c for c in o.ROLE_COLUMNS["order_items"] if c not in ("freight_value", "order_item_id")]
SQL["parquet_scan_evolved"] = "\nUNION ALL\n".join(
    f"SELECT {', '.join(_ITEM_COLS)}, CAST(order_item_id AS BIGINT) AS order_item_id, {freight} AS freight_value, "
    f"{gift} AS gift, {o.lineage('order_items', *day)} FROM ({o.ROLE_SQL['order_items']}) r"
    for freight, gift, day in (("CAST(NULL AS DOUBLE)", "CAST(NULL AS BOOLEAN)", _D1), ("freight_value", "order_id % 2 = 0", _D2)))
SQL["silver_names_changed"] = SQL["silver_products"]
SQL["pipeline_gate_blocks_publish"] = (
    "SELECT *, 'gold:gold_sales_summary' AS failed, false AS gold_published, true AS silver_published "
    f"FROM ({_GOLD_HELD}) c")
SQL["sales_summary_incremental"] = SQL["sales_summary"]
