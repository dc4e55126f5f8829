"""The expected result of every registered query."""

from __future__ import annotations

from fixtures.oracle import (
    KINDS,
    big,
    countif,
    load_counts,
    money_avg,
    money_sum,
    nearest,
    parsed,
    pct,
    record_text,
)


def _all(table: str) -> str:
    return f"SELECT * FROM {table}"


def _drop_row_no(table: str) -> str:
    return f"SELECT * EXCLUDE (row_no) FROM {table}"


def _avg2(x: str) -> str:
    return f"CAST({nearest(f'100 * sum({x})', f'count({x})')} AS DOUBLE) / 100"


def _distribution(table: str, column: str) -> str:
    return (
        f"SELECT {column}, count(*) AS n_rows,"
        f" {pct('count(*)', f'(SELECT count(*) FROM {table})')} AS pct FROM {table} GROUP BY {column}"
    )


# Declared tests, by table.
# The declared column tests and accepted values.
NOT_NULL = {
    "orders_enriched": ["order_id", "customer_id", "order_status"],
    "order_items_enriched": ["order_id", "product_id", "seller_id"],
    "payments": ["order_id", "payment_value"],
    "geolocation_deduped": ["zip_code_prefix"],
    "stg_orders": ["order_id", "customer_id", "order_status"],
    "stg_order_items": ["order_id", "product_id", "seller_id", "price"],
    "stg_payments": ["order_id", "payment_value"],
    "stg_geolocation": ["zip_code_prefix", "latitude", "longitude"],
    "mart_order_kpis": ["order_month", "total_orders", "gmv_brl"],
    "mart_seller_performance": ["seller_id", "total_revenue_brl"],
    "mart_delivery_performance": ["customer_state"],
    "mart_geo_sales": ["state", "total_gmv_brl"],
    "mart_payment_analysis": ["payment_type", "order_month"],
}
UNIQUE = [
    "orders_enriched.order_id",
    "geolocation_deduped.zip_code_prefix",
    "stg_orders.order_id",
    "stg_geolocation.zip_code_prefix",
    "mart_order_kpis.order_month",
    "mart_seller_performance.seller_id",
    "mart_delivery_performance.customer_state",
    "mart_geo_sales.state",
]
PAYMENT_TYPES = "'Credit Card','Boleto','Voucher','Debit Card','Unknown'"
ACCEPTED = {
    "stg_orders.order_status": "'delivered','shipped','canceled','invoiced','processing','unavailable',"
                               "'created','approved'",
    "stg_payments.payment_type": PAYMENT_TYPES,
    "mart_seller_performance.seller_tier": "'Bronze','Silver','Gold','Platinum'",
    "mart_delivery_performance.delivery_grade": "'Excellent','Good','Needs Improvement','Poor'",
}


def _test(column: str, test: str, failures: str, rest: str) -> str:
    table, name = column.split(".")
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{test}' AS test,"
        f" {failures} AS failures {rest}"
    )


_TESTS = {
    "not_null": [
        _test(f"{t}.{c}", "not_null", "count(*)", f"FROM {t} WHERE {c} IS NULL")
        for t, names in NOT_NULL.items() for c in names
    ],
    "unique": [
        _test(c, "unique", f"count(DISTINCT {c.split('.')[1]})",
              "FROM {0} WHERE {1} IN (SELECT {1} FROM {0} GROUP BY 1 HAVING count(*) > 1)".format(*c.split(".")))
        for c in UNIQUE
    ],
    "accepted_values": [
        _test(c, "accepted_values", f"count(DISTINCT {c.split('.')[1]})",
              f"FROM {c.split('.')[0]} WHERE {c.split('.')[1]} NOT IN ({values})")
        for c, values in ACCEPTED.items()
    ],
}


def _tests(*kinds: str) -> str:
    return "\nUNION ALL ".join(sql for kind in kinds for sql in _TESTS[kind])


KEYS = {
    "orders": "order_id", "order_items": "order_id, order_item_id",
    "payments": "order_id, payment_sequential", "reviews": "review_id", "customers": "customer_id",
    "products": "product_id", "sellers": "seller_id", "category_translation": "product_category_name",
}
PARENTS = [
    ("reviews.order_id", "orders.order_id"),
    ("payments.order_id", "orders.order_id"),
    ("order_items.order_id", "orders.order_id"),
    ("orders.customer_id", "customers.customer_id"),
    ("order_items.product_id", "products.product_id"),
    ("order_items.seller_id", "sellers.seller_id"),
    ("customers.customer_zip_code_prefix", "geolocation.geolocation_zip_code_prefix"),
    ("sellers.seller_zip_code_prefix", "geolocation.geolocation_zip_code_prefix"),
    ("products.product_category_name", "category_translation.product_category_name"),
]


def _orphans(child: str, parent: str) -> str:
    (ct, cc), (pt, pc) = child.split("."), parent.split(".")
    return (
        f"SELECT '{child}' AS child, '{parent}' AS parent, count(*) AS orphans FROM raw_{ct}"
        f" WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM raw_{pt})"
    )


_LOADS = [load_counts(t, 0) for t in KINDS] + [
    "SELECT 'reviews' AS table_name, count(*) FILTER (WHERE len(f) <= 7) AS row_count,"
    " count(*) FILTER (WHERE len(f) > 7) AS bad_records, CAST(500 AS BIGINT) AS max_bad"
    " FROM review_fields"
]
_COUNTED = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}" for t in [*KINDS, "reviews"]
)
_KEYED = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {big('0')} AS null_keys, (SELECT count(*) FROM"
    f" (SELECT {k} FROM raw_{t} GROUP BY {k} HAVING count(*) > 1) d) AS duplicate_keys"
    for t, k in KEYS.items()
)
_PARENTS = " UNION ALL ".join(_orphans(c, p) for c, p in PARENTS)
_RATES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS null_rows,"
    f" {pct(f'count(*) - count({c})', 'count(*)')} AS null_pct FROM raw_orders"
    for c in ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
              "order_estimated_delivery_date")
)
_LOADED = " UNION ALL ".join(_LOADS)
_SHORT = {"order_items": "items", "category_translation": "translation"}

EXPECTED: dict[str, str] = {
    **{f"parse_{_SHORT.get(t, t)}": parsed(t) for t in KINDS},
    "parse_rejects": " UNION ALL ".join(record_text(t) for t in KINDS),
    "raw_load_counts": f"SELECT table_name, row_count FROM ({_LOADED}) t ORDER BY row_count DESC",
    "bad_record_budget": f"SELECT *, bad_records <= max_bad AS passes FROM ({_LOADED}) t",
    "partition_pruned_orders": """
        SELECT order_id, order_status, order_purchase_timestamp FROM raw_orders
        WHERE order_purchase_timestamp BETWEEN TIMESTAMP '1996-01-15 00:00:00'
          AND TIMESTAMP '1996-06-30 23:59:59'""",
    "partition_stats": """
        SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, count(*) AS n_rows
        FROM raw_orders GROUP BY 1""",
    "quoted_csv_customers": _drop_row_no("raw_customers"),
    "stream_ingest_orders": parsed("orders"),
    "stream_ingest_items": parsed("order_items"),
    "stream_ingest_geolocation": parsed("geolocation"),
    "raw_load_orders": parsed("orders"),
    "delivery_delay": "SELECT order_id, delivery_delay_days, is_late_delivery FROM orders_delayed",
    "lookup_orders_customers": """
        SELECT o.* EXCLUDE (row_no), customer_state, customer_city, customer_zip_code_prefix,
               customer_unique_id
        FROM raw_orders o LEFT JOIN raw_customers c ON o.customer_id = c.customer_id""",
    "lookup_items_sellers": _drop_row_no("items_sellers"),
    "lookup_items_products": """
        SELECT i.* EXCLUDE (row_no), coalesce(p.product_category_name, '') AS product_category_name
        FROM raw_order_items i LEFT JOIN raw_products p ON i.product_id = p.product_id""",
    "lookup_items_translation": "SELECT * EXCLUDE (seller_state, seller_city) FROM order_items_enriched",
    "stg_customers": _drop_row_no("raw_customers"),
    "stg_products": _drop_row_no("raw_products"),
    "stg_sellers": _drop_row_no("raw_sellers"),
    "row_counts": _COUNTED,
    "dq_primary_keys": _KEYED,
    "dq_orphans": _PARENTS,
    "dq_null_rates": _RATES,
    "dq_status_dist": _distribution("raw_orders", "order_status"),
    "dq_payment_dist": _distribution("raw_payments", "payment_type"),
    "dq_date_range": """
        SELECT min(order_purchase_timestamp) AS first_at, max(order_purchase_timestamp) AS last_at,
               count(DISTINCT strftime(order_purchase_timestamp, '%Y-%m')) AS months
        FROM raw_orders""",
    "dq_total_gmv": f"SELECT {money_sum('price')} AS gmv_brl FROM raw_order_items",
    "dq_multi_zip": """
        SELECT geolocation_zip_code_prefix, count(*) AS n_rows FROM raw_geolocation
        GROUP BY 1 HAVING count(*) > 1""",
    "dq_positive_price": "SELECT * EXCLUDE (row_no) FROM raw_order_items WHERE price <= 0",
    "kpi_customers_by_state": """
        SELECT customer_state, count(DISTINCT customer_unique_id) AS customers
        FROM raw_customers GROUP BY 1""",
    "payments_raw": _all("payments"),
    **{
        name: _all(name)
        for name in (
            "orders_enriched", "order_items_enriched", "geolocation_deduped", "stg_orders",
            "stg_order_items", "stg_payments", "stg_geolocation", "order_values", "order_payments",
            "seller_rollup", "top_category_per_seller", "state_rollup", "state_centroid",
            "mart_order_kpis", "mart_seller_performance", "mart_delivery_performance",
            "mart_geo_sales", "mart_payment_analysis", "reviews_clean", "reviews_typed",
        )
    },
    "sold_items": """
        SELECT order_id, seller_id, seller_state, seller_city, price, total_item_value, category_display,
               delivery_delay_days, is_late_delivery, order_month
        FROM sold""",
    "paid_orders": _all("paid"),
    "order_totals": _all("order_totals"),
    "payment_share": "SELECT payment_type, order_month, pct_of_monthly_orders FROM mart_payment_analysis",
    "kpi_category_revenue": f"""
        SELECT category_display, {money_sum('price')} AS revenue_brl, count(*) AS items_sold,
               count(DISTINCT order_id) AS orders
        FROM sold GROUP BY 1""",
    "kpi_on_time_rate": f"""
        SELECT count(*) AS deliveries, {countif('delivery_delay_days <= 0')} AS on_time,
               {pct(countif('delivery_delay_days <= 0'), 'count(*)')} AS on_time_pct
        FROM delivered WHERE delivery_delay_days IS NOT NULL""",
    "kpi_aov_by_payment": f"""
        SELECT payment_type, count(*) AS orders, {money_avg('paid_by_order')} AS aov_brl
        FROM (SELECT order_id, payment_type, {money_sum('payment_value')} AS paid_by_order
              FROM paid GROUP BY 1, 2) t
        GROUP BY 1""",
    "kpi_monthly_active": """
        SELECT order_month, active_customers,
               active_customers - lag(active_customers) OVER (ORDER BY order_month) AS change
        FROM (SELECT order_month, count(DISTINCT customer_unique_id) AS active_customers
              FROM stg_orders GROUP BY 1) t""",
    "kpi_customer_ltv": f"""
        SELECT customer_unique_id, count(*) AS orders,
               coalesce({money_sum('v')}, 0) AS lifetime_value_brl,
               min(order_purchase_timestamp) AS first_order_at,
               max(order_purchase_timestamp) AS last_order_at, {money_avg('v')} AS avg_order_value_brl
        FROM (SELECT d.*, total_order_value AS v FROM delivered d LEFT JOIN order_values USING (order_id)) t
        GROUP BY 1""",
    "kpi_processing_hours": """
        SELECT order_id, (epoch(order_approved_at) - epoch(order_purchase_timestamp)) / 3600.0::DOUBLE
                 AS processing_time_hours
        FROM stg_orders""",
    "kpi_status_by_month": """
        SELECT order_month, order_status, count(*) AS orders FROM stg_orders GROUP BY 1, 2""",
    "dq_not_null": _tests("not_null"),
    "dq_unique": _tests("unique"),
    "dq_accepted_values": _tests("accepted_values"),
    "dq_unexpected_payment_types": f"""
        SELECT payment_type, count(*) AS n_rows FROM stg_payments
        WHERE payment_type NOT IN ({PAYMENT_TYPES}) GROUP BY 1""",
    "dq_validations": f"""
        SELECT * FROM (WITH keys AS ({_KEYED}), parents AS ({_PARENTS}), found AS (
          SELECT 'row_count' AS validation, table_name AS subject, row_count AS measure, row_count > 0 AS passes
          FROM ({_COUNTED})
          UNION ALL SELECT 'null_keys', table_name, null_keys, null_keys = 0 FROM keys
          UNION ALL SELECT 'duplicate_keys', table_name, duplicate_keys, duplicate_keys = 0 FROM keys
          UNION ALL SELECT 'orphans', child, orphans, orphans = 0 FROM parents
          UNION ALL SELECT 'null_rate', column_name, null_pct, NULL FROM ({_RATES})
          UNION ALL SELECT 'order_status', 'orders', count(DISTINCT order_status), count(*) = 0
            FROM raw_orders WHERE order_status NOT IN ({ACCEPTED["stg_orders.order_status"]})
          UNION ALL SELECT 'payment_type', 'payments', count(DISTINCT payment_type), NULL FROM raw_payments
          UNION ALL SELECT 'date_range', 'orders',
            count(DISTINCT strftime(order_purchase_timestamp, '%Y-%m')), count(*) > 0 FROM raw_orders
          UNION ALL SELECT 'total_gmv', 'order_items', {money_sum('price')}, sum(price) > 0 FROM raw_order_items
          UNION ALL SELECT 'multi_row_zip', 'geolocation', count(*), NULL FROM (
            SELECT 1 FROM raw_geolocation GROUP BY geolocation_zip_code_prefix HAVING count(*) > 1)
          UNION ALL SELECT 'positive_price', 'order_items', count(*), count(*) = 0
            FROM raw_order_items WHERE price <= 0)
        SELECT validation, subject, CAST(measure AS DOUBLE) AS measure,
               CASE WHEN passes IS NULL THEN 'info' WHEN passes THEN 'pass' ELSE 'fail' END AS status
        FROM found) r""",
    "dq_report": f"""
        SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
        FROM ({_tests('not_null', 'unique', 'accepted_values')}) t""",
    **{
        f"incremental_{name}": _all(name)
        for name in (
            "mart_order_kpis", "mart_seller_performance", "mart_delivery_performance", "mart_geo_sales",
            "mart_payment_analysis",
        )
    },
    "raw_load_reviews": """
        SELECT review_id, order_id, review_score, nullif(review_comment_title, '') AS review_comment_title,
               nullif(replace(text, chr(13) || chr(10), chr(10)), '') AS review_comment_message,
               review_creation_date, review_answer_timestamp
        FROM raw_reviews JOIN (SELECT doc_id AS row_no, text FROM documents) d USING (row_no)""",
    "reviews_stats": f"""
        SELECT {countif("outcome <> 'skipped'")} AS total_output,
               {countif("outcome = 'already_good'")} AS already_good,
               {countif("outcome = 'reconstructed'")} AS reconstructed,
               {countif("outcome = 'skipped'")} AS skipped,
               {pct(countif("outcome <> 'skipped'"), 'count(*)')} AS recovery_rate
        FROM review_rows""",
    "kpi_review_by_state": f"""
        SELECT seller_state, {_avg2('review_score')} AS avg_score, count(*) AS reviews
        FROM reviews_typed JOIN (SELECT DISTINCT order_id, seller_state FROM stg_order_items) s
          USING (order_id)
        GROUP BY 1""",
    "kpi_review_dist": _distribution("reviews_typed", "review_score").replace("n_rows", "reviews"),
    "kpi_score_by_delivery": f"""
        SELECT is_late_delivery, {_avg2('review_score')} AS avg_score, count(*) AS reviews
        FROM reviews_typed JOIN stg_orders USING (order_id) GROUP BY 1""",
}
