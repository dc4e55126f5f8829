"""What every registered query must return, as SQL over the given tables.

Written from the meaning of each query, not from its Spark code; only the mapping of the given tables
to raw tables is common to both.
"""

from __future__ import annotations

import re


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


def nearest(num: str, den: str) -> str:
    """num / den to the nearest whole number, halves away from zero."""
    return (
        f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END"
        f" * ((2 * abs({num}) + ({den})) // nullif(2 * ({den}), 0)))"
    )


def money_sum(x: str) -> str:
    return f"CAST(sum({cents(x)}) AS DOUBLE) / 100"


def money_avg(x: str) -> str:
    return f"CAST({nearest(f'sum({cents(x)})', f'count({x})')} AS DOUBLE) / 100"


def avg1(x: str) -> str:
    return f"CAST({nearest(f'10 * sum({x})', f'count({x})')} AS DOUBLE) / 10"


def pct(part: str, whole: str) -> str:
    return f"CAST({nearest(f'1000 * ({part})', whole)} AS DOUBLE) / 10"


def countif(predicate: str) -> str:
    return f"count(*) FILTER (WHERE {predicate})"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# Named subqueries; one may use any other.
PARTS: dict[str, str] = {
    "raw_orders": """
        SELECT md5(CAST(o_orderkey AS VARCHAR)) AS order_id,
               md5(CAST(o_custkey AS VARCHAR)) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE 'processing' END AS order_status,
               CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
               CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 48) AS order_approved_at,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3 DAY AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 33 <> 0
                    THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 43 AS INTEGER))
                         + to_seconds((o_orderkey * 7919) % 86400)
               END AS order_delivered_customer_date,
               CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(30 + c_nationkey % 10 AS INTEGER))
                 AS order_estimated_delivery_date,
               o_orderkey AS row_no
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "raw_order_items": """
        SELECT md5(CAST(l_orderkey AS VARCHAR)) AS order_id,
               CAST(l_linenumber AS BIGINT) AS order_item_id,
               md5(CAST(l_partkey AS VARCHAR)) AS product_id,
               md5(CAST(l_suppkey AS VARCHAR)) AS seller_id,
               CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
               CAST(CAST(round(l_extendedprice * 100) AS BIGINT) //
                 CASE l_suppkey % 4 WHEN 0 THEN 100 WHEN 1 THEN 1000 WHEN 2 THEN 10000 ELSE 100000 END
                 AS DOUBLE) / 100 AS price,
               l_quantity AS freight_value,
               l_orderkey * 7 + l_linenumber AS row_no
        FROM lineitem""",
    "raw_payments": """
        SELECT md5(CAST(o_orderkey AS VARCHAR)) AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                    WHEN '3-MEDIUM' THEN 'voucher' WHEN '4-NOT SPECIFIED' THEN 'debit_card'
                    ELSE 'not_defined' END AS payment_type,
               o_orderkey % 24 + 1 AS payment_installments, o_totalprice AS payment_value,
               o_orderkey * 2 + 1 AS row_no
        FROM orders
        UNION ALL
        SELECT md5(CAST(o_orderkey AS VARCHAR)), 2, 'voucher', 1,
               CASE WHEN o_orderkey % 40 = 0 THEN 0.0::DOUBLE
                    ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 10 AS DOUBLE) / 100 END,
               o_orderkey * 2 + 2
        FROM orders WHERE o_orderkey % 20 = 0""",
    "raw_customers": """
        SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_id,
               md5('u' || CAST(c_custkey % 1000 AS VARCHAR)) AS customer_unique_id,
               CAST(c_custkey % 12 AS VARCHAR) AS customer_zip_code_prefix,
               'city_' || CAST(c_custkey % 50 AS VARCHAR) AS customer_city,
               n_name AS customer_state, c_custkey AS row_no
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT md5(CAST(p_partkey AS VARCHAR)) AS product_id,
               CASE WHEN p_partkey % 50 = 0 THEN '' ELSE lower(p_type) END AS product_category_name,
               CAST(length(p_name) AS BIGINT) AS product_name_length,
               CAST(p_size * 10 AS BIGINT) AS product_description_length,
               CASE WHEN p_partkey % 6 <> 0 THEN p_partkey % 6 END AS product_photos_qty,
               CAST(p_size * 100 AS DOUBLE) AS product_weight_g,
               CAST(p_size AS DOUBLE) + 0.5 AS product_length_cm,
               CAST(p_size + 1 AS DOUBLE) AS product_height_cm,
               CAST(p_size + 2 AS DOUBLE) AS product_width_cm, p_partkey AS row_no
        FROM part""",
    "raw_sellers": """
        SELECT md5(CAST(s_suppkey AS VARCHAR)) AS seller_id,
               CAST(s_suppkey % 15 AS VARCHAR) AS seller_zip_code_prefix,
               'city_' || CAST(s_suppkey % 10 AS VARCHAR) AS seller_city,
               n_name AS seller_state, s_suppkey AS row_no
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_geolocation": """
        SELECT CAST(label AS VARCHAR) AS geolocation_zip_code_prefix,
               CAST(embedding[1] AS DOUBLE) AS geolocation_lat,
               CAST(embedding[2] AS DOUBLE) AS geolocation_lng,
               'city_' || CAST(vec_id % 3 AS VARCHAR) AS geolocation_city,
               'NATION_' || CAST(label AS VARCHAR) AS geolocation_state, vec_id AS row_no
        FROM embeddings""",
    "raw_category_translation": """
        SELECT DISTINCT lower(p_type) AS product_category_name,
               'en_' || lower(p_type) AS product_category_name_english,
               CAST(length(p_type) AS BIGINT) AS row_no
        FROM part WHERE p_type <> 'PROMO'""",
    "raw_reviews": """
        SELECT md5('r' || CAST(doc_id AS VARCHAR)) AS review_id,
               md5(CAST(doc_id AS VARCHAR)) AS order_id,
               CAST(doc_id % 5 + 1 AS VARCHAR) AS review_score, source AS review_comment_title,
               regexp_replace(text, '[\\t\\n\\x0b\\x0c\\r"]', ' ', 'g') AS review_comment_message,
               strftime(TIMESTAMP '2018-01-01 00:00:00' + to_hours(doc_id), '%Y-%m-%d %H:%M:%S')
                 AS review_creation_date,
               strftime(TIMESTAMP '2018-01-02 00:00:00' + to_hours(doc_id), '%Y-%m-%d %H:%M:%S')
                 AS review_answer_timestamp,
               doc_id AS row_no
        FROM documents""",
    # The fields a record falls apart into.
    "review_fields": """
        SELECT row_no,
               [CASE WHEN row_no % 50 = 0 THEN 'x' ELSE '' END || review_id, order_id, review_score,
                review_comment_title]
               || CASE WHEN row_no % 4 = 0 THEN string_split(review_comment_message, ',')
                       ELSE [review_comment_message] END
               || [review_creation_date]
               || CASE WHEN row_no % 10 <> 0 THEN [review_answer_timestamp] ELSE [] END AS f,
               row_no % 10 <> 0 AS answered
        FROM raw_reviews""",
    "review_rows": """
        SELECT CASE WHEN len(f) = 7 THEN 'already_good' WHEN row_no % 50 = 0 THEN 'skipped'
                    ELSE 'reconstructed' END AS outcome,
               CASE WHEN len(f) = 7 THEN f ELSE
                 [f[1], f[2], f[3], CASE WHEN len(m) > 0 THEN m[1] ELSE '' END,
                  array_to_string(m[2:], ', '), f[len(f) - CASE WHEN answered THEN 1 ELSE 0 END],
                  CASE WHEN answered THEN f[len(f)] ELSE '' END] END AS r
        FROM (SELECT *, list_transform(f[4:len(f) - CASE WHEN answered THEN 2 ELSE 1 END],
                lambda x: trim(x, ' ' || chr(160) || chr(133) || chr(28) || chr(29) || chr(30) || chr(31)
                  || chr(8194) || chr(8195) || chr(8201) || chr(8239) || chr(8232) || chr(8233)
                  || chr(12288))) AS m
              FROM review_fields) t""",
    "reviews_clean": """
        SELECT r[1] AS review_id, r[2] AS order_id, r[3] AS review_score, r[4] AS review_comment_title,
               r[5] AS review_comment_message, r[6] AS review_creation_date,
               r[7] AS review_answer_timestamp
        FROM review_rows WHERE outcome <> 'skipped'""",
    "reviews_typed": """
        SELECT trim(review_id) AS review_id, trim(order_id) AS order_id,
               CAST(review_score AS BIGINT) AS review_score,
               trim(review_comment_title) AS review_comment_title,
               trim(review_comment_message) AS review_comment_message,
               try_cast(review_creation_date AS TIMESTAMP) AS review_creation_date,
               try_cast(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
        FROM reviews_clean
        WHERE regexp_full_match(review_id, '[a-f0-9]{32}') AND review_score IN ('1','2','3','4','5')
          AND try_cast(review_creation_date AS TIMESTAMP) IS NOT NULL""",
    "orders_delayed": """
        SELECT *,
               CAST(floor((epoch(order_delivered_customer_date) - epoch(order_estimated_delivery_date))
                    / 86400) AS BIGINT) AS delivery_delay_days,
               CAST(floor((epoch(order_delivered_customer_date) - epoch(order_estimated_delivery_date))
                    / 86400) AS BIGINT) > 0 AS is_late_delivery
        FROM raw_orders""",
    "orders_enriched": """
        SELECT o.* EXCLUDE (row_no), customer_state, customer_city, customer_zip_code_prefix,
               customer_unique_id
        FROM orders_delayed o LEFT JOIN raw_customers c ON o.customer_id = c.customer_id""",
    "items_sellers": """
        SELECT i.*, seller_state, seller_city
        FROM raw_order_items i LEFT JOIN raw_sellers s ON i.seller_id = s.seller_id""",
    "items_products": """
        SELECT i.*, coalesce(p.product_category_name, '') AS product_category_name
        FROM items_sellers i LEFT JOIN raw_products p ON i.product_id = p.product_id""",
    "order_items_enriched": """
        SELECT i.* EXCLUDE (row_no),
               coalesce(t.product_category_name_english, '') AS product_category_name_english
        FROM items_products i LEFT JOIN raw_category_translation t
          ON i.product_category_name = t.product_category_name""",
    "payments": "SELECT * EXCLUDE (row_no) FROM raw_payments",
    "geolocation_deduped": """
        SELECT geolocation_zip_code_prefix AS zip_code_prefix,
               round(avg(geolocation_lat), 6) AS avg_lat, round(avg(geolocation_lng), 6) AS avg_lng,
               min(geolocation_state) AS geolocation_state, min(geolocation_city) AS geolocation_city
        FROM raw_geolocation GROUP BY 1""",
    "stg_orders": """
        SELECT *, CAST(order_purchase_timestamp AS DATE) AS order_date,
               strftime(order_purchase_timestamp, '%Y-%m') AS order_month,
               CAST(extract(year FROM order_purchase_timestamp) AS BIGINT) AS order_year,
               CAST(extract(month FROM order_purchase_timestamp) AS BIGINT) AS order_month_num
        FROM orders_enriched
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
          AND order_status IN ('delivered','shipped','canceled','invoiced','processing','unavailable',
                               'created','approved')""",
    "stg_order_items": f"""
        SELECT *, CAST(coalesce({cents('price')}, 0) + coalesce({cents('freight_value')}, 0) AS DOUBLE)
                    / 100 AS total_item_value,
               CASE WHEN product_category_name_english <> '' THEN product_category_name_english
                    WHEN product_category_name <> '' THEN product_category_name
                    ELSE 'unknown' END AS category_display
        FROM order_items_enriched
        WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
          AND price IS NOT NULL""",
    "stg_payments": """
        SELECT order_id, payment_sequential,
               CASE payment_type WHEN 'credit_card' THEN 'Credit Card' WHEN 'boleto' THEN 'Boleto'
                    WHEN 'voucher' THEN 'Voucher' WHEN 'debit_card' THEN 'Debit Card'
                    ELSE coalesce(payment_type, 'Unknown') END AS payment_type,
               payment_installments, payment_value, payment_installments > 1 AS is_instalment_purchase
        FROM payments WHERE order_id IS NOT NULL AND payment_value > 0""",
    "stg_geolocation": """
        SELECT zip_code_prefix, avg_lat AS latitude, avg_lng AS longitude, geolocation_city AS city,
               geolocation_state AS state
        FROM geolocation_deduped""",
    "delivered": "SELECT * FROM stg_orders WHERE order_status = 'delivered'",
    "order_values": f"""
        SELECT order_id, {money_sum('price')} AS total_revenue,
               {money_sum('freight_value')} AS total_freight,
               {money_sum('total_item_value')} AS total_order_value,
               count(DISTINCT product_id) AS distinct_products, count(*) AS total_items
        FROM stg_order_items GROUP BY order_id""",
    "order_payments": f"""
        SELECT order_id, {money_sum('payment_value')} AS total_payment_value,
               count(DISTINCT payment_type) AS payment_methods_used,
               max(payment_installments) AS max_installments,
               {avg1('payment_installments')} AS avg_installments
        FROM stg_payments GROUP BY order_id""",
    "order_grain": """
        SELECT o.*, coalesce(total_revenue, 0) AS revenue, coalesce(total_freight, 0) AS freight,
               coalesce(total_order_value, 0) AS order_value, coalesce(total_items, 0) AS items,
               coalesce(max_installments, 1) AS max_parts,
               CAST(round(coalesce(avg_installments, 1) * 10) AS BIGINT) AS parts_tenths
        FROM delivered o LEFT JOIN order_values v USING (order_id)
        LEFT JOIN order_payments p USING (order_id)""",
    "mart_order_kpis": f"""
        SELECT order_month, order_year, order_month_num,
               count(DISTINCT order_id) AS total_orders,
               count(DISTINCT customer_state) AS states_served,
               {money_sum('revenue')} AS gmv_brl, {money_sum('freight')} AS total_freight_brl,
               {money_avg('order_value')} AS aov_brl,
               CAST(sum(items) AS DOUBLE) AS total_items_sold,
               {countif('is_late_delivery')} AS late_orders,
               {countif('NOT is_late_delivery')} AS on_time_orders,
               {avg1('delivery_delay_days')} AS avg_delivery_delay_days,
               {pct(countif('is_late_delivery'), 'count(DISTINCT order_id)')} AS late_delivery_pct,
               CAST({nearest('sum(parts_tenths)', 'count(*)')} AS DOUBLE) / 10 AS avg_installments,
               {avg1('max_parts')} AS avg_max_installments
        FROM order_grain GROUP BY order_month, order_year, order_month_num""",
    "sold": """
        SELECT i.*, o.delivery_delay_days, o.is_late_delivery, o.order_month
        FROM stg_order_items i JOIN delivered o USING (order_id)""",
    "seller_rollup": f"""
        SELECT seller_id, seller_state, seller_city, count(DISTINCT order_id) AS total_orders,
               count(*) AS total_items_sold, {money_sum('price')} AS total_revenue_brl,
               {money_avg('price')} AS avg_item_price_brl,
               {money_sum('total_item_value')} AS total_gmv_brl,
               {avg1('delivery_delay_days')} AS avg_delivery_delay_days,
               {countif('is_late_delivery')} AS late_deliveries,
               {pct(countif('is_late_delivery'), 'count(DISTINCT order_id)')} AS late_delivery_pct,
               count(DISTINCT order_month) AS active_months
        FROM sold GROUP BY seller_id, seller_state, seller_city""",
    "sold_per_category": "SELECT seller_id, category_display, count(*) AS n FROM sold GROUP BY ALL",
    "top_category_per_seller": """
        SELECT seller_id, first(category_display ORDER BY n DESC, category_display) AS top_category
        FROM sold_per_category GROUP BY seller_id""",
    # Tiers, grades and labels.
    "mart_seller_performance": """
        SELECT s.*, top_category,
               CASE WHEN total_revenue_brl >= 50000 THEN 'Platinum'
                    WHEN total_revenue_brl >= 10000 THEN 'Gold'
                    WHEN total_revenue_brl >= 1000 THEN 'Silver' ELSE 'Bronze' END AS seller_tier
        FROM seller_rollup s LEFT JOIN top_category_per_seller USING (seller_id)""",
    "mart_delivery_performance": f"""
        SELECT *, CASE WHEN late_pct <= 5 THEN 'Excellent' WHEN late_pct <= 15 THEN 'Good'
                       WHEN late_pct <= 25 THEN 'Needs Improvement' ELSE 'Poor' END AS delivery_grade
        FROM (SELECT customer_state, count(DISTINCT order_id) AS total_delivered_orders,
                     {countif('delivery_delay_days < 0')} AS early_deliveries,
                     {countif('delivery_delay_days = 0')} AS on_time_deliveries,
                     {countif('delivery_delay_days > 0')} AS late_deliveries,
                     {countif('delivery_delay_days > 7')} AS very_late_deliveries,
                     {pct(countif('delivery_delay_days > 0'), 'count(*)')} AS late_pct,
                     {pct(countif('delivery_delay_days < 0'), 'count(*)')} AS early_pct,
                     {avg1('delivery_delay_days')} AS avg_delay_days,
                     min(delivery_delay_days) AS best_delivery_days,
                     max(delivery_delay_days) AS worst_delivery_days
              FROM delivered WHERE delivery_delay_days IS NOT NULL GROUP BY customer_state) t""",
    "order_totals": f"""
        SELECT o.order_id, customer_state, customer_zip_code_prefix, {money_sum('total_item_value')}
                 AS order_value
        FROM stg_orders o LEFT JOIN stg_order_items i USING (order_id)
        WHERE order_status IN ('delivered', 'shipped') GROUP BY ALL""",
    "state_rollup": f"""
        SELECT customer_state AS state, count(DISTINCT order_id) AS total_orders,
               {money_sum('order_value')} AS total_gmv_brl,
               {money_avg('order_value')} AS avg_order_value_brl,
               count(DISTINCT customer_zip_code_prefix) AS distinct_zips
        FROM order_totals GROUP BY 1""",
    "state_centroid": "SELECT state, " + ", ".join(
        f"CAST({nearest(f'sum(CAST(round({c} * 1000000) AS BIGINT))', f'100 * count({c})')} AS DOUBLE)"
        f" / 10000 AS {name}"
        for c, name in (("latitude", "state_lat"), ("longitude", "state_lng"))
    ) + " FROM stg_geolocation GROUP BY state",
    "mart_geo_sales": """
        SELECT s.*, state_lat, state_lng,
               rank() OVER (ORDER BY total_gmv_brl DESC NULLS LAST) AS gmv_rank
        FROM state_rollup s LEFT JOIN state_centroid USING (state)""",
    "paid": """
        SELECT p.*, o.order_month, o.order_year
        FROM stg_payments p JOIN delivered o USING (order_id)""",
    "payment_rollup": f"""
        SELECT payment_type, order_month, order_year, count(DISTINCT order_id) AS total_orders,
               {money_sum('payment_value')} AS total_payment_value_brl,
               {money_avg('payment_value')} AS avg_payment_value_brl,
               {countif('is_instalment_purchase')} AS instalment_orders,
               {avg1('payment_installments')} AS avg_installments,
               max(payment_installments) AS max_installments
        FROM paid GROUP BY payment_type, order_month, order_year""",
    "mart_payment_analysis": f"""
        SELECT p.*, {pct('total_orders', 'month_orders')} AS pct_of_monthly_orders
        FROM payment_rollup p JOIN (SELECT order_month AS m, sum(total_orders) AS month_orders
                                    FROM payment_rollup GROUP BY 1) t ON order_month = m""",
}


def query(select: str) -> str:
    """``select`` with the named subqueries it needs, innermost first."""
    order: list[str] = []

    def need(sql: str, user: str = "") -> None:
        for name in PARTS:
            if name != user and name not in order and re.search(rf"(?<![\w.']){name}(?![\w.'(])", sql):
                need(PARTS[name], name)
                if name not in order:
                    order.append(name)

    need(select)
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in order)
    return f"WITH {parts}\n{select}" if order else select


# Columns of the raw tables and their kinds.
KINDS: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "text",
        "customer_id": "text",
        "order_status": "text",
        "order_purchase_timestamp": "instant",
        "order_approved_at": "instant",
        "order_delivered_carrier_date": "instant",
        "order_delivered_customer_date": "instant",
        "order_estimated_delivery_date": "instant",
    },
    "order_items": {
        "order_id": "text",
        "order_item_id": "whole",
        "product_id": "text",
        "seller_id": "text",
        "shipping_limit_date": "instant",
        "price": "decimal",
        "freight_value": "decimal",
    },
    "payments": {
        "order_id": "text",
        "payment_sequential": "whole",
        "payment_type": "text",
        "payment_installments": "whole",
        "payment_value": "decimal",
    },
    "customers": {
        "customer_id": "text",
        "customer_unique_id": "text",
        "customer_zip_code_prefix": "text",
        "customer_city": "text",
        "customer_state": "text",
    },
    "products": {
        "product_id": "text",
        "product_category_name": "text",
        "product_name_length": "whole",
        "product_description_length": "whole",
        "product_photos_qty": "whole",
        "product_weight_g": "decimal",
        "product_length_cm": "decimal",
        "product_height_cm": "decimal",
        "product_width_cm": "decimal",
    },
    "sellers": {
        "seller_id": "text",
        "seller_zip_code_prefix": "text",
        "seller_city": "text",
        "seller_state": "text",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "text",
        "geolocation_lat": "decimal",
        "geolocation_lng": "decimal",
        "geolocation_city": "text",
        "geolocation_state": "text",
    },
    "category_translation": {
        "product_category_name": "text",
        "product_category_name_english": "text",
    },
}


def columns(table: str) -> list[tuple[str, str]]:
    return list(KINDS[table].items())


def parsed(table: str) -> str:
    """The undamaged value of every field that a reader can still make out."""
    cls = "row_no % 31"
    value = {
        "text": "CASE WHEN {cls} = 6 THEN {c} || ', \"q\"' ELSE {c} END",
        "whole": "CASE WHEN {cls} NOT IN (4, 5, 7) THEN {c} END",
        "decimal": "CASE WHEN {cls} = 7 THEN 1000.0::DOUBLE WHEN {cls} NOT IN (4, 5) THEN {c} END",
        "instant": "CASE WHEN {cls} = 7 THEN {c} + INTERVAL 250 MILLISECOND WHEN {cls} NOT IN (4, 5) THEN {c} END",
    }
    shown = ", ".join(f"{value[k].format(c=c, cls=cls)} AS {c}" for c, k in columns(table))
    return f"SELECT {shown} FROM raw_{table} WHERE {cls} NOT IN (1, 2)"


def record_text(table: str) -> str:
    """The undamaged record as text."""
    shown = {
        "text": "{c}", "whole": "coalesce(CAST({c} AS VARCHAR), '')", "decimal": "coalesce(CAST({c} AS VARCHAR), '')",
        "instant": "coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '')",
    }
    fields = [shown[k].format(c=c) for c, k in columns(table)]
    whole, short = (" || ',' || ".join(f) for f in (fields, fields[:-1]))
    return (
        f"SELECT '{table}' AS table_name, substr(CASE WHEN row_no % 31 = 1 THEN {short}"
        f" ELSE {whole} || ',surplus' END, 1, 80) AS record_start"
        f" FROM raw_{table} WHERE row_no % 31 IN (1, 2)"
    )


def load_counts(table: str, max_bad: int) -> str:
    kinds = set(KINDS[table].values())
    bad = ["row_no % 31 = 2"]
    if kinds - {"text"}:
        bad.append("row_no % 31 = 4")
    if "whole" in kinds:
        bad.append("row_no % 31 = 7")
    rule = " OR ".join(bad)
    return (
        f"SELECT '{table}' AS table_name, {countif(f'NOT ({rule})')} AS row_count,"
        f" {countif(rule)} AS bad_records, CAST({max_bad} AS BIGINT) AS max_bad FROM raw_{table}"
    )
