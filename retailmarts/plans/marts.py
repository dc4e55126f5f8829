"""Staging models → business marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.functions import columns
from retailmarts.functions.exact import mean_1dp, mean_money, money, percent, round_div, sum_units, units
from retailmarts.functions.labels import delivery_grade, seller_tier
from retailmarts.operators.lookup import JOINED, attach, attach_to_few
from retailmarts.operators.rollups import (
    delivered,
    item_totals,
    order_facts,
    state_centroid,
)

#: How each mart is read: columns, and whether the largest come first.
ORDER = {
    "mart_order_kpis": (("order_year", False), ("order_month_num", False)),
    "mart_seller_performance": (("total_revenue_brl", True), ("seller_id", False)),
    "mart_delivery_performance": (("late_pct", True), ("customer_state", False)),
    "mart_geo_sales": (("total_gmv_brl", True), ("state", False)),
    "mart_payment_analysis": (("order_year", False), ("order_month", False), ("total_orders", True), ("payment_type", False)),
}

_MEAN_DELAY = mean_1dp("sum(delivery_delay_days)", "count(delivery_delay_days)")
_LATE = "count_if(is_late_delivery)"
_ORDERS = "count(DISTINCT order_id)"
SELLER = ["seller_id", "seller_state", "seller_city"]
SELLER_SUMS = ["n", "price", "priced", "gmv", "delay", "delayed", "late"]


def kpi_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, *keep: str) -> DataFrame:
    """Delivered orders with what the monthly KPIs add up; ``keep`` are columns of the orders carried along."""
    of_order = [
        "order_id", "order_month", "order_year", "order_month_num", "customer_state",
        "delivery_delay_days", "is_late_delivery", *keep,
    ]
    facts, of_none = order_facts(items, payments)
    return attach(delivered(orders).select(of_order), facts, "order_id", of_none).select(
        *of_order,
        *columns(
            revenue="coalesce(revenue_cents, 0L)",
            freight="coalesce(freight_cents, 0L)",
            value="coalesce(value_cents, 0L)",
            items="coalesce(items, 0L)",
            max_parts="coalesce(max_installments, 1L)",
            parts_tenths="coalesce(installment_tenths, 10L)",
        ),
    )


def mart_order_kpis(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Delivered orders per month: volume, revenue, delivery and payment behaviour."""
    return (
        kpi_orders(orders, items, payments).groupBy("order_month", "order_year", "order_month_num")
        .agg(
            *columns(
                total_orders=_ORDERS,
                states_served="count(DISTINCT customer_state)",
                gmv_brl="sum(revenue) / 100D",
                total_freight_brl="sum(freight) / 100D",
                aov_brl=f"{round_div('sum(value)', 'count(*)')} / 100D",
                total_items_sold="double(sum(items))",
                late_orders=_LATE,
                on_time_orders="count_if(NOT is_late_delivery)",
                avg_delivery_delay_days=_MEAN_DELAY,
                late_delivery_pct=percent(_LATE, _ORDERS),
                avg_installments=f"{round_div('sum(parts_tenths)', 'count(*)')} / 10D",
                avg_max_installments=mean_1dp("sum(max_parts)", "count(*)"),
            )
        )
        .orderBy(F.asc_nulls_last("order_year"), F.asc_nulls_last("order_month_num"))
    )


def sold_items(orders: DataFrame, items: DataFrame, *keep: str) -> DataFrame:
    """Line items of delivered orders, with what the seller figures need and the columns ``keep`` of the orders."""
    return items.select(
        "seller_id", "seller_state", "seller_city", "order_id", "price", "total_item_value",
        "category_display",
    ).join(
        delivered(orders).select("order_id", "delivery_delay_days", "is_late_delivery", "order_month", *keep),
        "order_id",
    )


def seller_figures(sold: DataFrame) -> DataFrame:
    """Per seller: orders, items, revenue, lateness, active months, top category.

    The late percentage divides late items by orders, so it can exceed 100.
    """
    return seller_rows(seller_parts(sold))


def seller_parts(sold: DataFrame, *keys: str) -> DataFrame:
    """One row per seller, month and category (per ``keys``): totals, and the orders that are counted there.

    The sold items lie by order, so the first item of each order and seller is found where they are, and
    the sum of these is the number of distinct orders.  A hot seller's items are combined before the shuffle.
    """
    first = f"row_number() OVER (PARTITION BY {', '.join(['order_id', *SELLER, *keys])} ORDER BY order_month) = 1"
    return sold.select("*", *columns(_first=first)).groupBy(*keys, *SELLER, "order_month", "category_display").agg(
        *columns(
            orders="count_if(_first)",
            n="count(*)",
            price=sum_units("price"),
            priced=f"count({units('price')})",
            gmv=sum_units("total_item_value"),
            delay="sum(delivery_delay_days)",
            delayed="count(delivery_delay_days)",
            late=_LATE,
        )
    )


def seller_rows(parts: DataFrame) -> DataFrame:
    """Totals and items per seller, month and category → one row per seller.

    Of a seller there are few parts, however many its items, so all of them may lie together."""
    top = "first_value(category_display) OVER (PARTITION BY seller_id ORDER BY _of_category DESC, category_display)"
    told = (
        parts.repartition("seller_id")
        .select("*", *columns(_of_category="sum(n) OVER (PARTITION BY seller_id, category_display)"))
        .select("*", *columns(_top=top))
    )
    totals = told.groupBy(*SELLER).agg(*columns(
        months="count(DISTINCT order_month)", top_category="min(_top)", **{c: f"sum({c})" for c in ["orders", *SELLER_SUMS]}
    ))
    return totals.select(
        *SELLER,
        *columns(
            total_orders="orders",
            total_items_sold="n",
            total_revenue_brl=money("price"),
            avg_item_price_brl=mean_money("price", "priced"),
            total_gmv_brl=money("gmv"),
            avg_delivery_delay_days=mean_1dp("delay", "delayed"),
            late_deliveries="late",
            late_delivery_pct=percent("late", "orders"),
            top_category="top_category",
            active_months="months",
        ),
    )


def mart_seller_performance(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per seller with volume, revenue, lateness, top category and tier."""
    return seller_mart(seller_figures(sold_items(orders, items)))


def seller_mart(figures: DataFrame) -> DataFrame:
    return (
        figures
        .select("*", *columns(seller_tier=seller_tier("total_revenue_brl")))
        .orderBy(F.desc_nulls_last("total_revenue_brl"), "seller_id")
    )


def mart_delivery_performance(orders: DataFrame) -> DataFrame:
    """Delivered orders with a known delay, per customer state: how early or late, and a grade."""
    late_pct = percent("count_if(delivery_delay_days > 0)", "count(*)")
    return (
        delivered(orders)
        .where("delivery_delay_days IS NOT NULL")
        .groupBy("customer_state")
        .agg(
            *columns(
                total_delivered_orders=_ORDERS,
                early_deliveries="count_if(delivery_delay_days < 0)",
                on_time_deliveries="count_if(delivery_delay_days = 0)",
                late_deliveries="count_if(delivery_delay_days > 0)",
                very_late_deliveries="count_if(delivery_delay_days > 7)",
                late_pct=late_pct,
                early_pct=percent("count_if(delivery_delay_days < 0)", "count(*)"),
                avg_delay_days=_MEAN_DELAY,
                best_delivery_days="min(delivery_delay_days)",
                worst_delivery_days="max(delivery_delay_days)",
                delivery_grade=delivery_grade(late_pct),
            )
        )
        .orderBy(F.desc_nulls_last("late_pct"), "customer_state")
    )


def order_totals(orders: DataFrame, items: DataFrame, *keep: str) -> DataFrame:
    """Per delivered or shipped order and place: item value in units, NULL without items."""
    place = ["order_id", "customer_state", "customer_zip_code_prefix", *keep]
    moving = orders.where("order_status IN ('delivered', 'shipped')").select(place)
    totals, of_none = item_totals(items)
    return (
        attach(moving, totals, "order_id", of_none, by=place)
        .groupBy(*place, JOINED)
        .agg(*columns(value_units="sum(value_units)"))
        .drop(JOINED)
    )


def state_rollup(totals: DataFrame) -> DataFrame:
    """Per state: orders, total and mean value (orders without items do not count), ZIPs."""
    return totals.withColumnRenamed("customer_state", "state").groupBy("state").agg(
        *columns(
            total_orders=_ORDERS,
            total_gmv_brl=money("sum(value_units)"),
            avg_order_value_brl=mean_money("sum(value_units)", "count(value_units)"),
            distinct_zips="count(DISTINCT customer_zip_code_prefix)",
        )
    )


def mart_geo_sales(orders: DataFrame, items: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Sales per customer state with the state's centre and its rank by value."""
    return geo_mart(state_rollup(order_totals(orders, items)), geolocation)


def geo_mart(states: DataFrame, geolocation: DataFrame) -> DataFrame:
    # One row per state is left, so a single ordering of them is small at any scale.
    rank = "bigint(rank() OVER (ORDER BY total_gmv_brl DESC NULLS LAST))"
    return (
        attach_to_few(states, state_centroid(geolocation), "state")
        .select(
            "state", "total_orders", "total_gmv_brl", "avg_order_value_brl", "distinct_zips",
            "state_lat", "state_lng", *columns(gmv_rank=rank),
        )
        .orderBy(F.desc_nulls_last("total_gmv_brl"), "state")
    )


def paid_orders(payments: DataFrame, orders: DataFrame, *keep: str) -> DataFrame:
    """Payments of delivered orders with the order's month."""
    return payments.join(
        delivered(orders).select("order_id", "order_month", "order_year", *keep), "order_id"
    )


def mart_payment_analysis(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payment type per month: orders, amounts, installments, share of the month's orders.

    An order paid in two ways counts for both, also in the month's total; ``instalment_orders`` counts
    payments.
    """
    return payment_mart(
        paid_orders(payments, orders)
        .groupBy("payment_type", "order_month", "order_year")
        .agg(
            *columns(
                total_orders=_ORDERS,
                total_payment_value_brl=money(sum_units("payment_value")),
                avg_payment_value_brl=mean_money(
                    sum_units("payment_value"), f"count({units('payment_value')})"
                ),
                instalment_orders="count_if(is_instalment_purchase)",
                avg_installments=mean_1dp("sum(payment_installments)", "count(payment_installments)"),
                max_installments="max(payment_installments)",
            )
        )
    )


def payment_mart(figures: DataFrame) -> DataFrame:
    """Figures per payment type and month with their share of the month's orders."""
    month_orders = "(sum(total_orders) OVER (PARTITION BY order_month))"
    return (
        figures
        .select("*", *columns(pct_of_monthly_orders=percent("total_orders", month_orders)))
        .orderBy(
            F.asc_nulls_last("order_year"), F.asc_nulls_last("order_month"),
            F.desc_nulls_last("total_orders"), "payment_type",
        )
    )
