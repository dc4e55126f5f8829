"""Declared KPIs: figures the product names without defining them; the plain reading of each name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retailmarts.functions import columns
from retailmarts.functions.exact import mean_2dp, mean_money, money, percent, sum_units
from retailmarts.operators.lookup import JOINED, attach
from retailmarts.operators.rollups import delivered, distribution, item_totals

_MEAN_SCORE = mean_2dp("sum(review_score)", "count(*)")


def category_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered revenue, items and orders per shown category."""
    sold = items.select("order_id", "price", "category_display").join(
        delivered(orders).select("order_id"), "order_id"
    )
    return sold.groupBy("category_display").agg(
        *columns(
            revenue_brl=money(sum_units("price")),
            items_sold="count(*)",
            orders="count(DISTINCT order_id)",
        )
    )


def review_by_state(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Mean score and reviews per seller state; an order of two states counts in both."""
    places = items.select("order_id", "seller_state").distinct()
    return (
        reviews.select("order_id", "review_score")
        .join(places, "order_id")
        .groupBy("seller_state")
        .agg(*columns(avg_score=_MEAN_SCORE, reviews="count(*)"))
    )


def on_time_rate(orders: DataFrame) -> DataFrame:
    """Share of delivered orders that arrived on or before the estimate."""
    on_time = "count_if(delivery_delay_days <= 0)"
    return delivered(orders).where("delivery_delay_days IS NOT NULL").agg(
        *columns(deliveries="count(*)", on_time=on_time, on_time_pct=percent(on_time, "count(*)"))
    )


def aov_by_payment(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean amount an order paid by each payment type, delivered orders."""
    per_order = (
        payments.join(delivered(orders).select("order_id"), "order_id")
        .groupBy("order_id", "payment_type")
        .agg(*columns(paid=sum_units("payment_value")))
    )
    return per_order.groupBy("payment_type").agg(
        *columns(orders="count(*)", aov_brl=mean_money("sum(paid)", "count(paid)"))
    )


def monthly_active(orders: DataFrame) -> DataFrame:
    """Distinct customers per month and the change from the month before."""
    months = orders.groupBy("order_month").agg(
        *columns(active_customers="count(DISTINCT customer_unique_id)")
    )
    # One row per month is left, so a single ordering of them is small at any scale.
    before = "lag(active_customers) OVER (ORDER BY order_month ASC NULLS LAST)"
    return months.select("*", *columns(change=f"active_customers - {before}"))


def customer_ltv(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per customer: delivered orders, their value, first and last of them, mean order value."""
    totals, of_none = item_totals(items)
    customer = ["customer_unique_id"]
    bought = attach(
        delivered(orders).select(*customer, "order_id", "order_purchase_timestamp"), totals, "order_id", of_none, customer
    ).where("customer_unique_id IS NOT NULL")
    per_order = bought.groupBy(*customer, "order_id", JOINED).agg(*columns(
        value="sum(value_units)", valued="count(value_units)", first="min(order_purchase_timestamp)",
        last="max(order_purchase_timestamp)",
    ))
    return per_order.groupBy(*customer).agg(*columns(
        orders="count(order_id)", lifetime_value_brl=money("coalesce(sum(value), 0L)"), first_order_at="min(first)",
        last_order_at="max(last)", avg_order_value_brl=mean_money("sum(value)", "sum(valued)"),
    ))


def processing_hours(orders: DataFrame) -> DataFrame:
    """Hours from purchase to approval of each order."""
    seconds = "(unix_timestamp(order_approved_at) - unix_timestamp(order_purchase_timestamp))"
    return orders.select("order_id", *columns(processing_time_hours=f"{seconds} / 3600D"))


def review_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score with their share."""
    return distribution(reviews, "review_score", counted="reviews")


def score_by_delivery(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean score of reviews of late and of punctual orders; unknown delays stand apart."""
    return (
        reviews.select("order_id", "review_score")
        .join(orders.select("order_id", "is_late_delivery"), "order_id")
        .groupBy("is_late_delivery")
        .agg(*columns(avg_score=_MEAN_SCORE, reviews="count(*)"))
    )


def status_by_month(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_month", "order_status").agg(*columns(orders="count(*)"))


def customers_by_state(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_state").agg(
        *columns(customers="count(DISTINCT customer_unique_id)")
    )
