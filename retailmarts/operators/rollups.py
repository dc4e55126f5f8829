"""Aggregations shared by marts and KPIs.

Every one combines rows before its shuffle, and distinct counts shuffle on the counted value as well,
so one hot order, seller or state never lands in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from retailmarts.functions import columns
from retailmarts.functions.exact import mean_1dp, money, percent, round_div, sum_units, total, units
from retailmarts.operators.lookup import of_blank


def delivered(orders: DataFrame) -> DataFrame:
    return orders.where("order_status = 'delivered'")


def order_values(items: DataFrame) -> DataFrame:
    """Per order: revenue, freight, total value, distinct products, items."""
    return items.groupBy("order_id").agg(
        *columns(
            total_revenue=money(sum_units("price")),
            total_freight=money(sum_units("freight_value")),
            total_order_value=money(sum_units("total_item_value")),
            distinct_products="count(DISTINCT product_id)",
            total_items="count(*)",
        )
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """Per order: amount paid, distinct methods, largest and mean number of installments."""
    return payments.groupBy("order_id").agg(
        *columns(
            total_payment_value=money(sum_units("payment_value")),
            payment_methods_used="count(DISTINCT payment_type)",
            max_installments="max(payment_installments)",
            avg_installments=mean_1dp("sum(payment_installments)", "count(payment_installments)"),
        )
    )


_FACTS = {
    "revenue_cents": round_div(total("price"), 100),
    "freight_cents": round_div(total("freight"), 100),
    "value_cents": round_div(total("value"), 100),
    "items": "count(item)",
    "max_installments": "max(parts)",
    "installment_tenths": round_div("(sum(parts) * 10L)", "count(parts)"),
}


def order_facts(items: DataFrame, payments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the monthly KPIs need of items and payments, per order and of the blank order, in whole numbers.

    Stacking both and aggregating once replaces two rollups and two joins by one of each.  Amounts are
    cents, the mean number of installments is in tenths; a measure is NULL where the order has no row
    of its kind.
    """
    none = "CAST(NULL AS BIGINT)"
    item_rows = items.select(
        "order_id",
        *columns(
            price=units("price"),
            freight=units("freight_value"),
            value=units("total_item_value"),
            item="1L",
            parts=none,
        ),
    )
    payment_rows = payments.select(
        "order_id",
        *columns(price=none, freight=none, value=none, item=none, parts="payment_installments"),
    )
    rows = item_rows.unionByName(payment_rows)
    return rows.groupBy("order_id").agg(*columns(**_FACTS)), of_blank(rows, "order_id", **_FACTS)


def item_totals(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Total item value in units, per order and of the blank order."""
    value = {"value_units": sum_units("total_item_value")}
    return items.groupBy("order_id").agg(*columns(**value)), of_blank(items, "order_id", **value)


def top_category_per_seller(sold: DataFrame) -> DataFrame:
    """Per seller: the category with most items; of equal ones the first in the alphabet."""
    place = "row_number() OVER (PARTITION BY seller_id ORDER BY item_count DESC, category_display)"
    return (
        sold.groupBy("seller_id", "category_display")
        .agg(*columns(item_count="count(*)"))
        .select("*", *columns(rn=place))
        .where("rn = 1")
        .selectExpr("seller_id", "category_display AS top_category")
    )


def state_centroid(geolocation: DataFrame) -> DataFrame:
    """Per state: mean of its ZIPs' coordinates, which have six decimals; four are kept."""

    def mean_4dp(coordinate: str) -> str:
        millionths = f"sum(CAST(rint({coordinate} * 1e6D) AS BIGINT))"
        return f"({round_div(millionths, f'(count({coordinate}) * 100L)')} / 1e4D)"

    return geolocation.groupBy("state").agg(
        *columns(state_lat=mean_4dp("latitude"), state_lng=mean_4dp("longitude"))
    )


def distribution(df: DataFrame, column: str, counted: str = "n_rows") -> DataFrame:
    """Rows per value with their share of all rows; the window only sees one row per value."""
    return (
        df.groupBy(column)
        .agg(*columns(**{counted: "count(*)"}))
        .select("*", *columns(pct=percent(counted, f"(sum({counted}) OVER ())")))
    )
